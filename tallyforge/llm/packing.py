"""Best-fit packing of tokenised documents by the sum of squares of open bins.

A document goes where the sum over gaps of (open bins with that gap) squared
becomes smallest, longest documents first.  Lengths are bounded by the
bin, so the state is one count per gap.  Pieces are dealt to shards of about
``shard_rows`` pieces by a hash; a shard is one task's work and shards are
independent, so the number of tasks grows with the input and a shard loses at
most its few open bins.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterator
from functools import cache, cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from ..session import stored
from .common import fresh, small

#: Words a worker remembers, and the length from which they are forgotten first.
REMEMBERED, LONG = 300_000, 8
#: Separators that Python, not the tokenizer, takes for white space.
NOT_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")
#: Words whose normal form and parts need no tables: printable ASCII and Latin-1 letters.
PLAIN = re.compile("[!-~À-ÿ]+").fullmatch
#: The tokenizer's own split of such a word, in lower case (fixed value).
PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+").findall
WORD_END = "</w>"


def _printable() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a printable character: itself, or the next one from 256 on."""
    itself = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in itself]
    return {chr(b): b for b in itself} | {chr(256 + i): b for i, b in enumerate(others)}


class Known(dict):
    """Ids of words, made when first asked for."""

    def __init__(self, make: Callable[[str], bytes]):
        self.make = make

    def __missing__(self, word: str) -> bytes:
        self[word] = ids = self.make(word)
        return ids

    def forget(self) -> None:
        """Long words are rare ones and go first."""
        if len(self) > REMEMBERED:
            kept = {w: ids for w, ids in self.items() if len(w) <= LONG}
            self.clear()
            if len(kept) <= REMEMBERED // 2:
                self.update(kept)


class WordTokenizer:
    """Ids by a tokenizer file, faster for words met before and for plain words.

    The tokenizer drops white space and joins nothing over it, so a text's ids are
    those of its words.  Byte-level merges with a word end are the same merges as
    ranked ones in which the byte 255, which no UTF-8 has, stands for the word end.
    Any other word, or tokenizer, goes to the tokenizer itself.
    """

    def __init__(self, path: str):
        self.path = path
        self.known = Known(self._new)
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        self.special = [t["content"][:2] for t in given["added_tokens"]]
        self.merge = None
        model = given["model"]
        if model["type"] == "BPE" and model.get("end_of_word_suffix") == WORD_END and PARTS.__self__.pattern.split("[")[0] in str(given["pre_tokenizer"]):
            names = {t["content"] for t in given["added_tokens"]}
            byte, ranks = _printable(), {}
            for token, number in model["vocab"].items():
                if token not in names:
                    ends = token.endswith(WORD_END) and token != WORD_END
                    body = token.removesuffix(WORD_END) if ends else token
                    ranks[bytes(byte[c] for c in body) + (b"\xff" if ends else b"")] = number
            self.merge = tiktoken.Encoding("words", pat_str=".+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    @cached_property
    def whole(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)

    def _new(self, word: str) -> bytes:
        if self.merge and PLAIN(word) and not any(s in word for s in self.special):
            ids = [i for part in PARTS(word.lower()) for i in self.merge(part.encode() + b"\xff")]
        else:
            ids = self.whole.encode(word, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if any(c in text for c in NOT_SPACE):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        ids = b"".join(map(self.known.__getitem__, text.split()))
        self.known.forget()
        return ids


@cache
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def token_pieces(docs: DataFrame, tokenizer: str | Callable[[], str], size: int = 2048, end: int = 0) -> DataFrame:
    """``doc_id, piece, start, length, ids`` of every document.

    A document is its ids followed by the id ``end``; only longer ones are cut, into
    pieces of ``size`` ids, the last one shorter.  ids are little-endian unsigned
    32-bit numbers.  A null or empty text is the end id alone.  ``tokenizer`` is the
    path of a word tokenizer's file, or a function that gives it on an executor.
    """
    last = array("I", [end]).tobytes()
    names = ["doc_id", "piece", "start", "length", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_tokenizer(tokenizer() if callable(tokenizer) else tokenizer).encode
        for batch in small(batches):
            rows: list[tuple] = []
            held = 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text or "") + last
                for piece, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at : at + 4 * size]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, part))
                held += len(ids)
                if held >= 1 << 24:
                    yield _rows(rows)
                    rows, held = [], 0
            if rows:
                yield _rows(rows)

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    rows = docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary")


def place(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length in turn.

    Of the open bins that fit, the one that leaves the smallest sum of squares, the
    fullest of several; a new bin only if none fits.  Full bins are not open.
    """
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_at = np.zeros(size + 1, np.int64)  # open bins by how full they are
    held: list[list[int]] = [[] for _ in range(size + 1)]
    never = np.iinfo(np.int64).max
    made = 0
    for i, n in enumerate(lengths.tolist()):
        level = 0
        if n < size:
            # From level h to h + n the sum changes by 2 (N[h + n] - N[h]) + 2; a bin that gets full only leaves.
            now = open_at[1 : size - n + 1]
            change = 2 * (open_at[n + 1 :] - now) + 2
            change[-1] = 1 - 2 * now[-1]
            change[now == 0] = never
            best = len(change) - 1 - int(change[::-1].argmin())
            level = best + 1 if change[best] < never else 0
        if level:
            at = held[level].pop()
            open_at[level] -= 1
        else:
            at, made = made, made + 1
        bins[i], offsets[i] = at, level
        if level + n < size:
            held[level + n].append(at)
            open_at[level + n] += 1
    return bins, offsets


def pack(pieces: DataFrame, size: int = 2048, shard_rows: int = 1 << 16) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``: sequences hold at most ``size`` ids, offsets have no gaps from 0.

    ``pieces`` has ``length`` (1 to ``size``; others raise an error) and any further
    columns, which stay, whatever their names; it is read twice, so pass a stored table.
    No piece is left out.  Equal rows are pieces of their own and go to different shards:
    a shard is dealt by a hash of the row and its number in the table, which stays the
    same for a stored table that is read alike.  Equal lengths are placed in the order of
    the hash.  An empty table gives no rows.
    """
    pieces = pieces.drop("sequence_id", "offset")
    shards = max(1, -(-pieces.count() // shard_rows))
    columns = pieces.columns
    order, shard = fresh("order_of", columns), fresh("shard_of", columns)
    key = F.xxhash64(*[c for c in columns if c != "ids"])
    out = T.StructType(
        [*(T.StructField(f.name, f.dataType) for f in pieces.schema), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", order], ascending=[False, True], kind="stable")
        lengths = rows["length"].to_numpy()
        if len(lengths) and (lengths.min() < 1 or lengths.max() > size):
            raise ValueError(f"a piece is 1 to {size} ids long")
        bins, offsets = place(lengths, size)
        return rows[columns].assign(sequence_id=bins * shards + int(rows[shard].iloc[0]), offset=offsets)

    at = F.xxhash64(F.col(order), F.monotonically_increasing_id())
    dealt = pieces.withColumn(order, key).withColumn(shard, F.pmod(at, F.lit(shards)).cast("int"))
    return dealt.groupBy(shard).applyInPandas(run, out)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` from packed pieces that carry their ids: the pieces joined in order of offset.

    A sequence's offsets differ, so there are no ties; a null ``ids`` counts as no ids.
    Rows that repeat would be joined as often as they are there.  An empty table gives
    no rows.
    """
    return packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts")).selectExpr(
        "sequence_id", "unhex(array_join(transform(parts, p -> hex(p.ids)), '')) AS ids"
    )


def packed_digest(docs: DataFrame, tokenizer: str | Callable[[], str], size: int = 2048) -> DataFrame:
    """Where every piece goes, with the CRC-32 of its ids instead of the ids."""
    pieces = token_pieces(docs, tokenizer, size).selectExpr("doc_id", "piece", "start", "length", "crc32(ids) AS ids_crc32")
    return pack(stored(pieces), size)
