"""Documents as stored chunks of word numbers, and exchanges of hashes between chunks.

Counting something over all word windows of a corpus, and giving every place its
count back, would shuffle a row for every word.  Here a chunk (the documents of one
task, up to a number of words) asks for all its distinct hashes at once: they are
sorted, cut by hash range and sent as one packed array per range.  A range sees the
arrays of all chunks that have a hash of it and replies with one array each.  A
chunk holds a hash once however often it occurs, so no key is hot, and a range holds
a share of the hash space, so no range is.  Ranges are as many as the input needs.

The chunks themselves are stored in a table bucketed by chunk, so replies are
shuffled to them and they stay where they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ..session import shared_dir
from .common import byte_rows, cores, small, texts

#: Words of a chunk; a longer document is a chunk of its own.
CHUNK_WORDS = 2_000_000
#: Words that share a hash range.
RANGE_WORDS = 3_000_000

#: Bytes of a chunk of texts.
CHUNK_BYTES = 4_000_000

SCHEMA = "chunk long, part int, n_words long, doc_ids binary, lengths binary, words binary, vocabulary binary"
TEXT_SCHEMA = "chunk long, n_bytes long, doc_ids binary, lengths binary, data binary"


class Documents:
    """``ids`` of a chunk's documents, their ``lengths`` and where they start and end."""

    def __init__(self, row):
        self.number = int(row["chunk"])
        self.ids = pa.ipc.open_stream(row["doc_ids"]).read_all().column(0).to_pylist()
        self.lengths = np.frombuffer(row["lengths"], dtype=np.int64)
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths

    def inside(self, size: int) -> np.ndarray:
        """Which runs of ``size`` units lie in one document, by their start."""
        count = max(0, int(self.lengths.sum()) - size + 1)
        marks = np.zeros(count + 1, np.int32)
        some = self.lengths >= size
        marks[self.starts[some]] += 1
        np.subtract.at(marks, self.ends[some] - size + 1, 1)
        return np.cumsum(marks)[:count] > 0

    def documents(self) -> np.ndarray:
        """The rank of each unit's document among the chunk's documents."""
        return np.repeat(np.arange(len(self.lengths)), self.lengths)


class Texts(Documents):
    """``data``: the documents' UTF-8 bytes, one after the other."""

    def __init__(self, row):
        super().__init__(row)
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["data"]), dtype=np.uint8)


class Chunk(Documents):
    """``words`` of the documents as numbers into ``vocabulary``."""

    def __init__(self, row):
        super().__init__(row)
        unpack = zstandard.ZstdDecompressor().decompress
        self.part = int(row["part"])
        self.words = np.frombuffer(unpack(row["words"]), dtype=np.int32)
        text = unpack(row["vocabulary"])
        self.vocabulary = text.split(b"\n") if text else []

    def word_hashes(self) -> np.ndarray:
        """A 64-bit hash for each word of the vocabulary."""
        return np.array([xxhash.xxh3_64_intdigest(w) for w in self.vocabulary], dtype=np.uint64)


def _ids(ids: list) -> bytes:
    sink = pa.BufferOutputStream()
    column = pa.table({"id": pa.array(ids, pa.int64())})
    with pa.ipc.new_stream(sink, column.schema) as writer:
        writer.write_table(column)
    return sink.getvalue().to_pybytes()


def _row(number: int, part: int, ids: list, lengths: list[int], words: list[int], vocabulary: dict[bytes, int]) -> tuple:
    pack = zstandard.ZstdCompressor(3).compress
    return (
        number,
        part,
        len(words),
        _ids(ids),
        np.array(lengths, dtype=np.int64).tobytes(),
        pack(np.array(words, dtype=np.int32).tobytes()),
        pack(b"\n".join(vocabulary)),
    )


def stored_chunks(docs: DataFrame, split: Callable[[bytes], list[bytes]], part_of: Callable[[int | None], int] | None = None) -> DataFrame:
    """The documents as a stored table of chunks, bucketed by chunk.

    ``split`` makes the words of a text; ``part_of`` puts documents into parts by id,
    and a chunk holds one part.  Null texts have no words.
    """
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 24, 0
        held: dict[int, tuple[list, list[int], list[int], dict[bytes, int]]] = {}

        def full(part: int) -> pa.RecordBatch:
            nonlocal made
            row = _row(base + made, part, *held.pop(part))
            made += 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * 4)
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

        for batch in small(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), byte_rows(batch.column(1)), strict=True):
                part = part_of(doc_id) if part_of else 0
                ids, lengths, words, vocabulary = held.setdefault(part, ([], [], [], {}))
                found = split(text) if text else []
                ids.append(doc_id)
                lengths.append(len(found))
                words.extend([vocabulary.setdefault(w, len(vocabulary)) for w in found])
                if len(words) >= CHUNK_WORDS:
                    yield full(part)
        for part in sorted(held):
            yield full(part)

    return _bucketed(texts(docs).mapInArrow(run, SCHEMA))


def _bucketed(rows: DataFrame) -> DataFrame:
    spark = rows.sparkSession
    name, path = f"chunks_{uuid.uuid4().hex}", shared_dir(spark)
    rows.write.format("parquet").option("path", path).option("compression", "none").bucketBy(2 * cores(spark), "chunk").saveAsTable(name)
    return spark.table(name)


def stored_texts(docs: DataFrame) -> DataFrame:
    """The documents' bytes as a stored table of chunks, bucketed by chunk.  Null texts are empty."""
    names = [c.split()[0] for c in TEXT_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 24, 0
        ids, found, size = [], [], 0

        def full() -> pa.RecordBatch:
            lengths = np.array([len(t) for t in found], dtype=np.int64).tobytes()
            row = (base + made, size, _ids(ids), lengths, zstandard.ZstdCompressor(3).compress(b"".join(found)))
            kinds = (pa.int64(), pa.int64(), *[pa.binary()] * 3)
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

        for batch in small(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), byte_rows(batch.column(1)), strict=True):
                ids.append(doc_id)
                found.append(text or b"")
                size += len(found[-1])
                if size >= CHUNK_BYTES:
                    yield full()
                    made += 1
                    ids, found, size = [], [], 0
        if ids:
            yield full()

    return _bucketed(texts(docs).mapInArrow(run, TEXT_SCHEMA))


# --------------------------------------------------------------- packed arrays


def planes(values: np.ndarray) -> bytes:
    """Unsigned numbers, byte by byte of significance, so that rare high bytes compress away."""
    values = values.astype("<u8")
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    return bytes([width]) + np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def from_planes(data: bytes) -> np.ndarray:
    width = data[0]
    got = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((got.shape[1], 8), np.uint8)
    out[:, :width] = got.T
    return out.view("<u8").ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    return planes(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data), dtype=np.uint64)


# ------------------------------------------------------------------- exchanges


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def ranges_of(chunks: DataFrame, size: str = "n_words", each: int = RANGE_WORDS) -> int:
    """Ranges so that one has about ``each`` words (or bytes) of the input to do with."""
    total = chunks.agg({size: "sum"}).first()[0] or 0
    return max(cores(chunks.sparkSession), -(-total // each))


def cut(hashes: np.ndarray, ranges: int) -> list[tuple[int, int, int]]:
    """``range, start, stop`` of sorted hashes; ranges without a hash are left out."""
    at = (((hashes >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)
    names, starts = np.unique(at, return_index=True)
    return list(zip(names.tolist(), starts.tolist(), np.append(starts, len(hashes))[1:].tolist(), strict=True))


def segments(arrays: list[np.ndarray]) -> list[slice]:
    ends = np.cumsum([len(a) for a in arrays]).tolist()
    return [slice(e - len(a), e) for a, e in zip(arrays, ends, strict=True)]


def asked(chunks: DataFrame, ask: Callable[[Documents], Iterator[tuple]], schema: str, kind: type[Documents] = Chunk) -> DataFrame:
    """Rows that ``ask`` makes of each chunk."""
    names = [c.split()[0] for c in schema.split(", ")]

    def frames(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in tables:
            for row in some.to_dict("records"):
                yield pd.DataFrame(list(ask(kind(row))), columns=names)

    return chunks.mapInPandas(frames, schema)


def answered(
    chunks: DataFrame, replies: DataFrame, finish: Callable[[Documents, pd.DataFrame], pd.DataFrame], schema: str, kind: type[Documents] = Chunk
) -> DataFrame:
    """Rows that ``finish`` makes of each chunk and the replies to it."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(rows: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        frames = [finish(kind(row), got) for row in rows.to_dict("records")]
        return pd.concat(frames) if frames else pd.DataFrame(columns=names, dtype=object)

    return chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInPandas(run, schema)


# -------------------------------------------------------------- rolling hashes


@cache
def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


_known_powers: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers; a worker keeps the longest run it needed."""
    if len(_known_powers.get(base, ())) < n:
        out = np.full(n, base, dtype=np.uint64)
        out[0] = 1
        _known_powers[base] = np.multiply.accumulate(out)
    return _known_powers[base][:n] if n else np.zeros(0, np.uint64)


class Rolling:
    """64-bit hashes of runs of values, at any start and length."""

    def __init__(self, values: np.ndarray, base: int):
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * _powers(base, len(values)), out=self.sums[1:])
        self.back = _powers(_inverse(base), len(values) + 1)

    def all(self, size: int) -> np.ndarray:
        """The hash of each run of ``size`` values; empty if there are fewer."""
        if len(self.sums) <= size:
            return np.zeros(0, np.uint64)
        return mix((self.sums[size:] - self.sums[:-size]) * self.back[: len(self.sums) - size])

    def at(self, starts: np.ndarray, size: int) -> np.ndarray:
        return mix((self.sums[starts + size] - self.sums[starts]) * self.back[starts])
