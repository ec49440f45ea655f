"""Repeated passages of words, by fixed blocks as anchors.

With windows of ``size`` words, blocks of ``(size + 1) // 2`` words are cut from every
document without overlap: a window always holds one whole block.  The blocks are the
index; every rolling window of a block's length, in every document, probes it.  A
probe hits when the block is in the index and at least two documents have it.

Hits are extended exactly: each window around a hit, on either side of a repeat,
sends a 96-bit hash of all its words and learns whether a document with a smaller id
has the same window.  Windows that do, taken together, are the maximal exact repeats.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..session import stored
from .chunks import Chunk, Rolling, answered, asked, cut, from_planes, mix, pack_sorted, planes, ranges_of, segments, stored_chunks, unpack_sorted
from .common import words_of

BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class Probes:
    """A chunk's distinct rolling block hashes (48 bits, sorted) and where they are."""

    def __init__(self, chunk: Chunk, block: int):
        hashes = Rolling(chunk.word_hashes()[chunk.words] if len(chunk.words) else np.zeros(0, np.uint64), BASES[0]).all(block)
        self.at = np.flatnonzero(chunk.inside(block))
        self.hashes, self.which = np.unique(hashes[self.at] & np.uint64(0xFFFFFFFFFFFF << 16), return_inverse=True)
        document = chunk.documents()
        self.document = document[self.at] if len(self.at) else self.at
        self.anchor = (self.at - chunk.starts[self.document]) % block == 0 if len(self.at) else np.zeros(0, bool)

    def flags(self) -> tuple[np.ndarray, np.ndarray]:
        """For each hash: it is a block; several documents of the chunk have it."""
        n = len(self.hashes)
        block = np.bincount(self.which[self.anchor], minlength=n) > 0
        low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
        np.minimum.at(low, self.which, self.document)
        np.maximum.at(high, self.which, self.document)
        return block, low < high


def _hits(chunk: Chunk, probes: Probes, block: int, size: int, replies: pd.DataFrame, ranges: int) -> np.ndarray:
    """Starts of the windows around hits."""
    hit = np.zeros(len(probes.hashes), bool)
    bits = dict(zip(replies["range"], replies["data"], strict=True))
    for name, start, stop in cut(probes.hashes, ranges):
        if name in bits:
            hit[start:stop] = np.unpackbits(np.frombuffer(bits[name], np.uint8), count=stop - start)
    marks = np.zeros(len(chunk.words) + 1, np.int32)
    at = probes.at[hit[probes.which]] if len(probes.at) else probes.at
    # A window starting at s holds the block at q when s <= q and q + block <= s + size.
    np.add.at(marks, np.maximum(at - (size - block), 0), 1)
    np.add.at(marks, at + 1, -1)
    inside = chunk.inside(size)
    return np.flatnonzero((np.cumsum(marks)[: len(inside)] > 0) & inside)


class Windows:
    """The windows at ``at``: distinct 96-bit hashes (sorted), the smallest local document of each."""

    def __init__(self, chunk: Chunk, at: np.ndarray, size: int, ranks: np.ndarray):
        self.at = at
        values = chunk.word_hashes()[chunk.words] if len(at) else np.zeros(0, np.uint64)
        first = Rolling(values, BASES[0]).all(size)[at] if len(at) else np.zeros(0, np.uint64)
        second = Rolling(mix(values + np.uint64(1)), BASES[1]).all(size)[at] >> np.uint64(32) if len(at) else first
        order = np.lexsort((second, first))
        a, b = first[order], second[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        self.first, self.second = a[new], b[new]
        self.which = np.empty(len(a), np.int64)
        self.which[order] = np.cumsum(new) - 1
        self.rank = ranks[chunk.documents()[at]] if len(at) else np.zeros(0, np.int64)
        self.least = np.full(len(self.first), np.iinfo(np.int64).max)
        np.minimum.at(self.least, self.which, self.rank)


def _ranks(chunk: Chunk) -> np.ndarray:
    """Ids in order; rows without an id come last."""
    return np.array([np.iinfo(np.int64).max if i is None else i for i in chunk.ids], dtype=np.int64)


def remove_repeats(docs: DataFrame, size: int = 50) -> DataFrame:
    """``doc_id, n_words, n_removed, text``: words left after repeated passages are removed, joined by one space.

    Words are runs without ASCII white space, unchanged.  A word goes if a window of
    ``size`` consecutive words of its document covers it whose word sequence also
    starts in a document with a smaller id.  Windows are judged on the input.  Null and
    blank texts have no words and come back empty.  Rows without an id come after all
    ids; rows with the same id, or without one, do not remove each other's words.
    Repeats inside one document stay.  An empty table gives no rows.
    """
    if size < 2:
        raise ValueError("a window has two words at least")
    block = (size + 1) // 2
    chunks = stored_chunks(docs, words_of)
    ranges = ranges_of(chunks)

    def probe(chunk: Chunk):
        probes = Probes(chunk, block)
        blocks, several = probes.flags()
        for name, start, stop in cut(probes.hashes, ranges):
            yield chunk.number, name, pack_sorted(probes.hashes[start:stop] >> np.uint64(16)), np.packbits(blocks[start:stop]).tobytes(), np.packbits(several[start:stop]).tobytes()

    def found(rows: pd.DataFrame) -> pd.DataFrame:
        arrays = [unpack_sorted(h) for h in rows["hashes"]]
        bits = {c: np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=len(a)) for a, b in zip(arrays, rows[c], strict=True)]) for c in ("blocks", "several")}
        values, which, counts = np.unique(np.concatenate(arrays), return_inverse=True, return_counts=True)
        block_at = np.bincount(which, weights=bits["blocks"], minlength=len(values)) > 0
        hit = (block_at & ((counts > 1) | (np.bincount(which, weights=bits["several"], minlength=len(values)) > 0)))[which]
        replies = [np.packbits(hit[s]).tobytes() if hit[s].any() else None for s in segments(arrays)]
        out = pd.DataFrame({"chunk": rows["chunk"], "range": rows["range"], "data": replies})
        return out[out["data"].notna()]

    hits = stored(
        asked(chunks, probe, "chunk long, range int, hashes binary, blocks binary, several binary").groupBy("range").applyInPandas(found, "chunk long, range int, data binary")
    )

    def windows_of(chunk: Chunk, got: pd.DataFrame) -> Windows:
        at = _hits(chunk, Probes(chunk, block), block, size, got, ranges)
        return Windows(chunk, at, size, _ranks(chunk))

    def confirm(chunk: Chunk, got: pd.DataFrame) -> pd.DataFrame:
        windows = windows_of(chunk, got)
        rows = [
            (
                chunk.number,
                name,
                pack_sorted(windows.first[a:b]),
                planes(windows.second[a:b]),
                planes(windows.least[a:b].view(np.uint64) ^ np.uint64(1 << 63)),
            )
            for name, a, b in cut(windows.first, ranges)
        ]
        return pd.DataFrame(rows, columns=["chunk", "range", "first", "second", "least"])

    def earlier(rows: pd.DataFrame) -> pd.DataFrame:
        first = [unpack_sorted(h) for h in rows["first"]]
        least = np.concatenate([from_planes(x) for x in rows["least"]])
        a, b = np.concatenate(first), np.concatenate([from_planes(x) for x in rows["second"]])
        order = np.lexsort((least, b, a))
        new = np.ones(len(a), bool)
        new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
        lowest = np.empty(len(a), np.uint64)
        lowest[order] = least[order][np.flatnonzero(new)[np.cumsum(new) - 1]]
        replies = [np.packbits(lowest[s] < least[s]).tobytes() if (lowest[s] < least[s]).any() else None for s in segments(first)]
        out = pd.DataFrame({"chunk": rows["chunk"], "range": rows["range"], "seen": replies})
        return out[out["seen"].notna()]

    confirmed = stored(
        answered(chunks, hits, confirm, "chunk long, range int, first binary, second binary, least binary")
        .groupBy("range")
        .applyInPandas(earlier, "chunk long, range int, seen binary")
    )
    replies = hits.selectExpr("chunk", "range", "data", "CAST(NULL AS binary) AS seen").unionByName(
        confirmed.selectExpr("chunk", "range", "CAST(NULL AS binary) AS data", "seen")
    )

    def remove(chunk: Chunk, got: pd.DataFrame) -> pd.DataFrame:
        windows = windows_of(chunk, got[got["data"].notna()])
        bits = {r: b for r, b in zip(got["range"], got["seen"], strict=True) if b is not None}
        seen = np.zeros(len(windows.first), bool)
        for name, a, b in cut(windows.first, ranges):
            if name in bits:
                seen[a:b] = np.unpackbits(np.frombuffer(bits[name], np.uint8), count=b - a)
        gone = seen[windows.which] | (windows.rank > windows.least[windows.which]) if len(windows.which) else np.zeros(0, bool)
        marks = np.zeros(len(chunk.words) + 1, np.int64)
        np.add.at(marks, windows.at[gone], 1)
        np.add.at(marks, windows.at[gone] + size, -1)
        stay = np.cumsum(marks)[: len(chunk.words)] == 0
        names = np.array(chunk.vocabulary, dtype=object)
        kept_text, removed = [], []
        for start, end in zip(chunk.starts.tolist(), chunk.ends.tolist(), strict=True):
            kept = chunk.words[start:end][stay[start:end]]
            removed.append(end - start - len(kept))
            kept_text.append(b" ".join(names[kept].tolist()).decode() if len(kept) else "")
        return pd.DataFrame({"doc_id": pd.array(chunk.ids, dtype="Int64"), "n_words": chunk.lengths, "n_removed": removed, "text": kept_text})

    return answered(chunks, replies, remove, "doc_id long, n_words long, n_removed long, text string")
