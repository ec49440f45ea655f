"""Line deduplication: Bloom filters find suspected repeats, only those are shuffled and confirmed.

First scan: every document sends the 64-bit hashes of its distinct line keys,
packed into one array per task and slot of the hash range.  A slot keeps two
Bloom filters: a hash that the once-seen filter already holds goes to the
twice-seen filter.  The once-seen filter grows with its slot and never leaves
it.  The twice-seen filter holds repeats only; its size is a parameter, so what is
broadcast has a fixed bound.  A filter that is too small makes more
suspects, never fewer.

Second scan: lines that pass the twice-seen filter are suspects.  Their keys are
shuffled and counted as text, so a false positive drops nothing.  Documents
without a suspect are not shuffled at all.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .common import salted_join, LOWER, byte_rows, fresh, small

SLOT_BITS = 9
PROBES = 3
#: Hashes a task holds before it sends them on.
FLUSH = 1 << 20


def line_key(line: bytes) -> bytes:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    return line.strip().translate(LOWER)


def long_keys(text: bytes | None, least: int) -> list[bytes]:
    """The distinct keys of a text with at least ``least`` code points, in order."""
    keys = (k.strip() for k in (text or b"").translate(LOWER).split(b"\n"))
    return list(dict.fromkeys(k for k in keys if len(k) >= least and (k.isascii() or len(k.decode()) >= least)))


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(k) for k in keys], dtype=np.uint64)


def _positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """A column of bit positions for each probe; ``bits`` is a power of two."""
    other = (hashes >> np.uint64(21)) | np.uint64(1)
    return np.stack([(hashes + np.uint64(i) * other) & np.uint64(bits - 1) for i in range(PROBES)])


def _holds(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def _put(bits: np.ndarray, at: np.ndarray) -> None:
    np.bitwise_or.at(bits, (at >> np.uint64(3)).ravel(), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8).ravel())


def _send(found: list[np.ndarray]) -> pa.RecordBatch:
    hashes = np.sort(np.concatenate(found))
    slots = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int32)
    names, first = np.unique(slots, return_index=True)
    packs = [p.tobytes() for p in np.split(hashes, first[1:])]
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(packs, pa.binary())], ["slot", "hashes"])


def twice_seen(docs: DataFrame, least: int, filter_bits: int) -> dict[int, bytes]:
    """The twice-seen filter, a compressed slice per slot; at most ``filter_bits`` bits in all."""
    part = filter_bits >> SLOT_BITS

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in small(batches):
            for text in byte_rows(batch.column(0)):
                if keys := long_keys(text, least):
                    held.append(_hashes(keys))
                    n += len(keys)
                    if n >= FLUSH:
                        yield _send(held)
                        held, n = [], 0
        if held:
            yield _send(held)

    def repeats(rows: pd.DataFrame) -> pd.DataFrame:
        packs = [np.frombuffer(p, dtype=np.uint64) for p in rows["hashes"]]
        size = max(64, 1 << int(16 * sum(map(len, packs)) - 1).bit_length())
        once, twice = np.zeros(size // 8, np.uint8), np.zeros(part // 8, np.uint8)
        for pack in packs:
            values, counts = np.unique(pack, return_counts=True)
            at = _positions(values, size)
            again = values[(counts > 1) | _holds(once, at)]
            _put(once, at)
            _put(twice, _positions(again, part))
        if not twice.any():
            return pd.DataFrame(columns=["slot", "bits"], dtype=object)
        return pd.DataFrame({"slot": rows["slot"].iloc[:1], "bits": [zlib.compress(twice.tobytes(), 1)]})

    sent = docs.select(docs["text"].cast("string")).mapInArrow(send, "slot int, hashes binary")
    return {r["slot"]: r["bits"] for r in sent.groupBy("slot").applyInPandas(repeats, "slot int, bits binary").collect()}


_slices: dict[str, dict[int, np.ndarray]] = {}


def _unpacked(name: str, slices: dict[int, bytes]) -> dict[int, np.ndarray]:
    """The slices of a filter; a worker keeps those of one."""
    if name not in _slices:
        _slices.clear()
        _slices[name] = {slot: np.frombuffer(zlib.decompress(b), np.uint8) for slot, b in slices.items()}
    return _slices[name]


def drop_lines(docs: DataFrame, least: int = 20, min_docs: int = 3, filter_bits: int = 1 << 26) -> DataFrame:
    """Documents without their repeated lines, with ``n_lines`` (before) and ``n_dropped``.

    A key with at least ``least`` code points that ``min_docs`` rows hold loses all
    its lines except in the largest doc_id that holds it.  All columns stay; given
    columns of the two added names are replaced.  A null or empty text is one empty
    line and comes back empty.  Every row counts as a document, also when ids
    repeat; rows of the largest id all keep their lines.  A row without an id never
    keeps a line that some id keeps; a key that only rows without id hold stays.
    """
    docs = docs.drop("n_lines", "n_dropped").withColumn("text", F.col("text").cast("string"))
    spark, columns = docs.sparkSession, docs.columns
    if filter_bits & (filter_bits - 1) or filter_bits >> SLOT_BITS < 64:
        raise ValueError("filter_bits is a power of two, 64 bits a slot at least")
    part = filter_bits >> SLOT_BITS
    seen = spark.sparkContext.broadcast((uuid.uuid4().hex, twice_seen(docs, least, filter_bits)))
    at, drops_name = columns.index("text"), fresh("drops", columns)

    def suspects(texts: list[bytes | None]) -> Iterator[list[bytes] | None]:
        bits = _unpacked(*seen.value)
        for text in texts:
            keys = long_keys(text, least) if bits else []
            hits = []
            if keys:
                hashes = _hashes(keys)
                at_bits = _positions(hashes, part).T
                for key, slot, p in zip(keys, (hashes >> np.uint64(64 - SLOT_BITS)).tolist(), at_bits, strict=True):
                    if slot in bits and _holds(bits[slot], p):
                        hits.append(key)
            yield hits or None

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows with a suspect; the others do not wait for them."""
        for batch in small(batches):
            found = pa.array(suspects(byte_rows(batch.column(at))), pa.list_(pa.binary()))
            yield batch.filter(pa.compute.is_valid(found))

    def clear(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows without a suspect, as they are."""
        for batch in small(batches):
            texts = byte_rows(batch.column(at))
            found = pa.array(suspects(texts), pa.list_(pa.binary()))
            rows = finished(batch, texts, [None] * len(texts))
            yield rows.filter(pa.compute.is_null(found))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            yield finished(batch, byte_rows(batch.column(at)), batch.column(len(columns)).to_pylist())

    def finished(batch: pa.RecordBatch, texts: list[bytes | None], drops: list[list[bytes] | None]) -> pa.RecordBatch:
        kept, before, dropped = [], [], []
        for text, gone in zip(texts, map(set, (d or () for d in drops)), strict=True):
            lines = (text or b"").split(b"\n")
            stay = [x for x in lines if line_key(x) not in gone] if gone else lines
            kept.append(b"\n".join(stay).decode())
            before.append(len(lines))
            dropped.append(len(lines) - len(stay))
        out = list(batch.columns[: len(columns)])
        out[at] = pa.array(kept, pa.string())
        return pa.RecordBatch.from_arrays([*out, pa.array(before, pa.int64()), pa.array(dropped, pa.int64())], [*columns, "n_lines", "n_dropped"])

    binaries = T.ArrayType(T.BinaryType())
    plain = T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema])
    done = T.StructType([*plain, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    # A text's hash stands beside the id, so that rows of one id, or without any, are no group together.
    of, drop_id = fresh("text_hash", columns), fresh("drop_id", columns)
    hashed = docs.select("doc_id", F.xxhash64("text").alias("of"), "text")
    found = stored(
        hashed.mapInArrow(
            lambda batches: (
                pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(suspects(byte_rows(b.column(2))), pa.list_(pa.binary()))], ["doc_id", "of", "keys"]
                )
                for b in small(batches)
            ),
            T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("of", T.LongType()), T.StructField("keys", binaries)]),
        ).select("doc_id", "of", F.explode("keys").alias("key"))
    )
    gone = stored(found.groupBy("key").agg(F.max("doc_id").alias("keeper"), F.count("*").alias("uses")).where(F.col("uses") >= int(min_docs)))
    lost = salted_join(found, gone, ["key"], "uses").where("NOT (doc_id <=> keeper)")
    drops = stored(lost.groupBy("doc_id", "of").agg(F.collect_set("key").alias(drops_name)).withColumnsRenamed({"doc_id": drop_id, "of": of}))
    touched = docs.mapInArrow(marked, plain)
    same = (F.xxhash64(touched["text"]) == drops[of]) & touched["doc_id"].eqNullSafe(drops[drop_id])
    joined = touched.join(drops, same, "left").select(*columns, drops_name)
    return docs.mapInArrow(clear, done).unionByName(joined.mapInArrow(cut, done))
