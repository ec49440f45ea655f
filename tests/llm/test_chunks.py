import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyforge.llm import chunks

from . import cases

NUMBERS = st.lists(st.integers(0, (1 << 64) - 1), max_size=60)


@settings(max_examples=200, deadline=None)
@given(NUMBERS)
def test_packed_arrays_come_back(values):
    array = np.array(values, dtype=np.uint64)
    assert chunks.from_planes(chunks.planes(array)).tolist() == values
    ordered = np.unique(array)
    assert chunks.unpack_sorted(chunks.pack_sorted(ordered)).tolist() == ordered.tolist()


@settings(max_examples=200, deadline=None)
@given(NUMBERS, st.integers(1, 50))
def test_ranges_cover_all_hashes(values, ranges):
    ordered = np.unique(np.array(values, dtype=np.uint64))
    parts = chunks.cut(ordered, ranges)
    assert [n for n, _, _ in parts] == sorted({(v >> 32) * ranges >> 32 for v in ordered.tolist()})
    assert [i for _, a, b in parts for i in range(a, b)] == list(range(len(ordered)))


@pytest.mark.parametrize("size", [1, 3, 7])
def test_rolling_hashes_tell_runs_apart(size):
    values = np.random.default_rng(0).integers(0, 3, 400).astype(np.uint64) + np.uint64(7)
    rolling = chunks.Rolling(values, 0x9E3779B97F4A7C15)
    every = rolling.all(size).tolist()
    runs = [tuple(values[i : i + size].tolist()) for i in range(len(values) - size + 1)]
    assert len(every) == len(runs) and len(set(zip(every, runs, strict=True))) == len(set(every)) == len(set(runs))
    assert rolling.at(np.arange(len(every)), size).tolist() == every
    assert chunks.Rolling(values[:2], 0x9E3779B97F4A7C15).all(3).tolist() == []


@pytest.mark.parametrize("limit", [1, 100, 10**6])
def test_chunks_hold_every_document(spark, monkeypatch, limit):
    """Small chunks are many; nothing else changes."""
    monkeypatch.setattr(chunks, "CHUNK_WORDS", limit)
    docs = cases.documents(spark, partitions=2)
    found = []
    for row in chunks.stored_chunks(docs, bytes.split).collect():
        chunk = chunks.Chunk(row.asDict())
        for i, a, b in zip(chunk.ids, chunk.starts.tolist(), chunk.ends.tolist(), strict=True):
            found.append((i, [chunk.vocabulary[w] for w in chunk.words[a:b]]))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(found, key=key) == sorted(((i, (t or "").encode().split()) for i, t, *_ in cases.rows()), key=key)
    assert chunks.stored_chunks(cases.documents(spark, []), bytes.split).count() == 0
