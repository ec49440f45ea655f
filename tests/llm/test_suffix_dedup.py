import random
from collections import Counter

import pytest

from tallyforge.llm import suffix_dedup

from . import cases


def by_hand(rows, size):
    data = [(i, (t or "").encode()) for i, t, *_ in rows]
    seen = Counter(b[at : at + size] for _, b in data for at in range(len(b) - size + 1))
    out = Counter()
    for i, b in data:
        gone = bytearray(len(b))
        for at in range(len(b) - size + 1):
            if seen[b[at : at + size]] > 1:
                gone[at : at + size] = b"\1" * size
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[i, len(b), sum(gone), sum(1 for run in bytes(gone).split(b"\0") if run), kept] += 1
    return out


def result(table):
    return Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in table.collect())


@pytest.mark.parametrize("size", [400, 128])
def test_against_brute_force(spark, size):
    assert result(suffix_dedup.remove_repeats(cases.clashing(cases.documents(spark)), size)) == by_hand(cases.rows(), size)


@pytest.mark.parametrize("seed", range(3))
def test_edges_of_repeats(spark, seed):
    rnd = random.Random(seed)
    pool = "".join(rnd.choice("abcdefgh é\n") for _ in range(6000))
    rows = []
    for i in range(50):
        parts = []
        for _ in range(rnd.randint(1, 4)):
            at, n = rnd.randrange(5000), rnd.randint(100, 330)
            parts.append(pool[at : at + n])
            parts.append("".join(rnd.choice("xyz") for _ in range(rnd.choice([0, 0, 1, 5, 200]))))
        rows.append((i, "".join(parts), None, None, None))
    assert result(suffix_dedup.remove_repeats(cases.documents(spark, rows, 4), 150)) == by_hand(rows, 150)


def test_periodic_text_repeats_itself(spark):
    rows = [(1, "a" * 1000, None, None, None), (2, "ab" * 300 + "c", None, None, None), (3, "b" * 399, None, None, None)]
    assert result(suffix_dedup.remove_repeats(cases.documents(spark, rows))) == by_hand(rows, 400)


def test_empty(spark):
    assert suffix_dedup.remove_repeats(cases.documents(spark, [])).collect() == []
