import random
from collections import Counter

import pytest

from tallyforge.llm import substring_dedup

from . import cases


def by_hand(rows, size):
    split = [(i, (t or "").encode().split()) for i, t, *_ in rows]
    low = {}
    for i, words in split:
        for at in range(len(words) - size + 1):
            window = tuple(words[at : at + size])
            rank = float("inf") if i is None else i
            low[window] = min(rank, low.get(window, rank))
    out = Counter()
    for i, words in split:
        gone = set()
        for at in range(len(words) - size + 1):
            if low[tuple(words[at : at + size])] < (float("inf") if i is None else i):
                gone |= set(range(at, at + size))
        kept = b" ".join(w for n, w in enumerate(words) if n not in gone).decode()
        out[i, len(words), len(gone), kept] += 1
    return out


def result(table):
    return Counter((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in table.collect())


@pytest.mark.parametrize("size", [50, 7, 2])
def test_against_brute_force(spark, size):
    assert result(substring_dedup.remove_repeats(cases.clashing(cases.documents(spark)), size)) == by_hand(cases.rows(), size)


@pytest.mark.parametrize("seed", [1, 2])
def test_few_words(spark, seed, monkeypatch):
    rnd = random.Random(seed)
    rows = [(rnd.randint(-50, 50), " ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 60))), None, None, None) for _ in range(60)]
    assert result(substring_dedup.remove_repeats(cases.documents(spark, rows, 4), 9)) == by_hand(rows, 9)


def test_empty(spark):
    assert substring_dedup.remove_repeats(cases.documents(spark, [])).collect() == []
