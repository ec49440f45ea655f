import math
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from tallyforge.llm import lm_score

from . import cases


def tokens(text):
    return [*(text or "").encode().translate(lm_score.LOWER).split(), b"\n"]


def fold(doc_id):
    return crc32(b"" if doc_id is None else str(doc_id).encode()) % 7


def by_hand(rows):
    """Counts, the deleted block's cells and the score of every row."""
    split = [(i, tokens(t)) for i, t, *_ in rows]
    total, rest = [[Counter(), Counter()] for _ in range(2)]
    for i, words in split:
        for counts, kept in ((total, fold(i) != 2), (rest, fold(i) not in (2, 3))):
            if kept:
                counts[0].update(words)
                counts[1].update(zip([b"\n", *words[:-1]], words, strict=True))
    n, m = sum(total[0].values()), sum(rest[0].values())

    def ratio(value, scale):
        return round(lm_score.STEPS * math.log2(value * scale)) if value else lm_score.NONE

    cells = Counter()
    for i, words in split:
        if fold(i) == 3:
            for u, v in zip([b"\n", *words[:-1]], words, strict=True):
                c = rest[0][u]
                pair = rest[1][u, v] / max(c, 1)
                cells[c.bit_length(), ratio(pair, len(rest[0]) + 1), ratio(rest[0][v] / max(m, 1), len(rest[0]) + 1)] += 1
    weights = lm_score._weight_table(lm_score.learn_weights([(*k, n) for k, n in cells.items()]))
    out = []
    for i, words in split:
        base = sum(math.log10((total[0][w] + 1) / (n + len(total[0]) + 1)) for w in words)
        score = 0.0
        for u, v in zip([b"\n", *words[:-1]], words, strict=True):
            a, b, c = weights[total[0][u].bit_length()]
            score += math.log10(a * total[1][u, v] / max(total[0][u], 1) + b * total[0][v] / max(n, 1) + c / (len(total[0]) + 1)) if n else 0
        out.append((i, fold(i) == 2, len(words), sum(total[0][w] > 0 for w in words), n, base, score))
    return out


def compare(found, expected):
    key = lambda r: (r[0] is None, r[0] or 0, r[5])
    found = sorted((tuple(r) for r in found.collect()), key=key)
    expected = sorted(expected, key=key)
    assert [r[:5] for r in found] == [r[:5] for r in expected]
    assert np.allclose([r[5:] for r in found], [r[5:] for r in expected], rtol=1e-9)


def test_against_brute_force(spark):
    compare(lm_score.score(cases.clashing(cases.documents(spark))), by_hand(cases.rows()))


def test_nothing_to_learn_from(spark):
    held = [i for i in range(40) if fold(i) == 2]
    rows = [(i, "some words here", None, None, None) for i in held]
    compare(lm_score.score(cases.documents(spark, rows)), by_hand(rows))
    assert lm_score.score(cases.documents(spark, [])).collect() == []


def test_weights_recover_a_mixture():
    rnd = np.random.default_rng(0)
    two, one = rnd.integers(-4, 40, 3000), rnd.integers(-4, 20, 3000)
    ratios = np.stack([np.exp2(two / lm_score.STEPS), np.exp2(one / lm_score.STEPS), np.ones(3000)], axis=1)
    true = np.array([0.6, 0.3, 0.1])
    counts = np.rint(2000 * (ratios @ true) / (ratios @ true).sum() * 3000).astype(int)
    w = np.array(lm_score.learn_weights([(3, int(a), int(b), int(n)) for a, b, n in zip(two, one, counts, strict=True)])[3])
    start = counts @ np.log(ratios @ np.full(3, 1 / 3))
    assert abs(w.sum() - 1) < 1e-9 and counts @ np.log(ratios @ w) > start


def test_better_than_base_on_held_out(spark):
    held = [r for r in lm_score.score(cases.documents(spark)).collect() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


@pytest.mark.parametrize(("count", "expected"), [(0, 0), (1, 1), (2, 2), (3, 2), (4, 3), (1023, 10), (1024, 11)])
def test_buckets(count, expected):
    assert lm_score.bucket(np.array([count]))[0] == expected
