import random

import numpy as np
import pytest

from tallyforge.llm import decontaminate as de

from . import cases


def distance(item, part):
    """Fewest edits from the item to any stretch of part."""
    row = [0] * (len(part) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, v in enumerate(part, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (w != v)))
        row = new
    return min(row)


def edited(rnd, words, n):
    words = list(words)
    for at in sorted(rnd.sample(range(len(words)), n), reverse=True):
        kind = rnd.randrange(3)
        if kind == 0:
            words[at] = f"new{rnd.randrange(99)}"
        elif kind == 1:
            del words[at]
        else:
            words.insert(at, f"more{rnd.randrange(99)}")
    return words


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, hits string")


@pytest.fixture(scope="module")
def case():
    rnd = random.Random(9)
    items = [(i, cases.prose(rnd, rnd.randint(14, 70))) for i in range(25)] + [(100, "Only Four, short words"), (101, "one"), (102, None), (103, ""), (None, cases.prose(rnd, 30))]
    docs = []
    for n in range(150):
        text = cases.prose(rnd, rnd.randint(0, 150)).split()
        if n % 2:
            words = de.words_in(items[n % 25][1])
            at = rnd.randint(0, len(text))
            text[at:at] = edited(rnd, words, rnd.randint(0, len(words) // 5))
        docs.append((n, " ".join(text).upper() if n % 6 == 1 else " ".join(text), None, None, None))
    docs += [(500, "there are ONLY four short\nwords!! here", None, None, None), (501, "and one.", None, None, None), (502, items[-1][1], None, None, None)]
    docs += [(600, None, None, None, None), (601, "", None, None, None), (None, items[3][1], None, None, None), (602, " ".join([items[4][1]] * 50), None, None, None)]
    return items, docs


def by_hand(items, docs):
    out = {}
    for n, (doc_id, text, *_) in enumerate(docs):
        words = de.words_in(text)
        for item_id, item in items:
            own = de.words_in(item)
            if own:
                d = distance(own, words)
                if d <= int(0.2 * len(own) + 1e-9):
                    out[n, item_id] = (doc_id, d, len(own))
    return out


def test_recall_and_precision(spark, case):
    items, docs = case
    expected = by_hand(items, docs)
    numbered = spark.createDataFrame([(n, *d) for n, d in enumerate(docs)], f"n long, {cases.DOCS}").repartition(3)
    for block_words in (1 << 20, 400):
        found = {}
        for r in de.find(cases.clashing(numbered), benchmark(spark, [(i, t, "x") for i, t in items]), block_words=block_words).collect():
            for h in r["hits"]:
                found[r["n"], h["item_id"]] = (r["doc_id"], h["edits"], h["item_words"])
        assert found.keys() <= expected.keys()
        assert all(found[k] == expected[k] for k in found)
        exact = {k for k, (_, d, _) in expected.items() if d == 0}
        assert exact <= found.keys() and len(found) >= 0.9 * len(expected) and len(expected) > 60


def test_edits():
    rnd = random.Random(1)
    for _ in range(200):
        item = [rnd.randint(1, 6) for _ in range(rnd.randint(1, 12))]
        part = [rnd.randint(0, 6) for _ in range(rnd.randint(0, 20))]
        got = de.edits(np.array(item), np.array(part, dtype=np.int64), len(item))
        assert got[0] == distance(item, part)


def test_nothing(spark, case):
    items, docs = case
    docs, none = cases.documents(spark, docs), benchmark(spark, [])
    assert all(r["hits"] == [] for r in de.find(docs, none).collect())
    assert de.find(cases.documents(spark, []), benchmark(spark, [(i, t, "x") for i, t in items])).collect() == []


@pytest.mark.parametrize("length, least", [(17, 1), (18, 1), (20, 1), (22, 1), (25, 1), (29, 1), (30, 0.95), (40, 0.97)])
def test_recall_at_the_limit_by_length(length, least):
    rnd = random.Random(length)
    found = 0
    for trial in range(100):
        words = [f"w{rnd.randrange(5000)}" for _ in range(length)]
        index = de.Index([(1, " ".join(words))], 0.8, 0.99, 4)
        most = length // 5
        if trial % 2:
            for k in range(most):  # evenly spaced substitutions
                words[(2 * k + 1) * length // (2 * most)] = "new"
        else:
            words = edited(rnd, words, most)
        text = ["x"] * rnd.randint(0, 9) + words + ["y"] * 9
        found += bool(index.search(np.array([index.vocabulary.get(w, 0) for w in text], dtype=np.int32), [len(text)])[0])
    assert found >= least * 100


def test_walks_follow_from_the_target():
    needed = {n: de.walks_for(n, n // 5, 0.99, 4) for n in (15, 20, 30, 40, 60, 120)}
    assert needed[15] is None and needed[120] == 1 and all(n is None or n <= de.MOST for n in needed.values())
    assert [n or 99 for n in needed.values()] == sorted((n or 99 for n in needed.values()), reverse=True)
    assert (de.walks_for(40, 8, 0.6, 4) or 99) <= (de.walks_for(40, 8, 0.99, 4) or 99)
    assert de.walks_for(40, 0, 0.999, 4) == 1


@pytest.mark.parametrize("length", [33, 37, 48, 55, 74, 99, 140])
def test_the_target_recall_is_reached(length):
    rnd = random.Random(length)
    found = 0
    for trial in range(200):
        words = [f"w{rnd.randrange(5000)}" for _ in range(length)]
        index = de.Index([(1, " ".join(words))], 0.8, 0.99, 4)
        most = length // 5
        if trial % 2:
            for k in range(most):
                words[(2 * k + 1) * length // (2 * most)] = "new"
        else:
            words = edited(rnd, words, most)
        text = ["x"] * rnd.randint(0, 9) + words + ["y"] * 9
        found += bool(index.search(np.array([index.vocabulary.get(w, 0) for w in text], dtype=np.int32), [len(text)])[0])
    assert found >= 0.97 * 200  # 0.99 less what 200 trials vary
