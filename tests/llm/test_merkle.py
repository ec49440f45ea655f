import hashlib
from collections import Counter

import pytest

from tallyforge.llm import merkle

from . import cases


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(i, text, lang, source, n):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def tree(hashes):
    """The top, and of each leaf the (left, right) siblings of each level."""
    steps, level, at = [[] for _ in hashes], hashes, list(range(len(hashes)))
    while len(level) > 1:
        for i, p in enumerate(at):
            run = p // 8 * 8
            steps[i].append(("".join(level[run:p]), "".join(level[p + 1 : run + 8])))
        level = [h(*level[r : r + 8]) for r in range(0, len(level), 8)]
        at = [p // 8 for p in at]
    return level[0], steps


def by_hand(rows, found=lambda t: t):
    groups = {}
    for i, t, lang, source, n in rows:
        groups.setdefault(lang, []).append((i is not None, i or 0, leaf(i, t, lang, source, n), leaf(i, found(t), lang, source, n)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    tops = {g: tree([r[2] for r in sorted(groups[g])]) for g in names}
    root, above = tree([tops[g][0] for g in names])
    out = Counter()
    for g, up in zip(names, above, strict=True):
        for (known, i, own, then), steps in zip(sorted(groups[g]), tops[g][1], strict=True):
            out[i if known else None, own, tops[g][0], root, tuple(steps + up), then] += 1
    return out


def marks(found):
    return Counter(
        (r["doc_id"], r["leaf"], r["subroot"], r["root"], tuple((s["left"], s["right"]) for s in r["steps"]), r["found_leaf"]) for r in found.collect()
    )


@pytest.mark.parametrize("n", [4, 7, 40, 700])
def test_against_brute_force(spark, n):
    rows = cases.rows(n=n)
    docs = cases.clashing(cases.documents(spark, rows)).selectExpr("*", "1 AS grp", "2 AS place", "3 AS word", "4 AS total", "5 AS id", "6 AS leaf")
    assert marks(merkle.manifest(docs, found={"text": "upper(text)"})) == by_hand(rows, lambda t: None if t is None else t.upper())


def test_sparse_negative_and_repeated_ids(spark):
    ids = [-(1 << 62), -65, -64, -1, 0, 63, 64, 1 << 40, (1 << 62) + 5, 64, 64, 64, -1, None, None, (1 << 63) - 1, -(1 << 63)]
    rows = [(i, f"text {n % 9}", "en" if n % 3 else None, "s", n % 2) for n, i in enumerate(ids * 5)]
    assert marks(merkle.manifest(cases.documents(spark, rows))) == by_hand(rows)


def test_an_id_that_most_rows_share(spark):
    rows = [(7 if i % 3 else i, f"text {i % 50}", "en", None, None) for i in range(600)]
    assert marks(merkle.manifest(cases.documents(spark, rows, 6))) == by_hand(rows)


def test_many_groups(spark):
    rows = [(i, "x", f"l{i % 90}" if i % 5 else "é", None, None) for i in range(400)]
    assert marks(merkle.manifest(cases.documents(spark, rows))) == by_hand(rows)


def test_folding_tells_what_was_changed(spark):
    rows = [(i, "Big" if i % 4 else "small", "en", None, None) for i in range(100)]
    found = merkle.manifest(cases.documents(spark, rows), found={"text": "lower(text)"}).selectExpr("doc_id", f"{merkle.fold('found_leaf')} = root AS same")
    assert {r["doc_id"]: r["same"] for r in found.collect()} == {i: i % 4 == 0 for i in range(100)}


def test_empty(spark):
    assert merkle.manifest(cases.documents(spark, [])).collect() == []
