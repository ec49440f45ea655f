import random
import re
from collections import Counter

import pytest
import xxhash

from tallyforge.llm import components, simhash

from . import cases


def by_hand(text, words=4):
    parts = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not parts:
        return 0
    shingles = [" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, linked):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in linked:
        up[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def unsigned(value):
    return value & (1 << 64) - 1


def near(values, most):
    values = sorted(set(values))
    return {(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if bin(unsigned(a) ^ unsigned(b)).count("1") <= most}


@pytest.mark.parametrize("text", cases.texts())
def test_fingerprint(text):
    assert unsigned(simhash.fingerprint(text.encode() if text else None, 4)) == by_hand(text)


def test_shingles_follow_sparks_hash(spark):
    found = spark.sql("SELECT xxhash64('a bé c d') AS h").first()["h"]
    assert unsigned(found) == xxhash.xxh64_intdigest("a bé c d".encode(), 42)


@pytest.mark.parametrize("most", [0, 1, 2, 3, 4, 5, 7])
def test_links_lose_none(spark, most):
    rnd = random.Random(most)
    prints = []
    for _ in range(12):
        centre = rnd.getrandbits(64)
        for _ in range(12):
            value = centre
            for bit in rnd.sample(range(64), rnd.randint(0, 6)):
                value ^= 1 << bit
            prints.append(value - (1 << 64) if value >> 63 else value)
    prints += [0, -1, 1, -(1 << 63)]
    table = spark.createDataFrame([(p,) for p in set(prints)], "fp long")
    assert {tuple(r) for r in simhash.links(table, most).collect()} == near(prints, most)


def test_components_of_a_long_chain(spark):
    chain = list(range(60))
    random.Random(1).shuffle(chain)
    edges = [*zip(chain, chain[1:], strict=False), (100, 101), (100, 100)]
    found = components.components(spark.createDataFrame(edges, "a long, b long"))
    expected = roots([*chain, 100, 101], edges)
    assert {tuple(r) for r in found.collect()} == set(expected.items())


def expected_components(rows):
    prints = [(i, by_hand(t)) for i, t, *_ in rows]
    root = roots({p for _, p in prints}, near([p for _, p in prints], 4))
    least = {}
    for i, p in prints:
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    return Counter((i, p, least.get(root[p])) for i, p in prints)


def test_components_of_documents(spark):
    docs = cases.clashing(cases.documents(spark))
    found = Counter((r["doc_id"], unsigned(r["fp"]), r["component_id"]) for r in simhash.near_duplicates(docs).collect())
    assert found == expected_components(cases.rows())


def test_one_of_each(spark):
    kept = simhash.one_of_each(cases.documents(spark))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = [r["doc_id"] for r in kept.collect()]
    assert Counter(ids) == Counter({c for _, _, c in expected_components(cases.rows())})


def test_empty(spark):
    empty = cases.documents(spark, [])
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.one_of_each(empty).collect() == []


def test_cells_are_not_broadcast(spark):
    """Fifty cells a fingerprint: their size is not that of the fingerprints, which Spark goes by."""
    prints = spark.range(100).selectExpr("xxhash64(id) AS fp")
    plan = simhash.links(prints)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
