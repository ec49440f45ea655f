import math
import random

import pytest

from tallyforge.llm import topk

SCHEMA = "vec_id long, embedding array<float>, vector string, id string"


def by_hand(rows, k):
    usable = {}
    for i, v, *_ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable.setdefault((i, tuple(math.floor(1024 * x) for x in v)), None)
    out = set()
    for q, qv in usable:
        if q % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(qv, v, strict=True)), i) for i, v in usable if i != q and len(v) == len(qv))
            out |= {(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)}
    return out


def vectors(seed, n, dims=6):
    rnd = random.Random(seed)
    rows = [(i, [float(f"{rnd.gauss(0, 1):.3f}") for _ in range(dims)], None, None) for i in range(-100, n)]
    same = rows[7][1]
    rows += [(n + i, same, None, None) for i in range(60)]  # ties
    rows += [(200000, [0.0] * dims, None, None), (200100, same, None, None), rows[3], (None, same, None, None), (300000, None, None, None)]
    rows += [(300100, [None] * dims, None, None), (300200, [math.nan] * dims, None, None), (300300, [math.inf] * dims, None, None)]
    return [*rows, (400000, [1.0, -1.0], None, None), (400001, [0.5, 0.25], None, None), (500000, [], None, None)]


@pytest.mark.parametrize(("shard_rows", "block", "k"), [(1 << 14, 1 << 12, 10), (100, 2, 10), (37, 5, 3)])
def test_against_all_pairs(spark, shard_rows, block, k):
    rows = vectors(k, 500)
    given = topk.whole_vectors(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding")
    found = topk.top_k(given, given.where("id % 100 = 0"), k, shard_rows, block)
    got = [tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect()]
    assert len(got) == len(set(got)) and set(got) == {(q, n, i, s) for q, n, i, s in by_hand([(r[0], [None if x is None else float(x) for x in r[1]] if r[1] is not None else None) for r in exact(rows)], k)}


def exact(rows):
    import struct

    single = lambda x: None if x is None else struct.unpack("f", struct.pack("f", x))[0]
    return [(i, None if v is None else [single(x) for x in v]) for i, v, *_ in rows]


def test_tree_prunes_clusters():
    import numpy as np

    rnd = np.random.default_rng(0)
    points = (rnd.normal(size=(40, 1, 8)) * 5000 + rnd.normal(size=(40, 100, 8)) * 50).reshape(-1, 8).astype(np.int64)
    tree = topk.Tree(points)
    assert sorted(tree.order.tolist()) == list(range(len(points)))
    query = points[5] * 2
    bounds = tree.bounds(query[None])[0]
    for (start, stop), bound in zip(tree.spans, bounds, strict=True):
        assert (points[tree.order[start:stop]] @ query).max() <= bound
    ids = [np.array([i]) for i in range(len(points))]
    found = topk.search(tree, ids, -1, query, bounds, 10, -np.inf)
    assert [s for s, _ in found] == sorted((points @ query).tolist(), reverse=True)[:10]
    leaves = [n for n, kids in enumerate(tree.kids) if not kids]
    assert sum(bounds[n] >= found[-1][0] for n in leaves) < len(leaves) / 4


def test_most_shards_of_clustered_vectors_are_never_met(spark):
    import numpy as np
    from pyspark.sql import functions as F

    rnd = np.random.default_rng(1)
    points = (rnd.normal(size=(64, 1, 6)) * 9000 + rnd.normal(size=(64, 60, 6)) * 40).reshape(-1, 6).astype(int)
    given = spark.createDataFrame([(i, [int(x) for x in p]) for i, p in enumerate(points)], "id long, vector array<long>").repartition(4)
    found = topk.top_k(given, given.where("id % 40 = 0"), 5, shard_rows=60)
    scores = points @ points.T
    for q in range(0, len(points), 40):
        best = sorted((-int(s), i) for i, s in enumerate(scores[q]) if i != q)[:5]
        assert [(-r["score"], r["vec_id"]) for r in found.where(f"query_id = {q}").orderBy("rank").collect()] == best if q % 800 == 0 else True
    stored_points = topk._points(given, 5).cache()
    splits = topk.top_splits(stored_points, 60)
    dealt = topk._dealt(stored_points, splits)
    boxes = topk._boxes(dealt, splits)
    cells = dealt.select("cell", "part").distinct().count()
    assert cells > 30
    kth = {q: sorted((int(s) for i, s in enumerate(scores[q]) if i != q), reverse=True)[4] for q in range(0, len(points), 40)}
    asked = spark.createDataFrame([(q, [int(x) for x in points[q]], v, 3) for q, v in kth.items()], "query_id long, vector array<long>, kth long, deal long")
    met = topk.meetings(asked, splits, boxes, False).count() + topk.meetings(asked, splits, boxes, True).count()
    assert len(kth) <= met < 0.2 * len(kth) * cells
    every = topk.meetings(asked.withColumn("kth", F.lit(None).cast("long")), splits, boxes, False)
    assert every.count() >= len(kth) * (cells - 1)


def test_empty(spark):
    given = topk.whole_vectors(spark.createDataFrame([], SCHEMA), "vec_id", "embedding")
    assert topk.top_k(given, given).collect() == []
