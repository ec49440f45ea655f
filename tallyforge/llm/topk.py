"""Exact top-k inner products with KD-trees.

Vectors are dealt to shards by the top splits of a KD-tree, whose medians come from a
bounded sample; each of its cells keeps the tight box of all its vectors.  A shard
builds the rest of the tree by median splits on the widest dimension; every node keeps
the tight box of its vectors.  A query visits nodes best first: a box's bound is the
largest inner product that any point in it could have, and a node is left out when its
bound is below the k-th best score so far.

Each query first searches a shard of the cell with the highest bound.  Its k-th score
then leaves out all cells with a lower bound, before anything is sent to them, and goes
along to the others, where it prunes from the start.  Equal vectors are one tree point
with their k + 1 smallest ids, which is all that a result can need.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

LEAF = 64
#: About so many vectors give the top splits, and so many cells these make at most.
SAMPLE, CELLS = 1 << 14, 1 << 10
#: Below this, inner products are exact in doubles.
EXACT = float(1 << 52)


def bounds_of(low: np.ndarray, high: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """The largest inner product of each query with any point of each box."""
    q, low, high = queries.astype(np.float64), low.astype(np.float64), high.astype(np.float64)
    found = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    reach = np.abs(q) @ np.maximum(np.abs(low), np.abs(high)).T
    return np.where(reach < EXACT, found, found + reach * 1e-12)


class Splits:
    """The top of a KD-tree: ``2 ** depth`` cells by medians of a sample, each dealt to ``parts`` shards."""

    def __init__(self, sample: np.ndarray, depth: int, parts: int):
        self.depth, self.parts = depth, parts
        inner = (1 << depth) - 1
        self.dims, self.values = np.zeros(inner, np.int64), np.full(inner, np.iinfo(np.int64).max)
        todo = [(0, sample)] if inner else []
        while todo:
            node, rows = todo.pop()
            wide = rows.max(axis=0).astype(np.float64) - rows.min(axis=0) if len(rows) else np.zeros(1)
            if wide.max() <= 0:
                continue  # all go left
            d = int(wide.argmax())
            self.dims[node], self.values[node] = d, np.partition(rows[:, d], (len(rows) - 1) // 2)[(len(rows) - 1) // 2]
            right = rows[:, d] > self.values[node]
            if 2 * node + 2 < inner:
                todo += [(2 * node + 1, rows[~right]), (2 * node + 2, rows[right])]

    def cells(self, rows: np.ndarray) -> np.ndarray:
        node = np.zeros(len(rows), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (rows[np.arange(len(rows)), self.dims[node]] > self.values[node])
        return node - ((1 << self.depth) - 1)


#: For lengths that the sample has not met, which are rare.
ALONE = Splits(np.zeros((0, 1), np.int64), 0, 1)


def _matrix(vectors: pd.Series, dims: int) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=np.int64).reshape(len(vectors), dims)


class Tree:
    """A KD-tree over the rows of an integer matrix."""

    def __init__(self, points: np.ndarray):
        self.order = np.arange(len(points))
        self.spans: list[tuple[int, int]] = []
        self.kids: list[tuple[int, int] | None] = []
        low, high = [], []
        todo = [(0, len(points), -1, 0)]
        while todo:
            start, stop, parent, side = todo.pop()
            node = len(self.spans)
            if parent >= 0:
                kids = self.kids[parent] or (0, 0)
                self.kids[parent] = (node, kids[1]) if side == 0 else (kids[0], node)
            rows = points[self.order[start:stop]]
            low.append(rows.min(axis=0))
            high.append(rows.max(axis=0))
            self.spans.append((start, stop))
            self.kids.append(None)
            wide = high[-1].astype(np.float64) - low[-1]
            if stop - start > LEAF and len(wide) and wide.max() > 0:
                middle = (stop - start) // 2
                split = np.argpartition(rows[:, int(wide.argmax())], middle)
                self.order[start:stop] = self.order[start:stop][split]
                self.kids[node] = (0, 0)
                todo += [(start, start + middle, node, 0), (start + middle, stop, node, 1)]
        self.points = points[self.order]
        self.low, self.high = np.array(low), np.array(high)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        return bounds_of(self.low, self.high, queries)


def search(tree: Tree, ids: list[np.ndarray], own: int, query: np.ndarray, bounds: np.ndarray, k: int, kth: float) -> list[tuple[int, int]]:
    """The best ``(score, id)`` in a tree that reach ``kth``; best first, ties to smaller ids."""
    best: list[tuple[int, int]] = []
    heap = [(-bounds[0], 0)]
    small = float(bounds.max(initial=0)) < EXACT and float(np.abs(query).astype(np.float64) @ np.abs(tree.points).max(axis=0, initial=0)) < EXACT
    point = query.astype(np.float64) if small else query
    while heap:
        bound, node = heapq.heappop(heap)
        if -bound < kth:
            break
        if tree.kids[node]:
            for kid in tree.kids[node]:
                if bounds[kid] >= kth:
                    heapq.heappush(heap, (-bounds[kid], kid))
            continue
        start, stop = tree.spans[node]
        scores = tree.points[start:stop] @ point
        near = np.flatnonzero(scores >= kth)
        if len(near):
            best += [(int(scores[i]), int(x)) for i in near for x in ids[tree.order[start + i]] if x != own]
            best.sort(key=lambda found: (-found[0], found[1]))
            del best[k:]
            if len(best) == k:
                kth = max(kth, best[-1][0])
    return best


def _points(vectors: DataFrame, k: int) -> DataFrame:
    """``vector, ids``: each distinct vector with its k + 1 smallest ids."""
    first = Window.partitionBy("vector").orderBy("id")
    rows = vectors.distinct().withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k + 1)
    return rows.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def top_splits(points: DataFrame, shard_rows: int) -> dict[int, Splits]:
    """The splits for each length of vectors that a sample of about SAMPLE vectors meets."""
    step = max(1, -(-points.count() // SAMPLE))
    sample = points.where(F.pmod(F.xxhash64("vector", F.lit(5)), F.lit(step)) == 0).select("vector").collect()
    by_length: dict[int, list[list[int]]] = {}
    for (vector,) in sample:
        by_length.setdefault(len(vector), []).append(vector)
    found = {}
    for dims, rows in by_length.items():
        whole = max(1, len(rows) * step // shard_rows)  # shards that these vectors fill
        depth = min(whole, max(1, CELLS * len(rows) // len(sample))).bit_length() - 1 if dims else 0
        parts = -(-len(rows) * step // (shard_rows << depth))
        found[dims] = Splits(np.array(rows, dtype=np.int64).reshape(len(rows), dims), depth, max(1, parts))
    return found


def _dealt(points: DataFrame, splits: dict[int, Splits]) -> DataFrame:
    """Adds ``dims, cell, part``: the shard of each vector."""
    sent = points.sparkSession.sparkContext.broadcast(splits)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dims, rows in batch.groupby(batch["vector"].map(len)):
                own = sent.value.get(dims, ALONE)
                yield rows.assign(dims=dims, cell=own.cells(_matrix(rows["vector"], dims)), part=rows["deal"] % own.parts)

    hashed = points.withColumn("deal", F.pmod(F.xxhash64("vector", F.lit(7)), F.lit(1 << 30)))
    return hashed.mapInPandas(run, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in hashed.schema)}, dims int, cell int, part int").drop("deal")


def _boxes(dealt: DataFrame, splits: dict[int, Splits]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length with splits its cells, and the lower and upper corners of their vectors' boxes; at most CELLS and a few."""

    def corners(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for (dims, cell), rows in batch.groupby(["dims", "cell"]):
                matrix = _matrix(rows["vector"], dims)
                low, high = held.get((dims, cell), (matrix[0], matrix[0]))
                held[dims, cell] = np.minimum(low, matrix.min(axis=0)), np.maximum(high, matrix.max(axis=0))
        yield pd.DataFrame([(*key, *box) for key, box in held.items()], columns=["dims", "cell", "low", "high"])

    schema = "dims int, cell int, low array<long>, high array<long>"

    def joined(rows: pd.DataFrame) -> pd.DataFrame:
        low, high = np.stack(rows["low"].tolist()).min(axis=0), np.stack(rows["high"].tolist()).max(axis=0)
        return pd.DataFrame({"dims": rows["dims"].iloc[:1], "cell": rows["cell"].iloc[:1], "low": [low], "high": [high]})

    known = dealt.where(F.col("dims").isin([*splits])).select("dims", "cell", "vector")
    found: dict[int, list] = {}
    for r in known.mapInPandas(corners, schema).groupBy("dims", "cell").applyInPandas(joined, schema).orderBy("dims", "cell").collect():
        found.setdefault(r["dims"], []).append(r)
    return {
        dims: tuple(np.array([r[c] for r in rows], dtype=np.int64).reshape(len(rows), *([] if c == "cell" else [dims])) for c in ("cell", "low", "high"))
        for dims, rows in found.items()
    }


def meetings(asked: DataFrame, splits: dict[int, Splits], boxes: dict, first: bool) -> DataFrame:
    """``query_id, vector, kth, dims, cell, part`` of every shard that a query of ``(query_id, vector, kth, deal)`` has to meet.

    ``first``: one shard of the cell with the highest bound.  Otherwise all other shards
    of cells whose bound reaches ``kth``; a null kth is reached by all.
    """
    sent = asked.sparkSession.sparkContext.broadcast((splits, boxes))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        splits, boxes = sent.value
        for batch in batches:
            for dims, rows in batch.groupby(batch["vector"].map(len)):
                own = splits.get(dims, ALONE)
                cells, low, high = boxes.get(dims, (np.zeros(1, np.int64), np.zeros((1, dims)), np.zeros((1, dims))))
                for at in range(0, len(rows), 256):
                    some = rows.iloc[at : at + 256]
                    bounds = bounds_of(low, high, _matrix(some["vector"], dims))
                    best, home = bounds.argmax(axis=1), (some["deal"] % own.parts).to_numpy()
                    if first:
                        yield some.assign(dims=dims, cell=cells[best], part=home)
                        continue
                    limit = some["kth"].astype(float).fillna(-np.inf).to_numpy() if dims in boxes else np.full(len(some), -np.inf)
                    near = np.repeat((bounds >= limit[:, None])[:, :, None], own.parts, axis=2)
                    near[np.arange(len(some)), best, home] = False
                    query, cell, part = np.nonzero(near)
                    for a in range(0, len(query), 1 << 12):  # few copies of vectors at a time
                        b = a + (1 << 12)
                        yield some.iloc[query[a:b]].assign(dims=dims, cell=cells[cell[a:b]], part=part[a:b])

    return asked.mapInPandas(run, "query_id long, vector array<long>, kth long, deal long, dims int, cell int, part int").drop("deal")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = 1 << 14, block: int = 1 << 12) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k highest inner products, ties to smaller ids.

    ``vectors (id, vector)`` and ``queries (id, vector)`` hold arrays of longs without
    nulls.  A query is compared with the vectors of its own length, not with rows of
    its own id.  Repeated rows count once; an id with several vectors is several
    candidates, or queries answered together.  All answers if fewer than k; no rows
    for a query without candidates, or from empty tables.  Scores are exact while
    they fit a long.

    Queries meet shards in blocks of at most ``block``, shards hold about
    ``shard_rows`` distinct vectors.
    """
    points = stored(_points(vectors, k))
    splits = top_splits(points, shard_rows)
    dealt = stored(_dealt(points, splits))
    boxes = _boxes(dealt, splits)
    asked = stored(queries.distinct().select(F.col("id").alias("query_id"), "vector", F.pmod(F.xxhash64("vector", F.lit(11)), F.lit(1 << 30)).alias("deal")))
    groups = max(1, -(-asked.count() // block))
    keys = ["dims", "cell", "part", "block"]

    def answer(rows: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(rows) and len(ask):
            dims = int(ask["dims"].iloc[0])
            tree = Tree(_matrix(rows["vector"], dims))
            ids = rows["ids"].tolist()
            for at in range(0, len(ask), 256):
                some = ask.iloc[at : at + 256]
                matrix = _matrix(some["vector"], dims)
                for query, own, kth, bounds in zip(matrix, some["query_id"], some["kth"], tree.bounds(matrix), strict=True):
                    limit = -np.inf if pd.isna(kth) else float(kth)
                    found += [(own, query, i, s) for s, i in search(tree, ids, own, query, bounds, k, limit)]
        return pd.DataFrame(found, columns=["query_id", "vector", "vec_id", "score"])

    def against(met: DataFrame) -> DataFrame:
        """A shard is copied to every block of queries it meets."""
        ask = met.withColumn("block", F.pmod(F.xxhash64("query_id", "vector"), F.lit(groups)).cast("int"))
        blocks = ask.select(*keys).distinct().select(*(F.col(c).alias(c) for c in keys))  # columns of their own
        left = dealt.join(blocks, keys[:-1])
        return left.groupBy(keys).cogroup(ask.groupBy(keys)).applyInPandas(answer, "query_id long, vector array<long>, vec_id long, score long")

    home = asked.select("query_id", "vector", F.lit(None).cast("long").alias("kth"), "deal")
    first = stored(against(stored(meetings(home, splits, boxes, True))))
    kth = first.groupBy("query_id", "vector").agg(F.when(F.count("*") == k, F.min("score")).alias("kth"))
    known = asked.join(kth, ["query_id", "vector"], "left").select("query_id", "vector", "kth", "deal")
    rest = against(stored(meetings(known, splits, boxes, False)))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    both = first.unionByName(rest).select("query_id", "vec_id", "score")
    return both.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def whole_vectors(rows: DataFrame, id_column: str, vector_column: str, scale: int = 1024) -> DataFrame:
    """``id, vector``: components as floor(scale * x); vectors that are null or hold null or non-finite components, and null ids, are left out."""
    return (
        rows.selectExpr(f"CAST(`{id_column}` AS long) AS id", f"CAST(`{vector_column}` AS array<double>) AS given")
        .where("id IS NOT NULL AND given IS NOT NULL AND forall(given, x -> coalesce(abs(x) < double('Infinity') AND NOT isnan(x), false))")
        .selectExpr("id", f"transform(given, x -> CAST(floor({scale} * x) AS long)) AS vector")
    )
