"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the node's smallest neighbour."""
    return edges.sparkSession.sql(
        """WITH both AS (SELECT a AS u, b AS v FROM {e} UNION ALL SELECT b, a FROM {e}),
                low AS (SELECT u, least(u, min(v)) AS m FROM both GROUP BY u)
           SELECT DISTINCT v AS a, m AS b FROM both JOIN low USING (u) WHERE v > u AND v <> m""",
        e=edges,
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    return edges.sparkSession.sql(
        """WITH down AS (SELECT greatest(a, b) AS u, least(a, b) AS v FROM {e}),
                low AS (SELECT u, min(v) AS m FROM down GROUP BY u)
           SELECT DISTINCT v AS a, m AS b FROM down JOIN low USING (u) WHERE v <> m
           UNION SELECT u, m FROM low""",
        e=edges,
    )


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges (a, b)``; root is the component's smallest node.

    Each round writes its edges to the shared folder, so lineage stays short and a
    lost executor costs one round.  Rounds grow with the logarithm of the largest
    component.  Nodes are longs; edges with a null end and loops are ignored.  No
    edges give no rows.
    """
    spark = edges.sparkSession
    state = stored(edges.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct())
    before = None
    while True:
        seen = state.selectExpr("count(*) AS n", "bit_xor(xxhash64(a, b)) AS x", "sum(hash(a, b)) AS s").first()
        if seen["n"] == 0 or seen == before:
            break
        before = seen
        state = stored(_small_star(_large_star(state)))
    return spark.sql("SELECT a AS node, b AS root FROM {s} UNION SELECT b, b FROM {s}", s=state)
