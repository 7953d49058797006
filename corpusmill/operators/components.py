"""Connected components of an edge table by alternating large and small stars.

Each round is two aggregations over the edges; the smallest member of a node's
neighbourhood is found with map-side partial aggregation and joined back, so a
hub's edges are spread by a skew join, never gathered in one task. Rounds end
when the edges no longer change: then every edge links a member to the smallest
member of its component. Each round is written to the shared work folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..work import forget, written

#: Rounds before giving up; they grow with the logarithm of the longest path.
ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link neighbours of each node to the smallest node near it.

    ``edges`` has (u, v) with v < u. Large star: for each node n, its larger
    neighbours are linked to the minimum of n and its neighbours. Small star:
    its smaller neighbours and n itself are.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    linked = both.join(least, "u")
    if large:
        out = linked.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return out.where(F.col("u") != F.col("v")).distinct()


def _state(edges: DataFrame):
    mark = F.xxhash64("u", "v").cast("decimal(20,0)")
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(mark).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; component is its smallest node.

    Edges may repeat, point either way or loop; loops and nulls link nothing. An
    empty table gives no rows. The id columns may be of any type with an order.
    """
    pairs = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    ).distinct()
    now = written(pairs, "edges")
    state = _state(now)
    for _ in range(ROUNDS):
        if not state[0]:
            break
        new = written(_star(_star(now, large=True), large=False), "edges")
        forget(now)
        now, old, state = new, state, _state(new)
        if state == old:
            break
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    members = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(roots)
