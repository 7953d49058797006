"""Which rows changed between two versions of a table, read from trees of digests.

A snapshot files a digest of each row under the hash of its key and sums digests up
by hash prefix: a node of the tree is a prefix of hexadecimal digits, its digest
that of its sixteen children. Two snapshots are compared from the root down, and only
below nodes that differ; at the end row digests are read of differing leaves alone.
The tables themselves are not read again. Work is that of hashing a version once, and then
of what changed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..work import written, written_by

#: Rows a leaf of the tree has on average, at most.
LEAF_ROWS = 64
#: Most levels below the root: sixteen to that power are the most leaves.
LEVELS = 6
#: Up to so many differing nodes are filters of the next read; more are joined.
LITERALS = 2000


@dataclass
class Snapshot:
    """``rows``: (top, hash, key columns, n, low, high); ``nodes``: (level, node, digest)."""

    rows: DataFrame
    nodes: DataFrame
    keys: list[str]
    levels: int


def _canonical(columns: list[str]) -> Column:
    """The columns as JSON text, nulls written out, so that different rows differ."""
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns]), {"ignoreNullFields": "false"})


def _part(digest: Column, begin: int) -> Column:
    return F.conv(F.substring(digest, begin, 15), 16, 10).cast("decimal(20,0)")


def snapshot(df: DataFrame, keys: list[str], columns: list[str] | None = None, leaf_rows: int = LEAF_ROWS) -> Snapshot:
    """Files a version. A key may be null or repeat: its rows are one multiset.

    ``columns`` are those whose change counts, by default all. Row digests have 120
    bits and are added up by key, so the order of rows doesn't matter.
    """
    columns = columns or df.columns
    body = F.md5(_canonical(columns))
    hashed = df.select(*keys, F.md5(_canonical(keys)).alias("hash"), _part(body, 1).alias("low"), _part(body, 16).alias("high"))
    rows = hashed.groupBy("hash", *keys).agg(F.count(F.lit(1)).alias("n"), F.sum("low").alias("low"), F.sum("high").alias("high"))
    placed = rows.withColumn("top", F.substring("hash", 1, 2))
    ranges = placed.repartitionByRange("hash").sortWithinPartitions("hash")  # a file holds few tops, its row groups few leaves
    rows = written_by(ranges.select("hash", *keys, "n", "low", "high", "top"), "top", "row-digests")
    total = rows.count()
    levels = min(LEVELS, max(1, math.ceil(math.log(max(total, 1) / leaf_rows, 16))) if total > leaf_rows else 1)
    mark = F.md5(F.concat_ws(":", F.sum("n"), F.sum("low"), F.sum("high")))
    level = written(rows.groupBy(F.substring("hash", 1, levels).alias("node")).agg(mark.alias("digest")), "leaf-digests")
    every = level.withColumn("level", F.lit(levels))
    for depth in range(levels - 1, -1, -1):
        children = F.array_sort(F.collect_list(F.concat("node", "digest")))  # at most sixteen
        level = level.groupBy(F.substring("node", 1, depth).alias("node")).agg(F.md5(F.array_join(children, ",")).alias("digest"))
        every = every.unionByName(level.withColumn("level", F.lit(depth)))
    return Snapshot(rows, written_by(every, "level", "node-digests"), list(keys), levels)


def differing_nodes(old: Snapshot, new: Snapshot) -> DataFrame:
    """``node``: prefixes of the deepest common level whose rows differ, found from the root down."""
    levels = min(old.levels, new.levels)
    found = None
    for depth in range(levels + 1):
        sides = [s.nodes.where(F.col("level") == depth).select("node", F.col("digest").alias(d)) for s, d in ((old, "a"), (new, "b"))]
        if found is not None:
            sides = [_below(s, "node", found, depth - 1) for s in sides]
        found = sides[0].join(sides[1], "node", "full").where(~F.col("a").eqNullSafe(F.col("b"))).select("node")
        found = written(found, "differing")  # read by both sides of the next level
    return found


def _below(rows: DataFrame, column: str, nodes: DataFrame, digits: int) -> DataFrame:
    """Rows whose prefix is one of the nodes; few nodes are constants that reach the scan."""
    few = [r["node"] for r in nodes.limit(LITERALS + 1).collect()]
    prefix = F.substring(column, 1, digits)
    if len(few) <= LITERALS:
        return rows.where(prefix.isin(few) if few else F.lit(False))
    return rows.join(nodes.withColumnRenamed("node", "__node"), prefix == F.col("__node"), "left_semi")


def rows_below(side: Snapshot, nodes: DataFrame, digits: int) -> DataFrame:
    """The row digests of a snapshot under the nodes: what a comparison reads of it."""
    tops = [r["t"] for r in nodes.select(F.substring("node", 1, 2).alias("t")).distinct().collect()]  # at most 256
    if not tops:
        return side.rows.where(F.lit(False))
    whole = F.col("top").isin(tops) if digits >= 2 else F.substring("top", 1, digits).isin(tops)
    return _below(side.rows.where(whole), "hash", nodes, digits)


def changes(old: Snapshot, new: Snapshot) -> DataFrame:
    """Key columns and ``change``: added, removed or changed; unchanged keys have no row.

    A key that repeats is changed when the multiset of its rows is.
    """
    nodes, digits = differing_nodes(old, new), min(old.levels, new.levels)
    mark = F.concat_ws(":", "n", "low", "high")
    a, b = (rows_below(s, nodes, digits).select("hash", *s.keys, mark.alias("m")) for s in (old, new))
    both = a.alias("a").join(b.alias("b"), F.col("a.hash") == F.col("b.hash"), "full")
    change = F.when(F.col("a.m").isNull(), "added").when(F.col("b.m").isNull(), "removed").otherwise("changed")
    return both.where(~F.col("a.m").eqNullSafe(F.col("b.m"))).select(*[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in old.keys], change.alias("change"))


def stale(inputs: DataFrame, changed: DataFrame, report: str, key: str) -> DataFrame:
    """``report, n_inputs, n_changed, fresh``: a report is fresh while none of its inputs changed.

    ``inputs`` has ``report, key`` of the version it was made from; a key that is gone counts as changed.
    """
    gone = changed.where("change <> 'added'").select(key).distinct().withColumn("__changed", F.lit(1))
    n = inputs.select(report, key).distinct().join(gone, key, "left")
    return n.groupBy(report).agg(F.count(F.lit(1)).alias("n_inputs"), F.count("__changed").alias("n_changed"), (F.count("__changed") == 0).alias("fresh"))
