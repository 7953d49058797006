"""Coverage at every level at once, and distinct counts that add up over rounds.

``levels`` is one aggregation by grouping sets: the rows and, with weight zero, the
domain they should cover, so that what is missing has a row at each level.
Distinct ids per round are kept as bitmaps (exact, for whole non-negative numbers) or as
HyperLogLog sketches (any type); both merge, so a new round is read alone and joined to
what is stored.
"""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Sketch size: 2^LG registers, a relative standard error of 1.04 / sqrt(2^LG), 1.6 % for 12.
LG = 12


def grouping_sets(tree: list[str], others: list[str]) -> list[list[str]]:
    """Each prefix of ``tree`` (from the top down), with and without each of ``others``."""
    tops = [tree[:k] for k in range(len(tree) + 1)]
    return [top + [o for o, keep in zip(others, keeps) if keep] for top in tops for keeps in product((False, True), repeat=len(others))]


def levels(rows: DataFrame, domain: DataFrame, tree: list[str], others: list[str]) -> DataFrame:
    """``tree + others, level, n, n_leaves, n_missing``: coverage at all of :func:`grouping_sets`.

    ``domain`` has every combination that counts (``tree`` and ``others``), once each; rows
    outside it are left out. ``level`` is the grouping id: its bits, in the order of the
    columns, tell which were summed over. ``n`` counts rows, ``n_leaves`` the combinations
    below and ``n_missing`` those of them without a row.
    """
    keys = tree + others
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))  # a row a combination, map-side
    whole = domain.select(*keys).join(counted, keys, "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    sets = [[F.col(c) for c in s] for s in grouping_sets(tree, others)]
    return whole.groupingSets(sets, *[F.col(k) for k in keys]).agg(
        F.grouping_id(*keys).cast("long").alias("level"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_leaves"), F.count_if(F.col("n") == 0).alias("n_missing")
    )


def full_domain(parts: list[DataFrame]) -> DataFrame:
    """All combinations of small lists of values: the grid to be covered."""
    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), parts)


def round_bitmaps(rows: DataFrame, topic: str, round_: str, id_: str) -> DataFrame:
    """``topic, round, bucket, bits``: the ids of each round, 32,768 a bitmap. Null and negative ids are left out."""
    fine = rows.where(F.col(id_) >= 0)
    return fine.groupBy(topic, round_, F.bitmap_bucket_number(id_).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(id_)).alias("bits"))


def merged_bitmaps(stored: DataFrame, fresh: DataFrame, topic: str, round_: str) -> DataFrame:
    """Two tables of bitmaps as one; rounds may be in both."""
    return stored.unionByName(fresh).groupBy(topic, round_, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_over_rounds(bitmaps: DataFrame, topic: str, round_: str) -> DataFrame:
    """``topic, round, n_distinct, new_distinct, total_distinct``: exact, from bitmaps alone.

    New ids are what a bucket's running union gains in a round; the rounds of a
    topic are few, its buckets are what grows and they are worked on apart.
    """
    so_far = Window.partitionBy(topic, "bucket").orderBy(round_)
    union = bitmaps.withColumn("all", F.bitmap_count(F.bitmap_or_agg("bits").over(so_far)))
    gained = union.withColumn("new", F.col("all") - F.coalesce(F.lag("all").over(so_far), F.lit(0)))
    rounds = gained.groupBy(topic, round_).agg(F.sum(F.bitmap_count("bits")).alias("n_distinct"), F.sum("new").alias("new_distinct"))
    return rounds.withColumn("total_distinct", F.sum("new_distinct").over(Window.partitionBy(topic).orderBy(round_)))


def round_sketches(rows: DataFrame, topic: str, round_: str, id_: str) -> DataFrame:
    """``topic, round, sketch``: a HyperLogLog sketch of each round's ids."""
    return rows.groupBy(topic, round_).agg(F.hll_sketch_agg(F.col(id_), F.lit(LG)).alias("sketch"))


def merged_sketches(stored: DataFrame, fresh: DataFrame, topic: str, round_: str) -> DataFrame:
    """Two tables of sketches as one; rounds may be in both."""
    return stored.unionByName(fresh).groupBy(topic, round_).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated_over_rounds(sketches: DataFrame, topic: str, round_: str) -> DataFrame:
    """``topic, round, estimate``: distinct ids up to each round, from the union of sketches."""
    so_far = Window.partitionBy(topic).orderBy(round_)
    return sketches.select(topic, round_, F.hll_sketch_estimate(F.hll_union_agg("sketch").over(so_far)).alias("estimate"))
