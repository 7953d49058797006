"""Exact and near-duplicate detection over texts, with transitive merging.

Similar are two texts whose token sets have a Jaccard similarity of at least the
threshold, or where the set of the shorter text (not empty) lies in the longer's.
Pairs come from equality joins, never from all pairs: texts of equal sets are one
entry first; Jaccard candidates share a token of their prefixes (rarest tokens
first); subset candidates hold the shorter's rarest token. Every candidate is
verified exactly, so the result is that of comparing everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..dialect import column
from ..functions import text as rules
from ..work import written
from .components import connected_components

THRESHOLD = 0.85


def chinese_set(key: str = "key") -> Column:
    """Distinct Chinese characters: the token set of pack ``zh``."""
    return column(rules.char_set, key)


def word_ngrams(key: str = "key", n: int = 5) -> Column:
    """Distinct n-grams of lower-cased words, hashed: the token set of pack ``latin``.

    Texts of fewer words have their whole word sequence as the one token. Words are
    hashed once each; an n-gram is the hash of its words' hashes (missing ones add nothing).
    """
    words = F.transform(F.filter(F.split(F.lower(key), r"[^\p{L}\p{N}]+"), lambda w: w != ""), lambda w: F.xxhash64(w))

    def grams(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(w) - n, F.lit(0)))
        made = F.array_distinct(F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(n)])))
        return F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(made)

    return let(words, grams)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once a row, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def exact(df: DataFrame, key: Column, order: str) -> DataFrame:
    """The first row of each key by ``order``; rows with an empty key go."""
    first = Window.partitionBy("__key").orderBy(order)
    return df.withColumn("__key", key).where("__key <> ''").withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__key", "__n")


def prepared(items: DataFrame) -> DataFrame:
    """Items (``idx, len, tokens``) as a written table with sorted ``tokens``, their number ``n`` and a digest
    ``key`` of the set, so that token sets are made once and later steps that need none don't read them.

    Other columns stay. A digest has 96 bits.
    """
    ordered = items.withColumn("tokens", F.array_sort("tokens")).withColumn("n", F.size("tokens"))
    return written(ordered.withColumn("key", F.concat_ws(":", F.xxhash64("tokens").cast("string"), F.hash("tokens").cast("string"))), "items")


def entries(items: DataFrame) -> DataFrame:
    """One row per distinct token set: ``set_id, key, tokens, n, min_len, max_len``.

    ``items`` are :func:`prepared`. ``set_id`` is the smallest idx, ``n`` the size of the set,
    ``tokens`` those of its tokens that another set has too, rarest first: tokens
    of one set only can make nothing similar, and are the rarest of all.
    """
    least = [F.min("idx").alias("set_id"), F.min("len").alias("min_len"), F.max("len").alias("max_len"), F.min("n").alias("n")]
    sets = written(items.groupBy("key").agg(*least), "sets")
    copies = written(items.select("idx", "key").join(sets.select("key", "set_id"), "key").where("idx <> set_id").select("idx"), "copies")
    spread = items.join(copies, "idx", "left_anti").select(F.col("idx").alias("set_id"), F.explode("tokens").alias("token"))
    # all tokens travel this once; a token is at most one row a set, and a window over many rows spills
    shared = spread.withColumn("f", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("f > 1")
    ordered = shared.groupBy("set_id").agg(F.array_sort(F.collect_list(F.struct("f", "token"))).alias("o"))  # of one set
    out = sets.join(ordered, "set_id", "left").select(
        "set_id", "key", F.coalesce(F.transform("o", lambda x: x["token"]), F.array()).alias("tokens"), "n", "min_len", "max_len"
    )
    return written(out, "entries")


def similar_pairs(sets: DataFrame, threshold: float = THRESHOLD, subset: bool = True) -> DataFrame:
    """(a, b, jaccard, is_subset) of distinct sets (:func:`entries`) that are similar, a < b."""
    own = F.col("n") - F.size("tokens")  # tokens of this set only, which come before the others
    prefix = F.slice("tokens", 1, F.greatest(F.col("n") - F.ceil(threshold * F.col("n") - F.lit(1e-9)).cast("int") + 1 - own, F.lit(0)))
    filled = sets.where("n > 0")
    left = filled.select(F.col("set_id").alias("a"), F.col("n").alias("na"), F.explode(prefix).alias("token"))
    right = left.select(F.col("a").alias("b"), F.col("na").alias("nb"), "token")
    near = left.join(right, "token").where("a < b").where(F.least("na", "nb") >= threshold * F.greatest("na", "nb") - 1e-9)
    candidates = near.select("a", "b")
    if subset:  # a set with a token of its own lies in no other
        rare = filled.where(own == 0).select(F.col("set_id").alias("s"), F.col("n").alias("ns"), F.col("min_len"), F.element_at("tokens", 1).alias("token"))
        wide = filled.select(F.col("set_id").alias("l"), F.col("n").alias("nl"), F.col("max_len"), F.explode("tokens").alias("token"))
        inside = rare.join(wide, "token").where("s <> l AND ns <= nl AND min_len < max_len")
        candidates = candidates.unionByName(inside.select(F.least("s", "l").alias("a"), F.greatest("s", "l").alias("b")))
    one = sets.select(F.col("set_id").alias("a"), F.col("tokens").alias("x"), F.col("n").alias("nx"), F.col("min_len").alias("min_x"), F.col("max_len").alias("max_x"))
    two = sets.select(F.col("set_id").alias("b"), F.col("tokens").alias("y"), F.col("n").alias("ny"), F.col("min_len").alias("min_y"), F.col("max_len").alias("max_y"))
    both = candidates.distinct().join(one, "a").join(two, "b").withColumn("common", F.size(F.array_intersect("x", "y")))
    jaccard = F.col("common") / (F.col("nx") + F.col("ny") - F.col("common"))
    within = ((F.col("common") == F.col("nx")) & (F.col("min_x") < F.col("max_y"))) | ((F.col("common") == F.col("ny")) & (F.col("min_y") < F.col("max_x")))
    found = both.select("a", "b", jaccard.alias("jaccard"), within.alias("is_subset"))
    return found.where((F.col("jaccard") >= threshold) | (F.col("is_subset") if subset else F.lit(False)))


def components(items: DataFrame, threshold: float = THRESHOLD, subset: bool = True) -> DataFrame:
    """(idx, component) of every one of :func:`prepared` items; a component is named by its smallest idx."""
    sets = entries(items)
    pairs = similar_pairs(sets, threshold, subset)
    labels = connected_components(pairs.select("a", "b"))
    named = sets.join(labels.withColumnRenamed("node", "set_id"), "set_id", "left").select("key", F.coalesce("component", "set_id").alias("component"))
    return items.select("idx", "key").join(named, "key").select("idx", "component")


def representatives(items: DataFrame, classes: DataFrame) -> DataFrame:
    """``component, kept, members, ord``: the longest text of each class, ties to the
    first; ``members`` counts all. ``items`` has ``idx, len``."""
    best = F.min(F.struct((-F.col("len")).alias("l"), "idx")).alias("best")
    return items.join(classes, "idx").groupBy("component").agg(best, F.count(F.lit(1)).alias("members")).select(
        "component", F.col("best.idx").alias("kept"), "members"
    )


def merged_texts(items: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """``component, kept, pos, merged``: of each class with more than one entry the text
    kept and the others, longest first (ties in their order), a row each; their number
    is what was merged by likeness. ``texts`` has ``idx, text``."""
    rows = items.select("idx", "len").join(classes, "idx").join(texts.select("idx", "text"), "idx")
    order = Window.partitionBy("component").orderBy(F.desc("len"), "idx")
    ranked = rows.withColumn("pos", F.row_number().over(order) - 1).withColumn("kept", F.first("text").over(order))
    return ranked.where("pos > 0").select("component", "kept", F.col("pos").cast("long").alias("pos"), F.col("text").alias("merged"))


def merge_sources(sources: DataFrame, classes: DataFrame) -> DataFrame:
    """``component, url, frequency``: sources of all members, summed by URL."""
    return sources.join(classes, "idx").groupBy("component", "url").agg(F.sum("frequency").alias("frequency"))
