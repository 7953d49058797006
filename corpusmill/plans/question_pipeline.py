"""From a collection manifest to confirmed questions, coverage and next queries.

One plan: hits and pages → candidates → judged → sources by text → near-duplicate
classes → frequency gate → ids → coverage → recommended queries → audit.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..dialect import SPARK
from ..functions import text as rules
from ..operators import containment, dedupe, latin, numbering, questions
from ..work import written


@dataclass
class Result:
    """``problems`` (confirmed and pending), their ``sources``, ``matrix``, ``next_queries``, one-row ``audit``."""

    problems: DataFrame
    sources: DataFrame
    matrix: DataFrame
    next_queries: DataFrame
    audit: DataFrame


@dataclass
class Pack:
    """What depends on the language of the questions."""

    candidates: Callable[[DataFrame, DataFrame, list[str] | None], DataFrame]  # of hits, pages and terms
    category: Callable[[], Column]  # of ``text`` and ``source_url``: pass, or A to E
    key: Callable[[str], Column]  # equal keys are one question
    tokens: Callable[[str], Column]  # of a key: sets that are compared


ZH = Pack(questions.candidates, lambda: F.expr(rules.judged(SPARK)), lambda c: F.expr(rules.dedupe_key(SPARK, c)), dedupe.chinese_set)
#: Questions of texts in Latin letters; the lists are this library's own (``packs.LATIN_*``).
LATIN = Pack(latin.candidates, latin.category, latin.key, lambda c: containment.words(F.col(c)))


def run(hits: DataFrame, pages: DataFrame, topic: str, terms: list[str] | None = None, expanded: list[str] = (), abstract: bool = False, pack: Pack = ZH) -> Result:
    """The whole pipeline over flattened manifests (see ``flatten_manifest``)."""
    found = written(pack.candidates(hits, pages, terms).withColumn("category", pack.category()), "candidates")
    texts, sources = questions.aggregate_sources(found.where("category = 'pass'"))
    ranges = texts.repartitionByRange("first").sortWithinPartitions("first")  # numbers follow the order, with gaps
    texts = written(ranges.withColumn("idx", F.monotonically_increasing_id()), "texts")
    sources = written(sources.join(texts.select("key", "idx"), "key").drop("key"), "sources")

    keyed = texts.withColumn("dedupe_key", pack.key("text"))
    kept = dedupe.exact(keyed, F.col("dedupe_key"), "idx")  # sources of exact repeats are not merged
    items = dedupe.prepared(kept.select("idx", F.length("dedupe_key").alias("len"), pack.tokens("dedupe_key").alias("tokens")))
    classes = written(dedupe.components(items), "classes")
    best = dedupe.representatives(items, classes)
    merged = written(dedupe.merge_sources(sources.select("idx", "url", "frequency"), classes).withColumn("type", F.coalesce(F.expr(_tier()), F.lit("tertiary"))), "merged")

    gate = questions.frequency_gate(merged, "component")
    others = items.select("idx", "len").join(classes, "idx").join(best.select("component", "kept"), "component").where("idx <> kept").join(texts.select("idx", "text"), "idx")
    dups = others.groupBy("component").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("len")).alias("l"), "idx", "text"))), lambda x: x["text"]).alias("duplicates"))
    listed = merged.groupBy("component").agg(F.array_sort(F.collect_list(F.struct("url", "type", "frequency"))).alias("sources"))
    rows = best.join(texts.withColumnRenamed("idx", "kept"), "kept").join(gate, "component").join(dups, "component", "left").join(listed, "component")
    numbered = numbering.numbered(rows, "status", "component")
    name = F.when(F.col("status") == "confirmed", F.expr(rules.padded_id(SPARK, "n", "P"))).otherwise(F.expr(rules.padded_id(SPARK, "n", "PV")))
    problems = written(
        numbered.select(
            name.alias("id"), F.col("component").alias("ord"), "text", F.col("text").alias("original"), "perspective", "sub_dimension", "status", "total_frequency", "source_count",
            F.coalesce("duplicates", F.array().cast("array<string>")).alias("duplicates"), "sources",
        ),
        "problems",
    )
    matrix = questions.coverage(problems)
    gaps = questions.missing(matrix, abstract)
    nexts = questions.queries(gaps, topic, list(expanded), per_cell=2)
    return Result(problems, merged, matrix, nexts, audit(hits, pages, found, problems, items, classes))


def _tier() -> str:
    from ..functions import url

    return url.tier(SPARK)


def reachability(hits: DataFrame, pages: DataFrame) -> DataFrame:
    """``reachability``: share of distinct URLs found that were fetched, empty pages too."""
    wanted = hits.select("url").where("url <> ''").distinct()
    got = wanted.join(pages.select("url").distinct().withColumn("got", F.lit(1)), "url", "left")
    return got.agg(F.coalesce(F.count("got") / F.nullif(F.count(F.lit(1)), F.lit(0)), F.lit(0.0)).alias("reachability"))


def audit(hits: DataFrame, pages: DataFrame, found: DataFrame, problems: DataFrame, items: DataFrame, classes: DataFrame) -> DataFrame:
    """Counters of a run, in one row."""
    c = found.agg(
        F.count(F.lit(1)).alias("candidates_total"),
        F.count_if((F.col("category") == "pass") & (F.col("extracted_from") == "content")).alias("from_fetched_pages"),
        F.count_if((F.col("category") == "pass") & (F.col("extracted_from") == "search_title")).alias("from_search_title"),
        *[F.count_if(F.col("category") == k).alias(f"rejected_{k}") for k in "ABCDE"],
    )
    p = problems.agg(F.count_if(F.col("status") != "confirmed").alias("frequency_rejected"), F.count_if(F.col("status") == "confirmed").alias("confirmed"))
    m = classes.agg((F.count(F.lit(1)) - F.count_distinct("component")).alias("duplicates_merged"))
    return c.join(p, F.lit(True)).join(m, F.lit(True)).join(reachability(hits, pages), F.lit(True))
