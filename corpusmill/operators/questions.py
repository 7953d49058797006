"""Question extraction, judging, source aggregation, gates, coverage, next queries."""

from __future__ import annotations

import html as html_entities

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import packs
from ..dialect import SPARK, column
from ..functions import text as rules
from ..functions import url as urls
from ..work import written
from . import dedupe


@F.pandas_udf(StringType())
def unescape(text: pd.Series) -> pd.Series:
    """HTML character references; the full table is the standard library's."""
    return text.map(lambda t: None if t is None else html_entities.unescape(t))


def stripped(html: Column | str) -> Column:
    """Text of markup: no scripts, styles, tags; references resolved."""
    name = html if isinstance(html, str) else None
    return unescape(F.expr(rules.strip_html(SPARK, name)))


def _over(df: DataFrame, into: str, rule, source: str, **options) -> DataFrame:
    return df.withColumn(into, F.expr(rule(SPARK, source, **options)))


def with_title_question(df: DataFrame, title: str = "title", into: str = "question", terms: list[str] | None = None, hold: bool = False) -> DataFrame:
    """The question in a title, or null: cleaned, ending as one, relevant, real.

    ``hold`` writes the cleaned titles first. Without it a later filter on the
    result is pushed below the cleaning, which then stands in the plan once for
    each of the many tests.
    """
    df = _over(df, "__a", rules.title_bare, title)
    df = _over(df, "__b", rules.clean_tail, "__a")
    df = _over(df, "__c", rules.unquoted, "__b")
    df = _over(df, "__d", rules.clean_head_rest, "__c")
    df = _over(df, "__q", rules.normalised, "__d")
    ends = F.col("__d").rlike("(？|\\?|吗|呢)$")
    df = written(df, "titles") if hold else df
    fine = (~column(rules.not_question, "__d")) & ends & column(rules.question_like, "__d") & column(rules.relevant, "__q", terms=terms) & column(rules.real_question, "__q")
    return df.withColumn(into, F.when(fine, F.col("__q"))).drop("__a", "__b", "__c", "__d", "__q")


def content_questions(pages: DataFrame, terms: list[str] | None = None, most: int = 50) -> DataFrame:
    """``url, pos, text``: questions of page bodies, headings first, distinct in
    order of appearance; no more sentences once ``most`` are found (headings all count)."""
    heads = pages.select("url", F.posexplode(F.regexp_extract_all("html", F.lit("(?s)<h[1-3][^>]*>(.*?)</h[1-3]>"), F.lit(1))).alias("pos", "h"))
    heads = with_title_question(heads.withColumn("title", stripped("h")), "title", "text", terms, hold=True).where("text IS NOT NULL")
    heads = heads.select("url", F.lit(0).alias("part"), "pos", "text")
    parts = pages.select("url", stripped("html").alias("t")).select(
        "url", F.posexplode(F.split("t", "(?<=[。！？?\\n“”‘’「」『』()（）])")).alias("pos", "s")
    )
    asked = parts.withColumn("s", F.expr(SPARK.strip("s"))).where(~column(rules.not_question, "s") & F.col("s").rlike("(？|\\?|吗|呢)$") & column(rules.question_like, "s"))
    asked = _over(asked, "q", rules.normalised, "s")
    asked = written(_over(asked, "q", rules.clean_question, "q").select("url", "pos", "q"), "asked").where(column(rules.real_question, "q"))
    asked = _over(asked, "q", rules.clean_tail, "q")
    asked = _over(asked, "q", rules.unquoted, "q")
    asked = written(_over(asked, "q", rules.clean_head_rest, "q"), "asked").where(column(rules.relevant, "q", terms=terms))
    every = heads.unionByName(asked.select("url", F.lit(1).alias("part"), "pos", F.col("q").alias("text")))
    first = Window.partitionBy("url", "text").orderBy("part", "pos")
    distinct = every.withColumn("k", F.row_number().over(first)).where("k = 1")
    ranked = distinct.withColumn("n", F.row_number().over(Window.partitionBy("url").orderBy("part", "pos")))
    return ranked.where((F.col("n") <= most) | (F.col("part") == 0)).select("url", F.col("n").alias("pos"), "text")


def flatten_manifest(manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hits, pages): search hits with their ordinals, and fetched pages."""
    groups = manifest.select(F.posexplode("search_results").alias("group_idx", "g"))
    hits = groups.select("group_idx", "g.perspective", "g.sub_dimension", "g.query", F.posexplode("g.results").alias("result_idx", "r")).select(
        "group_idx", "result_idx", "perspective", "sub_dimension", "query", "r.title", "r.url", "r.snippet"
    )
    pages = manifest.select(F.explode("fetched_pages").alias("url", "html"))
    return hits, pages


def candidates(hits: DataFrame, pages: DataFrame, terms: list[str] | None = None) -> DataFrame:
    """Questions of each hit: of its page where one was fetched, else of its title.

    ``cand_idx, text, source_url, extracted_from, perspective, sub_dimension``.
    """
    fetched = pages.where("html IS NOT NULL AND html <> ''")
    body = hits.join(content_questions(fetched, terms), "url").select(
        "group_idx", "result_idx", "pos", "text", F.col("url").alias("source_url"), F.lit("content").alias("extracted_from"), "perspective", "sub_dimension"
    )
    rest = with_title_question(hits.join(fetched, "url", "left_anti"), "title", "text", terms, hold=True).where("text IS NOT NULL")
    titles = rest.select(
        "group_idx", "result_idx", F.lit(0).alias("pos"), "text", F.col("url").alias("source_url"), F.lit("search_title").alias("extracted_from"), "perspective", "sub_dimension"
    )
    order = F.struct("group_idx", "result_idx", "pos")
    return body.unionByName(titles).withColumn("cand_idx", order).drop("group_idx", "result_idx", "pos")


def aggregate_sources(questions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(texts, sources): texts by normalised key, first wins; URLs with counts and tiers."""
    keyed = questions.withColumn("key", column(rules.normalised, "text")).where("key <> ''")
    texts = keyed.groupBy("key").agg(
        F.min_by("text", "cand_idx").alias("text"), F.min_by("perspective", "cand_idx").alias("perspective"),
        F.min_by("sub_dimension", "cand_idx").alias("sub_dimension"), F.min("cand_idx").alias("first"),
    )
    sources = keyed.groupBy("key", F.col("source_url").alias("url")).agg(F.count(F.lit(1)).alias("frequency"))
    sources = sources.withColumn("type", F.coalesce(F.expr(urls.tier(SPARK, "url")), F.lit("tertiary")))
    return texts, sources


def frequency_gate(sources: DataFrame, by: str) -> DataFrame:
    """``by, status, total_frequency, source_count``: confirmed with a primary source,
    two hits of secondary or three of tertiary ones."""
    hits = lambda t: F.sum(F.when(F.col("type") == t, F.col("frequency")).otherwise(0))
    ok = (F.max(F.when(F.col("type") == "primary", 1).otherwise(0)) == 1) | (hits("secondary") >= 2) | (hits("tertiary") >= 3)
    return sources.groupBy(by).agg(
        F.when(ok, "confirmed").otherwise("single_source").alias("status"), F.sum("frequency").alias("total_frequency"), F.count_distinct("url").alias("source_count")
    )


def cells(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, p, s) for i, (p, s) in enumerate(packs.CELLS)], "cell int, perspective string, sub_dimension string")


def coverage(problems: DataFrame) -> DataFrame:
    """All cells with their number of problems, zeros too; others are ignored."""
    n = problems.groupBy("perspective", "sub_dimension").agg(F.count(F.lit(1)).alias("n"))
    return cells(problems.sparkSession).join(n, ["perspective", "sub_dimension"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def missing(matrix: DataFrame, abstract: bool = False) -> DataFrame:
    """Cells without problems, those exempt for abstract topics left out."""
    found = matrix.where("n < 1")
    if abstract:
        for p, s in packs.ABSTRACT_EXEMPT:
            found = found.where(~((F.col("perspective") == p) & (F.col("sub_dimension") == s)))
    return found


def coverage_summary(matrix: DataFrame, abstract: bool = False) -> DataFrame:
    """One row ``fully_covered, n_missing, missing, exempt``: cells without problems in
    the grid's order, and those that an abstract topic need not fill."""
    cell = F.struct("cell", F.concat_ws("/", "perspective", "sub_dimension").alias("name"))
    names = F.array_join(F.transform(F.array_sort(F.collect_list(cell)), lambda c: c["name"]), "、")  # the grid has few cells
    exempt = "、".join("/".join(c) for c in packs.ABSTRACT_EXEMPT) if abstract else ""
    n = F.count(F.lit(1))
    return missing(matrix, abstract).agg((n == 0).alias("fully_covered"), n.alias("n_missing"), names.alias("missing"), F.lit(exempt).alias("exempt"))


def source_gap(sources: DataFrame, top: list[str]) -> DataFrame:
    """One row ``counts, gap``: how many sources (``note, title``) name each of the few
    top questions, and those that none does, joined by 、, or 无. One pass, no join."""
    text = F.concat(F.coalesce("note", F.lit("")), F.coalesce("title", F.lit("")))
    counted = sources.agg(F.array(*[F.count_if(text.contains(q)) for q in top]).alias("counts"))
    lacking = F.filter(F.array(*[F.when(F.col("counts")[i] == 0, F.lit(q)) for i, q in enumerate(top)]), lambda q: q.isNotNull())
    return counted.select(F.array_join(F.transform("counts", lambda n: n.cast("string")), "、").alias("counts"), F.when(F.size(lacking) > 0, F.array_join(lacking, "、")).otherwise("无").alias("gap"))


def topic_relevant(rows: DataFrame, terms: DataFrame, text: str = "text") -> DataFrame:
    """``rows`` with ``relevant``: the text holds a term of its ``topic`` (case kept).

    ``terms`` has ``topic, term``; a topic without terms, or none, takes the core terms.
    Terms are folded to an array a topic, so a row meets one array, not every term.
    """
    listed = terms.where("topic IS NOT NULL AND term <> ''").groupBy("topic").agg(F.collect_set("term").alias("__terms"))
    core = F.array(*map(F.lit, packs.CORE_TERMS))
    held = F.coalesce(F.exists(F.coalesce("__terms", core), lambda t: F.col(text).contains(t)), F.lit(False))
    return rows.join(listed, "topic", "left").withColumn("relevant", held).drop("__terms")


def queries(gaps: DataFrame, topic: str, terms: list[str], templates: dict = packs.NEXT_ROUND, people: list[str] = packs.NEXT_PEOPLE, per_cell: int | None = 3) -> DataFrame:
    """``perspective, sub_dimension, n, query``: term by template, person by term by
    template for groups of people; distinct in order, ``per_cell`` at most if given."""
    spark = gaps.sparkSession
    shapes = spark.createDataFrame([(*k, i, t) for k, ts in templates.items() for i, t in enumerate(ts)], "perspective string, sub_dimension string, t int, template string")
    words = spark.createDataFrame([(i, w) for i, w in enumerate([topic, *terms][:5])], "w int, term string")
    who = spark.createDataFrame(list(enumerate(people)), "p int, person string")
    asked = gaps.select("cell", "perspective", "sub_dimension").distinct().join(F.broadcast(shapes), ["perspective", "sub_dimension"])
    grouped = F.col("sub_dimension") == "人群差异"
    by_person = asked.where(grouped).join(F.broadcast(who), F.lit(True)).join(F.broadcast(words.where("w < 3")), F.lit(True))
    by_term = asked.where(~grouped).join(F.broadcast(words), F.lit(True)).withColumn("p", F.lit(0)).withColumn("person", F.lit(""))
    made = by_person.unionByName(by_term).withColumn("query", F.expr(f"replace(replace(template, '{packs.PERSON}', person), '{packs.TERM}', term)"))
    order = F.struct("p", "w", "t")
    first = made.groupBy("cell", "perspective", "sub_dimension", "query").agg(F.min(order).alias("o")) if per_cell else made.withColumn("o", order)
    ranked = first.withColumn("n", F.row_number().over(Window.partitionBy("cell").orderBy("o")))
    return (ranked.where(F.col("n") <= per_cell) if per_cell else ranked).select("perspective", "sub_dimension", "n", "query")


def expand_terms(results: DataFrame, topic: str, most: int = 10) -> DataFrame:
    """``ord, term``: synonyms named after hint words, distinct in order of appearance."""
    text = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("snippet", F.lit("")))
    found = results.select("idx", text.alias("t"))
    by_hint = None
    for h, hint in enumerate(packs.SYNONYM_HINTS):
        part = found.select("idx", F.lit(h).alias("h"), F.posexplode(F.regexp_extract_all("t", F.lit(f"[^，。；！？\\n]{{0,20}}{hint}[^，。；！？\\n]{{0,60}}"), F.lit(0))).alias("m", "s"))
        by_hint = part if by_hint is None else by_hint.unionByName(part)
    terms = by_hint.select("idx", "h", "m", F.posexplode(F.split("s", "[、，；/]")).alias("p", "term")).withColumn("term", F.expr(SPARK.strip("term")))
    kept = terms.where((F.length("term") >= 2) & (F.col("term") != topic))
    first = kept.groupBy("term").agg(F.min(F.struct("idx", "h", "m", "p")).alias("o"))
    return first.orderBy("o").limit(most).select(F.row_number().over(Window.orderBy("o")).alias("ord"), "term")


def gaps(problems: DataFrame, cards: DataFrame, topic: str, least: int = 2) -> DataFrame:
    """``question, frequency``: problems near the topic (shared bigrams, or a trigram
    of theirs within it) that no card covers. Thresholds fall with short topics."""
    grams = sorted({topic[i : i + 2] for i in range(len(topic) - 1)})
    need = min(least, len(grams))
    own = F.expr(rules.shingles(SPARK, "question", 2))
    shared = F.size(F.array_intersect(own, F.array(*map(F.lit, grams)))) if grams else F.lit(0)
    inside = F.exists(F.expr(rules.shingles(SPARK, "question", 3)), lambda g: F.lit(topic).contains(g))
    return problems.where((F.col("question") != "") & ((shared >= need) | inside)).join(cards.select("question"), "question", "left_anti")
