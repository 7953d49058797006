"""Sources, claims and cards: independence, confidence, references, contracts, lineage, stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import packs
from ..dialect import SPARK
from ..functions import text as rules
from ..functions import url as urls


def independence(sources: DataFrame) -> DataFrame:
    """Warnings for sources that are not independent: ``card, ord, rule, key, first``.

    ``sources`` has ``card, ord, name, url, original_source_id``. Repeated
    originals, aggregators (exact host), repeated articles; repeated domains,
    where academic articles are not held to the domain.
    """
    s = sources.withColumn("host", F.expr(urls.host(SPARK))).withColumn("article", F.expr(urls.article_key(SPARK)))
    has_url = F.coalesce(F.col("url"), F.lit("")) != ""

    def repeated(df: DataFrame, key: str, rule: str) -> DataFrame:
        w = Window.partitionBy("card", key).orderBy("ord")
        return df.withColumn("k", F.row_number().over(w)).withColumn("first", F.first("name").over(w)).where("k > 1").select(
            "card", "ord", F.lit(rule).alias("rule"), F.col(key).alias("key"), "first"
        )

    originals = repeated(s.where("original_source_id <> ''"), "original_source_id", "original")
    turned = s.where(has_url & F.col("host").isin(packs.AGGREGATORS)).select("card", "ord", F.lit("aggregator").alias("rule"), F.col("host").alias("key"), F.col("name").alias("first"))
    articles = repeated(s.where(has_url & F.col("article").isNotNull()), "article", "article")
    domains = repeated(s.where(has_url & F.col("article").isNull()), "host", "domain")
    return originals.unionByName(turned).unionByName(articles).unionByName(domains)


def authorities(sources: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Sources graded high that can be checked: no aggregator (or below one), with a
    key, and a valid URL or, for local ones, a file of the library (``files.path``)."""
    s = sources.withColumn("key", F.expr(urls.source_key(SPARK))).withColumn("local", F.expr(rules.local_source(SPARK, "name")))
    s = s.where(F.coalesce(F.col("grade") == "high", F.lit(False)) & ~F.expr(urls.aggregator(SPARK)) & F.col("key").isNotNull())
    remote = s.where(~F.col("local") & F.expr(urls.valid(SPARK)))
    if files is None:
        return remote
    return remote.unionByName(s.where("local").join(files.select(F.col("path").alias("name")), "name", "left_semi"))


def confidence(cards: DataFrame, sources: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """``card, groups, confidence``: 低 without an authority, 高 with two independent
    ones, no conflict and a library to check against, else 中.

    Counting is a fold over a card's sources in order: a source whose key was
    seen, or whose domain was (unless it is an academic article), adds nothing.
    ``cards`` has ``card, has_conflict``.
    """
    auth = authorities(sources, files).withColumn("host", F.expr(urls.host(SPARK))).withColumn("article", F.expr(urls.article_key(SPARK)))
    listed = auth.groupBy("card").agg(F.array_sort(F.collect_list(F.struct("ord", "key", "host", (F.col("article").isNotNull()).alias("academic")))).alias("a"))
    kind = "struct<keys:array<string>,hosts:array<string>>"
    start = F.struct(F.array().cast("array<string>").alias("keys"), F.array().cast("array<string>").alias("hosts")).cast(kind)

    def step(acc, x):
        seen = F.array_contains(acc["keys"], x["key"]) | ((x["host"] != "") & F.array_contains(acc["hosts"], x["host"]) & ~x["academic"])
        more = F.struct(F.array_append(acc["keys"], x["key"]).alias("keys"), F.when(x["host"] != "", F.array_append(acc["hosts"], x["host"])).otherwise(acc["hosts"]).alias("hosts"))
        return F.when(seen, acc).otherwise(more.cast(kind))

    counted = listed.select("card", F.aggregate("a", start, step, lambda acc: F.size(acc["keys"])).cast("long").alias("groups"))
    out = cards.join(counted, "card", "left").withColumn("groups", F.coalesce("groups", F.lit(0).cast("long")))
    high = (F.col("groups") >= 2) & ~F.col("has_conflict") & F.lit(files is not None)
    return out.select("card", "groups", F.when(F.col("groups") == 0, "低").when(high, "高").otherwise("中").alias("confidence"))


def answers_manifest(graded: DataFrame, problems: DataFrame, warnings: DataFrame) -> DataFrame:
    """``card, confidence, state, reasons``: cards graded anew; one with broken rules
    (``problems``) or low confidence is to be completed whatever it says of itself.
    Reasons to watch it: low confidence, to be completed, doubtful independence (once)."""
    bad = problems.select("card").distinct().withColumn("bad", F.lit(True))
    odd = warnings.select("card").distinct().withColumn("odd", F.lit(True))
    rows = graded.join(bad, "card", "left").join(odd, "card", "left")
    low = F.col("confidence") == "低"
    open_ = low | F.coalesce("bad", F.lit(False)) | (F.col("state") == "待补采")
    reasons = F.filter(F.array(F.when(low, "置信度低"), F.when(open_, "待补采"), F.when(F.coalesce("odd", F.lit(False)), "独立性存疑")), lambda r: r.isNotNull())
    return rows.select("card", "confidence", F.when(open_, "待补采").otherwise(F.col("state")).alias("state"), reasons.alias("reasons"))


def watch_list(graded: DataFrame, problems: DataFrame, warnings: DataFrame) -> DataFrame:
    """``card, reason``: a row for each reason of :func:`answers_manifest`."""
    return answers_manifest(graded, problems, warnings).select("card", F.explode("reasons").alias("reason"))


def answers_statistics(manifest: DataFrame) -> DataFrame:
    """``n_cards, n_met, n_open, n_watched`` of an answers manifest."""
    state = F.col("state")
    return manifest.agg(
        F.count(F.lit(1)).alias("n_cards"), F.count_if(state == "达标").alias("n_met"), F.count_if(state == "待补采").alias("n_open"),
        F.coalesce(F.sum(F.size("reasons").cast("long")), F.lit(0)).cast("long").alias("n_watched"),
    )


def regraded(stated: DataFrame, graded: DataFrame) -> DataFrame:
    """``card, stated, graded``: cards that state (``card, confidence``) another confidence than they get."""
    s = stated.where("confidence <> ''").select("card", F.col("confidence").alias("stated"))
    return s.join(graded.select("card", F.col("confidence").alias("graded")), "card").where("stated <> graded")


def unmatched_articles(cards: DataFrame, outlines: DataFrame, chapters: DataFrame) -> DataFrame:
    """``part, rule``: cards (``question``) need exactly one outline (``article_id,
    question``) and outlines a card; chapters (``article_id``) are those of the outlines."""
    n = outlines.groupBy("question").agg(F.count(F.lit(1)).alias("n"))
    asked = cards.select("question").distinct().withColumn("card", F.lit(True)).join(n, "question", "full_outer")
    rule = F.when(F.col("n").isNull(), "no_outline").when(F.col("card").isNull(), "unknown_card").when(F.col("n") > 1, "repeated_outline")
    planned = outlines.select("article_id").distinct().withColumn("planned", F.lit(True))
    written_ = chapters.select("article_id").distinct().withColumn("there", F.lit(True))
    both = planned.join(written_, "article_id", "full_outer")
    lacking = F.when(F.col("there").isNull(), "no_chapter").when(F.col("planned").isNull(), "unknown_chapter")
    found = asked.select(F.col("question").alias("part"), rule.alias("rule")).unionByName(both.select(F.col("article_id").alias("part"), lacking.alias("rule")))
    return found.where("rule IS NOT NULL")


def unknown_card_fields(references: DataFrame, fields: DataFrame, sources: DataFrame) -> DataFrame:
    """References (``article, section, ref``) of early outlines that name neither a filled
    field of their card (``article, field, value``) nor one of its sources (``article, source_id``)."""
    known = fields.where("value <> ''").select("article", F.col("field").alias("ref")).unionByName(sources.select("article", F.col("source_id").alias("ref")))
    return references.join(known, ["article", "ref"], "left_anti").select("article", "section", "ref")


def unknown_references(evidence: DataFrame, claims: DataFrame) -> DataFrame:
    """Cited claim ids that no claim has."""
    return evidence.join(claims.select("article", "claim_id"), ["article", "claim_id"], "left_anti")


def missing_quotes(quotes: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Quotes that do not occur in their source's text."""
    return quotes.join(snapshots, "source_id").where(~F.col("text").contains(F.col("quote"))).select(*quotes.columns)


def unique_match(outlines: DataFrame, cards: DataFrame) -> DataFrame:
    """Outlines with the card of their question, where exactly one has it."""
    one = cards.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("question"))).where("n = 1").drop("n")
    return outlines.join(one, "question", "left")


def id_errors(ids: DataFrame, scope: str, col: str) -> DataFrame:
    """``scope, col, error``: ids missing, malformed or repeated within their scope."""
    repeats = F.row_number().over(Window.partitionBy(scope, col).orderBy("ord")) > 1
    bad = ~F.coalesce(F.col(col).rlike(r"^[A-Za-z0-9][A-Za-z0-9_-]*$"), F.lit(False))
    return ids.withColumn("__r", repeats).select(scope, "ord", col, F.when(bad, "malformed").when(F.col("__r"), "repeated").alias("error")).where("error IS NOT NULL")


def required_errors(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``key, field``: required text fields that are null or blank."""
    lacking = F.filter(F.array(*[F.when(~F.expr(rules.nonempty(SPARK, f"`{f}`")), F.lit(f)) for f in fields]), lambda f: f.isNotNull())
    return df.select(key, F.explode(lacking).alias("field"))


def one_to_one(criteria: DataFrame, checks: DataFrame) -> DataFrame:
    """``article, criterion_id, error``: criteria unchecked, checks unknown or repeated."""
    n = checks.groupBy("article", "criterion_id").agg(F.count(F.lit(1)).alias("n"))
    both = criteria.select("article", "criterion_id", F.lit(True).alias("wanted")).join(n, ["article", "criterion_id"], "full_outer")
    error = F.when(F.col("n").isNull(), "unchecked").when(F.col("wanted").isNull(), "unknown").when(F.col("n") > 1, "repeated")
    return both.select("article", "criterion_id", error.alias("error")).where("error IS NOT NULL")


def stale_inputs(recorded: DataFrame, current: DataFrame) -> DataFrame:
    """``report, path``: recorded inputs whose file is gone or has another hash."""
    now = current.select("path", F.col("sha256").alias("now"))
    return recorded.join(now, "path", "left").where("now IS NULL OR now <> sha256").select("report", "path")


def fresh_reports(reports: DataFrame, recorded: DataFrame, current: DataFrame, required: DataFrame) -> DataFrame:
    """``report, fresh``: version 3, no errors, counts as listed, status pass or minor,
    all inputs unchanged and all required inputs recorded."""
    stale = stale_inputs(recorded, current).select("report").distinct().withColumn("stale", F.lit(True))
    lacking = required.join(recorded.select("report", "path"), ["report", "path"], "left_anti").select("report").distinct().withColumn("lacking", F.lit(True))
    any_input = recorded.select("report").distinct().withColumn("any", F.lit(True))
    sound = (F.col("version") == 3) & (F.col("n_errors") == 0) & (F.col("error_count") == 0) & (F.col("warning_count") == F.col("n_warnings")) & F.col("status").isin("pass", "minor")
    rows = reports.join(stale, "report", "left").join(lacking, "report", "left").join(any_input, "report", "left")
    return rows.select("report", (F.coalesce(sound, F.lit(False)) & F.col("stale").isNull() & F.col("lacking").isNull() & F.col("any").isNotNull()).alias("fresh"))


def stage_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(packs.STAGES)), "stage_idx int, stage string")


def blocked(prerequisites: DataFrame, target: str, spark: SparkSession) -> DataFrame:
    """Prerequisites (``reason, min_stage, ok``) that keep a target stage from starting."""
    at = packs.STAGES.index(target)
    stages = stage_table(spark).withColumnRenamed("stage", "min_stage")
    return prerequisites.join(F.broadcast(stages), "min_stage").where(f"stage_idx <= {at} AND NOT ok").select("stage_idx", "reason")


def current_stage(status: DataFrame) -> DataFrame:
    """The first stage (by ``stage_idx``) that is not satisfied."""
    return status.groupBy("tutorial").agg(F.min_by("stage", F.when(~F.col("satisfied"), F.col("stage_idx"))).alias("stage"), F.count_if("satisfied").alias("done"))


def rolled_back(gates: DataFrame, target: str, spark: SparkSession) -> DataFrame:
    """Gates that survive going back to a stage: those of earlier stages."""
    at = packs.STAGES.index(target)
    kept = [g for g, s in packs.GATE_STAGE.items() if packs.STAGES.index(s) < at]
    return gates.where(F.col("gate").isin(kept) if kept else F.lit(False))


def saturation(rounds: DataFrame, threshold: float = 0.5, consecutive: int = 3) -> DataFrame:
    """``topic, round, rate, streak, saturated``: new findings over what was known.

    The streak counts rounds below the threshold since the last one that was not.
    """
    rate = F.when(F.col("prev_total") == 0, F.when(F.col("new_count") > 0, 1.0).otherwise(0.0)).otherwise(F.col("new_count") / F.col("prev_total"))
    order = Window.partitionBy("topic").orderBy("round")
    marked = rounds.withColumn("rate", rate).withColumn("low", (F.col("rate") < threshold).cast("int"))
    runs = marked.withColumn("run", F.sum(1 - F.col("low")).over(order))
    streak = F.sum("low").over(Window.partitionBy("topic", "run").orderBy("round"))
    return runs.withColumn("streak", streak).select("topic", "round", "rate", "streak", (F.col("streak") >= consecutive).alias("saturated"))


def acceptance(total: DataFrame, target_words: int, coverage: DataFrame) -> DataFrame:
    """``material_ok, needed_units, coverage_gaps``: three times the target, two sources a question."""
    gaps = coverage.where("n_sources < 2").agg(F.array_join(F.sort_array(F.collect_list("question")), "、").alias("coverage_gaps"))
    need = target_words * 3
    return total.select((F.col("total") >= need).alias("material_ok"), F.greatest(F.lit(0), need - F.col("total")).cast("long").alias("needed_units")).join(gaps, F.lit(True))
