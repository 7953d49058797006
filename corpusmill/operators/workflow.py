"""Stage state: stamped reports, bound gates, confirmation, dashboards, back-fill rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import packs
from . import evidence


def stamped(reports: DataFrame, inputs: DataFrame, files: DataFrame, checker: str, version: int = 3) -> DataFrame:
    """Reports with their status and the hashes of inputs and checker: ``report, status,
    checker, version, inputs, files``. ``inputs`` has ``report, path, sha256``, ``files`` the checker's."""
    listed = inputs.groupBy("report").agg(F.array_sort(F.collect_set(F.struct("path", "sha256"))).alias("inputs"))
    own = files.agg(F.array_sort(F.collect_set(F.struct("path", "sha256"))).alias("files"))  # the checker's few files
    status = F.when(F.col("n_errors") > 0, "fail").when(F.col("n_warnings") > 0, "minor").otherwise("pass")
    return reports.withColumn("status", status).join(listed, "report", "left").join(own, F.lit(True)).withColumn("checker", F.lit(checker)).withColumn("version", F.lit(version))


def differing_copies(copies: DataFrame) -> DataFrame:
    """Names of files (``name, path, sha256``) whose copies are not all the same."""
    return copies.groupBy("name").agg(F.count_distinct("sha256").alias("versions"), F.count(F.lit(1)).alias("copies")).where("versions > 1")


def gates_passed(gates: DataFrame, bound: DataFrame, current: DataFrame) -> DataFrame:
    """``gate, passed``: confirmed, and the files bound to it (``gate, path, sha256``) are
    exactly the current ones. The topic gate binds no files."""
    mark = lambda df, c: df.select("gate", "path", "sha256").distinct().withColumn(c, F.lit(1))
    both = mark(bound, "b").join(mark(current, "c"), ["gate", "path", "sha256"], "full_outer")
    off = both.where("b IS NULL OR c IS NULL").select("gate").distinct().withColumn("off", F.lit(True))
    fine = F.coalesce(F.col("confirmed") != "", F.lit(False)) & ((F.col("gate") == "topic") | F.col("off").isNull())
    return gates.join(off, "gate", "left").select("gate", fine.alias("passed"))


def confirmed(gates: DataFrame, gate: str, value: str, spark: SparkSession) -> DataFrame:
    """Gates after one is confirmed: those of later stages are open again."""
    at = packs.STAGES.index(packs.GATE_STAGE[gate])
    kept = [g for g, s in packs.GATE_STAGE.items() if packs.STAGES.index(s) <= at and g != gate]
    rows = gates.where(F.col("gate").isin(kept) if kept else F.lit(False)).select("gate", "confirmed")
    return rows.unionByName(spark.createDataFrame([(gate, value)], "gate string, confirmed string"))


def stage_status(assets: DataFrame, spark: SparkSession) -> DataFrame:
    """``stage_idx, stage, satisfied``: a stage needs all its assets (``stage, asset, ok``)."""
    ok = assets.groupBy("stage").agg(F.bool_and("ok").alias("ok"))
    return evidence.stage_table(spark).where("stage <> 'init'").join(ok, "stage", "left").select("stage_idx", "stage", F.coalesce("ok", F.lit(False)).alias("satisfied"))


def dashboard(status: DataFrame) -> DataFrame:
    """``tutorial, line``: done stages, the current one, a mark for each stage in order."""
    marks = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("stage_idx", "stage", "satisfied"))), lambda s: F.concat(F.when(s["satisfied"], "✅").otherwise("⬜"), s["stage"])), " → ")
    done = F.count_if("satisfied")
    return status.groupBy("tutorial").agg(F.concat_ws(" ", F.concat(done.cast("string"), F.lit("/"), F.count(F.lit(1)).cast("string")), marks).alias("line"))


def blocker_hint(blocked: DataFrame) -> DataFrame:
    """``tutorial, text``: the first reason (``tutorial, ord, reason``) and what can be done about all."""
    listed = blocked.groupBy("tutorial").agg(F.min_by("reason", "ord").alias("first"), F.bool_or(F.col("reason").contains("硬闸门")).alias("gate"), F.bool_or(F.col("reason").rlike("缺 |没有|机检|不通过")).alias("lacking"))
    return listed.select("tutorial", F.concat_ws(
        "\n", F.concat(F.lit("⚠️ 当前阻塞："), "first"), F.lit("\n你可以："), F.when(F.col("gate"), "- 拍板确认 → 我写入 confirmations.json 继续\n- 回退修改 → 我重置对应闸门，旧产物保留可比"),
        F.when(F.col("lacking"), "- 补齐产物 → 我先补跑/修到达标再继续"), F.lit("- 暂停 → 进度已落 progress.md，随时 resume 恢复"),
    ).alias("text"))


def library_assets(libraries: DataFrame, entries: DataFrame) -> DataFrame:
    """``tutorial, ok``: a topic, entries, enough material, no gap in coverage.
    ``libraries`` has ``tutorial, topic, material_ok, coverage_gaps``, ``entries`` ``tutorial``."""
    n = entries.groupBy("tutorial").agg(F.count(F.lit(1)).alias("n"))
    fine = (F.trim("topic") != "") & (F.col("n") > 0) & F.col("material_ok") & (F.col("coverage_gaps") == "")
    return libraries.join(n, "tutorial", "left").select("tutorial", F.coalesce(fine, F.lit(False)).alias("ok"))


def problem_assets(lists: DataFrame, problems: DataFrame) -> DataFrame:
    """``tutorial, ok``: a topic (``tutorial, topic``), and problems (``tutorial, text``) that all have a text."""
    n = problems.groupBy("tutorial").agg(F.bool_and(F.coalesce(F.trim("text") != "", F.lit(False))).alias("whole"))
    return lists.join(n, "tutorial", "left").select("tutorial", F.coalesce((F.trim("topic") != "") & F.col("whole"), F.lit(False)).alias("ok"))


def answer_assets(cards: DataFrame, fresh: DataFrame) -> DataFrame:
    """``tutorial, ok``: the manifest's report is fresh (``tutorial, fresh``), all cards are of
    version 3, met, of high or middle confidence, with a question that no other has."""
    good = (F.col("version") == 3) & (F.col("state") == "达标") & F.col("confidence").isin("高", "中") & (F.trim("question") != "")
    n = cards.groupBy("tutorial").agg(F.bool_and(F.coalesce(good, F.lit(False))).alias("good"), (F.count_distinct("question") == F.count(F.lit(1))).alias("once"))
    return fresh.join(n, "tutorial", "left").select("tutorial", F.coalesce(F.col("fresh") & F.col("good") & F.col("once"), F.lit(False)).alias("ok"))


def dimensions(articles: DataFrame, findings: DataFrame, outcomes: DataFrame, with_steps: DataFrame) -> DataFrame:
    """``article, dimension, status, n_errors``: the four dimensions of each article.

    ``findings`` has ``article, dimension``; outcomes (``article, state``) decide what is
    verifiable; articles without declared steps (``with_steps``) have none to follow.
    """
    grid = articles.select("article").distinct().select("article", F.explode(F.array(*map(F.lit, packs.DIMENSIONS))).alias("dimension"))
    n = findings.groupBy("article", "dimension").agg(F.count(F.lit(1)).alias("n"))
    j = grid.join(n, ["article", "dimension"], "left").join(outcomes.select("article", "state"), "article", "left")
    j = j.join(with_steps.select("article").distinct().withColumn("steps", F.lit(True)), "article", "left").withColumn("n_errors", F.coalesce("n", F.lit(0).cast("long")))
    follow, verify = packs.DIMENSIONS[:2]
    status = F.when(F.col("dimension") == verify, F.coalesce("state", F.lit("not_verified"))).when(F.col("n_errors") > 0, "fail").when((F.col("dimension") == follow) & F.col("steps").isNull(), "not_applicable").otherwise("pass")
    return j.select("article", "dimension", status.alias("status"), "n_errors")


def qc_collection(articles: DataFrame, checks: DataFrame, dims: DataFrame) -> DataFrame:
    """``article, reason``: the tutorial and render reports (``article, checker, fresh``) must be
    fresh and every dimension (``article, dimension, status``) passed or not applicable."""
    is_fresh = lambda c: F.coalesce(F.bool_or(F.when(F.col("checker") == c, F.col("fresh"))), F.lit(False)).alias(c)
    c = checks.groupBy("article").agg(is_fresh("tutorial"), is_fresh("render"))
    fine = F.col("status").isin("pass", "not_applicable")
    known = F.count_distinct(F.when(F.col("dimension").isin(packs.DIMENSIONS), F.col("dimension"))) == len(packs.DIMENSIONS)
    good = dims.groupBy("article").agg((F.bool_and(F.coalesce(fine, F.lit(False))) & known).alias("good"))
    j = articles.select("article").distinct().join(c, "article", "left").join(good, "article", "left").na.fill(False)
    why = packs.QC_REASONS
    first = F.when(~F.col("tutorial"), why["tutorial"]).when(~F.col("good"), why["dimension"])
    reasons = F.filter(F.array(first, F.when(~F.col("render"), why["render"])), lambda r: r.isNotNull())
    return j.select("article", F.explode(reasons).alias("reason"))


def waived_cells(rounds: DataFrame, empty: int = 2) -> DataFrame:
    """Cells that stay empty after as many back-fill rounds without a find: ``perspective, sub_dimension``."""
    tried = rounds.where("backfill").groupBy("perspective", "sub_dimension").agg(F.count_if(F.col("found") == 0).alias("n_empty"), F.sum("found").alias("n"))
    return tried.where((F.col("n_empty") >= empty) & (F.col("n") == 0)).select("perspective", "sub_dimension")


def search_rounds(rounds: DataFrame) -> DataFrame:
    """Rounds that count towards saturation: back-fills do not."""
    return rounds.where(~F.col("backfill"))
