"""Sinks: problem lists as JSON and Markdown, harvest manifests, layered files, reports."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..dialect import SPARK
from ..functions import text as rules
from . import ordered_text


#: Columns that put the lines of a report in order.
REPORT_ORDER = ("part", "head", "ord", "sub")


def report_lines(topic: str, problems: DataFrame, matrix: DataFrame, date: str) -> DataFrame:
    """The report as rows ``part, head, ord, sub, value``, in order by the first four:
    a table a perspective in first-seen order, the coverage list, then a block a problem.

    ``problems`` has ``ord, id, text, original, perspective, sub_dimension, status,
    total_frequency, source_count, duplicates, sources``; ``ord`` is unique. Only the
    heads of tables are grouped (first ``ord`` a perspective), so no row or task holds
    the report: :func:`ordered_text.write_text` writes it in parts. A problem with a
    null field that a line shows has an empty line.
    """
    p = problems
    spark = p.sparkSession
    of = lambda part, head, ord, sub, value: [F.lit(part).alias("part"), head.cast("long").alias("head"), ord.cast("long").alias("ord"), F.lit(sub).alias("sub"), value.alias("value")]
    none = F.lit(0)
    fixed = [(0, 0, f"# {topic} — 真问题清单"), (0, 1, ""), (0, 2, f"> 生成时间：{date}"), (0, 3, ""), (2, -2, "## 16 格覆盖度"), (2, -1, ""), (3, 0, ""), (3, 1, "## 详细问题")]
    marks = spark.createDataFrame(fixed, "part int, ord int, value string").select(F.col("part"), F.lit(-1).cast("long").alias("head"), F.col("ord").cast("long"), F.lit(0).alias("sub"), "value")

    first = p.groupBy(F.col("perspective").alias("named")).agg(F.min("ord").alias("head"))
    line = F.format_string("| %s | %s | %s | %s | %s |", "id", "text", "sub_dimension", F.col("source_count").cast("string"), "status")
    rows = p.join(first, F.col("perspective").eqNullSafe(F.col("named"))).select(*of(1, F.col("head"), F.col("ord"), 1, line))
    title = F.concat(F.lit("## "), "named", F.lit("视角\n\n| ID | 问题 | 子维度 | 来源数 | 状态 |\n|---|---|---|---|---|"))
    heads = first.select(*of(1, F.col("head"), F.col("head"), 0, title))
    after = first.select(*of(1, F.col("head"), F.lit((1 << 63) - 1), 2, F.lit("")))

    mark = F.when(F.col("n") > 0, "✅").otherwise("❌")
    cell = F.format_string("- %s / %s: %s (%s)", "perspective", "sub_dimension", mark, F.col("n").cast("string"))
    cover = matrix.select(*of(2, none, F.col("cell"), 0, cell))

    sources = F.transform("sources", lambda s: F.concat(F.lit("\n  - ["), s["type"], F.lit("] "), s["url"], F.lit(" (频次 "), s["frequency"].cast("string"), F.lit(")")))
    block = F.concat(
        F.format_string("\n### %s %s\n- **原始文本**：%s\n- **视角 / 子维度**：%s / %s\n- **状态**：%s\n", "id", "text", "original", "perspective", "sub_dimension", "status"),
        F.format_string("- **总频次 / 来源数**：%s / %s", F.col("total_frequency").cast("string"), F.col("source_count").cast("string")),
        F.when(F.size("duplicates") > 0, F.concat(F.lit("\n- **合并的近似问题**："), F.array_join("duplicates", ", "))).otherwise(""),
        F.when(F.size("sources") > 0, F.concat(F.lit("\n- **来源**："), F.array_join(sources, ""))).otherwise(""),
    )
    detail = p.select(*of(3, none, F.col("ord"), 0, block))
    out = marks
    for more in (heads, rows, after, cover, detail):
        out = out.unionByName(more)
    return out


def write_json(df: DataFrame, path: str) -> None:
    """Rows as JSON objects; fields that are null stay."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def problem_list(problems: DataFrame, head: dict) -> DataFrame:
    """Lines ``part, list, ord, value`` of the one object of a run: the fields of ``head``,
    then ``problems`` (confirmed) and ``pending_validation`` (the rest), by ``ord``."""
    spark = problems.sparkSession
    row = F.to_json(F.struct(*problems.columns), {"ignoreNullFields": "false"})
    out = None
    for n, (name, status) in enumerate([("problems", F.col("status") == "confirmed"), ("pending_validation", F.coalesce(F.col("status") != "confirmed", F.lit(True)))]):
        inner = ordered_text.listed(problems.where(status).select(F.col("ord").cast("long"), row.alias("value")), "ord")
        first, last = F.col("part") == 0, F.col("part") == 2
        value = F.when(first, F.lit(f"{json.dumps(name)}: [")).when(last, F.lit("]," if n == 0 else "]")).otherwise(F.col("value"))
        lines = inner.select(F.lit(1).alias("part"), (F.lit(3 * n) + F.col("part")).alias("list"), F.coalesce("ord", F.lit(0)).alias("ord"), value.alias("value"))
        out = lines if out is None else out.unionByName(lines)
    opening = "{" + "".join(f"{json.dumps(k)}: {json.dumps(v, ensure_ascii=False)}, " for k, v in head.items())
    marks = spark.createDataFrame([(0, opening), (2, "}")], "part int, value string").select("part", F.lit(0).alias("list"), F.lit(0).cast("long").alias("ord"), "value")
    return out.unionByName(marks)


def write_outputs(folder: str, topic: str, problems: DataFrame, audit: DataFrame, matrix: DataFrame, date: str, exit_reason: str = "saturated", rounds: int = 1) -> None:
    """The three artefacts below a new folder: the problem list as one JSON object and
    as Markdown, both texts in ordered parts, and the one-row audit as JSON."""
    head = {"topic": topic, "generated_at": date, "exit_reason": exit_reason, "retrieval_rounds": rounds}
    ordered_text.write_text(problem_list(problems, head), f"{folder}/problem_list", "part", "list", "ord")
    ordered_text.write_text(report_lines(topic, problems, matrix, date), f"{folder}/problem_list_md", *REPORT_ORDER)
    write_json(audit.select(F.lit(topic).alias("topic"), F.lit(date).alias("generated_at"), "*"), f"{folder}/audit_report")


def write_layers(harvested: DataFrame, folder: str) -> DataFrame:
    """Texts by layer, with safe file names: ``layer, name, text`` as Parquet."""
    named = harvested.withColumn("name", F.expr(rules.safe_name(SPARK, "title")))
    named.select("layer", "name", "text").write.mode("overwrite").partitionBy("layer").parquet(folder)
    return named


def harvest_entries(harvested: DataFrame) -> DataFrame:
    """Entries of the harvest manifest: ``url, layer, title, units, value, outcome, watched``."""
    units = F.expr(rules.content_units(SPARK))
    return harvested.select(
        "url", "layer", "title", units.alias("units"), "value", F.expr(rules.harvest_outcome(SPARK)).alias("outcome"), (F.col("value") == "unknown").alias("watched")
    )


def upsert_sources(known: DataFrame, found: DataFrame) -> DataFrame:
    """Sources of ``found`` whose canonical URL is new, the first of each."""
    from ..functions import url as urls

    key = F.expr(urls.canonical(SPARK))
    first = found.withColumn("canonical", key).groupBy("canonical").agg(F.min_by(F.struct(*found.columns), "ord").alias("s")).select("canonical", "s.*")
    return first.join(known.select(key.alias("canonical")), "canonical", "left_anti").drop("canonical")


def watched(entries: DataFrame) -> DataFrame:
    """``url`` of the manifest's entries whose value is unknown: the watch list."""
    return entries.where("value = 'unknown'").select("url")


def append_progress(spark, folder: str, lines: list[str]) -> None:
    """A few progress lines, appended to the log; blanks at their ends go."""
    rows = spark.createDataFrame([(line.rstrip(),) for line in lines], "value string")
    rows.coalesce(1).write.mode("append").text(folder)


def write_confirmations(gates: DataFrame, folder: str) -> DataFrame:
    """The gates (``gate, confirmed``) as a new version below ``folder``; what readers
    see changes only when the version is whole. Returns the version's rows."""
    from uuid import uuid4

    path = f"{folder}/version={uuid4().hex}"
    gates.select("gate", "confirmed").coalesce(1).write.parquet(path)
    return gates.sparkSession.read.parquet(path)


def exit_code(errors: DataFrame) -> int:
    """1 if a report has errors, else 0."""
    return int(not errors.where("severity = 'error'").isEmpty())


def finish(findings, folder: str) -> int:
    """Writes the findings that ``findings()`` gives (``severity`` among their columns)
    as JSON and returns the exit code: 0, 1 with errors, 2 if they could not be made."""
    from pyspark.errors import PySparkException

    try:
        found = findings()
        write_json(found, folder)
        return exit_code(found)
    except (PySparkException, OSError, ValueError) as e:
        print(f"error: {e}")
        return 2
