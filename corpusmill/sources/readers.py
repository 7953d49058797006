"""Sources: manifests, cards, outlines, Markdown trees, reports; all as typed relations.

JSON is read with a fixed schema and permissive parsing: a corrupt file is a row
with ``_corrupt_record``, never a failed job. Files outside the library root, or
named by absolute or climbing paths, are rejected by rule before they are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_HIT = "struct<title:string,url:string,snippet:string>"
#: The collection manifest: what was searched for, found and fetched.
MANIFEST = (
    "topic string, expanded_terms array<string>, retrieval_rounds int, "
    f"search_results array<struct<perspective:string,sub_dimension:string,query:string,results:array<{_HIT}>>>, fetched_pages map<string,string>"
)
_RECORD = "struct<status:string,by:string,at:string,method:string>"
_CLAIM = (
    "struct<claim_id:string,statement:string,claim_type:string,scope:string,conflicts:array<string>,"
    f"evidence:array<struct<source_id:string,locator:string,quote:string>>,verification:struct<support:{_RECORD}>>"
)
#: An answer card with its sources and claims.
CARD = (
    "schema_version int, `问题` string, `类型` string, `一句话答案` string, `置信度` string, `状态` string, `争议点` array<string>, `适用边界` array<string>, "
    "`出处` array<struct<source_id:string,`来源`:string,url:string,original_source_id:string,`定级`:string,sha256:string>>, "
    f"claims array<{_CLAIM}>"
)
#: An outline contract.
OUTLINE = (
    "schema_version int, article_id string, `问题` string, `标题` string, `类型` string, tutorial_type string, `写给` string, `读完能` string, `适用范围` string, "
    "`前置条件` array<string>, `失败边界` array<string>, `交付物` array<string>, `环境` map<string,string>, "
    "`成功标准` array<struct<criterion_id:string,`描述`:string,`验证方法`:string,`预期结果`:string>>, "
    "`小节` array<struct<section_id:string,`标题`:string,`干什么`:string,`证据`:array<string>,`构件`:string,"
    "`步骤`:array<struct<step_id:string,`动作`:string,`预期结果`:string,`验证方法`:string,`失败处理`:string>>>>, `练习` array<string>"
)
_FILE = "array<struct<path:string,sha256:string>>"
#: A stamped report.
REPORT = (
    "schema_version int, errors array<string>, warnings array<string>, error_count int, warning_count int, status string, "
    f"inputs {_FILE}, checker struct<name:string,version:int,files:{_FILE}>"
)


def json_files(spark: SparkSession, path: str, schema: str, recursive: bool = False, pattern: str = "*.json", without: tuple[str, ...] = ()) -> DataFrame:
    """JSON documents, one a file, with ``path`` and ``_corrupt_record``; ``without``
    are endings of file names to leave out."""
    fields = StructType.fromDDL(schema).add("_corrupt_record", "string")
    reader = spark.read.schema(fields).option("multiLine", True).option("mode", "PERMISSIVE").option("pathGlobFilter", pattern)
    df = reader.option("recursiveFileLookup", recursive).json(path).withColumn("path", F.col("_metadata.file_path"))
    for ending in without:
        df = df.where(~F.col("path").endswith(ending))
    return df


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return json_files(spark, path, MANIFEST)


def cards(spark: SparkSession, path: str) -> DataFrame:
    """Answer cards below a folder, without manifests and check reports."""
    return json_files(spark, path, CARD, recursive=True, without=("answers-manifest.json", ".check.json"))


def outlines(spark: SparkSession, path: str) -> DataFrame:
    return json_files(spark, path, OUTLINE, recursive=True)


def reports(spark: SparkSession, path: str) -> DataFrame:
    return json_files(spark, path, REPORT, recursive=True)


def markdown_tree(spark: SparkSession, path: str, nonempty: bool = False) -> DataFrame:
    """``path, layer, name, text`` of all Markdown files; the layer is the folder's name."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").text(path, wholetext=True)
    parts = F.split(F.col("_metadata.file_path"), "/")
    out = files.select(
        F.col("_metadata.file_path").alias("path"), F.element_at(parts, -2).alias("layer"),
        F.regexp_replace(F.element_at(parts, -1), r"\.md$", "").alias("name"), F.col("value").alias("text"),
    )
    return out.where(F.col("text").rlike(r"(?U)\S")) if nonempty else out


def file_hashes(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``path, sha256`` of files, for lineage."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"))


def inside(names: DataFrame, files: DataFrame, root: str) -> DataFrame:
    """Names that are relative, do not climb, and are files below the root."""
    fine = (F.col("name") != "") & ~F.col("name").startswith("/") & ~F.col("name").rlike(r"(^|/)\.\.(/|$)")
    at = F.concat(F.lit(root.rstrip("/") + "/"), F.regexp_replace("name", r"(^|/)(\./)+", "$1"))
    return names.where(fine).withColumn("path", at).join(files.select("path"), "path", "left_semi")


def fetch_log(log: DataFrame) -> DataFrame:
    """``total_urls, success_count, failure_count`` of fetch diagnostics."""
    return log.agg(F.count(F.lit(1)).alias("total_urls"), F.count_if("success").alias("success_count"), F.count_if(~F.col("success")).alias("failure_count"))


def fetched(first: DataFrame, second: DataFrame) -> DataFrame:
    """Results by URL: of plain requests where they gave a page, else of the browser.

    Both have ``url, html, error``; where both failed the error is ``all_failed``.
    """
    a, b = first.select("url", F.col("html").alias("h1"), F.col("error").alias("e1")), second.select("url", F.col("html").alias("h2"), F.col("error").alias("e2"))
    html = F.coalesce("h1", "h2")
    error = F.when(html.isNotNull(), None).when(F.col("e1").isNotNull() & F.col("e2").isNotNull(), "all_failed").otherwise(F.coalesce("e1", "e2"))
    return a.join(b, "url", "full_outer").select("url", html.alias("html"), error.alias("error"), F.when(F.col("h1").isNotNull(), "http").when(F.col("h2").isNotNull(), "browser").alias("method"))


def harvest_plan(sources: DataFrame, has_key: bool = True) -> DataFrame:
    """``url, layer, channel, skipped``: how each source (``url, action, redundant_with``)
    is to be fetched; one that repeats a source already taken costs no fetch."""
    from ..dialect import SPARK
    from ..functions import url as urls

    again = F.coalesce(F.col("redundant_with"), F.lit("")) != ""
    channel = F.expr(urls.channel(SPARK, has_key="true" if has_key else "false"))
    return sources.select(
        "url", F.expr(urls.layer(SPARK)).alias("layer"), F.when(again, "skip").otherwise(channel).alias("channel"),
        F.when(again, F.concat(F.lit("与已采 "), "redundant_with", F.lit(" 同内容"))).alias("skipped"),
    )


def retry_schedule(spark: SparkSession, tries: int = 3, backoff: float = 1.0) -> DataFrame:
    """``attempt, wait_s``: waits double from try to try; none before the first."""
    wait = F.when(F.col("id") == 0, 0.0).otherwise(backoff * F.pow(2.0, F.col("id") - 1))
    return spark.range(tries).select((F.col("id") + 1).alias("attempt"), wait.alias("wait_s"))
