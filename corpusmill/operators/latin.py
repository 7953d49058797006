"""Questions in Latin letters: extraction and judging for the question pipeline.

A sentence asks if it begins with an interrogative (``packs.LATIN_ASKING``); that is how
texts without question marks show it. Lists are this library's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import packs

#: Sentences of a page that are candidates, at most; headings all count.
MOST = 50
ASKS = rf"^({'|'.join(packs.LATIN_ASKING)})([^\p{{L}}\p{{N}}]|$)"


def holds(words: list[str]) -> str:
    """A pattern for texts with one of the words."""
    return rf"(^|[^\p{{L}}])({'|'.join(words)})([^\p{{L}}]|$)"


def key(column: str) -> Column:
    """Lower-cased, blanks folded and trimmed: equal keys are one question."""
    return F.trim(F.regexp_replace(F.lower(column), r"\s+", " "))


def _asking(df: DataFrame) -> DataFrame:
    shown = df.withColumn("text", F.trim(F.regexp_replace("text", r"\s+", " ")))
    return shown.where(F.lower("text").rlike(ASKS) & F.length("text").between(*packs.LATIN_LENGTH))


def content_questions(pages: DataFrame) -> DataFrame:
    """``url, pos, text``: asking headings, then asking sentences of the bare text, distinct in order of appearance."""
    bare = F.regexp_replace(F.regexp_replace("html", r"(?s)<(script|style)[^>]*>.*?</(script|style)>", ""), "<[^>]*>", "\n")
    heads = pages.select("url", F.lit(0).alias("part"), F.posexplode(F.regexp_extract_all("html", F.lit("<h[1-3][^>]*>([^<]*)</h[1-3]>"), F.lit(1))).alias("pos", "text"))
    parts = pages.select("url", F.lit(1).alias("part"), F.posexplode(F.split(bare, r"[.!?\n]+")).alias("pos", "text"))
    every = _asking(heads.unionByName(parts))
    first = every.withColumn("k", F.row_number().over(Window.partitionBy("url", "text").orderBy("part", "pos"))).where("k = 1")
    ranked = first.withColumn("n", F.row_number().over(Window.partitionBy("url").orderBy("part", "pos")))
    return ranked.where((F.col("n") <= MOST) | (F.col("part") == 0)).select("url", F.col("n").alias("pos"), "text")


def candidates(hits: DataFrame, pages: DataFrame, terms: list[str] | None = None) -> DataFrame:
    """Questions of each hit, of its page where one was fetched, else of its title (see ``questions.candidates``)."""
    fetched = pages.where("html IS NOT NULL AND html <> ''")
    cols = ["group_idx", "result_idx", "pos", "text", F.col("url").alias("source_url"), "extracted_from", "perspective", "sub_dimension"]
    body = hits.join(content_questions(fetched), "url").withColumn("extracted_from", F.lit("content")).select(*cols)
    rest = _asking(hits.join(fetched, "url", "left_anti").withColumn("text", F.col("title")).withColumn("pos", F.lit(0)))
    titles = rest.withColumn("extracted_from", F.lit("search_title")).select(*cols)
    return body.unionByName(titles).withColumn("cand_idx", F.struct("group_idx", "result_idx", "pos")).drop("group_idx", "result_idx", "pos")


def category() -> Column:
    """pass, or why not: E without a source, C abstract, D a value judgement."""
    has = lambda words: F.lower("text").rlike(holds(words))
    return F.when(F.coalesce(F.col("source_url"), F.lit("")) == "", "E").when(has(packs.LATIN_ABSTRACT), "C").when(has(packs.LATIN_VALUES), "D").otherwise("pass")
