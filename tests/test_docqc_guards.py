"""Guards and trimming on Spark's side give what the patterns alone give."""

from pyspark.sql import functions as F

from corpusmill import packs
from corpusmill.dialect import BLANKS, SPARK
from corpusmill.operators import docqc

TEXTS = [
    None, "", " ", "plain words", "如何设置\n文字", "## 如何设置\n1. 一\n## 步骤\n文", "\x01如何\x01步骤", "# 标题平台\n正文平台\n### 小\n", "  # a\n\t> b\n - c\n* d\n\n\n- e", "一定 不一定 必然", "必必然",
    "不仅好，而且快。既要快，又要稳。是甲，是乙，也是丙。", "非常十分", "**粗** **", "你你让我们", "所以。\n\n总之，好。\n\n因此所以。\n\n由此可见", "未来必然涨", "\r    four\x85    b", "a\n    code\nb", "\tcode", "    code", "a\n\n　b \n\xa0c\n\n",
    "x<!-- a\nb -->y", "```\ncode\n```\nend", "~~~\nb\n~~~", "#" * 7 + " x", "#x", "#　wide", *[f"{c}{c}# a b{c}c{c}" for c in BLANKS + "\x1c​᠎﻿"],
]


def test_strip_is_no_pattern_and_equals_it(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    assert "regexp" not in SPARK.strip("t")
    for made, pattern in ((SPARK.strip("t"), r"(?U)^\s+|\s+$"), (docqc._lstrip(SPARK, "t"), r"(?U)^\s+")):
        same = df.where(~F.expr(made).eqNullSafe(F.regexp_replace("t", pattern, "")))
        assert same.collect() == []


def test_metrics_with_and_without_guards(spark, monkeypatch):
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(TEXTS)], "doc_id long, text string, title string")
    guarded = sorted(map(str, docqc.METRICS.on(df).collect()))
    monkeypatch.setattr(docqc, "unless", lambda d, x, words, value, none: value)
    assert guarded == sorted(map(str, docqc.METRICS.on(df).collect()))


def test_nonspace_equals_its_pattern(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    assert df.where(~F.expr(docqc.nonspace(SPARK)).eqNullSafe(F.length(F.regexp_replace("text", r"(?U)\s", "")).cast("long"))).collect() == []


def test_words_of_choices():
    assert docqc._alternatives(packs.STRONG_CLAIM) == ["一定会", "必然", "必将", "百分百", "肯定会"]
