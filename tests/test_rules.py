"""Rules against cases worked out by hand."""

import pytest
from pyspark.sql import functions as F

from corpusmill import fixtures as fx
from corpusmill.dialect import SPARK, values
from corpusmill.functions import text, url
from corpusmill.operators import questions


def one(spark, rule, value, **options):
    return spark.createDataFrame([(value,)], "x string").select(F.expr(rule(SPARK, "x", **options)).alias("r")).first()["r"]


@pytest.mark.parametrize("value, want", [("https://www.nhc.gov.cn/a", "primary"), ("https://www.sohu.com/a", "secondary"), ("https://www.zhihu.com/q", "tertiary"), ("https://unknown.example", None), ("https://www.faa.gov", "primary")])
def test_tier(spark, value, want):
    assert one(spark, url.tier, value) == want


@pytest.mark.parametrize("value, want", [
    ("https://www.cdc.gov/x", "L1"), ("https://docs.python.org", "L1"), ("https://arxiv.org/abs/1", "L6"), ("https://github.com/a", "L2"), ("https://a.github.io", "L2"), ("https://zhuanlan.zhihu.com/p", "L3"),
    ("https://medium.com/x", "L4"), ("https://news.ycombinator.com", "L5"), ("https://fedex.com", "L5"), ("https://nowhere.example", "L3"), ("https://pubmed.ncbi.nlm.nih.gov/1", "L1"),
])
def test_layer(spark, value, want):
    assert one(spark, url.layer, value) == want


def test_links(spark):
    rows = {r.idx: r for r in values(spark, *fx.LINKS).select("idx", F.expr(url.quality(SPARK)).alias("q"), F.expr(url.channel(SPARK)).alias("c"), F.expr(url.mirror(SPARK)).alias("m"), F.expr(url.article_key(SPARK)).alias("a"), F.expr(url.canonical(SPARK)).alias("k")).collect()}
    assert [rows[i].q for i in range(6)] == ["reject", "reject", "reject", "high", "high", "medium"]
    assert [rows[i].c for i in (6, 7, 8, 9, 10, 0)] == ["opencli", "opencli", "collector", "skip-book", "firecrawl-download", "firecrawl-scrape"]
    assert rows[11].m == "https://europepmc.org/article/MED/30112233" and rows[12].m == "https://europepmc.org/articles/PMC7654321" and rows[13].m is None
    assert rows[11].a == rows[16].a == "pmid:30112233" and rows[14].a == "arxiv:2401.00001" and rows[15].a == "doi:10.1000/abc" and rows[12].a == "pmc:PMC7654321"
    assert rows[18].k == rows[19].k == "https://x.com/a"
    assert rows[22].k == "http://www.nhc.gov.cn/a?b=2&c=4"


@pytest.mark.parametrize("value, want", [("代餐和节食差在哪里？", "pass"), ("减脂好不好？", "D"), ("可能有人问减脂难在哪？", "A"), ("这还用说吗减脂就是少吃", "B"), ("减脂吗？", "C")])
def test_judge(spark, value, want):
    row = spark.createDataFrame([(value, "https://a")], "text string, source_url string").select(F.expr(text.judged(SPARK)).alias("r")).first()
    assert row.r == want


@pytest.mark.parametrize("value, has, lacks", [
    ("2023-06-08作者：林小北1、节食、断食和减脂有什么不同？", "节食、断食和减脂有什么不同", "2023"), ("最热内容 · 关于减脂加餐，应该怎么选？", "关于减脂加餐，应该怎么选", "·"),
    ("深蹲练的是腿     ‼️断食减肥更快？", "断食减肥更快", "深蹲"),
])
def test_clean(spark, value, has, lacks):
    out = one(spark, text.clean_question, value)
    assert has in out and lacks not in out


@pytest.mark.parametrize("value", ["你见过胖的长跑冠军吗？", "还在饿着减肥？", "减脂打卡送礼品，你心动了吗？"])
def test_not_real(spark, value):
    assert not one(spark, text.real_question, value)


@pytest.mark.parametrize("value, want", [("睡眠 quality 日记 note", 6), ("abc 晚间拉伸 123", 5)])
def test_units(spark, value, want):
    assert one(spark, text.content_units, value) == want


def test_types(spark):
    got = {r.text: (r.t, r.e) for r in values(spark, *fx.QUESTIONS).select("text", F.expr(text.question_type(SPARK)).alias("t"), F.expr(text.type_evidence(SPARK)).alias("e")).collect()}
    assert got["哪个减脂动作效果好？"] == ("争议型", "哪个、效果好")
    assert got["每周跑步日程如何安排?"][0] == "方法型" and got["楼下面馆怎么样"] == ("事实型", "") and got["代餐和节食差在哪里？"][0] == "事实型"


@pytest.mark.parametrize("value, want", [(None, "empty"), ("Error: rate limit", "quota"), ("403 forbidden", "blocked"), ("短", "thin"), ("减脂" * 300, "ok"), ("", "empty")])
def test_outcome(spark, value, want):
    assert one(spark, text.harvest_outcome, value) == want


def test_titles(spark):
    got = [r.question for r in questions.with_title_question(values(spark, *fx.TITLES)).orderBy("idx").collect()]
    assert got[0] == "减脂期间应该怎么睡？" and got[1] == "减肥和增肌有什么区别？" and got[6] == "减肥能不能喝咖啡？" and got[9] == "减脂为什么会头晕？"
    assert got[2] is got[3] is got[4] is got[7] is got[8] is got[11] is got[13] is None


def test_links_in_markdown(spark):
    assert one(spark, text.without_links, '[](https://a.com "t")正文') == "正文"
    assert one(spark, text.without_links, "见[文](https://www.a.com/d)和[外](https://b.org)", site="a.com") == "见文和[外](https://b.org)"
