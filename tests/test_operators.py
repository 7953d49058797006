"""Set-level operators: against brute force, and against published expectations."""

import random

import pytest
from pyspark.sql import functions as F

from corpusmill import fixtures as fx
from corpusmill import packs
from corpusmill.dialect import values
from corpusmill.operators import contracts, dedupe, docqc, evidence, questions, workflow
from corpusmill.plans import question_pipeline
from corpusmill.sources import readers, sinks


def _brute(items, t):
    """Every pair compared: components by smallest idx."""
    root = {i: i for i, _, _ in items}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, li, a in items:
        for j, lj, b in items:
            if i < j:
                jac = 1.0 if not a and not b else len(a & b) / len(a | b)
                if jac >= t or (a and a <= b and li < lj) or (b and b <= a and lj < li):
                    x, y = find(i), find(j)
                    root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}


@pytest.mark.parametrize("seed", range(3))
def test_similarity_join_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    items = []
    for i in range(120):
        size = rng.choice([0, 1, 2, 3, 8, 9, 10])
        items.append((i, rng.randint(1, 14), frozenset(rng.sample("abcdefghijklmn", size))))
    df = spark.createDataFrame([(i, n, sorted(s)) for i, n, s in items], "idx long, len int, tokens array<string>")
    got = {r.idx: r.component for r in dedupe.components(dedupe.prepared(df), 0.85).collect()}
    assert got == _brute(items, 0.85)


def test_zh_dedupe_cases(spark):
    from corpusmill.catalog import zh_items

    items = zh_items(spark)
    classes = {r.idx: r.component for r in dedupe.components(items).collect()}
    assert classes[0] == classes[1] == classes[6]  # reordered, and one inside the other
    assert classes[3] == classes[4] != classes[0] and classes[2] != classes[0]
    assert 5 not in classes and 10 not in classes and 11 not in classes  # exact repeats and blanks go
    assert classes[7] == classes[8] == classes[9]  # no Chinese characters at all


def test_pipeline(spark):
    out = question_pipeline.run(values(spark, *fx.HITS), values(spark, *fx.PAGES), "减脂", expanded=["燃脂"])
    rows = {r.text: r for r in out.problems.collect()}
    a = out.audit.first()
    assert a.reachability == pytest.approx(1 / 7)
    merged = next(r for t, r in rows.items() if "到底减脂是什么" in t)
    assert merged.source_count == 3 and merged.total_frequency == 3 and merged.status == "confirmed" and len(merged.duplicates) == 2
    assert rows["减肥药有哪些副作用？"].status == "confirmed"
    assert any(r.status == "single_source" for r in rows.values()) and "减肥药好不好？" not in rows
    assert {r.id for r in rows.values() if r.status == "confirmed"} == {"P001", "P002"}
    assert out.next_queries.count() > 0 and a.rejected_D == 1
    lines = sinks.report_lines("减脂", out.problems, out.matrix, "2026-01-01").orderBy(*sinks.REPORT_ORDER).collect()
    report = "".join(r.value + "\n" for r in lines)
    assert report.startswith("# 减脂 — 真问题清单") and "## 基础视角" in report and "❌ (0)" in report and "### P001" in report


def test_manifest_files(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"topic": "减脂", "expanded_terms": ["a"], "retrieval_rounds": 1, "search_results": [{"perspective": "基础", "sub_dimension": "What", "query": "q", "results": [{"title": "减脂是什么？", "url": "https://a"}]}], "fetched_pages": {"https://a": ""}}')
    (tmp_path / "bad.json").write_text("{nope")
    m = readers.manifest(spark, str(tmp_path))
    assert sum(r["_corrupt_record"] is not None for r in m.select("topic", "_corrupt_record").collect()) == 1
    m = m.where("topic is not null")
    hits, pages = questions.flatten_manifest(m)
    assert hits.count() == 1 and pages.count() == 1
    assert [r.text for r in questions.candidates(hits, pages).collect()] == ["减脂是什么？"]


def test_markdown_tree_and_guard(spark, tmp_path):
    (tmp_path / "L1").mkdir()
    (tmp_path / "L1" / "a.md").write_text("# a")
    (tmp_path / "L1" / "blank.md").write_text(" \n")
    tree = readers.markdown_tree(spark, str(tmp_path), nonempty=True).collect()
    assert [(r.layer, r.name) for r in tree] == [("L1", "a")]
    files = readers.file_hashes(spark, str(tmp_path))
    root = files.select("path").first().path.rsplit("/L1/", 1)[0]
    names = spark.createDataFrame([("L1/a.md",), ("../x",), ("/etc/passwd",), ("L1/none.md",), ("",)], "name string")
    assert [r.name for r in readers.inside(names, files, root).collect()] == ["L1/a.md"]


def test_fetch_routing(spark):
    a = spark.createDataFrame([("u1", "<p>", None), ("u2", None, "timeout"), ("u3", None, "404")], "url string, html string, error string")
    b = spark.createDataFrame([("u2", "<p>", None), ("u3", None, "blocked")], "url string, html string, error string")
    got = {r.url: (r.method, r.error) for r in readers.fetched(a, b).collect()}
    assert got == {"u1": ("http", None), "u2": ("browser", None), "u3": (None, "all_failed")}
    assert [r.wait_s for r in readers.retry_schedule(spark).collect()] == [0.0, 1.0, 2.0]


def test_upsert_and_layers(spark, tmp_path):
    known = spark.createDataFrame([("https://x.com/a",)], "url string")
    found = spark.createDataFrame([(1, "https://X.com/a/?utm_source=1"), (2, "https://b.org"), (3, "https://b.org/#top")], "ord int, url string")
    assert [r.ord for r in sinks.upsert_sources(known, found).collect()] == [2]
    rows = spark.createDataFrame([("L1", "a/b: c?", "t"), ("L2", "???", "t")], "layer string, title string, text string")
    assert sorted(r.name for r in sinks.write_layers(rows, str(tmp_path / "out")).collect()) == ["a_b_c", "untitled"]


def test_evidence(spark):
    grades = {r.card: r.confidence for r in evidence.confidence(values(spark, *fx.CARDS), values(spark, *fx.SOURCES), values(spark, *fx.FILES)).collect()}
    assert grades == {"a": "高", "b": "中", "c": "低", "d": "中", "e": "中", "f": "高", "g": "低", "h": "低"}
    warned = {(r.card, r.rule) for r in evidence.independence(values(spark, *fx.SOURCES)).collect()}
    assert warned == {("b", "domain"), ("c", "aggregator"), ("d", "article"), ("e", "original")}


def test_saturation(spark):
    got = {(r.topic, r["round"]): (r.streak, r.saturated) for r in evidence.saturation(values(spark, *fx.ROUNDS)).collect()}
    assert got["t", 5] == (3, True) and got["t", 6] == (0, False) and got["u", 1] == (1, False)


@pytest.mark.parametrize("score, want", [(100, "通过"), (85, "通过"), (70, "通过但提示 minor 问题"), (69, "不通过")])
def test_verdict(spark, score, want):
    from corpusmill.functions import text

    assert spark.sql(f"SELECT {text.verdict(str(score))} AS v").first().v == want


def test_document_quality(spark):
    found = {(r.doc_id, r.rule) for r in docqc.findings(values(spark, *fx.DOCS)).collect()}
    assert {(2, "heading_jump"), (2, "absolutes"), (2, "intensifiers"), (2, "invitation"), (2, "parallels"), (2, "missing_list"), (3, "long_paragraph"), (6, "orphan_h3")} <= found
    assert (3, "absolutes") not in found and (1, "missing_list") not in found and (1, "no_question") not in found


def test_rules_of_essays(spark):
    found = {(r.doc_id, r.rule) for r in docqc.findings(values(spark, *fx.ESSAYS)).collect()}
    rules = ("main_line_lost", "unhedged_claim", "summary_endings", "lists_touch")
    assert {f for f in found if f[1] in rules} == {(1, "main_line_lost"), (3, "unhedged_claim"), (4, "summary_endings"), (5, "lists_touch"), (7, "lists_touch")}


def test_banned_words_come_as_the_text_has_them(spark):
    rows = spark.createDataFrame([(1, "最后说赋能，首先说抓手。\n```\n本质上\n```", None, 0)], "doc_id long, text string, case_name string, n_materials long")
    assert docqc.chapter(rows).first().banned == "最后、赋能、首先、抓手"


def test_prose_mask(spark):
    text = "a\n```py\ncode\n~~~\n```\nb <!-- x\ny --> c\n    indented\n> ```\n> q\n> ```\nend"
    got = spark.createDataFrame([(text,)], "t string").select(docqc.masked(F.col("t")).alias("m")).first().m
    assert got == "a\n\n\n\n\nb \n c\n\n\n\n\nend"


def _outline(**over):
    base = {
        "schema_version": 3, "article_id": "a1", "问题": "q", "标题": "t", "tutorial_type": "操作型", "写给": "w", "读完能": "能判断", "适用范围": "s", "前置条件": [], "失败边界": ["f"], "交付物": ["d"], "环境": {"os": "x"},
        "成功标准": [{"criterion_id": "k1", "描述": "d", "验证方法": "v", "预期结果": "r"}],
        "小节": [{"section_id": "s1", "标题": "一", "干什么": "x", "证据": ["c1"], "步骤": [{"step_id": "p1", "动作": "a", "预期结果": "b", "验证方法": "c", "失败处理": "d"}]}], "练习": [],
    }
    return base | over


def _outlines(spark, *rows):
    import json

    from pyspark.sql.types import StructType

    text = spark.createDataFrame([(json.dumps(r, ensure_ascii=False),) for r in rows], "j string")
    return text.select(F.from_json("j", StructType.fromDDL(readers.OUTLINE)).alias("o")).select("o.*")


def test_outline_contract(spark):
    rules = lambda *rows: {(r.part, r.rule) for r in contracts.outline_contract(_outlines(spark, *rows)).collect()}
    assert rules(_outline()) == set()
    assert ("outline", "no_step") in rules(_outline(小节=[{"section_id": "s1", "标题": "一", "干什么": "x", "证据": ["c1"]}]))
    bad = rules(_outline(schema_version=2, article_id="-x", 环境={}, 成功标准=[], 写给=" "))
    assert {("outline", r) for r in ("version", "article_id", "environment", "no_criteria", "missing_写给")} <= bad
    step = {"step_id": "p1", "动作": "a", "预期结果": "b", "验证方法": "c", "失败处理": "d"}
    twice = rules(_outline(小节=[{"section_id": "s1", "标题": "一", "干什么": "x", "证据": ["c1"], "步骤": [step, step]}, {"section_id": "s1", "标题": "一", "干什么": "", "证据": []}]))
    assert {("p1", "step_id"), ("s1", "section_id"), ("s1", "title_repeated"), ("s1", "section_purpose"), ("s1", "section_evidence")} <= twice
    assert ("outline", "no_exercise") in rules(_outline(tutorial_type="概念型"))


def test_chapter_against_outline(spark):
    o = _outlines(spark, _outline(标题="减脂大全", 读完能="能了解原理"))
    text = "## 一\n<!-- step:p1 -->\na b c\n见[^c9]\n"
    ch = spark.createDataFrame([("a1", text)], "article_id string, text string")
    claims = spark.createDataFrame([("a1", "c1")], "article_id string, claim_id string")
    got = {(r.part, r.rule) for r in contracts.body_references(ch, o, claims).collect()}
    assert got == {("c9", "unknown_reference"), ("c1", "missing_reference"), ("s1/c1", "section_reference")}
    assert {(r.part, r.rule) for r in contracts.step_markers(ch, o).collect()} == {("p1", "step_lacks_失败处理")}
    assert {r.rule for r in contracts.coverage_of_outline(ch, o).collect()} == {"lacks_失败边界", "lacks_交付物", "lacks_criterion"}
    cards = spark.createDataFrame([("q", "达标")], "question string, state string")
    assert {r.rule for r in contracts.outline_style(o, cards).collect()} == {"outcome_is_knowledge", "document_title"}
    schema = "article_id string, criterion_id string, status string, observed string, by string, at string, method string, log string, sha256 string"
    logs = spark.createDataFrame([("l", "h")], "path string, sha256 string")
    for status, sha, want in (("pass", "h", "pass"), ("pass", "x", "fail"), ("fail", "h", "fail"), ("open", "h", "not_verified")):
        rec = spark.createDataFrame([("a1", "k1", status, "o", "b", "t", "m", "l", sha)], schema)
        assert contracts.outcome_state(rec, o, logs).first().state == want


def test_card_errors(spark):
    import json

    from pyspark.sql.types import StructType

    card = {
        "schema_version": 3, "问题": "q", "类型": "事实型", "一句话答案": "a", "置信度": "高", "状态": "达标", "出处": [{"source_id": "s1", "来源": "L1/a.md", "original_source_id": "o", "sha256": "h"}],
        "claims": [{"claim_id": "c1", "statement": "s", "claim_type": "t", "scope": "x", "conflicts": [], "evidence": [{"source_id": "s1", "locator": "l", "quote": "q"}], "verification": {"support": {"status": "verified", "by": "b", "at": "t", "method": "m"}}}],
    }
    worse = card | {"问题": "w", "类型": "x", "出处": [{"source_id": "s1", "来源": "网页", "url": ""}], "claims": [{"claim_id": "c1", "statement": "", "conflicts": ["z"], "evidence": [{"source_id": "s9"}]}]}
    text = spark.createDataFrame([(json.dumps(r, ensure_ascii=False),) for r in (card, worse)], "j string")
    df = text.select(F.from_json("j", StructType.fromDDL(readers.CARD)).alias("o")).select("o.*")
    files = spark.createDataFrame([("L1/a.md", "h")], "path string, sha256 string")
    got = {(r["问题"], r.rule) for r in contracts.card_errors(df, files).collect()}
    assert got == {("w", r) for r in ("bad_type", "no_url", "no_original", "claim_statement", "claim_claim_type", "claim_scope", "conflicts", "support", "unknown_source")}


def test_lint():
    bad = "# a\n### b\n```\nx\n```\n| a | b |\n|---|---|\n| 1 |\n![](i.png) [x](#none) [y](#a) see[^1]\n~~~py\n"
    assert {r for r, _, _ in contracts.lint_text(bad)} == {"heading_jump", "fence_language", "table_width", "image_description", "dead_anchor", "undefined_note", "open_fence"}
    assert contracts.lint_text("# a\n\n## b\n\n[b](#b) see[^1]\n\n[^1]: note\n") == []


def test_streams(spark, tmp_path):
    from corpusmill.streaming import rounds

    src, out = tmp_path / "in", tmp_path / "out"
    rows = values(spark, *fx.ROUNDS)
    rows.where("round <= 3").coalesce(1).write.parquet(str(src))
    stream = rounds.saturation_stream(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(src)))
    q = stream.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True)
    q.start().awaitTermination()
    rows.where("round > 3").coalesce(1).write.mode("append").parquet(str(src))
    q.start().awaitTermination()
    got = {(r.topic, r["round"], r.streak, r.saturated) for r in spark.read.parquet(str(out)).collect()}
    assert got == {(r.topic, r["round"], r.streak, r.saturated) for r in evidence.saturation(rows).collect()}

    add = rounds.upsert_batches(spark, str(tmp_path / "catalogue"))
    links = spark.createDataFrame([("https://a.com/",), ("https://a.com",)], "url string")
    for i in range(2):
        add(links, i)
    assert spark.read.parquet(str(tmp_path / "catalogue")).count() == 1


def test_progress_confirmations_and_exit_codes(spark, tmp_path):
    log = str(tmp_path / "progress")
    sinks.append_progress(spark, log, ["- one  "])
    sinks.append_progress(spark, log, ["- two", ""])
    assert sorted(r.value for r in spark.read.text(log).collect()) == ["", "- one", "- two"]

    gates = values(spark, *fx.GATES)
    assert sinks.write_confirmations(gates, str(tmp_path / "gates")).count() == gates.count()

    broken = spark.createDataFrame([("a", "error")], "rule string, severity string")
    assert sinks.finish(lambda: broken, str(tmp_path / "r1")) == 1
    assert sinks.finish(lambda: broken.limit(0), str(tmp_path / "r0")) == 0
    assert sinks.finish(lambda: spark.read.json(str(tmp_path / "nowhere")), str(tmp_path / "r2")) == 2
    assert spark.read.json(str(tmp_path / "r1")).first().rule == "a"


def test_watched_entries(spark):
    entries = spark.createDataFrame([("u1", "unknown"), ("u2", "high"), ("u3", None)], "url string, value string")
    assert [r.url for r in sinks.watched(entries).collect()] == ["u1"]


def test_empty_tables_of_manifest_and_coverage(spark):
    none = lambda f: values(spark, f[0], [])
    assert evidence.unmatched_articles(none(fx.ASKING), none(fx.PLANNED), none(fx.CHAPTERS)).count() == 0
    row = evidence.answers_statistics(spark.createDataFrame([], "card string, state string, reasons array<string>")).first()
    assert tuple(row) == (0, 0, 0, 0)
    assert questions.coverage_summary(questions.coverage(none(("perspective string, sub_dimension string", [])))).first().n_missing == len(packs.CELLS)
    assert questions.source_gap(none(fx.NOTES), ["甲", "乙"]).first().asDict() == {"counts": "0、0", "gap": "甲、乙"}
    assert workflow.qc_collection(values(spark, *fx.ARTICLES), none(fx.CHECKERS), none(fx.GOOD_DIMS)).count() == 8


def test_tokens_travel_once(spark, monkeypatch):
    """Of all tables that entries write, one is made by a shuffle of tokens; sets of tokens are not shuffled whole."""
    rows = [(i, 9, [f"t{i}_{k}" for k in range(20)] + [f"s{i % 7}"]) for i in range(60)] + [(100 + i, 8, [f"t{i}_{k}" for k in range(20)] + [f"s{i % 7}"]) for i in range(5)]
    items = dedupe.prepared(spark.createDataFrame(rows, "idx long, len int, tokens array<string>"))
    plans, write = [], dedupe.written
    monkeypatch.setattr(dedupe, "written", lambda df, tag: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, tag))
    found = {r.set_id: r for r in dedupe.entries(items).collect()}
    assert sum(p.count("Exchange hashpartitioning(token#") for p in plans) == 1
    assert not any("Exchange hashpartitioning(set_id" in p and "explode(tokens" not in p and "tokens#" in p for p in plans)
    assert len(found) == 60 and all(r.n == 21 and r.tokens == [f"s{i % 7}"] for i, r in found.items())
    assert (found[0].min_len, found[0].max_len, found[7].min_len) == (8, 9, 9)
