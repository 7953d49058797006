"""Contract checks over cards, outlines, chapters and verification records.

Nested records are flattened once; each check is a relation of findings
``(key, part, rule)``. Rules with state over a whole text (Markdown structure)
run batch-wise in Python; all others are expressions.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import packs
from ..dialect import SPARK
from ..functions import text as rules
from ..functions import url as urls

_ID = r"^[A-Za-z0-9][A-Za-z0-9_-]*$"


def filled(c: Column | str) -> Column:
    """A text that is not blank."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.rlike(r"(?U)\S"), F.lit(False))


def _broken(df: DataFrame, key: str, part: Column, **tests: Column) -> DataFrame:
    """A row for each test (true where broken)."""
    found = F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(r)) for r, c in tests.items()]), lambda r: r.isNotNull())
    return df.select(key, part.cast("string").alias("part"), F.explode(found).alias("rule"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _all_filled(array: str) -> Column:
    return F.forall(array, lambda v: filled(v))


def outline_contract(outlines: DataFrame) -> DataFrame:
    """``article_id, part, rule`` of version-3 outlines that break the contract."""
    o = outlines
    top = _broken(
        o, "article_id", F.lit("outline"),
        version=~(F.col("schema_version").eqNullSafe(3)), article_id=~F.coalesce(F.col("article_id").rlike(_ID), F.lit(False)),
        tutorial_type=~F.coalesce(F.col("tutorial_type").isin(packs.ARCHETYPES), F.lit(False)),
        **{f"missing_{f}": ~filled(f"`{f}`") for f in ("问题", "标题", "写给", "读完能", "适用范围")},
        **{f"not_texts_{f}": F.col(f"`{f}`").isNull() | ~_all_filled(f"`{f}`") for f in ("前置条件", "失败边界", "交付物")},
        **{f"empty_{f}": F.size(f"`{f}`") == 0 for f in ("失败边界", "交付物")},
        environment=F.col("`环境`").isNull() | (F.size("`环境`") == 0) | ~F.forall(F.map_values("`环境`"), lambda v: filled(v)),
        no_criteria=F.col("`成功标准`").isNull() | (F.size("`成功标准`") == 0), no_sections=F.col("`小节`").isNull() | (F.size("`小节`") == 0),
        no_exercise=(F.col("tutorial_type") == "概念型") & ~F.coalesce((F.size("`练习`") > 0) & _all_filled("`练习`"), F.lit(False)),
        no_step=F.col("tutorial_type").isin("操作型", "排错型") & ~F.coalesce(F.exists("`小节`", lambda s: F.size(F.coalesce(s["步骤"], F.array())) > 0), F.lit(False)),
    )
    criteria = o.select("article_id", F.posexplode("`成功标准`").alias("pos", "c"))
    again = F.row_number().over(Window.partitionBy("article_id", "id").orderBy("pos")) > 1
    criteria = criteria.withColumn("id", F.col("c.criterion_id")).withColumn("again", again)
    c = _broken(criteria, "article_id", F.col("id"), criterion_fields=~(filled("c.criterion_id") & filled("c.`描述`") & filled("c.`验证方法`") & filled("c.`预期结果`")), criterion_repeated=F.col("again") & filled("id"))
    sections = o.select("article_id", F.posexplode("`小节`").alias("pos", "s")).withColumn("id", F.col("s.section_id")).withColumn("title", F.col("s.`标题`"))
    sections = sections.withColumn("again", again).withColumn("same_title", F.row_number().over(Window.partitionBy("article_id", "title").orderBy("pos")) > 1)
    s = _broken(
        sections, "article_id", F.coalesce("id", F.col("pos").cast("string")), section_id=~F.coalesce(F.col("id").rlike(_ID), F.lit(False)) | F.col("again"),
        section_title=~filled("title"), section_purpose=~filled("s.`干什么`"), title_repeated=F.col("same_title") & filled("title"),
        section_evidence=F.col("s.`证据`").isNull() | (F.size("s.`证据`") == 0) | ~F.forall("s.`证据`", lambda v: filled(v)),
    )
    steps = sections.select("article_id", "pos", F.posexplode("s.`步骤`").alias("n", "t")).withColumn("id", F.col("t.step_id"))
    repeat = F.row_number().over(Window.partitionBy("article_id", "id").orderBy("pos", "n")) > 1
    whole = filled("id") & filled("t.`动作`") & filled("t.`预期结果`") & filled("t.`验证方法`") & filled("t.`失败处理`")
    t = _broken(steps.withColumn("again", repeat), "article_id", F.coalesce("id", F.lit("?")), step_fields=~whole, step_id=whole & (~F.col("id").rlike(_ID) | F.col("again")))
    return _union([top, c, s, t])


def outline_style(outlines: DataFrame, cards: DataFrame) -> DataFrame:
    """``article_id, part, rule, severity``: reader, outcome, titles, components, card state.

    ``cards`` has ``question, state``.
    """
    o = outlines.withColumn("reader", F.expr(SPARK.strip("coalesce(`写给`, '')"))).withColumn("outcome", F.expr(SPARK.strip("coalesce(`读完能`, '')")))
    o = o.withColumn("title", F.expr(SPARK.strip("coalesce(`标题`, '')"))).join(cards.select(F.col("question").alias("问题"), F.col("state").alias("card_state")), "问题", "left")
    modern = F.coalesce(F.col("schema_version") == 3, F.lit(False))
    knows = F.col("outcome").rlike("^[能会](了解|理解|知道|认识|掌握|学习)(?!到)")
    top = _broken(
        o, "article_id", F.lit("outline"), card_missing=F.col("card_state").isNull(), card_not_ready=F.col("card_state") != "达标", generic_reader=F.col("reader").isin(packs.GENERIC_READERS),
        outcome_missing=F.col("outcome") == "", outcome_form=(F.col("outcome") != "") & ~F.col("outcome").rlike("^[能会]"), outcome_is_knowledge=knows,
    ).withColumn("severity", F.lit("error"))
    soft = _broken(
        o, "article_id", F.lit("outline"), section_count=~modern & ~F.size("`小节`").between(5, 8), document_title=F.col("title").rlike("(大全|详解|浅析|概述|白皮书|圣经)$")
    ).withColumn("severity", F.lit("warning"))
    sec = o.select("article_id", modern.alias("modern"), F.posexplode("`小节`").alias("pos", "s"))
    sec = sec.withColumn("t", F.expr(SPARK.strip("coalesce(s.`标题`, '')"))).withColumn("c", F.expr(SPARK.strip("coalesce(s.`构件`, '')")))
    defines = ~F.col("modern") & F.col("t").rlike("^(什么是|什么叫|何谓|聊聊)|(的定义|的概念|是什么|是什么意思)$")
    bad = _broken(
        sec, "article_id", F.col("pos"), no_purpose=~filled("s.`干什么`"), no_evidence=F.coalesce(F.size("s.`证据`") == 0, F.lit(True)), definition_title=defines,
        unknown_component=(F.col("c") != "") & ~F.col("c").isin(packs.COMPONENTS),
    ).withColumn("severity", F.lit("error"))
    term = F.lit(False)
    for w in packs.TERM_ENDINGS:
        term = term | F.col("t").endswith(w)
    odd = _broken(sec, "article_id", F.col("pos"), term_title=term & ~defines).withColumn("severity", F.lit("warning"))
    return _union([top, soft, bad, odd])


def card_errors(cards: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """``问题, part, rule`` of cards: sources that cannot be checked, fields, domains, claims."""
    c = cards
    top = _broken(
        c, "问题", F.lit("card"), no_sources=F.col("`出处`").isNull() | (F.size("`出处`") == 0), **{f"missing_{f}": ~filled(f"`{f}`") for f in packs.CARD_FIELDS},
        bad_type=filled("`类型`") & ~F.col("`类型`").isin(packs.CARD_TYPES), bad_state=~F.coalesce(F.col("`状态`").isin("达标", "待补采"), F.lit(False)),
        bad_version=F.col("schema_version").isNotNull() & (F.col("schema_version") != 3),
    )
    src = c.select("问题", "schema_version", F.posexplode("`出处`").alias("pos", "s")).select("问题", "schema_version", "pos", F.col("s.`来源`").alias("name"), "s.url", "s.source_id", "s.original_source_id", "s.sha256")
    src = src.withColumn("local", F.coalesce(F.expr(rules.local_source(SPARK, "name")), F.lit(False)))
    if files is not None:
        src = src.join(files.select(F.col("path").alias("name"), F.col("sha256").alias("now"), F.lit(True).alias("there")), "name", "left")
    else:
        src = src.withColumn("now", F.lit(None).cast("string")).withColumn("there", F.lit(None).cast("boolean"))
    again = F.row_number().over(Window.partitionBy("问题", "source_id").orderBy("pos")) > 1
    v3 = F.col("schema_version") == 3
    s = _broken(
        src.withColumn("again", again), "问题", F.col("pos"), local_unchecked=F.col("local") & F.col("there").isNull(), no_url=~F.col("local") & ~F.coalesce(F.expr(urls.valid(SPARK)), F.lit(False)),
        source_id=v3 & (~F.coalesce(F.col("source_id").rlike(_ID), F.lit(False)) | F.col("again")), no_original=v3 & ~filled("original_source_id"),
        snapshot=v3 & F.col("there").isNotNull() & ~F.col("now").eqNullSafe(F.col("sha256")),
    )
    claims = c.where(v3).select("问题", F.posexplode_outer("claims").alias("pos", "k"), F.transform("`出处`", lambda x: x["source_id"]).alias("ids")).withColumn("id", F.col("k.claim_id"))
    claims = claims.withColumn("again", F.row_number().over(Window.partitionBy("问题", "id").orderBy("pos")) > 1)
    support = F.col("k.verification.support")
    k = _broken(
        claims, "问题", F.coalesce("id", F.lit("?")), no_claims=F.col("k").isNull(), claim_id=F.col("k").isNotNull() & (~F.coalesce(F.col("id").rlike(_ID), F.lit(False)) | F.col("again")),
        **{f"claim_{f}": F.col("k").isNotNull() & ~filled(f"k.{f}") for f in ("statement", "claim_type", "scope")},
        conflicts=F.col("k").isNotNull() & (F.col("k.conflicts").isNull() | (F.size("k.conflicts") > 0)),
        support=F.col("k").isNotNull() & ~F.coalesce((support["status"] == "verified") & filled(support["by"]) & filled(support["at"]) & filled(support["method"]), F.lit(False)),
        no_evidence=F.col("k").isNotNull() & F.coalesce(F.size("k.evidence") == 0, F.lit(True)),
    )
    ev = claims.select("问题", "id", "ids", F.explode("k.evidence").alias("e"))
    e = _broken(
        ev, "问题", F.col("id"), unknown_source=~F.coalesce(F.array_contains("ids", F.col("e.source_id")), F.lit(False)),
        quote_missing=F.array_contains("ids", F.col("e.source_id")) & ~(filled("e.quote") & filled("e.locator")),
    )
    return _union([top, s, k, e])


def body_references(chapters: DataFrame, outlines: DataFrame, claims: DataFrame) -> DataFrame:
    """``article_id, part, rule``: references of a chapter against outline and claims.

    ``chapters`` has ``article_id, text`` (masked prose), ``claims`` ``article_id, claim_id``.
    """
    body = F.regexp_replace("text", r"(?m)^\[\^[^\]]+\]:.*$", "")
    ch = chapters.withColumn("body", body).withColumn("used", F.array_distinct(F.regexp_extract_all("body", F.lit(r"\[\^([A-Za-z0-9_-]+)\]"), F.lit(1))))
    ch = ch.withColumn("h2", F.regexp_extract_all("text", F.lit(r"(?m)^##\s+(.+?)\s*$"), F.lit(1)))
    ch = ch.withColumn("chunks", F.slice(F.split("body", r"(?m)^##\s+.+$", -1), 2, 1_000_000))
    known = claims.groupBy("article_id").agg(F.collect_set("claim_id").alias("known"))
    o = outlines.select("article_id", F.array_distinct(F.flatten(F.transform("`小节`", lambda s: s["证据"]))).alias("expected"), F.transform("`小节`", lambda s: s["标题"]).alias("titles"), F.col("`小节`").alias("sections"))
    j = ch.join(o, "article_id").join(known, "article_id", "left").withColumn("known", F.coalesce("known", F.array().cast("array<string>")))
    unknown = j.select("article_id", F.explode(F.array_except("used", "known")).alias("part"), F.lit("unknown_reference").alias("rule"))
    lacking = j.select("article_id", F.explode(F.array_except("expected", "used")).alias("part"), F.lit("missing_reference").alias("rule"))
    order = j.where(~F.col("h2").eqNullSafe(F.col("titles"))).select("article_id", F.lit("headings").alias("part"), F.lit("section_order").alias("rule"))
    per = j.select("article_id", F.explode(F.arrays_zip("sections", "chunks")).alias("z")).where("z.sections IS NOT NULL AND z.chunks IS NOT NULL")
    refs = F.regexp_extract_all("z.chunks", F.lit(r"\[\^([A-Za-z0-9_-]+)\]"), F.lit(1))
    own = per.select("article_id", F.explode(F.array_except(F.col("z.sections.`证据`"), refs)).alias("id"), F.col("z.sections.section_id").alias("s"))
    return _union([unknown, lacking, order, own.select("article_id", F.concat_ws("/", "s", "id").alias("part"), F.lit("section_reference").alias("rule"))])


def step_markers(chapters: DataFrame, outlines: DataFrame) -> DataFrame:
    """``article_id, part, rule``: steps whose marker is missing or repeated, or whose
    chunk of the text lacks a field of the outline."""
    steps = outlines.select("article_id", F.explode(F.flatten(F.transform("`小节`", lambda s: F.coalesce(s["步骤"], F.array())))).alias("t"))
    j = steps.join(chapters.select("article_id", "text"), "article_id").withColumn("marker", F.concat(F.lit("<!-- step:"), "t.step_id", F.lit(" -->")))
    times = (F.length("text") - F.length(F.replace("text", "marker", F.lit("")))) / F.length("marker")
    after = F.expr("substring(text, instr(text, marker) + length(marker))")
    chunk = F.element_at(F.split(after, "<!-- step:|\\n##\\s", -1), 1)
    j = j.withColumn("times", times).withColumn("chunk", chunk)
    once = F.col("times") == 1
    fields = {f"step_lacks_{f}": once & ~F.col("chunk").contains(F.col(f"t.`{f}`")) for f in ("动作", "预期结果", "验证方法", "失败处理")}
    return _broken(j, "article_id", F.col("t.step_id"), step_marker=~once, **fields)


def coverage_of_outline(chapters: DataFrame, outlines: DataFrame) -> DataFrame:
    """``article_id, part, rule``: outline items and success criteria not in the text."""
    j = outlines.join(chapters.select("article_id", "text"), "article_id")
    parts = []
    for f in ("前置条件", "失败边界", "交付物", "练习"):
        parts.append(j.select("article_id", "text", F.explode(f"`{f}`").alias("part")).where(~F.col("text").contains(F.col("part"))).select("article_id", "part", F.lit(f"lacks_{f}").alias("rule")))
    crit = j.select("article_id", "text", F.explode("`成功标准`").alias("c")).where(~F.col("text").contains(F.col("c.`预期结果`")))
    return _union([*parts, crit.select("article_id", F.col("c.criterion_id").alias("part"), F.lit("lacks_criterion").alias("rule"))])


def outcome_state(records: DataFrame, outlines: DataFrame, logs: DataFrame) -> DataFrame:
    """``article_id, state``: pass, fail or not_verified by the recorded checks.

    ``records`` has ``article_id, criterion_id, status, observed, by, at, method, log, sha256``;
    ``logs`` ``path, sha256``. A record that fits but whose criteria or logs do not
    is a fail; without a record nothing is verified.
    """
    want = outlines.select("article_id", F.explode("`成功标准`").alias("c")).select("article_id", F.col("c.criterion_id").alias("criterion_id"))
    r = records.join(logs.select(F.col("path").alias("log"), F.col("sha256").alias("now")), "log", "left")
    whole = filled("observed") & filled("by") & filled("at") & filled("method") & filled("log") & filled("sha256") & F.col("now").eqNullSafe(F.col("sha256"))
    each = r.groupBy("article_id").agg(
        F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_set("criterion_id")).alias("ids"), F.max((F.col("status") == "fail").cast("int")).alias("failed"),
        F.min((F.col("status") == "pass").cast("int")).alias("passed"), F.min(whole.cast("int")).alias("whole"),
    )
    wanted = want.groupBy("article_id").agg(F.sort_array(F.collect_set("criterion_id")).alias("expected"))
    j = wanted.join(each, "article_id", "left")
    fits = (F.col("ids") == F.col("expected")) & (F.col("n") == F.size("expected"))
    state = F.when(F.col("n").isNull(), "not_verified").when(F.col("failed") == 1, "fail").when(F.col("passed") == 0, "not_verified").when(fits & (F.col("whole") == 1), "pass").otherwise("fail")
    return j.select("article_id", state.alias("state"))


# ---- Markdown structure: a small block reader, batch-wise


_FENCE = re.compile(r"^\s{0,3}(?:>\s*)*(`{3,}|~{3,})\s*(\S*)")


def slug(heading: str) -> str:
    """Anchor of a heading: lower case, marks dropped, blanks to dashes."""
    return re.sub(r"\s+", "-", re.sub(r"[^\w\s-]", "", heading.strip().lower()))


def _cells(line: str) -> int:
    bare = re.sub(r"`[^`]*`", "", line.strip()).replace("\\|", "")
    return len(bare.strip("|").split("|"))


def lint_text(text: str) -> list[tuple[str, str, int]]:
    """(rule, severity, line) of a Markdown text: open fences, fences without a
    language, table widths, heading jumps, undefined notes, dead anchors, images
    without a description."""
    out, fence, level, anchors, seen = [], None, 0, set(), {}
    prose, lines = [], text.splitlines()
    table = None
    for n, line in enumerate(lines, 1):
        m = _FENCE.match(line)
        if fence:
            if m and m[1][0] == fence[0][0] and len(m[1]) >= len(fence[0]) and not m[2]:
                fence = None
            continue
        if m:
            fence = (m[1], n)
            if not m[2]:
                out.append(("fence_language", "warning", n))
            continue
        prose.append((n, line))
        h = re.match(r"^(#{1,6})\s+(.*?)\s*#*$", line)
        if h:
            if level and len(h[1]) - level > 1:
                out.append(("heading_jump", "error", n))
            level = len(h[1])
            base = slug(h[2])
            k = seen.get(base, 0)
            seen[base] = k + 1
            anchors.add(f"{base}-{k}" if k else base)
        if line.strip().startswith("|"):
            width = _cells(line)
            if table is not None and width != table:
                out.append(("table_width", "error", n))
            table = table or width
        else:
            table = None
    if fence:
        out.append(("open_fence", "error", fence[1]))
    body = "\n".join(p for _, p in prose)
    defined = set(re.findall(r"(?m)^\[\^([^\]]+)\]:", body))
    for n, line in prose:
        bare = re.sub(r"`[^`]*`", "", line)
        for note in re.findall(r"\[\^([^\]]+)\](?!:)", bare):
            if note not in defined:
                out.append(("undefined_note", "error", n))
        for alt, _ in re.findall(r"!\[([^\]]*)\]\(([^)]*)\)", bare):
            if not alt.strip():
                out.append(("image_description", "warning", n))
        for target in re.findall(r"(?<!!)\[[^\]]*\]\(#([^)\s]+)\)", bare):
            if target not in anchors:
                out.append(("dead_anchor", "error", n))
    return out


def lint(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, rule, severity, line`` of Markdown texts."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            rows = [(k, *f) for k, t in zip(b[key], b["text"]) for f in lint_text(t or "")]
            yield pd.DataFrame(rows, columns=[key, "rule", "severity", "line"])

    return df.select(key, "text").mapInPandas(run, f"{key} {kind}, rule string, severity string, line long")


def local_links(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, target``: distinct files that links and images outside code name (no
    scheme, no bare anchor), without query and anchor."""
    from .docqc import masked

    bare = F.regexp_replace(masked(F.col("text")), "`[^`]*`", "")
    target = F.regexp_replace("t", "[?#].*$", "")
    found = df.select(key, F.explode(F.regexp_extract_all(bare, F.lit(r"\[[^\]]*\]\(([^)\s]+)"), F.lit(1))).alias("t"))
    return found.where(~F.col("t").rlike("^(?:[A-Za-z][A-Za-z0-9+.-]*:|//|#)")).select(key, target.alias("target")).where("target <> ''").distinct()


def missing_resources(df: DataFrame, files: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, target``: files named that are not there (``files.path``)."""
    return local_links(df, key).join(files.select(F.col("path").alias("target")), "target", "left_anti").select(key, "target")


def slugs(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, pos, anchor``: heading anchors, numbered where a slug comes again."""
    heads = df.select(key, F.posexplode(F.regexp_extract_all("text", F.lit(r"(?m)^#{1,6}\s+(.*?)\s*#*$"), F.lit(1))).alias("pos", "h"))
    base = F.regexp_replace(F.regexp_replace(F.lower(F.trim("h")), r"(?U)[^\w\s-]", ""), r"(?U)\s+", "-")
    k = F.row_number().over(Window.partitionBy(key, "slug").orderBy("pos")) - 1
    return heads.withColumn("slug", base).withColumn("k", k).select(key, F.col("pos").cast("long").alias("pos"), F.when(F.col("k") > 0, F.concat_ws("-", "slug", F.col("k").cast("string"))).otherwise(F.col("slug")).alias("anchor"))


def render_html(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, html``: a plain preview of headings, lists, code and paragraphs."""
    import html as h

    kind = df.schema[key].dataType.simpleString()

    def page(text: str) -> str:
        out, fence, items = [], None, []
        for line in [*(text or "").splitlines(), ""]:
            if fence is not None:
                if line.strip().startswith(("```", "~~~")):
                    out.append(f"<pre><code>{h.escape(chr(10).join(fence))}</code></pre>")
                    fence = None
                else:
                    fence.append(line)
                continue
            bullet = re.match(r"^\s*[-*]\s+(.*)", line)
            if items and not bullet:
                out.append("<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>")
                items = []
            head = re.match(r"^(#{1,6})\s+(.*)", line)
            if line.strip().startswith(("```", "~~~")):
                fence = []
            elif head:
                out.append(f'<h{len(head[1])} id="{slug(head[2])}">{h.escape(head[2])}</h{len(head[1])}>')
            elif bullet:
                items.append(h.escape(bullet[1]))
            elif line.strip():
                out.append(f"<p>{h.escape(line.strip())}</p>")
        if fence is not None:
            out.append(f"<pre><code>{h.escape(chr(10).join(fence))}</code></pre>")
        return "\n".join(out)

    def run(batches):
        for b in batches:
            yield pd.DataFrame({key: b[key], "html": [page(t) for t in b["text"]]})

    return df.select(key, "text").mapInPandas(run, f"{key} {kind}, html string")
