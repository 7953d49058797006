"""Document quality: line, block and sentence metrics, findings, scores.

All metrics are columns of one pass over a document; the masking of code, which
needs state from line to line, is a fold over the line array. Findings are rows.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import packs
from ..dialect import BLANKS, SPARK, WIDE_SPACE, Spark, Steps, any_of, ladder, starts, unless
from ..functions import text as rules

_BULLETS = ["- ", "* "]
_ITEM = "|[-*] "


def lines(d: Spark, x: str = "text") -> str:
    return d.split(x, r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]")


def _lstrip(d: Spark, x: str) -> str:
    return f"trim(LEADING {d.lit(BLANKS)} FROM {x})" if d.name == "spark" else d.sub(x, r"^\s+", "")


def _aside(d: Spark, x: str, more: str = "") -> str:
    """Whether a line is a heading, table or quote (with ``more``: or a list item)."""
    if d.name == "spark":  # the first two characters tell
        return d.has(f"left({_lstrip(d, x)}, 2)", f"^(?:[#|>]{more})")
    return d.has(x, f"^[{WIDE_SPACE}]*(?:[#|>]{more})")


def nonspace(d: Spark, x: str = "text") -> str:
    if d.name == "spark":  # plain blanks and newlines need no pattern
        x = f"replace(replace({x}, ' ', ''), {d.lit(chr(10))}, '')"
    return f"CAST(length({d.sub(x, chr(92) + 's', '')}) AS BIGINT)"


def median(d: Spark, x: str) -> str:
    """Median of an array of numbers; null if empty."""
    if d.name == "duckdb":
        return f"list_aggregate({x}, 'median')"
    s = f"array_sort({x})"
    middle = f"({s}[CAST((size({x}) - 1) DIV 2 AS INT)] + {s}[CAST(size({x}) DIV 2 AS INT)]) / 2.0D"
    return f"CASE WHEN size({x}) > 0 THEN {middle} END"


def evidence_digits(d: Spark, x: str) -> str:
    """Digits that are not part of a library path or a year note."""
    return d.count(d.sub(d.sub(x, packs.LAYER_PATH, ""), packs.YEAR_NOTE, ""), r"\d")


def heading_levels(d: Spark, x: str = "text") -> str:
    return unless(d, x, ["#"], d.transform(d.extract_all(x, r"(?m)^(#{1,6})\s", 1), "h", "length(h)"), "CAST(array() AS ARRAY<INT>)")


def blocks(d: Spark, x: str = "text") -> str:
    """Prose blocks: set off by blank lines, not all headings, tables or quotes."""
    keep = d.size(d.filter(lines(d, "b"), "l", f"{d.strip('l')} <> '' AND NOT {_aside(d, 'l')}"))
    return d.filter(d.split(x, r"\n\s*\n"), "b", f"{keep} > 0")


def sentence_parts(d: Spark, x: str = "text") -> str:
    return d.filter(d.transform(d.split(x, packs.SENTENCE_END), "s", d.strip("s")), "s", "s <> ''")


def last_sentences(d: Spark, x: str = "blocks") -> str:
    """The last sentence of each block that has one."""
    return d.filter(d.transform(x, "b", d.element(sentence_parts(d, "b"), "-1")), "s", "s IS NOT NULL")


def title_words(d: Spark, title: str = "title", x: str = "text") -> str:
    """Pairs of neighbouring Han characters of the title, or else of the first H1."""
    head = unless(d, x, ["#"], d.extract(x, "(?m)^#" + chr(92) + "s+(.+)$", 1), "''")
    source = f"coalesce(nullif({title}, ''), {head}, '')"
    runs = d.filter(d.extract_all(source, packs.HAN_RUN), "r", f"NOT {d.has('r', packs.CHAPTER_NUMBER)}")
    return f"flatten({d.transform(runs, 'r', d.transform(d.sequence('1', 'length(r) - 1'), 'i', 'substring(r, CAST(i AS INT), 2)'))})"


def line_kinds(d: Spark, x: str = "lines") -> str:
    """A letter for each line: B for a list item, E for an empty one, T for others."""
    return d.join(d.transform(x, "l", f"CASE WHEN {bullet(d, 'l')} THEN 'B' WHEN {d.strip('l')} = '' THEN 'E' ELSE 'T' END"), "")


def _alternatives(pattern: str) -> list[str]:
    """The words of a pattern that is a choice of words."""
    return pattern.strip("()").split("|")


def _matches(d: Spark, pattern: str, words: list[str]) -> str:
    """Matches of a pattern in ``text`` that all hold one of the words."""
    return unless(d, "text", words, d.count("text", pattern), "0L")


def _claims(d: Spark) -> str:
    """Whether the text makes a strong claim."""
    return any_of(d, "text", _alternatives(packs.STRONG_CLAIM)) if d.name == "spark" else d.has("text", packs.STRONG_CLAIM)


def _sums_up(d: Spark) -> str:
    return any_of(d, "text", packs.SUMMARY_HEADS) if d.name == "spark" else d.has("text", "|".join(packs.SUMMARY_HEADS))


def absolutes(d: Spark, x: str = "text") -> str:
    """Distinct absolute words, those after 不 or 必 excepted (no look-behind needed)."""
    found = d.distinct(d.extract_all(d.sub(x, "[不必]" + packs.ABSOLUTES, ""), packs.ABSOLUTES, 1))
    return unless(d, x, _alternatives(packs.ABSOLUTES), found, "CAST(array() AS ARRAY<STRING>)")


def bullet(d: Spark, x: str) -> str:
    return starts(d, _lstrip(d, x), _BULLETS)


def _if(d: Spark, holds: str, count: str) -> str:
    """A count of parts that only texts of some kind can have; others are not taken apart for it."""
    return f"CASE WHEN coalesce({holds}, false) THEN {count} ELSE CAST(0 AS BIGINT) END"


def missing_lists(d: Spark, x: str = "text") -> str:
    """Method sections (second-level headings with an action word) without a numbered list."""
    cut = d.split(d.sub(x, r"(?m)^##\s+", "\x01"), "\x01")
    parts = d.filter(cut, "p", d.has("p", rf"^[^\n]*{packs.STEP_TITLE}"))
    first = d.element(cut, "1")
    lacking = d.filter(parts, "p", f"NOT {d.has('p', r'(?m)^[^\S\n]*\d+[.]\s' if d.name == 'duckdb' else r'(?m)^\s*\d+\.\s')}")
    head = f"CASE WHEN {d.has(f'coalesce({first}, {d.lit("")})', rf'^[^\n]*{packs.STEP_TITLE}')} AND NOT {d.has(f'coalesce({first}, {d.lit("")})', r'(?m)^\s*\d+[.]\s')} THEN 1 ELSE 0 END"
    return unless(d, x, ["##", "\x01"], f"({d.size(lacking)} - {head})", "0L")  # one part, which counts twice


def anchor_hits(d: Spark, x: str = "text") -> str:
    """References to material, at most one on lines that only list names."""
    each = " + ".join(d.count("l", p) for p in packs.ANCHORS)
    listing = f"({d.has('l', packs.DUMP_HEAD)} OR ({d.count('l', packs.LAYER_PATH)} >= 2 AND {d.has('l', '[、，]')}))"
    hits = d.transform(lines(d, x), "l", f"CASE WHEN {listing} THEN least({each}, 1) ELSE {each} END")
    return f"CAST(list_sum({hits}) AS BIGINT)" if d.name == "duckdb" else f"aggregate({hits}, 0L, (a, v) -> a + v)"


#: Metric columns of a document whose text is column ``text`` (already masked), its
#: ``title`` may be null. Lines, blocks and sentences are columns that later steps share.
METRICS = Steps(
    ("n_chars_net", lambda d: nonspace(d)),
    ("n_units", lambda d: rules.content_units(d)),
    ("lines", lambda d: lines(d)),
    ("blocks", lambda d: blocks(d)),
    ("parts", lambda d: sentence_parts(d)),
    ("lens", lambda d: d.transform(d.filter("parts", "s", f"NOT {_aside(d, 's', _ITEM)}"), "s", "length(s)")),
    ("n_sentences", lambda d: d.size("lens")),
    ("median_len", lambda d: median(d, "lens")),
    ("n_near", lambda d: d.size(d.filter("lens", "v", "v >= 0.8 * median_len AND v <= 1.2 * median_len"))),
    ("n_blocks", lambda d: d.size("blocks")),
    ("n_long_blocks", lambda d: d.size(d.filter("blocks", "b", f"length(b) > 300 AND {nonspace(d, 'b')} > 300"))),
    ("tails", lambda d: last_sentences(d)),
    ("n_paragraphs", lambda d: d.size("tails")),
    ("n_summaries", lambda d: _if(d, _sums_up(d), d.size(d.filter("tails", "s", d.has("s", f"^[，,、\"'“‘]*(?:{'|'.join(packs.SUMMARY_HEADS)})"))))),
    ("prose_lines", lambda d: d.filter("lines", "l", f"{d.strip('l')} <> '' AND NOT {_aside(d, 'l', _ITEM)}")),
    ("n_prose_lines", lambda d: d.size("prose_lines")),
    ("title_words", lambda d: title_words(d)),
    ("n_title_words", lambda d: d.size("title_words")),
    ("n_pulled_back", lambda d: _if(d, "n_title_words > 0", d.size(d.filter("prose_lines", "l", f"{d.size(d.filter('title_words', 'w', 'contains(l, w)'))} > 0")))),
    ("n_unhedged", lambda d: _if(d, _claims(d), d.size(d.filter("parts", "s", f"length(s) <= 120 AND {d.has('s', packs.FUTURE_CLAIM)} AND {d.has('s', packs.STRONG_CLAIM)} AND NOT {d.has('s', packs.HEDGE)}")))),
    ("n_questions", lambda d: d.count("text", "[？?]")),
    ("n_digit_lines", lambda d: _if(d, d.has("text", r"\d"), d.size(d.filter("lines", "l", f"{d.has('l', chr(92) + 'd')} AND NOT {_aside(d, 'l')} AND {evidence_digits(d, 'l')} > 0")))),
    ("n_absolutes", lambda d: d.size(absolutes(d))),
    ("n_parallel", lambda d: " + ".join(_matches(d, p, [p[: p.index("[")]]) for p in packs.PARALLEL)),
    ("n_intensifiers", lambda d: _matches(d, packs.INTENSIFIERS, _alternatives(packs.INTENSIFIERS))),
    ("n_bold", lambda d: _matches(d, r"\*\*[^*]+\*\*", ["**"])),
    ("n_you", lambda d: _matches(d, "你", ["你"])),
    ("n_invites", lambda d: _matches(d, "让我们", ["让我们"])),
    ("levels", lambda d: heading_levels(d)),
    ("n_h2", lambda d: d.size(d.filter("levels", "v", "v = 2"))),
    ("n_h3", lambda d: d.size(d.filter("levels", "v", "v = 3"))),
    ("n_jumps", lambda d: d.size(d.filter(d.sequence("1", f"{d.size('levels')} - 1"), "i", f"{d.element('levels', 'i + 1')} - {d.element('levels', 'i')} > 1"))),
    ("n_missing_lists", lambda d: missing_lists(d)),
    ("lists_touch", lambda d: d.has(line_kinds(d), "BE+B")),
)

#: (rule, condition on metric columns); all are warnings but the first two.
ERRORS = [("long_paragraph", "n_long_blocks > 0"), ("heading_jump", "n_jumps > 0")]
WARNINGS = [
    ("main_line_lost", "conversational AND n_prose_lines >= 5 AND n_title_words > 0 AND n_pulled_back < 2"),
    ("unhedged_claim", "n_unhedged > 0"),
    ("uniform_sentences", "conversational AND n_sentences >= 5 AND n_near >= 0.7 * n_sentences"),
    ("no_question", "conversational AND n_questions = 0"),
    ("thin_evidence", "tutorial_type IS NULL AND n_chars_net >= 300 AND n_digit_lines < greatest(1, floor(n_chars_net / 800))"),
    ("absolutes", "n_absolutes > 0"),
    ("parallels", "n_parallel >= 2"),
    ("summary_endings", "n_paragraphs >= 3 AND n_summaries >= 2 AND CAST(n_summaries AS DOUBLE) / greatest(n_paragraphs, 1) > 0.3"),
    ("invitation", "n_invites > 0"),
    ("intensifiers", "n_intensifiers >= 3"),
    ("orphan_h3", "n_h3 = 1 AND n_h2 >= 2"),
    ("missing_list", "n_missing_lists > 0"),
    ("bold", "n_chars_net >= 300 AND n_bold * 1000 > 10 * n_chars_net"),
    ("no_address", "conversational AND n_chars_net >= 300 AND n_you < 2"),
    ("lists_touch", "lists_touch"),
]
_count = lambda rules_: " + ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END" for _, c in rules_)

#: Metrics and verdict; needs columns ``text`` (masked), ``title`` and ``tutorial_type``.
SCORED = METRICS.then(
    ("conversational", lambda d: f"(tutorial_type IS NULL OR tutorial_type NOT IN ({', '.join(map(d.lit, packs.STRUCTURED_TYPES))}))"),
    ("n_errors", lambda d: f"CAST({_count(ERRORS)} AS BIGINT)"),
    ("n_warnings", lambda d: f"CAST({_count(WARNINGS)} AS BIGINT)"),
    ("score", lambda d: "greatest(0, 100 - 5 * n_warnings)"),
    ("verdict", lambda d: f"CASE WHEN n_errors > 0 THEN '不通过' ELSE {rules.verdict()} END"),
    ("status", lambda d: ladder([("n_errors > 0 OR score < 70", "'fail'"), ("score < 85", "'minor'")], "'pass'")),
)


def scored(df: DataFrame) -> DataFrame:
    """Metrics and verdict of the prose of column ``text``."""
    return SCORED.on(df.withColumn("text", masked(F.col("text"))))


def findings(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per rule a document breaks: ``key, rule, severity``."""
    broken = F.filter(
        F.array(*[F.when(F.expr(c), F.struct(F.lit(r).alias("rule"), F.lit(s).alias("severity"))) for rs, s in ((ERRORS, "error"), (WARNINGS, "warning")) for r, c in rs]),
        lambda x: x.isNotNull(),
    )
    return scored(df).select(key, F.explode(broken).alias("f")).select(key, "f.rule", "f.severity")


def masked(text: Column) -> Column:
    """Prose only: comments, fenced code and indented lines become empty lines.

    A fold over lines carries the open fence; line numbers are kept. A text without
    fence, comment or indented line is its own prose.
    """
    bare = F.regexp_replace(text, "(?s)<!--.*?-->", "\u0001")  # a comment's newlines are restored below
    parts = F.split(bare, "\u0001", -1)
    gaps = F.transform(F.regexp_extract_all(text, F.lit("(?s)<!--.*?-->"), F.lit(0)), lambda c: F.regexp_replace(c, "[^\\n]", ""))
    joined = F.array_join(F.flatten(F.transform(F.arrays_zip(parts.alias("p"), gaps.alias("g")), lambda z: F.array(z["p"], F.coalesce(z["g"], F.lit(""))))), "")
    kind = "struct<fence:string,out:array<string>>"
    start = F.struct(F.lit("").alias("fence"), F.array().cast("array<string>").alias("out")).cast(kind)

    def step(a, line):
        mark = F.regexp_extract(line, r"^\s*(?:>\s*)*(`{3,}|~{3,})", 1)
        rest = F.regexp_extract(line, r"^\s*(?:>\s*)*(?:`{3,}|~{3,})(.*)$", 1)
        closes = (mark != "") & (F.substring(mark, 1, 1) == F.substring(a["fence"], 1, 1)) & (F.length(mark) >= F.length(a["fence"])) & (F.trim(rest) == "")
        inside = a["fence"] != ""
        fence = F.when(inside & closes, "").when(inside, a["fence"]).otherwise(mark)
        keep = ~inside & (mark == "") & ~line.rlike("^(    |\\t)")
        return F.struct(fence.alias("fence"), F.array_append(a["out"], F.when(keep, line).otherwise("")).alias("out")).cast(kind)

    folded = F.aggregate(F.split(joined, "\n", -1), start, step, lambda a: F.array_join(a["out"], "\n"))
    marks = ["```", "~~~", "<!--", "\n    ", "\n\t"]
    marked = reduce(or_, [text.startswith("    "), text.startswith("\t"), *[text.contains(m) for m in marks]])
    return F.when(marked, folded).otherwise(text)


def bullet_runs(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, start, n``: runs of consecutive bullet lines (gaps and islands)."""
    from pyspark.sql import Window

    rows = df.select(key, F.posexplode(F.expr(lines(SPARK))).alias("pos", "l")).where(F.expr(bullet(SPARK, "l")))
    island = F.col("pos") - F.row_number().over(Window.partitionBy(key).orderBy("pos"))
    return rows.withColumn("island", island).groupBy(key, "island").agg(F.min("pos").cast("long").alias("start"), F.count(F.lit(1)).alias("n")).drop("island")


def chapter(df: DataFrame) -> DataFrame:
    """:data:`CHAPTER` over ``text, case_name, n_materials``."""
    return CHAPTER.on(df.withColumn("prose", masked(F.col("text"))))


def _first_lines(d: Spark, x: str) -> str:
    return d.join(f"slice({lines(d, x)}, 1, 5)" if d.name == "spark" else f"({lines(d, x)})[1:5]", "\n")


def _from(d: Spark, x: str, parts: int) -> str:
    """What follows the last multiple of a ``parts``-th of the length."""
    at = f"floor(length({x}) / {parts})" if d.name == "spark" else f"(length({x}) // {parts})"
    return f"substring({x}, CAST({at} * {parts - 1} + 1 AS INT))"


def in_order(d: Spark, x: str, words: str) -> str:
    """Words that the text holds, by where it first has them."""
    at = d.filter(d.transform(words, "w", f"{'named_struct' if d.name == 'spark' else 'struct_pack'}({_fields(d, x)})"), "p", "p.at > 0")
    return d.transform(f"array_sort({at})" if d.name == "spark" else f"list_sort({at})", "p", "p.w")


def _fields(d: Spark, x: str) -> str:
    at = f"instr({x}, w)"
    return f"'at', {at}, 'w', w" if d.name == "spark" else f"at := {at}, w := w"


#: Chapter checks: ``text``, its masked ``prose``, ``case_name, n_materials`` to metric columns.
CHAPTER = Steps(
    ("hits", lambda d: anchor_hits(d)),
    ("anchor_rate", lambda d: "least(1.0, CAST(hits AS DOUBLE) / (2 * greatest(n_materials, 1)))"),
    ("head", lambda d: _first_lines(d, "text")),
    ("tail", lambda d: _from(d, "text", 3)),
    ("has_contract", lambda d: f"({d.has('head', packs.READER)} AND {d.has('head', packs.OUTCOME)})"),
    ("has_deliverable", lambda d: "(" + " OR ".join(d.has("tail", p) for p in packs.DELIVERABLES) + ")"),
    ("has_case", lambda d: "(case_name IS NULL OR case_name = '' OR contains(text, case_name))"),
    ("opening", lambda d: d.filter(d.extract_all(_first_lines(d, "prose"), packs.HAN_RUN), "w", f"w NOT IN ({', '.join(map(d.lit, packs.CHAPTER_NAMES))})")),
    ("closing", lambda d: d.filter(d.transform(lines(d, _from(d, "prose", 4)), "l", d.strip("l")), "l", f"l <> '' AND NOT {d.has('l', '^[#|>*-]')} AND NOT {d.has('l', packs.PREVIEW)}")),
    ("loops_back", lambda d: d.size(d.filter("closing", "l", f"{d.size(d.filter('opening', 'w', 'contains(l, w)'))} > 0 OR (coalesce(case_name, '') <> '' AND contains(l, case_name))")) + " > 0"),
    ("n_vague", lambda d: d.count("prose", packs.VAGUE)),
    ("n_rhetoric", lambda d: d.count("prose", packs.RHETORIC)),
    ("banned", lambda d: d.join(in_order(d, "prose", d.words(packs.BANNED)), "、")),
)

#: (rule, condition on :data:`CHAPTER` columns, severity).
CHAPTER_RULES = [
    ("thin_anchors", "anchor_rate < 0.6 AND NOT modern", "error"), ("no_contract", "NOT has_contract", "error"), ("no_deliverable", "NOT has_deliverable", "error"),
    ("case_missing", "NOT has_case", "error"), ("no_loop_back", "NOT loops_back AND NOT modern", "error"), ("vague", "n_vague > 0", "error"), ("rhetoric", "n_rhetoric > 2", "warning"),
]


def chapter_findings(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, rule, severity`` of the chapter rules a text breaks; ``modern`` says that
    anchors and the loop back are not asked for."""
    broken = F.filter(F.array(*[F.when(F.expr(c), F.struct(F.lit(r).alias("rule"), F.lit(s).alias("severity"))) for r, c, s in CHAPTER_RULES]), lambda x: x.isNotNull())
    return chapter(df).select(key, F.explode(broken).alias("f")).select(key, "f.rule", "f.severity")
