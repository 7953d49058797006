"""Markdown as rows: a table function gives tokens, everything else is a plan over them.

The reader keeps a stack of open containers (quotes, list items) for blocks and a
stack of delimiters for emphasis and brackets, reads a text once and yields a row a token:
``pos, line, depth, kind, info, content``. It is called by a lateral join, so
tokens stand beside the columns of their text. Lint, anchors, links and previews
are joins, windows and aggregates over tokens.

Blocks: quote, list, item (containers), heading, paragraph, code, open_code (a fence
that never closes), table, table_row, rule, html, note. Inlines, one deeper than
their block: link, image, note_ref, code_span, strong, emphasis, strike. Left out of
CommonMark: link reference definitions, entities, nested brackets in link texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from ..work import ship

SCHEMA = "pos long, line long, depth int, kind string, info string, content string"
_FENCE = re.compile(r"^ {0,3}(`{3,}|~{3,})[ \t]*([^`\n]*)$")
_HEADING = re.compile(r"^ {0,3}(#{1,6})(?:[ \t]+(.*?))?(?:[ \t]+#+)?[ \t]*$")
_RULE = re.compile(r"^ {0,3}([-*_])[ \t]*(?:\1[ \t]*){2,}$")
_ITEM = re.compile(r"^( {0,3})([-*+]|\d{1,9}[.)])([ \t]+|$)")
_DIVIDER = re.compile(r"^ {0,3}\|?[ \t]*:?-+:?[ \t]*(?:\|[ \t]*:?-+:?[ \t]*)*\|?[ \t]*$")
_NOTE = re.compile(r"^ {0,3}\[\^([^\]\s]+)\]:[ \t]*(.*)$")
_HTML = re.compile(r"^ {0,3}<(?:!--|/?[A-Za-z])")
_PUNCTUATION = re.compile(r"[^\w\s]")


def cells(line: str) -> int:
    """Cells of a table line; bars in code spans or after a backslash are text."""
    bare = re.sub(r"`[^`]*`", "", line.strip()).replace("\\|", "")
    return len(bare.removeprefix("|").removesuffix("|").split("|"))


class Blocks:
    """Leaf blocks and containers of one text, by lines."""

    def __init__(self, text: str):
        self.rows: list[tuple] = []  # (line, depth, kind, info, content)
        self.stack: list[tuple[str, int]] = []  # open containers: ("quote", 0), or ("item", columns to its content)
        self.leaf: list | None = None  # [kind, line, info, lines]
        for number, line in enumerate(text.split("\n"), 1):
            self._line(number, line.rstrip("\r").expandtabs(4))
        self._close(0)

    def _emit(self, line: int, kind: str, info: str = "", content: str = "", depth: int | None = None) -> None:
        self.rows.append((line, len(self.stack) if depth is None else depth, kind, info, content))

    def _end_leaf(self, closed: bool = False) -> None:
        if self.leaf and self.leaf[0] == "table":  # its rows stand already
            self.leaf = None
        if self.leaf:
            kind, line, info, lines = self.leaf
            if kind == "fence":
                kind, info = ("code" if closed else "open_code"), info[1]
            elif kind == "indented":
                kind, info = "code", "indented"
                while lines and not lines[-1].strip():
                    lines.pop()
            self._emit(line, kind, info, "\n".join(lines))
            self.leaf = None

    def _close(self, keep: int) -> None:
        self._end_leaf()
        del self.stack[keep:]

    def _line(self, number: int, line: str) -> None:
        kept = 0
        rest = line
        for kind, width in self.stack:  # containers that go on
            if kind == "quote":
                m = re.match(r"^ {0,3}> ?", rest)
                if not m:
                    break
                rest = rest[m.end():]
            elif not rest.strip():
                rest = ""
            elif len(rest) - len(rest.lstrip(" ")) >= width:
                rest = rest[width:]
            else:
                break
            kept += 1
        fence = self.leaf and self.leaf[0] == "fence"
        if kept < len(self.stack):
            lazy = self.leaf and self.leaf[0] == "paragraph" and rest.strip() and not self._begins(rest)
            if lazy:
                self.leaf[3].append(rest.strip())
                return
            self._close(kept)
            fence = None
        if fence:
            mark = self.leaf[2][0]
            if re.match(rf"^ {{0,3}}{re.escape(mark[0])}{{{len(mark)},}}[ \t]*$", rest):
                self._end_leaf(closed=True)
            else:
                self.leaf[3].append(rest)
            return
        while True:  # containers that begin
            quote, item = re.match(r"^ {0,3}> ?", rest), None if _RULE.match(rest) else _ITEM.match(rest)
            if self.leaf and self.leaf[0] == "indented" or not (quote or item):
                break
            if rest.startswith("    "):
                break
            self._end_leaf()
            if quote:
                self._emit(number, "quote")
                self.stack.append(("quote", 0))
                rest = rest[quote.end():]
                continue
            ordered = item[2][0].isdigit()
            self._emit(number, "item", "ordered" if ordered else "bullet")
            gap = len(item[3]) if 1 <= len(item[3]) <= 4 else 1
            self.stack.append(("item", len(item[1]) + len(item[2]) + gap))
            rest = rest[len(item[1]) + len(item[2]) + gap :]
        self._leaf_line(number, rest)

    def _begins(self, rest: str) -> bool:
        """Whether a line ends the paragraph before it."""
        return bool(_FENCE.match(rest) or _HEADING.match(rest) or _RULE.match(rest) or _ITEM.match(rest) or re.match(r"^ {0,3}>", rest))

    def _leaf_line(self, number: int, rest: str) -> None:
        kind = self.leaf[0] if self.leaf else None
        if not rest.strip():
            if kind == "indented":
                self.leaf[3].append("")
            else:
                self._end_leaf()
            return
        if kind in ("paragraph", None) and (m := _FENCE.match(rest)):
            self._end_leaf()
            self.leaf = ["fence", number, (m[1], m[2].strip().split(" ")[0]), []]
        elif kind == "indented" or kind is None and rest.startswith("    "):
            if rest.startswith("    "):
                self.leaf = self.leaf or ["indented", number, "", []]
                self.leaf[3].append(rest[4:])
            else:
                self._end_leaf()
                self._leaf_line(number, rest)
        elif kind == "table" and "|" in rest:
            self._emit(number, "table_row", str(cells(rest)), rest.strip(), len(self.stack) + 1)
        elif kind == "paragraph" and len(self.leaf[3]) == 1 and "|" in self.leaf[3][0] and _DIVIDER.match(rest) and cells(rest) == cells(self.leaf[3][0]):
            _, line, _, lines = self.leaf
            self.leaf = None
            self._emit(line, "table", str(cells(lines[0])), lines[0])
            self.leaf = ["table", line, "", []]
        elif kind == "paragraph" and (m := re.match(r"^ {0,3}(=+|-+)[ \t]*$", rest)):
            self.leaf[0], self.leaf[2] = "heading", "1" if m[1][0] == "=" else "2"
            self._end_leaf()
        elif m := _HEADING.match(rest):
            self._end_leaf()
            self._emit(number, "heading", str(len(m[1])), (m[2] or "").strip())
        elif _RULE.match(rest):
            self._end_leaf()
            self._emit(number, "rule")
        elif kind != "paragraph" and (m := _NOTE.match(rest)):
            self._end_leaf()
            self.leaf = ["note", number, m[1], [m[2]]]
        elif kind is None and _HTML.match(rest):
            self.leaf = ["html", number, "", [rest]]
        elif kind in ("paragraph", "html", "note"):
            self.leaf[3].append(rest.strip())
        else:
            self._end_leaf()
            self.leaf = ["paragraph", number, "", [rest.strip()]]

    def tokens(self) -> Iterator[tuple]:
        pos = 0
        for line, depth, kind, info, content in self.rows:
            yield pos, line, depth, kind, info, content
            pos += 1
            if kind in ("heading", "paragraph", "note", "table", "table_row"):
                for at, inner, detail, text in inlines(content):
                    yield pos, line + (content.count("\n", 0, at) if kind in ("paragraph", "note") else 0), depth + 1, inner, detail, text
                    pos += 1


_LINK = re.compile(r"\]\(\s*(?:<([^<>\n]*)>|([^\s()]*(?:\([^\s()]*\)[^\s()]*)*))(?:\s+(?:\"[^\"]*\"|'[^']*'|\([^)]*\)))?\s*\)")


_TICKS = re.compile("`+")


def inlines(text: str) -> list[tuple[int, str, str, str]]:
    """(place, kind, info, content) of the inline tokens of a block's text, by place.

    ``brackets`` holds what may become a link, ``delimiters`` what may become
    emphasis; a closing mark looks for its opener from the top of the stack.
    """
    out: list[tuple[int, str, str, str]] = []
    brackets: list[int] = []
    unclosed: set[int] = set()
    delimiters: list[list] = []  # [mark, place, length, can open, can close]
    i = 0
    while i < len(text):
        c = text[i]
        if c == "\\" and i + 1 < len(text) and _PUNCTUATION.match(text[i + 1]):
            i += 2
        elif c == "`":
            run = _TICKS.match(text, i).end() - i
            end = -1 if run in unclosed else _closing(text, i + run, run)
            if end < 0:
                unclosed.add(run)  # none closes a later run of this length either
            if end >= 0:
                out.append((i, "code_span", "", text[i + run : end].strip()))
                i = end
            i += run
        elif c == "[":
            note = re.compile(r"\[\^([^\]\s]+)\]").match(text, i)
            if note:
                out.append((i, "note_ref", note[1], ""))
                i = note.end()
            else:
                brackets.append(i)
                i += 1
        elif c == "]":
            begin = brackets.pop() if brackets else -1
            m = _LINK.match(text, i) if begin >= 0 else None
            if m:
                image = begin > 0 and text[begin - 1] == "!"
                out.append((begin - image, "image" if image else "link", m[1] if m[1] is not None else m[2], text[begin + 1 : i]))
                if not image:
                    brackets.clear()  # no link within a link
                i = m.end()
            else:
                i += 1
        elif c in "*_~":
            n = 1
            while i + n < len(text) and text[i + n] == c:
                n += 1
            if c != "~" or n == 2:
                _delimit(text, i, n, delimiters, out)
            i += n
        else:
            i += 1
    return sorted(out)


def _closing(text: str, at: int, run: int) -> int:
    """Where a run of exactly so many backticks begins, or -1."""
    for m in _TICKS.finditer(text, at):
        if len(m[0]) == run:
            return m.start()
    return -1


def _delimit(text: str, i: int, n: int, delimiters: list[list], out: list) -> None:
    """A run of marks: closes openers of its kind as far as it can, then may open."""
    c = text[i]
    before, after = text[i - 1] if i else " ", text[i + n] if i + n < len(text) else " "
    blank_b, blank_a, mark_b, mark_a = before.isspace(), after.isspace(), bool(_PUNCTUATION.match(before)), bool(_PUNCTUATION.match(after))
    left = not blank_a and (not mark_a or blank_b or mark_b)
    right = not blank_b and (not mark_b or blank_a or mark_a)
    opens = left and (c != "_" or not right or mark_b)
    closes = right and (c != "_" or not left or mark_a)
    whole, at = n, i
    while closes and n:
        k = next((k for k in range(len(delimiters) - 1, -1, -1) if delimiters[k][0] == c and not ((delimiters[k][4] or opens) and (delimiters[k][5] + whole) % 3 == 0 and (delimiters[k][5] % 3 or whole % 3) and c != "~")), None)
        if k is None:
            break
        del delimiters[k + 1 :]
        used = 2 if c == "~" else min(2, n, delimiters[k][2])
        delimiters[k][2] -= used
        begin = delimiters[k][1] + delimiters[k][2]
        out.append((begin, "strike" if c == "~" else ("strong" if used == 2 else "emphasis"), "", text[begin + used : at]))
        if not delimiters[k][2]:
            del delimiters[k]
        n, at = n - used, at + used
    if opens and n:
        delimiters.append([c, at, n, True, closes, whole])


@udtf(returnType=SCHEMA, useArrow=True)
class MarkdownTokens:
    """``markdown_tokens(text)``: the tokens of a text; a null text has none."""

    def eval(self, text: str):
        if text:
            yield from Blocks(text).tokens()


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.udtf.register("markdown_tokens", MarkdownTokens)


def tokens(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the tokens of each whole text, by a lateral join."""
    register(df.sparkSession)
    source = df.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    return df.sparkSession.sql("SELECT d.k, m.* FROM {docs} d, LATERAL markdown_tokens(d.t) m", docs=source).withColumnRenamed("k", key)


def anchors(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, pos, level, anchor``: of each heading, numbered where a slug comes again."""
    slug = F.regexp_replace(F.regexp_replace(F.lower(F.trim("content")), r"(?U)[^\w\s-]", ""), r"(?U)\s+", "-")
    heads = found.where("kind = 'heading'").select(key, "pos", F.col("info").cast("int").alias("level"), slug.alias("slug"))
    again = F.row_number().over(Window.partitionBy(key, "slug").orderBy("pos")) - 1
    return heads.withColumn("n", again).select(key, "pos", "level", F.when(F.col("n") > 0, F.concat_ws("-", "slug", F.col("n").cast("string"))).otherwise(F.col("slug")).alias("anchor"))


def links(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, line, kind, target, label``: links and images, in no code."""
    return found.where("kind in ('link', 'image')").select(key, "line", "kind", F.col("info").alias("target"), F.col("content").alias("label"))


def lint(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, rule, severity, line`` of tokens: fences without a language or an end, rows of
    another width than their table, jumps of heading levels, notes and anchors that
    are nowhere, images without a description."""
    order = Window.partitionBy(key).orderBy("pos")
    level = F.col("info").cast("int")
    heads = found.where("kind = 'heading'").withColumn("jump", level - F.lag(level).over(order) > 1)
    rows = found.where("kind in ('table', 'table_row')").withColumn("head", F.last(F.when(F.col("kind") == "table", F.col("info")), ignorenulls=True).over(order))
    refs, defined = found.where("kind = 'note_ref'"), found.where("kind = 'note'").select(key, "info").distinct()
    inner = found.where("kind = 'link' and info like '#%' and length(info) > 1").withColumn("anchor", F.substring("info", 2, 1 << 20))
    parts = [
        (found.where("kind in ('code', 'open_code') and info = ''"), "fence_language", "warning"), (found.where("kind = 'open_code'"), "open_fence", "error"),
        (heads.where("jump"), "heading_jump", "error"), (rows.where("kind = 'table_row' and info <> head"), "table_width", "error"),
        (refs.join(defined, [key, "info"], "left_anti"), "undefined_note", "error"), (found.where("kind = 'image' and trim(content) = ''"), "image_description", "warning"),
        (inner.join(anchors(found, key).select(key, "anchor").distinct(), [key, "anchor"], "left_anti"), "dead_anchor", "error"),
    ]
    out = None
    for df, rule, severity in parts:
        one = df.select(key, F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), "line")
        out = one if out is None else out.unionByName(one)
    return out


def preview(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, html``: a plain preview, blocks in order with their nesting as a class; one text's blocks are one row."""
    safe = F.replace(F.replace(F.replace("content", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    named = found.join(anchors(found, key).select(key, "pos", "anchor"), [key, "pos"], "left")
    wrap = lambda tag, inner: F.concat(F.lit(f'<{tag} class="d'), F.col("depth").cast("string"), F.lit('">'), inner, F.lit(f"</{tag}>"))
    piece = (
        F.when(F.col("kind") == "heading", F.concat(F.lit("<h"), "info", F.lit(' id="'), "anchor", F.lit('">'), safe, F.lit("</h"), "info", F.lit(">")))
        .when(F.col("kind") == "paragraph", wrap("p", safe)).when(F.col("kind").isin("code", "open_code"), wrap("pre", safe)).when(F.col("kind").isin("table", "table_row"), wrap("tr", safe))
        .when(F.col("kind") == "note", wrap("aside", safe)).when(F.col("kind") == "rule", F.lit("<hr>")).when(F.col("kind") == "image", F.concat(F.lit('<img src="'), "info", F.lit('" alt="'), safe, F.lit('">')))
    )
    pieces = named.withColumn("piece", piece).where("piece is not null")
    return pieces.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "piece"))), lambda x: x["piece"]), "\n").alias("html"))
