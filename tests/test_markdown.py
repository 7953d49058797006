"""Markdown tokens on hand-written cases and against a naive reader of drawn texts."""

import random
import re

import pytest

from corpusmill.operators import markdown

TEXT = """# Title *one* #

Some `code *x*` and **bold _both_** text, [site](https://a.org/x "t") ![](p.png) ~~gone~~ [^1]
still the paragraph
> quoted
lazy line
> - item
>   ```py
>   # no heading
>   ```

- a
  - b

    deep paragraph
1. one

| h | i |
|---|---|
| x | `a|b` | c |
| y | z |

Under
-----

[^1]: the note
***

    indented

    code
~~~
open"""


def rows(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    return markdown.tokens(df)


def test_tokens_of_a_text(spark):
    got = [(r.line, r.depth, r.kind, r.info, r.content) for r in rows(spark, TEXT).orderBy("pos").collect()]
    assert got == [
        (1, 0, "heading", "1", "Title *one*"), (1, 1, "emphasis", "", "one"),
        (3, 0, "paragraph", "", "Some `code *x*` and **bold _both_** text, [site](https://a.org/x \"t\") ![](p.png) ~~gone~~ [^1]\nstill the paragraph"),
        (3, 1, "code_span", "", "code *x*"), (3, 1, "strong", "", "bold _both_"), (3, 1, "emphasis", "", "both"), (3, 1, "link", "https://a.org/x", "site"), (3, 1, "image", "p.png", ""),
        (3, 1, "strike", "", "gone"), (3, 1, "note_ref", "1", ""),
        (5, 0, "quote", "", ""), (5, 1, "paragraph", "", "quoted\nlazy line"), (7, 1, "item", "bullet", ""), (7, 2, "paragraph", "", "item"), (8, 2, "code", "py", "# no heading"),
        (12, 0, "item", "bullet", ""), (12, 1, "paragraph", "", "a"), (13, 1, "item", "bullet", ""), (13, 2, "paragraph", "", "b"), (15, 2, "paragraph", "", "deep paragraph"),
        (16, 0, "item", "ordered", ""), (16, 1, "paragraph", "", "one"),
        (18, 0, "table", "2", "| h | i |"), (20, 1, "table_row", "3", "| x | `a|b` | c |"), (20, 2, "code_span", "", "a|b"), (21, 1, "table_row", "2", "| y | z |"),
        (23, 0, "heading", "2", "Under"), (26, 0, "note", "1", "the note"), (27, 0, "rule", "", ""), (29, 0, "code", "indented", "indented\n\ncode"), (32, 0, "open_code", "", "open"),
    ]


@pytest.mark.parametrize("text, want", [
    ("a*b*c", [("emphasis", "b")]), ("snake_case_name", []), ("***x***", [("emphasis", "**x**"), ("strong", "x")]), ("* not*", []), ("**a*", [("emphasis", "a")]), ("\\*x\\*", []), ("word*** word### x***", []),
    ("`` a`b ``", [("code_span", "a`b")]), ("`open", []), ("[a](b(c)d)", [("link", "a")]), ("[a [b](c) d](e)", [("link", "b")]), ("[x]", []), ("![alt *t*](i.png)", [("image", "alt *t*"), ("emphasis", "t")]), ("~~a~~ ~b~", [("strike", "a")]),
])
def test_inlines(text, want):
    assert [(kind, content) for _, kind, _, content in markdown.inlines(text)] == want


def naive(text):
    """Headings, fences and top-level bullets, line by line."""
    out, fence = [], None
    for n, line in enumerate(text.split("\n"), 1):
        m = re.match(r"^(`{3,}|~{3,})(\w*)$", line)
        if fence:
            if m and m[1][0] == fence[1][0] and len(m[1]) >= len(fence[1]) and not m[2]:
                out.append((fence[0], "code"))
                fence = None
        elif m:
            fence = (n, m[1])
        elif re.match(r"^#{1,6} \S", line):
            out.append((n, "heading"))
        elif re.match(r"^- \S", line):
            out.append((n, "item"))
    return sorted(out + ([(fence[0], "open_code")] if fence else []))


def test_drawn_texts_against_a_naive_reader(spark):
    rng = random.Random(7)
    lines = ["# head", "### h3", "- item", "plain words", "", "```", "```py", "~~~", "````", "#no", "-no", "####### seven"]
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randrange(25))) for _ in range(300)]
    got = {}
    for r in rows(spark, *texts).where("kind in ('heading', 'item', 'code', 'open_code')").collect():
        got.setdefault(r.doc_id, []).append((r.line, r.kind))
    for k, text in enumerate(texts):
        # a fence inside an item's paragraph ends the item first, as here all items are one line
        assert sorted(got.get(k, [])) == naive(text), text


def test_null_empty_and_long(spark):
    assert rows(spark, None, "", "\n\n").count() == 0
    assert rows(spark, "x *a* " * 200_000).where("kind = 'emphasis'").count() == 200_000


def test_lint_links_anchors_preview(spark):
    text = "# A\n\n### A\n\n```\nx\n```\n\n| a | b |\n|--|--|\n| 1 |\n\n![ ](p.png) [x](#a-1) [y](#b) [^n] [^m]\n\n[^n]: note\n\n~~~txt\nopen"
    found = rows(spark, text, "# fine\n\n[up](#fine)")
    assert sorted((r.doc_id, r.rule, r.severity, r.line) for r in markdown.lint(found).collect()) == [
        (0, "dead_anchor", "error", 13), (0, "fence_language", "warning", 5), (0, "heading_jump", "error", 3), (0, "image_description", "warning", 13), (0, "open_fence", "error", 17),
        (0, "table_width", "error", 11), (0, "undefined_note", "error", 13),
    ]
    assert sorted(r.anchor for r in markdown.anchors(found).collect()) == ["a", "a-1", "fine"]
    assert sorted((r.kind, r.target) for r in markdown.links(found).collect()) == [("image", "p.png"), ("link", "#a-1"), ("link", "#b"), ("link", "#fine")]
    html = {r.doc_id: r.html for r in markdown.preview(found).collect()}
    assert html[1] == '<h1 id="fine">fine</h1>\n<p class="d0">[up](#fine)</p>' and '<h3 id="a-1">A</h3>' in html[0] and '<pre class="d0">open</pre>' in html[0]
