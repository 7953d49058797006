"""Rules over text: normalising, cleaning, counting, judging, typing questions."""

from __future__ import annotations

import re

from .. import packs
from ..dialect import Rule, Spark, any_of, ends, ladder, starts

CJK_NARROW, CJK_WIDE = r"[\x{4E00}-\x{9FA5}]", r"[\x{4E00}-\x{9FFF}]"


def normalised(d: Spark, x: str = "text") -> str:
    """Stripped, with full-width question marks."""
    return f"replace({d.strip(x)}, '?', '？')"


def dedupe_key(d: Spark, x: str = "text") -> str:
    """Normalised, trailing particles and marks folded to one mark."""
    return d.sub(d.sub(normalised(d, x), "[吗呢么]+[？?]*$", "？"), "？+$", "？")


def chinese_chars(d: Spark, x: str = "text") -> str:
    return d.count(x, CJK_WIDE)


def content_units(d: Spark, x: str = "text") -> str:
    """Chinese characters and Latin words."""
    return f"({d.count(x, CJK_WIDE)} + {d.count(x, '[A-Za-z]+')})"


def valid_content(d: Spark, x: str = "text", least: int = 500) -> str:
    return f"({content_units(d, x)} >= {least})"


def char_set(d: Spark, x: str = "text") -> str:
    """Distinct Chinese characters, as an array."""
    return d.distinct(d.extract_all(x, CJK_NARROW))


def shingles(d: Spark, x: str = "text", n: int = 2) -> str:
    """Distinct character n-grams; none if the text is shorter."""
    grams = d.transform(d.sequence("1", f"length({x}) - {n - 1}"), "i", f"substring({x}, CAST(i AS INT), {n})")
    return d.distinct(grams)


def strip_html(d: Spark, x: str = "html") -> str:
    """Without scripts, styles and tags; character references stay (``questions.stripped`` replaces them)."""
    dot = "[\\s\\S]*?" if d.name == "duckdb" else "[\\x{0}-\\x{10FFFF}]*?"
    out = d.sub(x, f"<script[^>]*>{dot}</script>", "")
    return d.sub(d.sub(out, f"<style[^>]*>{dot}</style>", ""), "<[^>]+>", "")


def question_like(d: Spark, x: str = "text") -> str:
    """Ends in a question mark, or its first line holds an interrogative."""
    t = d.strip(x)
    line = d.extract(t, r"^[^\n]*", 0)
    return f"({ends(d, t, ['？', '?'])} OR {any_of(d, line, packs.QUESTION_WORDS)} AND NOT {d.has(t, chr(92) + 'n[^' + chr(92) + 'n]')})"


def not_question(d: Spark, x: str = "text") -> str:
    """Too short, too long, or any pattern of footers, code and navigation."""
    t = d.strip(x)
    tests = []
    for p in packs.NOT_QUESTIONS:
        if p == r"^[\s\W\d_]+$":  # RE2's classes are ASCII
            p = p if d.name == "spark" else r"^[^\p{L}\p{M}]+$"
        tests.append(d.has(t, p, "i" if d.name == "duckdb" else "iu"))
    return f"(length({t}) < 6 OR length({t}) > 60 OR {' OR '.join(tests)})"


def real_question(d: Spark, x: str = "text") -> str:
    """Not a leading or rhetorical line, not a guide's heading."""
    return f"(length({x}) >= 6 AND NOT ({' OR '.join(d.has(x, p) for p in packs.LEADING)}) AND NOT {starts(d, x, packs.GUIDES)})"


def relevant(d: Spark, x: str = "text", terms: list[str] | None = None) -> str:
    """Holds a term of the topic; the core terms are taken where none are given."""
    return any_of(d, x, terms or packs.CORE_TERMS)


def _chain(*steps: tuple) -> Rule:
    def run(d: Spark, x: str = "text") -> str:
        for step in steps:
            x = d.sub(x, *step) if isinstance(step, tuple) else d.strip(x)
        return x

    return run


#: Site tails, fold marks, ellipses, dashes.
clean_tail = _chain(
    (rf"\s*[\-–—|]\s*({'|'.join(packs.SITES)})\s*$",), (r"\s*展开\s*$",), (r"\s*收起\s*$",), (r"\s*[\.]{3,}\s*$",), (r"\s*[\-–—\|]+\s*$",), "strip",
)

_EMOJI = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}]+"
_MARKS = r"·•‼\x{FE0F}"
#: Markup, emoji, list marks with what stands before them, dates, bylines, user names, stray marks, end numbers.
clean_question = _chain(
    (r"\\n", "\n"), (r"\s+", " "), (r"\*+",), ("#+",), (_EMOJI,), (rf"^[^{_MARKS}]*[{_MARKS}]\s*",), (r"[‼\x{FE0F}·•⚠✅❌]+",),
    (r"\d{4}-\d{2}-\d{2}\s*",), (r"(作者|来源|编辑|整理|记者)[：:][^、,，；;:.。！?？\s]+\s*[、,]?",), (r"^\s*\S+?\s+(?:\d+|赞)\s+",),
    (r"^\s*帐号已注销\s*",), (r"^\s*[：:、,，；;\.\s\[（\(]+",), (r"\s*[\]）\)]\s*$",), (r"\s*\d+\s*$",), "strip",
)


def unquoted(d: Spark, x: str = "text") -> str:
    """Without the first pair of quotes that encloses the text."""
    t = d.strip(x)
    rungs = [
        (f"{starts(d, t, [a])} AND {ends(d, t, [b])}", d.strip(f"substring({t}, 2, greatest(length({t}) - 2, 0))")) for a, b in packs.QUOTES
    ]
    return ladder(rungs, t)


_FAQ = (rf"^({'|'.join(packs.FAQ_HEADS)})[：:、\.\s]+",)
_NUMBER = (r"^\d{1,3}[、\.\)\s]+",)
#: After the quotes: reporting heads, labels, five rounds of FAQ heads and numbers, list marks, connectives.
clean_head_rest = _chain(
    (r"^[「『《\"'\(]+",), (r"[」』》\"'\)]+$",), (rf"^({'|'.join(packs.REPORTING)})",), ("^【[^】]*】",),
    (r"^(作者|来源|编辑|记者|笔者|整理|摘录)[：:][^。]+[。,]?\s*",), (r"^(此刻新闻|热点新闻|首页|推荐|热门|专题|正文|导读|摘要)[：:、\s]*",),
    (r"^(上一篇|下一篇|上一条|下一条|相关阅读|延伸阅读|相关推荐|推荐阅读|猜你喜欢)[：:、\s]*",), *[_FAQ, _NUMBER] * 5,
    (r"^[（(]?[一二三四五六七八九十百零]+[）)]?[、\.\s]+",), (r"^[·•●○▪▫\-\*]+\s*",),
    ("^(人民号平台下载客户端|客户端|下载.*客户端|打开.*App|扫码下载|扫码关注|关注我们)",), (r"^参考资料[：:]\s*",), (r"\[\d+\]",),
    (rf"^({'|'.join(packs.CONNECTIVES)})[，,\s]*",), (r"^[，,、；;:\s]+",), "strip",
)


def title_bare(d: Spark, x: str = "title") -> str:
    """A title without the site that follows a dash."""
    return d.strip(d.sub(d.strip(x), rf"[\-–—]\s*({'|'.join(packs.TITLE_SITES)})[^\n]*$", ""))


def _judge_rungs(d: Spark, x: str, url: str) -> list[tuple[str, str, str]]:
    """(condition, category, reason) of what rejects a question, in order."""
    t = d.strip(x)
    asks = f"({ends(d, t, ['？', '?'])} OR {any_of(d, t, packs.QUESTION_WORDS)})"
    conditions = [
        f"coalesce({url}, '') = ''", f"length({t}) < 5", f"NOT {asks}", ends(d, t, ["！", "!"]), any_of(d, t, packs.AI_HINTS), any_of(d, t, packs.RHETORICAL),
        any_of(d, t, packs.ABSTRACT), d.has(t, rf"^{CJK_NARROW}{{1,3}}[吗呢？?]$"), any_of(d, t, packs.SUBJECTIVE), any_of(d, t, packs.FUTURE),
    ]
    return [(c, *said) for c, said in zip(conditions, packs.JUDGE_REASONS)]


def judged(d: Spark, x: str = "text", url: str = "source_url") -> str:
    """The category that rejects a question (A to E), or 'pass'."""
    return ladder([(c, d.lit(k)) for c, k, _ in _judge_rungs(d, x, url)], "'pass'")


def judge_reason(d: Spark, x: str = "text", url: str = "source_url") -> str:
    """Why :func:`judged` says so."""
    return ladder([(c, d.lit(why)) for c, _, why in _judge_rungs(d, x, url)], d.lit(packs.JUDGE_PASS))


def _signal(d: Spark, x: str, word: str) -> str:
    if word == "怎么(?!样)":  # no look-ahead in RE2
        return f"contains(replace({x}, '怎么样', ''), '怎么')"
    return f"contains({x}, {d.lit(word)})"


def question_type(d: Spark, x: str = "text") -> str:
    """Dispute before method before fact; facts are the fallback."""
    return ladder([("(" + " OR ".join(_signal(d, x, w) for w in words) + ")", d.lit(t)) for t, words in packs.TYPE_SIGNALS], "'事实型'")


def type_evidence(d: Spark, x: str = "text") -> str:
    """All signals of the type found, joined by 、; empty for the fallback."""
    def hits(words):
        found = [f"CASE WHEN {_signal(d, x, w)} THEN {d.lit(w)} END" for w in words]
        return d.join(d.filter(d.array(", ".join(found)), "w", "w IS NOT NULL"), "、")

    return ladder([("(" + " OR ".join(_signal(d, x, w) for w in words) + ")", hits(words)) for _, words in packs.TYPE_SIGNALS], "''")


def harvest_outcome(d: Spark, x: str = "text", least: int = 500) -> str:
    """quota, blocked, empty, thin or ok; null text is a missing file."""
    head = f"substring({x}, 1, 400)"
    units = content_units(d, x)
    flags = "i" if d.name == "duckdb" else "iu"
    return ladder(
        [
            (f"{x} IS NULL", "'empty'"), (d.has(head, packs.QUOTA, flags), "'quota'"), (d.has(head, packs.BLOCKED, flags), "'blocked'"),
            (f"{units} = 0", "'empty'"), (f"{units} < {least}", "'thin'"),
        ],
        "'ok'",
    )


def safe_name(d: Spark, x: str = "title") -> str:
    """A file name: bad characters to one underscore, 60 characters at most."""
    cleaned = d.sub(d.sub(x, packs.BAD_FILENAME, "_"), "^_+|_+$", "")
    return f"coalesce(nullif(substring({cleaned}, 1, 60), ''), 'untitled')"


def local_source(d: Spark, x: str = "source") -> str:
    """A path in the library rather than a web source."""
    return f"({d.has(x, '^L[1-7]/')} OR {ends(d, x, ['.md', '.markdown'])})"


def nonempty(d: Spark, x: str) -> str:
    return f"(coalesce(length({d.strip(x)}), 0) > 0)"


def without_links(d: Spark, x: str = "text", site: str | None = None) -> str:
    """Markdown without empty links; links into the site become their labels."""
    title = r"(?:\s+\"[^\"]*\")?"
    out = d.sub(x, rf"\[\]\(([^)\s]+){title}\)", "")
    if site:
        at = re.escape(site.lower().removeprefix("www."))
        out = d.sub(out, rf"\[([^\]]+)\]\((?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#)\s]*{at}[^)\s]*{title}\)", "\\1", "i" if d.name == "duckdb" else "i")
    return out


def without_site_links(d: Spark, x: str = "text", host: str = "site_host") -> str:
    """:func:`without_links` where each row names its own site; null or empty: none."""
    title = r"(?:\s+\"[^\"]*\")?"
    out = d.sub(x, rf"\[\]\(([^)\s]+){title}\)", "")
    at = f"regexp_replace(lower({host}), '^www[.]', '')"
    head, tail = rf"(?i)\[([^\]]+)\]\((?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#)\s]*\Q", rf"\E[^)\s]*{title}\)"
    pattern = f"concat({d.lit(head)}, {at}, {d.lit(tail)})"
    to = "'$1'" if d.name == "spark" else "'\\1', 'g'"
    return f"CASE WHEN coalesce({host}, '') = '' THEN {out} ELSE regexp_replace({out}, {pattern}, {to}) END"


def padded_id(d: Spark, n: str, prefix: str = "P") -> str:
    """``P007``: three digits at least."""
    digits = f"CAST({n} AS {'STRING' if d.name == 'spark' else 'VARCHAR'})"
    return f"concat({d.lit(prefix)}, lpad({digits}, CAST(greatest(3, length({digits})) AS INT), '0'))"


def verdict(score: str = "score") -> str:
    return ladder([(f"{score} >= 85", "'通过'"), (f"{score} >= 70", "'通过但提示 minor 问题'")], "'不通过'")


def report_status(errors: str = "errors", warnings: str = "warnings") -> str:
    return ladder([(f"{errors} > 0", "'fail'"), (f"{warnings} > 0", "'minor'")], "'pass'")
