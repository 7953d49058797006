"""Rules over URLs (network location, canonical form, article keys, routes)."""

from __future__ import annotations

from .. import packs
from ..dialect import Spark, any_of, ends, ladder, starts

_LOCATION = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"
_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"


def netloc(d: Spark, url: str = "url") -> str:
    """Lower-cased location, port and user included; '' where there is none."""
    return f"lower(coalesce({d.extract(url, _LOCATION, 1)}, ''))"


def host(d: Spark, url: str = "url") -> str:
    """The location without a leading ``www.``."""
    return d.sub(netloc(d, url), r"^www\.", "")


def scheme(d: Spark, url: str = "url") -> str:
    return f"lower(coalesce({d.extract(url, _SCHEME, 1)}, ''))"


def path(d: Spark, url: str = "url") -> str:
    """From the location to ``;``, ``?`` or ``#``."""
    return f"coalesce({d.extract(url, r'^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#;]*)', 1)}, '')"


def query(d: Spark, url: str = "url") -> str:
    return f"coalesce({d.extract(url, r'^[^?#]*[?]([^#]*)', 1)}, '')"


def canonical(d: Spark, url: str = "url") -> str:
    """Without utm parameters, parameters, fragment and trailing slashes; location lower-cased."""
    kept = d.join(d.filter(d.split(query(d, url), "&"), "q", f"NOT {starts(d, 'q', ['utm_'])}"), "&")
    bare = d.sub(path(d, url), "/+$", "")
    loc = netloc(d, url)
    head = f"CASE WHEN {scheme(d, url)} <> '' THEN concat({scheme(d, url)}, ':') ELSE '' END"
    return (
        f"concat({head}, CASE WHEN {loc} <> '' THEN concat('//', {loc}) ELSE '' END, "
        f"CASE WHEN {bare} = '' THEN '/' ELSE {bare} END, CASE WHEN {kept} <> '' THEN concat('?', {kept}) ELSE '' END)"
    )


def valid(d: Spark, url: str = "url") -> str:
    """An http or https URL with a location."""
    return f"(coalesce({scheme(d, url)} IN ('http', 'https') AND {host(d, url)} <> '', false))"


def _under(d: Spark, x: str, domains) -> str:
    """Equal to a domain or below it."""
    return f"({x} IN ({', '.join(map(d.lit, domains))}) OR {ends(d, x, ['.' + v for v in domains])})"


def anti_crawl(d: Spark, url: str = "url") -> str:
    return _under(d, netloc(d, url), packs.ANTI_CRAWL)


def fetch_route(d: Spark, url: str = "url") -> str:
    """Sites known to block plain requests go to a browser at once."""
    return ladder([(anti_crawl(d, url), "'browser'")], "'http_then_browser'")


def aggregator(d: Spark, url: str = "url") -> str:
    return _under(d, host(d, url), packs.AGGREGATORS)


def article_key(d: Spark, url: str = "url") -> str:
    """The article behind an academic URL, the same over mirrors; null for others."""
    at, p = host(d, url), path(d, url)
    trimmed = d.sub(p, "^/+|/+$", "")
    arxiv = d.sub(d.sub(d.sub(d.sub(trimmed, "^abs/", ""), "^pdf/", ""), r"\.pdf$", ""), r"v\d+$", "")
    pmc = d.extract(p, r"PMC\d+", 0, "i")
    number = d.extract(p, r"\d+", 0)
    academic = f"{at} IN ({', '.join(map(d.lit, packs.ACADEMIC))})"
    medline = f"({at} = 'pubmed.ncbi.nlm.nih.gov' OR ({at} = 'europepmc.org' AND contains({p}, '/MED/')))"
    return ladder(
        [
            (f"NOT coalesce({academic}, false)", d.lit(None)),
            (f"{at} = 'doi.org'", f"concat('doi:', lower({trimmed}))"),
            (f"{at} = 'arxiv.org'", f"concat('arxiv:', {arxiv})"),
            (f"{pmc} <> ''", f"concat('pmc:', upper({pmc}))"),
            (f"{medline} AND {number} <> ''", f"concat('pmid:', {number})"),
        ],
        d.lit(None),
    )


def source_key(d: Spark, original: str = "original_source_id", url: str = "url") -> str:
    """What makes a source one: its stated original, its article, or its domain."""
    at = host(d, url)
    return (
        f"coalesce(CASE WHEN {original} <> '' THEN concat('original:', lower({d.strip(original)})) END, "
        f"{article_key(d, url)}, CASE WHEN {at} <> '' THEN concat('domain:', {at}) END)"
    )


def mirror(d: Spark, url: str = "url") -> str:
    """A mirror with the same article, or null."""
    at, p = netloc(d, url), path(d, url)
    number, pmc = d.extract(p, r"/(\d{6,9})/?", 1), d.extract(p, r"/(PMC\d+)/?", 1, "i")
    return ladder(
        [
            (f"{at} NOT IN ({', '.join(map(d.lit, packs.MIRRORED))})", d.lit(None)),
            (f"contains({at}, 'pubmed') AND {number} <> ''", f"concat('https://europepmc.org/article/MED/', {number})"),
            (f"contains({at}, 'pmc') AND {pmc} <> ''", f"concat('https://europepmc.org/articles/', {pmc})"),
        ],
        d.lit(None),
    )


def exact_hosts(patterns: list[str]) -> list[str]:
    """The hosts that anchored patterns name, with and without ``www.`` where it is optional:
    a list for IN is one lookup, patterns are one search each."""
    out = []
    for p in patterns:
        host = p.removeprefix("^").removesuffix("$")
        bare = host.removeprefix(r"(www\.)?")
        out += [w + bare.replace("\\.", ".") for w in (("", "www.") if bare != host else ("",))]
    return list(dict.fromkeys(out))


def tier(d: Spark, url: str = "url") -> str:
    """Primary, secondary, tertiary, or null."""
    at = netloc(d, url)
    named = lambda patterns: f"{at} IN ({', '.join(map(d.lit, exact_hosts(patterns)))})"
    return ladder(
        [
            (" OR ".join(d.has(at, p) for p in packs.TIER_PRIMARY), "'primary'"),
            (named(packs.TIER_SECONDARY), "'secondary'"),
            (named(packs.TIER_TERTIARY), "'tertiary'"),
        ],
        d.lit(None),
    )


def layer(d: Spark, url: str = "url") -> str:
    """The six-layer source map; parts of the location decide, L3 is the default."""
    at = netloc(d, url)
    extra = {
        "L1": starts(d, at, ["docs."]),
        "L2": f"({at} = 'github.com' OR {at} = 'gitee.com' OR {ends(d, at, ['.github.io'])})",
    }
    rungs = []
    for name, parts in packs.LAYERS:
        tests = ([any_of(d, at, parts)] if parts else []) + ([extra[name]] if name in extra else [])
        rungs.append((" OR ".join(tests), d.lit(name)))
    return ladder(rungs, "'L3'")


def channel(d: Spark, url: str = "url", action: str = "action", has_key: str = "true") -> str:
    """How a source is collected: block lists first, then the stated action, then hints."""
    at = netloc(d, url)
    place = f"lower(concat({at}, {path(d, url)}))"
    return ladder(
        [
            (f"{_under(d, at, packs.BROWSER_HOSTS)} OR {any_of(d, place, packs.BROWSER_PATHS)}", "'opencli'"),
            (f"{action} = {d.lit(packs.BOOK_ACTION)}", "'skip-book'"),
            (f"{action} = {d.lit(packs.DOWNLOAD_ACTION)}", f"CASE WHEN {has_key} THEN 'firecrawl-download' ELSE 'firecrawl-scrape' END"),
            (any_of(d, place, packs.COLLECTOR_PARTS), "'collector'"),
        ],
        "'firecrawl-scrape'",
    )


def _quality_rungs(d: Spark, title: str, url: str, snippet: str) -> list[tuple[str, str, str]]:
    """(condition, grade, reason), rejection first."""
    at, text = netloc(d, url), f"concat({title}, ' ', {url}, ' ', coalesce({snippet}, ''))"
    shop = f"{any_of(d, at, packs.SHOP_PARTS)} OR {any_of(d, url, packs.SHOP_PARTS)}"
    medium = any_of(d, at, packs.MEDIUM_PARTS)
    conditions = [
        any_of(d, text, packs.MLM_WORDS), shop, d.has(title, packs.PITCH), f"{d.has(title, packs.BRAND_DOT)} AND {any_of(d, title, ['原理', '分析'])}",
        d.has(title, packs.SLIM_PRODUCT), f"{any_of(d, at, packs.HIGH_PARTS)} AND NOT {medium}", f"{starts(d, at, ['docs.'])} OR contains({url}, '/docs/')",
        medium, d.has(f"lower({url})", r"[.](pdf|epub)([?]|$)"), d.has(f"concat({at}, {url})", r"(blog|post|article)"),
    ]
    return [(c, *said) for c, said in zip(conditions, packs.QUALITY_REASONS)]


def quality(d: Spark, title: str = "title", url: str = "url", snippet: str = "snippet") -> str:
    """reject, high, medium or unknown; rejection overrides all."""
    return ladder([(c, d.lit(v)) for c, v, _ in _quality_rungs(d, title, url, snippet)], "'unknown'")


def quality_reason(d: Spark, title: str = "title", url: str = "url", snippet: str = "snippet") -> str:
    """Why :func:`quality` grades as it does."""
    return ladder([(c, d.lit(why)) for c, _, why in _quality_rungs(d, title, url, snippet)], d.lit(packs.QUALITY_UNKNOWN))


def link_state(d: Spark, status: str = "status") -> str:
    """What a response code says of a link."""
    return ladder(
        [(f"{status} BETWEEN 200 AND 399", "'accessible'"), (f"{status} IN (404, 410)", "'broken'"), (f"{status} IN (401, 403, 429)", "'restricted'")],
        "'unknown'",
    )
