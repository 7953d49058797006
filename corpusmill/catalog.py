"""All registered queries of the library's own operators, with DuckDB SQL."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures as fx
from . import packs
from .dialect import DUCK, SPARK, Steps, values, values_sql
from .functions import text, url
from .operators import containment, contracts, coverage, dedupe, docqc, evidence, independence, latin, markdown, merkle, phrases, questions, workflow
from .plans import question_pipeline
from .sources import ordered_text, readers, sinks, trees
from .streaming import backfill
from .work import work_folder

QUERIES: dict = {}
SQL: dict[str, str] = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Registers a function of (spark, sf_dir), with its SQL where there is one."""
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def rules(name: str, source, keep: str, **out) -> None:
    """A query of scalar rules over a table (with columns) or an inline relation.

    A rule is a function of the dialect; rules may use earlier ones by name.
    """
    steps = Steps(*out.items())
    columns = ", ".join([keep, *[c for c in out if not c.startswith("_")]])
    if isinstance(source, str):
        table, cols = source.split(":")
        base = f"SELECT {cols} FROM {table}"
        frame = lambda spark, d: read(spark, d, table).select(*cols.split(", "))
    else:
        base = values_sql(*source)
        frame = lambda spark, d: values(spark, *source)
    QUERIES[name] = lambda spark, d: steps.on(frame(spark, d)).selectExpr(*columns.split(", "))
    SQL[name] = f"SELECT {columns} FROM ({steps.sql(base)})"


# ---- URLs and sources ----

rules(
    "url_parts", "pages:page_id, url", "page_id", location=lambda d: url.netloc(d), host=lambda d: url.host(d), canonical=lambda d: url.canonical(d),
    tier=lambda d: url.tier(d), layer=lambda d: url.layer(d), route=lambda d: url.fetch_route(d), valid=lambda d: url.valid(d),
)
rules(
    "zh_url_rules", fx.LINKS, "idx", location=lambda d: url.netloc(d), host=lambda d: url.host(d), canonical=lambda d: url.canonical(d), tier=lambda d: url.tier(d),
    layer=lambda d: url.layer(d), channel=lambda d: url.channel(d), channel_no_key=lambda d: url.channel(d, has_key="false"), quality=lambda d: url.quality(d),
    mirror=lambda d: url.mirror(d), article=lambda d: url.article_key(d), valid=lambda d: url.valid(d), crawl=lambda d: url.anti_crawl(d), turned=lambda d: url.aggregator(d),
    file_name=lambda d: text.safe_name(d),
)


@query("url_tier_counts", f"SELECT coalesce({url.tier(DUCK)}, 'none') AS tier, {url.layer(DUCK)} AS layer, count(*) AS n FROM pages GROUP BY ALL")
def url_tier_counts(spark, d):
    tier = F.coalesce(F.expr(url.tier(SPARK)), F.lit("none")).alias("tier")
    return read(spark, d, "pages").groupBy(tier, F.expr(url.layer(SPARK)).alias("layer")).agg(F.count(F.lit(1)).alias("n"))


@query("url_canonical_dedupe", f"SELECT min(page_id) AS page_id, {url.canonical(DUCK)} AS canonical, count(*) AS n FROM pages GROUP BY 2")
def url_canonical_dedupe(spark, d):
    return read(spark, d, "pages").groupBy(F.expr(url.canonical(SPARK)).alias("canonical")).agg(F.min("page_id").alias("page_id"), F.count(F.lit(1)).alias("n"))


@query("channel_routing", f"SELECT {url.channel(DUCK, action=DUCK.lit(''))} AS channel, count(*) AS n FROM pages GROUP BY 1")
def channel_routing(spark, d):
    return read(spark, d, "pages").groupBy(F.expr(url.channel(SPARK, action="''")).alias("channel")).agg(F.count(F.lit(1)).alias("n"))


rules("link_states", ("idx long, status int", [(i, c) for i, c in enumerate([200, 301, 404, 410, 401, 403, 429, 500, None])]), "idx", state=lambda d: url.link_state(d))

# ---- text ----

def bare_pages_sql() -> str:
    """CTEs down to ``bare``: pages as stripped text with every character reference replaced, by
    joins: each reference takes the longest name of the table that it begins with."""
    names = ", ".join(f"({DUCK.lit(name)}, {DUCK.lit(char)})" for name, char in sorted(html5.items()))
    ref = "'&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\\t\\n\\f <&#;]{1,32};?)'"
    return f"""names(name, chars) AS (VALUES {names}),
stripped AS (SELECT page_id, url, {text.strip_html(DUCK)} AS s FROM pages),
cut AS (SELECT page_id, string_split_regex(s, {ref}) AS parts, regexp_extract_all(s, {ref}) AS refs FROM stripped),
refs AS (SELECT page_id, unnest(refs) AS ref, generate_subscripts(refs, 1) AS i FROM cut),
named AS (SELECT ref, arg_max(chars, length(name)) || substring(ref, max(length(name)) + 2) AS v FROM (SELECT DISTINCT ref FROM refs) r JOIN names ON starts_with(substring(ref, 2), name) GROUP BY ref),
numbered AS (SELECT ref, CASE WHEN regexp_matches(ref, '^&#[xX]') THEN ('0x' || regexp_extract(ref, '[0-9a-fA-F]+', 0))::BIGINT ELSE regexp_extract(ref, '[0-9]+', 0)::BIGINT END AS c FROM (SELECT DISTINCT ref FROM refs WHERE ref LIKE '&#%')),
known AS (SELECT ref, v FROM named UNION ALL SELECT ref, CASE WHEN c = 0 OR c > 1114111 OR c BETWEEN 55296 AND 57343 THEN chr(65533) ELSE chr(c::INT) END FROM numbered),
joined AS (SELECT page_id, string_agg(coalesce(v, ref) || parts[i + 1], '' ORDER BY i) AS tail FROM refs LEFT JOIN known USING (ref) JOIN cut USING (page_id) GROUP BY page_id),
bare AS (SELECT page_id, url, CASE WHEN len(refs) = 0 THEN s ELSE parts[1] || tail END AS bare FROM stripped JOIN cut USING (page_id) LEFT JOIN joined USING (page_id))"""


def bare_pages(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "pages").select("page_id", "url", questions.stripped("html").alias("bare"))


_BARE = Steps(*dict(n_bare=lambda d: "length(bare)", units=lambda d: text.content_units(d, "bare"), valid=lambda d: text.valid_content(d, "bare"), outcome=lambda d: text.harvest_outcome(d, "bare")).items())


@query("html_strip_units", f"WITH {bare_pages_sql()} SELECT page_id, bare, n_bare, units, valid, outcome FROM ({_BARE.sql('SELECT page_id, bare FROM bare')})")
def html_strip_units(spark, d):
    """Pages without markup, with all character references replaced, and what their texts are worth."""
    return _BARE.on(bare_pages(spark, d)).select("page_id", "bare", "n_bare", "units", "valid", "outcome")


rules("content_validity", "documents:doc_id, text", "doc_id", units=lambda d: text.content_units(d), chinese=lambda d: text.chinese_chars(d), valid=lambda d: text.valid_content(d), outcome=lambda d: text.harvest_outcome(d))
rules("zh_harvest_outcome", fx.HARVEST, "idx", units=lambda d: text.content_units(d), outcome=lambda d: text.harvest_outcome(d))
rules(
    "zh_text_rules", fx.QUESTIONS, "idx", stripped=lambda d: d.strip("text"), normal=lambda d: text.normalised(d), key=lambda d: text.dedupe_key(d), judged=lambda d: text.judged(d),
    type=lambda d: text.question_type(d), evidence=lambda d: text.type_evidence(d), asks=lambda d: text.question_like(d), not_question=lambda d: text.not_question(d),
    real=lambda d: text.real_question(d), relevant=lambda d: text.relevant(d), n_set=lambda d: d.size(text.char_set(d)), n_bigrams=lambda d: d.size(text.shingles(d)), id=lambda d: text.padded_id(d, "idx"),
)
rules("zh_clean_question", fx.RAW, "idx", cleaned=lambda d: text.clean_question(d), tail=lambda d: text.clean_tail(d, "cleaned"), unquoted=lambda d: text.unquoted(d, "tail"), head=lambda d: text.clean_head_rest(d, "unquoted"))

_TITLE = dict(
    _a=lambda d: text.title_bare(d), _b=lambda d: text.clean_tail(d, "_a"), _c=lambda d: text.unquoted(d, "_b"), _d=lambda d: text.clean_head_rest(d, "_c"), _q=lambda d: text.normalised(d, "_d"),
    question=lambda d: f"CASE WHEN NOT {text.not_question(d, '_d')} AND {d.has('_d', '(？|[?]|吗|呢)$')} AND {text.question_like(d, '_d')} AND {text.relevant(d, '_q')} AND {text.real_question(d, '_q')} THEN _q END",
)
SQL["zh_extract_title"] = f"SELECT idx, question FROM ({Steps(*_TITLE.items()).sql(values_sql(*fx.TITLES))})"
QUERIES["zh_extract_title"] = lambda spark, d: questions.with_title_question(values(spark, *fx.TITLES)).select("idx", "question")

rules("markdown_links", ("idx long, text string", [(0, "[](https://a.com/x \"t\")正文"), (1, "见[文档](https://www.a.com/d)与[外部](https://b.org/p \"标题\")"), (2, "无链接")]), "idx", kept=lambda d: text.without_links(d, site="a.com"), only_empty=lambda d: text.without_links(d))

rules("site_links", fx.HOSTED, "idx", kept=lambda d: text.without_site_links(d))
rules("zh_quality_reasons", fx.LINKS, "idx", quality=lambda d: url.quality(d), reason=lambda d: url.quality_reason(d))
rules("zh_judge_reasons", fx.QUESTIONS, "idx", category=lambda d: text.judged(d), reason=lambda d: text.judge_reason(d))


@query("unknown_sources", f"SELECT page_id, url FROM (SELECT page_id, url, {url.quality(DUCK, title=DUCK.lit(''), snippet=DUCK.lit(''))} AS value FROM pages) WHERE value = 'unknown'")
def unknown_sources(spark, d):
    value = F.expr(url.quality(SPARK, title=SPARK.lit(""), snippet=SPARK.lit("")))
    return read(spark, d, "pages").select("page_id", "url").withColumn("value", value).where("value = 'unknown'").select("page_id", "url")


@query("harvest_plan", f"""SELECT url, {url.layer(DUCK)} AS layer, CASE WHEN coalesce(redundant_with, '') <> '' THEN 'skip' ELSE {url.channel(DUCK)} END AS channel,
 CASE WHEN redundant_with <> '' THEN '与已采 ' || redundant_with || ' 同内容' END AS skipped FROM ({values_sql(*fx.PLAN)})""")
def harvest_plan(spark, d):
    return readers.harvest_plan(values(spark, *fx.PLAN))


@query("heading_extract", "SELECT page_id, len(regexp_extract_all(html, '<h[1-3][^>]*>([^<]*)</h[1-3]>')) AS n_headings, coalesce(array_to_string(regexp_extract_all(html, '<h[1-3][^>]*>([^<]*)</h[1-3]>', 1), ' | '), '') AS headings FROM pages")
def heading_extract(spark, d):
    found = F.regexp_extract_all("html", F.lit("<h[1-3][^>]*>([^<]*)</h[1-3]>"), F.lit(1))
    return read(spark, d, "pages").select("page_id", F.size(found).cast("long").alias("n_headings"), F.array_join(found, " | ").alias("headings"))


@query("content_hash", "SELECT doc_id, sha256(text) AS sha256 FROM documents")
def content_hash(spark, d):
    return read(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))


# ---- acceptance, gates ----

@query("material_acceptance", f"WITH t AS (SELECT source, sum({text.content_units(DUCK)})::BIGINT AS total, count(*) AS n FROM documents GROUP BY source) SELECT source, total, n, total >= 24000 AS material_ok, greatest(0, 24000 - total)::BIGINT AS needed, n < 2 AS gap FROM t")
def material_acceptance(spark, d):
    t = read(spark, d, "documents").groupBy("source").agg(F.sum(F.expr(text.content_units(SPARK))).alias("total"), F.count(F.lit(1)).alias("n"))
    return t.select("source", "total", "n", (F.col("total") >= 24000).alias("material_ok"), F.greatest(F.lit(0), 24000 - F.col("total")).cast("long").alias("needed"), (F.col("n") < 2).alias("gap"))


_GATE = """SELECT {key}, CASE WHEN max(CASE WHEN type = 'primary' THEN 1 ELSE 0 END) = 1 OR sum(CASE WHEN type = 'secondary' THEN frequency ELSE 0 END) >= 2
 OR sum(CASE WHEN type = 'tertiary' THEN frequency ELSE 0 END) >= 3 THEN 'confirmed' ELSE 'single_source' END AS status,
 sum(frequency)::BIGINT AS total_frequency, count(DISTINCT url) AS source_count FROM s GROUP BY {key}"""


@query("source_frequency_gate", f"WITH p AS (SELECT {url.host(DUCK)} AS host, url, coalesce({url.tier(DUCK)}, 'tertiary') AS type FROM pages), s AS (SELECT host, url, type, count(*) AS frequency FROM p GROUP BY ALL) " + _GATE.format(key="host"))
def source_frequency_gate(spark, d):
    s = read(spark, d, "pages").groupBy(F.expr(url.host(SPARK)).alias("host"), "url", F.coalesce(F.expr(url.tier(SPARK)), F.lit("tertiary")).alias("type")).agg(F.count(F.lit(1)).alias("frequency"))
    return questions.frequency_gate(s, "host")


# ---- duplicates ----

_WORDS = "list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')"
_LATIN = f"""i AS (SELECT doc_id AS idx, length(text) AS len, {_WORDS} AS w FROM documents),
t AS (SELECT idx, len, CASE WHEN len(w) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i+4], ' ')))) END AS tokens FROM i),
e AS (SELECT tokens, min(idx) AS set_id, min(len) AS min_len, max(len) AS max_len, len(tokens) AS n FROM t GROUP BY tokens),
x AS (SELECT set_id, n, unnest(tokens) AS token FROM e),
c AS (SELECT p.set_id AS a, q.set_id AS b, count(*) AS common FROM x p JOIN x q ON p.token = q.token AND p.set_id < q.set_id GROUP BY ALL),
s AS (SELECT a, b, common / (p.n + q.n - common) AS jaccard, (common = p.n AND p.min_len < q.max_len) OR (common = q.n AND q.min_len < p.max_len) AS is_subset
 FROM c JOIN e p ON p.set_id = a JOIN e q ON q.set_id = b),
good AS (SELECT * FROM s WHERE jaccard >= 0.85 OR is_subset)"""
_COMPONENTS = """, both_ways AS (SELECT a, b FROM good UNION SELECT b, a FROM good),
r(node, seen) AS (SELECT set_id, set_id FROM e UNION SELECT b.b, r.seen FROM r JOIN both_ways b ON b.a = r.node),
l AS (SELECT node, min(seen) AS component FROM r GROUP BY node),
k AS (SELECT t.idx, t.len, l.component FROM t JOIN e ON e.tokens = t.tokens JOIN l ON l.node = e.set_id)"""


def latin_items(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.prepared(read(spark, d, "documents").select(F.col("doc_id").alias("idx"), F.length("text").alias("len"), dedupe.word_ngrams("text").alias("tokens")))


def zh_items(spark: SparkSession) -> DataFrame:
    keyed = dedupe.exact(values(spark, *fx.DEDUPE).withColumn("key", F.expr(text.dedupe_key(SPARK))), F.col("key"), "idx")
    return dedupe.prepared(keyed.select("idx", F.length("key").alias("len"), dedupe.chinese_set("key").alias("tokens"), "text", "url"))


@query("exact_dedupe", f"SELECT min(doc_id) AS doc_id, count(*) AS n FROM documents WHERE {text.dedupe_key(DUCK)} <> '' GROUP BY {text.dedupe_key(DUCK)}")
def exact_dedupe(spark, d):
    key = F.expr(text.dedupe_key(SPARK))
    return read(spark, d, "documents").withColumn("key", key).where("key <> ''").groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n")).drop("key")


@query("jaccard_pairs", f"WITH {_LATIN} SELECT a, b, jaccard FROM good WHERE jaccard >= 0.85")
def jaccard_pairs(spark, d):
    return dedupe.similar_pairs(dedupe.entries(latin_items(spark, d)), subset=False).select("a", "b", "jaccard")


@query("subset_pairs", f"WITH {_LATIN} SELECT a, b FROM good WHERE is_subset")
def subset_pairs(spark, d):
    return dedupe.similar_pairs(dedupe.entries(latin_items(spark, d))).where("is_subset").select("a", "b")


@query("dup_components", f"WITH RECURSIVE {_LATIN}{_COMPONENTS} SELECT idx AS doc_id, component FROM k")
def dup_components(spark, d):
    return dedupe.components(latin_items(spark, d)).withColumnRenamed("idx", "doc_id")


@query("dup_representatives", f"WITH RECURSIVE {_LATIN}{_COMPONENTS} SELECT component, arg_min(idx, (-len) * 1000000000000 + idx) AS kept, count(*) AS members FROM k GROUP BY component")
def dup_representatives(spark, d):
    items = latin_items(spark, d)
    return dedupe.representatives(items, dedupe.components(items))


@query("merge_sources", f"WITH RECURSIVE {_LATIN}{_COMPONENTS} SELECT component, source AS url, count(*) AS frequency FROM k JOIN documents ON doc_id = idx GROUP BY ALL")
def merge_sources(spark, d):
    sources = read(spark, d, "documents").select(F.col("doc_id").alias("idx"), F.col("source").alias("url"), F.lit(1).cast("long").alias("frequency"))
    return dedupe.merge_sources(sources, dedupe.components(latin_items(spark, d)))


_ZH = f"""f AS ({values_sql(*fx.DEDUPE)}), key AS (SELECT *, {text.dedupe_key(DUCK)} AS key FROM f),
i AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY idx) AS n FROM key WHERE key <> '') WHERE n = 1),
t AS (SELECT idx, length(key) AS len, {text.char_set(DUCK, 'key')} AS s FROM i),
good AS (SELECT p.idx AS a, q.idx AS b FROM t p JOIN t q ON p.idx < q.idx WHERE
 CASE WHEN len(p.s) = 0 AND len(q.s) = 0 THEN 1.0 ELSE len(list_intersect(p.s, q.s)) / len(list_distinct(p.s || q.s)) END >= 0.85
 OR (len(p.s) > 0 AND len(list_intersect(p.s, q.s)) = len(p.s) AND p.len < q.len) OR (len(q.s) > 0 AND len(list_intersect(p.s, q.s)) = len(q.s) AND q.len < p.len)),
both_ways AS (SELECT a, b FROM good UNION SELECT b, a FROM good),
r(node, seen) AS (SELECT idx, idx FROM t UNION SELECT b.b, r.seen FROM r JOIN both_ways b ON b.a = r.node),
k AS (SELECT t.idx, t.len, min(seen) AS component FROM r JOIN t ON t.idx = r.node GROUP BY ALL)"""


@query("zh_dedupe", f"WITH RECURSIVE {_ZH} SELECT component, arg_min(idx, (-len) * 1000000 + idx) AS kept, count(*) AS members FROM k GROUP BY component")
def zh_dedupe(spark, d):
    items = zh_items(spark)
    return dedupe.representatives(items, dedupe.components(items))


@query("zh_merged_texts", f"""WITH RECURSIVE {_ZH}, o AS (SELECT k.component, f.text, k.idx, k.len FROM k JOIN f USING (idx)),
p AS (SELECT component, text, row_number() OVER w - 1 AS pos, first_value(text) OVER w AS kept FROM o WINDOW w AS (PARTITION BY component ORDER BY len DESC, idx)) SELECT component, kept, pos, text AS merged FROM p WHERE pos > 0""")
def zh_merged_texts(spark, d):
    items = zh_items(spark)
    return dedupe.merged_texts(items, dedupe.components(items), items)


@query("benchmark_overlap", "SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)")
def benchmark_overlap(spark, d):
    return phrases.holding(read(spark, d, "documents"), read(spark, d, "benchmark"), "doc_id", "item_id")


@query("phrase_hits", """SELECT d.doc_id, b.item_id, unnest(list_filter(range(0, length(d.text) - length(b.text) + 1), lambda i: substr(d.text, i + 1, length(b.text)) = b.text)) AS start
FROM documents d JOIN benchmark b ON contains(d.text, b.text)""")
def phrase_hits(spark, d):
    """Where each benchmark passage stands in each document."""
    return phrases.find(read(spark, d, "documents"), read(spark, d, "benchmark"), "doc_id", "item_id")


_SENTENCES = r"""s AS (SELECT item_id, generate_subscripts(p, 1) - 1 AS ord, trim(unnest(p)) AS phrase FROM (SELECT item_id, regexp_split_to_array(text, '[.!?\n]+') AS p FROM benchmark)),
q AS (SELECT item_id, phrase, min(ord) AS ord FROM s WHERE length(phrase) >= 5 GROUP BY ALL)"""


def benchmark_sentences(spark, d) -> DataFrame:
    """``item_id, ord, phrase``: the sentences of each item, repeated ones once."""
    parts = read(spark, d, "benchmark").select("item_id", F.posexplode(F.split("text", r"[.!?\n]+")).alias("ord", "phrase")).withColumn("phrase", F.trim("phrase"))
    return parts.where(F.length("phrase") >= 5).groupBy("item_id", "phrase").agg(F.min("ord").alias("ord"))


def _turns(spark, d) -> DataFrame:
    return read(spark, d, "conversations").withColumn("at", F.struct("conv_id", "turn"))


@query("conversation_phrases", f"""WITH {_SENTENCES}, h AS (SELECT conv_id, turn, phrase, text FROM conversations JOIN (SELECT DISTINCT phrase FROM q) ON contains(text, phrase))
SELECT conv_id, turn, phrase, unnest(list_filter(range(0, length(text) - length(phrase) + 1), lambda i: substr(text, i + 1, length(phrase)) = phrase)) AS start FROM h""")
def conversation_phrases(spark, d):
    """Sentences of the benchmark that conversations repeat, with their places."""
    told = benchmark_sentences(spark, d).select(F.col("phrase").alias("name"), "phrase").distinct()
    return phrases.find(_turns(spark, d), told, "at", "name", phrase="phrase").select("at.conv_id", "at.turn", F.col("name").alias("phrase"), "start")


@query("phrase_gaps", f"""WITH {_SENTENCES}, n AS (SELECT phrase, sum((length(text) - length(replace(text, phrase, ''))) // length(phrase)) AS n FROM documents JOIN (SELECT DISTINCT phrase FROM q) ON contains(text, phrase) GROUP BY phrase)
SELECT item_id, count(*) AS n_phrases, count(n.n) AS n_covered, coalesce(sum(n.n), 0)::BIGINT AS n_hits, coalesce(string_agg(q.phrase, '、' ORDER BY q.ord) FILTER (n.n IS NULL), '无') AS gap FROM q LEFT JOIN n USING (phrase) GROUP BY item_id""")
def phrase_gaps(spark, d):
    """How far documents cover the sentences of each benchmark item, and which are missing."""
    told = benchmark_sentences(spark, d)
    hits = phrases.find(read(spark, d, "documents"), told.select("phrase", F.col("phrase").alias("text")).distinct(), "doc_id", "phrase")
    return phrases.gaps(told, hits, "item_id", "phrase")


_WORD_SET = "list_distinct(list_filter(regexp_split_to_array(lower(t), '[^\\p{L}\\p{N}]+'), lambda w: w <> ''))"


@query("sentences_within", rf"""WITH a AS (SELECT DISTINCT trim(unnest(regexp_split_to_array(text, '[.!?\n]+'))) AS t FROM conversations),
r AS (SELECT t AS id, length(t) AS len, {_WORD_SET} AS w FROM a), s AS (SELECT doc_id AS id, length(t) AS len, {_WORD_SET} AS w FROM (SELECT doc_id, text AS t FROM documents)),
p AS (SELECT list_sort(w) AS w, min(id) AS id, min(len) AS len FROM r WHERE len(w) >= 2 GROUP BY 1), q AS (SELECT list_sort(w) AS w, min(id) AS id, max(len) AS len FROM s GROUP BY 1),
x AS (SELECT id, len, len(w) AS n, unnest(w) AS token FROM p), y AS (SELECT id, len, unnest(w) AS token FROM q)
SELECT x.id AS sentence, y.id AS doc_id FROM x JOIN y USING (token) WHERE x.len < y.len GROUP BY x.id, y.id, x.n HAVING count(*) = x.n""")
def sentences_within(spark, d):
    """Sentences of conversations whose words all stand in a document, by distinct word sets."""
    told = read(spark, d, "conversations").select(F.explode(F.split("text", r"[.!?\n]+")).alias("s")).select(F.trim("s").alias("s")).distinct()
    small = told.select(F.col("s").alias("id"), F.length("s").alias("len"), containment.hashed(containment.words(F.col("s"))).alias("tokens")).where(F.size("tokens") >= 2)
    large = read(spark, d, "documents").select(F.col("doc_id").alias("id"), F.length("text").alias("len"), containment.hashed(containment.words(F.col("text"))).alias("tokens"))
    found = containment.contained(containment.distinct_sets(small, "id", "tokens", "len"), containment.distinct_sets(large, "id", "tokens", "len"))
    return found.select(F.col("part").alias("sentence"), F.col("whole").alias("doc_id"))


# ---- coverage, generation, saturation ----

_CELLS = f"cells AS ({values_sql('cell int, perspective string, sub_dimension string', [(i, p, s) for i, (p, s) in enumerate(packs.CELLS)])})"
_EVENT_CELLS = f"p AS (SELECT c.perspective, c.sub_dimension FROM events e JOIN cells c ON c.cell = (e.user_id + hour(e.ts)) % 17)"


def event_problems(spark, d):
    """Events dealt to cells: an analogue of problems at scale (cell 16 is in no grid)."""
    e = read(spark, d, "events").select(((F.col("user_id") + F.hour("ts")) % 17).cast("int").alias("cell"))
    return e.join(F.broadcast(questions.cells(spark)), "cell").select("perspective", "sub_dimension")


@query("coverage_matrix", f"WITH {_CELLS}, {_EVENT_CELLS}, n AS (SELECT perspective, sub_dimension, count(*) AS n FROM p GROUP BY ALL) SELECT c.perspective, c.sub_dimension, coalesce(n.n, 0) AS n FROM cells c LEFT JOIN n USING (perspective, sub_dimension)")
def coverage_matrix(spark, d):
    return questions.coverage(event_problems(spark, d)).select("perspective", "sub_dimension", "n")


_LEVEL_KEYS = ["perspective", "sub_dimension", "event_type", "week"]


@query("coverage_levels", f"""WITH {_CELLS}, e AS (SELECT c.perspective, c.sub_dimension, e.event_type, (date_diff('day', DATE '2024-01-01', e.ts::DATE) // 7)::INTEGER AS week FROM events e JOIN cells c ON c.cell = (e.user_id + hour(e.ts)) % 17 WHERE e.user_id % 3 = 0),
dom AS (SELECT perspective, sub_dimension, event_type, week FROM cells CROSS JOIN (SELECT DISTINCT event_type FROM events) CROSS JOIN (SELECT DISTINCT (date_diff('day', DATE '2024-01-01', ts::DATE) // 7)::INTEGER AS week FROM events)),
w AS (SELECT dom.*, (SELECT count(*) FROM e WHERE e.perspective = dom.perspective AND e.sub_dimension = dom.sub_dimension AND e.event_type = dom.event_type AND e.week = dom.week) AS n FROM dom)
SELECT perspective, sub_dimension, event_type, week, grouping_id(perspective, sub_dimension, event_type, week)::BIGINT AS level, sum(n)::BIGINT AS n, count(*) AS n_leaves, count(*) FILTER (n = 0) AS n_missing
FROM w GROUP BY GROUPING SETS ({', '.join('(' + ', '.join(x) + ')' for x in coverage.grouping_sets(_LEVEL_KEYS[:2], _LEVEL_KEYS[2:]))})""")
def coverage_levels(spark, d):
    """Coverage of the cells by events at every level: cell, perspective, all, by type and week or over them."""
    week = F.floor(F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) / 7).cast("int")
    e = read(spark, d, "events").withColumn("week", week)
    cells = questions.cells(spark)
    rows = e.where("user_id % 3 = 0").withColumn("cell", ((F.col("user_id") + F.hour("ts")) % 17).cast("int")).join(F.broadcast(cells), "cell")
    domain = coverage.full_domain([cells.select("perspective", "sub_dimension"), e.select("event_type").distinct(), e.select("week").distinct()])
    return coverage.levels(rows, domain, _LEVEL_KEYS[:2], _LEVEL_KEYS[2:])


@query("distinct_rounds", """WITH e AS (SELECT event_type, ts::DATE AS day, user_id FROM events), f AS (SELECT event_type, user_id, min(day) AS day FROM e GROUP BY ALL),
r AS (SELECT event_type, day, count(DISTINCT user_id) AS n_distinct FROM e GROUP BY ALL), n AS (SELECT event_type, day, count(*) AS n FROM f GROUP BY ALL)
SELECT event_type, day, n_distinct, coalesce(n, 0)::BIGINT AS new_distinct, sum(coalesce(n, 0)) OVER (PARTITION BY event_type ORDER BY day)::BIGINT AS total_distinct, true AS near FROM r LEFT JOIN n USING (event_type, day)""")
def distinct_rounds(spark, d):
    """Users of each event type by day and up to each day: exact from bitmaps; ``near``: the sketches' estimate is within 5 %.

    Days are stored one half after the other and merged, as rounds that arrive over time are.
    """
    e = read(spark, d, "events").select("event_type", F.to_date("ts").alias("day"), "user_id")
    halves = [e.where("user_id % 2 = 0"), e.where("user_id % 2 = 1")]
    bits = coverage.merged_bitmaps(*[coverage.round_bitmaps(h, "event_type", "day", "user_id") for h in halves], "event_type", "day")
    drawn = coverage.merged_sketches(*[coverage.round_sketches(h, "event_type", "day", "user_id") for h in halves], "event_type", "day")
    exact, rough = coverage.distinct_over_rounds(bits, "event_type", "day"), coverage.estimated_over_rounds(drawn, "event_type", "day")
    return exact.join(rough, ["event_type", "day"]).withColumn("near", F.abs(F.col("estimate") - F.col("total_distinct")) <= 0.05 * F.col("total_distinct")).drop("estimate")


_FEW = ("perspective string, sub_dimension string", [("基础", "What"), ("旅程", "瓶颈期"), ("旅程", "瓶颈期"), ("其他", "x")])


@query("missing_cells", f"WITH {_CELLS}, p AS ({values_sql(*_FEW)}) SELECT perspective, sub_dimension FROM cells WHERE (perspective, sub_dimension) NOT IN (SELECT (perspective, sub_dimension) FROM p) AND (perspective, sub_dimension) NOT IN (('基础', 'How much'), ('争议时效', '争议'))")
def missing_cells(spark, d):
    return questions.missing(questions.coverage(values(spark, *_FEW)), abstract=True).select("perspective", "sub_dimension")


_CELL_NAMES = f"WITH {_CELLS}, p AS ({values_sql(*_FEW)}), m AS (SELECT cell, perspective || '/' || sub_dimension AS name FROM cells WHERE (perspective, sub_dimension) NOT IN (SELECT (perspective, sub_dimension) FROM p))"


@query("coverage_summary", f"{_CELL_NAMES} SELECT count(*) = 0 AS fully_covered, count(*) AS n_missing, string_agg(name, '、' ORDER BY cell) AS missing, '基础/How much、争议时效/争议' AS exempt FROM m WHERE name NOT IN ('基础/How much', '争议时效/争议')")
def coverage_summary(spark, d):
    return questions.coverage_summary(questions.coverage(values(spark, *_FEW)), abstract=True)


@query("coverage_summary_events", f"WITH {_CELLS}, {_EVENT_CELLS}, m AS (SELECT cell, perspective || '/' || sub_dimension AS name FROM cells ANTI JOIN p USING (perspective, sub_dimension)) SELECT count(*) = 0 AS fully_covered, count(*) AS n_missing, coalesce(string_agg(name, '、' ORDER BY cell), '') AS missing, '' AS exempt FROM m")
def coverage_summary_events(spark, d):
    return questions.coverage_summary(questions.coverage(event_problems(spark, d)))


@query("source_gap", f"""WITH s AS (SELECT coalesce(note, '') || coalesce(title, '') AS t FROM ({values_sql(*fx.NOTES)})), q AS ({values_sql('i int, q string', list(enumerate(fx.TOP)))}),
n AS (SELECT i, q, count(t) AS n FROM q LEFT JOIN s ON contains(t, q) GROUP BY ALL) SELECT string_agg(n, '、' ORDER BY i) AS counts, coalesce(string_agg(q, '、' ORDER BY i) FILTER (n = 0), '无') AS gap FROM n""")
def source_gap(spark, d):
    return questions.source_gap(values(spark, *fx.NOTES), fx.TOP)


@query("topic_relevance", f"""WITH t AS ({values_sql(*fx.TERMS)}), k AS (SELECT topic, list(term) AS terms FROM t WHERE topic IS NOT NULL AND term <> '' GROUP BY topic)
SELECT idx, coalesce(len(list_filter(coalesce(terms, {DUCK.words(packs.CORE_TERMS)}), lambda w: contains(text, w))) > 0, false) AND text IS NOT NULL AS relevant FROM ({values_sql(*fx.ASKED)}) a LEFT JOIN k ON k.topic = a.topic""")
def topic_relevance(spark, d):
    return questions.topic_relevant(values(spark, *fx.ASKED), values(spark, *fx.TERMS)).select("idx", "relevant")


def _queries_sql(templates, people, per_cell, gaps_sql) -> str:
    shapes = values_sql("perspective string, sub_dimension string, t int, template string", [(*k, i, t) for k, ts in templates.items() for i, t in enumerate(ts)])
    words = values_sql("w int, term string", [(0, "减脂"), (1, "燃脂"), (2, "刷脂"), (3, "瘦身")])
    who = values_sql("p int, person string", list(enumerate(people)))
    top = f"WHERE n <= {per_cell}" if per_cell else ""
    return f"""WITH {_CELLS}, g AS ({gaps_sql}), s AS ({shapes}), w AS ({words}), h AS ({who}),
m AS (SELECT cell, perspective, sub_dimension, replace(replace(template, '{packs.PERSON}', coalesce(person, '')), '{packs.TERM}', term) AS query, min((coalesce(p, 0) * 1000 + w) * 1000 + t) AS o
 FROM g JOIN s USING (perspective, sub_dimension) JOIN w ON true LEFT JOIN h ON sub_dimension = '人群差异' WHERE sub_dimension <> '人群差异' OR w < 3 GROUP BY ALL)
SELECT perspective, sub_dimension, n::INTEGER AS n, query FROM (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY o) AS n FROM m) {top}"""


_MISSING = "SELECT cell, perspective, sub_dimension FROM cells WHERE cell NOT IN (0, 10)"


@query("recommended_queries", _queries_sql(packs.NEXT_ROUND, packs.NEXT_PEOPLE, 2, _MISSING))
def recommended_queries(spark, d):
    return questions.queries(questions.missing(questions.coverage(values(spark, *_FEW))), "减脂", ["燃脂", "刷脂", "瘦身"], per_cell=2)


@query("search_terms", _queries_sql(packs.FIRST_ROUND, packs.FIRST_PEOPLE, None, "SELECT * FROM cells"))
def search_terms(spark, d):
    return questions.queries(questions.cells(spark), "减脂", ["燃脂", "刷脂", "瘦身"], packs.FIRST_ROUND, packs.FIRST_PEOPLE, None)


_SATURATED = """, marked AS (SELECT *, (rate < 0.5)::INT AS low FROM rated), runs AS (SELECT *, sum(1 - low) OVER (PARTITION BY topic ORDER BY round) AS run FROM marked)
SELECT topic, round, rate, sum(low) OVER (PARTITION BY topic, run ORDER BY round)::BIGINT AS streak, sum(low) OVER (PARTITION BY topic, run ORDER BY round) >= 3 AS saturated FROM runs"""
_RATE = "CASE WHEN prev_total = 0 THEN CASE WHEN new_count > 0 THEN 1.0 ELSE 0.0 END ELSE new_count / prev_total END::DOUBLE AS rate"


@query("saturation_zh", f"WITH r AS ({values_sql(*fx.ROUNDS)}), rated AS (SELECT topic, round, {_RATE} FROM r){_SATURATED}")
def saturation_zh(spark, d):
    return evidence.saturation(values(spark, *fx.ROUNDS))


@query("saturation_rounds", f"""WITH f AS (SELECT event_type AS topic, user_id, min(date_diff('day', DATE '1970-01-01', ts::DATE)) AS round FROM events GROUP BY ALL),
r AS (SELECT topic, round, count(*) AS new_count FROM f GROUP BY ALL), c AS (SELECT *, coalesce(sum(new_count) OVER (PARTITION BY topic ORDER BY round ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev_total FROM r),
rated AS (SELECT topic, round, {_RATE} FROM c){_SATURATED}""")
def saturation_rounds(spark, d):
    from pyspark.sql import Window

    day = F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")).cast("long")
    first = read(spark, d, "events").groupBy(F.col("event_type").alias("topic"), "user_id").agg(F.min(day).alias("round"))
    rounds = first.groupBy("topic", "round").agg(F.count(F.lit(1)).alias("new_count"))
    before = Window.partitionBy("topic").orderBy("round").rowsBetween(Window.unboundedPreceding, -1)
    return evidence.saturation(rounds.withColumn("prev_total", F.coalesce(F.sum("new_count").over(before), F.lit(0))))


# finds of the events table: a topic's items (whole values) with the cell of their first find
_FINDS = """f AS (SELECT (user_id % 40)::BIGINT AS topic, floor(value)::BIGINT AS item, ((user_id + hour(ts) // 2) % 17)::INTEGER AS cell, ts, ts::DATE - DATE '1970-01-01' AS round FROM events)"""


def event_finds(spark, d) -> DataFrame:
    cell = ((F.col("user_id") + F.floor(F.hour("ts") / 2)) % 17).cast("int")
    return read(spark, d, "events").select((F.col("user_id") % 40).cast("long").alias("topic"), F.floor("value").cast("long").alias("item"), cell.alias("cell"), F.col("ts").cast("timestamp").alias("ts"))


@query("backfill_rounds", f"""WITH RECURSIVE {_FINDS}, r AS (SELECT topic, round, row_number() OVER (PARTITION BY topic ORDER BY round) AS k FROM (SELECT DISTINCT topic, round FROM f WHERE round < (SELECT max(round) FROM f))),
a AS (SELECT topic, item, min(struct_pack(t := ts, c := cell)) AS first FROM f GROUP BY ALL), n AS (SELECT topic, (first.t::DATE - DATE '1970-01-01') AS round, first.c AS cell, count(*) AS n FROM a GROUP BY ALL),
i AS (SELECT r.*, coalesce(list(n.cell) FILTER (n.n > 0), []) AS hit, coalesce(sum(n.n), 0)::BIGINT AS new_count FROM r LEFT JOIN n USING (topic, round) GROUP BY ALL),
w AS (SELECT topic, 0::BIGINT AS k, 0::BIGINT AS round, false AS backfill, 0::BIGINT AS new_count, 0::BIGINT AS prev_total, 0::BIGINT AS total, 0 AS streak, range(0, 16) AS missing, [0 FOR x IN range(0, 16)] AS empty FROM (SELECT DISTINCT topic FROM r)
 UNION ALL SELECT topic, k, round, backfill, new_count, prev_total, prev_total + new_count, streak, list_filter(still, lambda c: empty[c + 1] < 2), empty FROM (
  SELECT w.topic, i.k, i.round, w.k > 0 AND len(w.missing) > 0 AS backfill, i.new_count, w.total AS prev_total,
   CASE WHEN w.k > 0 AND len(w.missing) > 0 THEN w.streak WHEN CASE WHEN w.total = 0 THEN i.new_count = 0 ELSE i.new_count < 0.5 * w.total END THEN w.streak + 1 ELSE 0 END AS streak,
   list_filter(w.missing, lambda c: NOT list_contains(i.hit, c)) AS still,
   list_transform(range(0, 16), lambda c: CASE WHEN w.k = 0 OR NOT list_contains(w.missing, c) THEN w.empty[c + 1] WHEN list_contains(i.hit, c) THEN 0 ELSE w.empty[c + 1] + 1 END) AS empty
  FROM w JOIN i ON i.topic = w.topic AND i.k = w.k + 1)),
h AS (SELECT topic, unnest(hit) AS cell, round FROM i)
SELECT topic, round, backfill, new_count, prev_total, streak, len(missing)::INTEGER AS n_missing,
 len(list_filter(range(0, 16), lambda c: empty[c + 1] >= 2))::INTEGER - (SELECT count(DISTINCT h.cell) FROM h WHERE h.topic = w.topic AND h.round <= w.round AND h.cell < 16 AND w.empty[h.cell + 1] >= 2)::INTEGER AS n_waived,
 len(missing) = 0 AND streak >= 3 AS saturated FROM w WHERE k > 0""")
def backfill_rounds(spark, d):
    """Events replayed as a stream that is stopped and started again: what each round decides."""
    return backfill.replay(event_finds(spark, d))


rules("round_saturation", ("idx long, seen long, total long", [(0, 3, 10), (1, 2, 10), (2, 5, 8), (3, 0, 0), (4, 3, 11)]), "idx", saturated=lambda d: "(total > 0 AND seen >= 3 AND CAST(seen AS DOUBLE) / greatest(total, 1) >= 0.3)")


@query("topic_gaps", f"""WITH p AS ({values_sql(*fx.PROBLEMS)}), c AS ({values_sql(*fx.COVERED)}) SELECT question, frequency FROM p WHERE question NOT IN (SELECT question FROM c)
 AND (len(list_intersect({text.shingles(DUCK, 'question')}, {text.shingles(DUCK, DUCK.lit('减脂平台期'))})) >= 2 OR len(list_filter({text.shingles(DUCK, 'question', 3)}, lambda g: contains('减脂平台期', g))) > 0)""")
def topic_gaps(spark, d):
    return questions.gaps(values(spark, *fx.PROBLEMS), values(spark, *fx.COVERED), "减脂平台期")


@query("expanded_terms", "SELECT * FROM (VALUES (1, '减脂又称燃脂'), (2, '刷脂'), (3, '体重停滞也叫平台期'), (4, '俗称卡秤')) AS t(ord, term)")
def expanded_terms(spark, d):
    hits = values(spark, *fx.HITS).withColumn("idx", F.col("group_idx") * 1000 + F.col("result_idx")).withColumn("title", F.lit(""))
    return questions.expand_terms(hits, "减脂")


# ---- document quality ----

def prose_sql(source: str) -> str:
    """Hand-written: ``text`` without comments, fences and indented lines, line numbers kept."""
    return rf"""SELECT * EXCLUDE (p, g, t) REPLACE (array_to_string(list_reduce(string_split(t, chr(10)), lambda acc, l: {{
 'f': CASE WHEN acc.f = '' THEN regexp_extract(l, '^\s*(?:>\s*)*(`{{3,}}|~{{3,}})', 1)
           WHEN left(regexp_extract(l, '^\s*(?:>\s*)*(`{{3,}}|~{{3,}})', 1), 1) = left(acc.f, 1) AND length(regexp_extract(l, '^\s*(?:>\s*)*(`{{3,}}|~{{3,}})', 1)) >= length(acc.f)
                AND regexp_matches(l, '^\s*(?:>\s*)*(?:`{{3,}}|~{{3,}}) *$') THEN '' ELSE acc.f END,
 'o': list_append(acc.o, CASE WHEN acc.f = '' AND NOT regexp_matches(l, '^\s*(?:>\s*)*(?:`{{3,}}|~{{3,}})') AND NOT regexp_matches(l, '^(?:    |\t)') THEN l ELSE '' END)}},
 {{'f': '', 'o': []::VARCHAR[]}}).o, chr(10)) AS text)
FROM (SELECT *, array_to_string(list_transform(range(1, len(p) + 1), lambda i: p[i] || coalesce(regexp_replace(g[i], '[^\n]', '', 'g'), '')), '') AS t
 FROM (SELECT *, regexp_split_to_array(text, '(?s)<!--.*?-->') AS p, regexp_extract_all(text, '(?s)<!--.*?-->') AS g FROM ({source})))"""


_SHOWN = "doc_id, n_chars_net, n_units, n_sentences, median_len, n_near, n_blocks, n_long_blocks, n_paragraphs, n_summaries, n_prose_lines, n_title_words, n_pulled_back, n_unhedged, lists_touch, n_questions, n_digit_lines, n_absolutes, n_parallel, n_intensifiers, n_bold, n_you, n_h2, n_h3, n_jumps, n_missing_lists, n_errors, n_warnings, score, verdict, status"
QUERIES["zh_doc_metrics"] = lambda spark, d: docqc.scored(values(spark, *fx.DOCS)).selectExpr(*_SHOWN.split(", "))
SQL["zh_doc_metrics"] = f"SELECT {_SHOWN} FROM ({docqc.SCORED.sql(prose_sql(values_sql(*fx.DOCS)))})"
_DOC = "SELECT doc_id, text, CAST(NULL AS VARCHAR) AS title, CAST(NULL AS VARCHAR) AS tutorial_type FROM documents"
QUERIES["doc_score"] = lambda spark, d: docqc.scored(read(spark, d, "documents").select("doc_id", "text", F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("tutorial_type"))).selectExpr(*_SHOWN.split(", "))
SQL["doc_score"] = f"SELECT {_SHOWN} FROM ({docqc.SCORED.sql(prose_sql(_DOC))})"
_CHAPTER = "doc_id, hits, anchor_rate, has_contract, has_deliverable, has_case, loops_back, n_vague, n_rhetoric, banned"
_CHAPTER_SQL = docqc.CHAPTER.sql(f"SELECT s.*, p.text AS prose FROM ({values_sql(*fx.DOCS)}) s JOIN ({prose_sql(values_sql(*fx.DOCS))}) p USING (doc_id)")
QUERIES["zh_chapter_checks"] = lambda spark, d: docqc.chapter(values(spark, *fx.DOCS)).selectExpr(*_CHAPTER.split(", "))
SQL["zh_chapter_checks"] = f"SELECT {_CHAPTER} FROM ({_CHAPTER_SQL})"
QUERIES["zh_chapter_findings"] = lambda spark, d: docqc.chapter_findings(values(spark, *fx.DOCS).withColumn("modern", F.col("doc_id") == 6))
SQL["zh_chapter_findings"] = f"WITH s AS (SELECT *, doc_id = 6 AS modern FROM ({_CHAPTER_SQL})) " + " UNION ALL ".join(f"SELECT doc_id, '{r}' AS rule, '{v}' AS severity FROM s WHERE {c}" for r, c, v in docqc.CHAPTER_RULES)
QUERIES["zh_findings"] = lambda spark, d: docqc.findings(values(spark, *fx.DOCS))
SQL["zh_findings"] = f"WITH s AS ({docqc.SCORED.sql(prose_sql(values_sql(*fx.DOCS)))}) " + " UNION ALL ".join(
    f"SELECT doc_id, '{r}' AS rule, '{s}' AS severity FROM s WHERE {c}" for rs, s in ((docqc.ERRORS, "error"), (docqc.WARNINGS, "warning")) for r, c in rs
)

# rules whose SQL is written by hand, line by line, over texts that trip them
_ESSAYS = f"e AS ({prose_sql(values_sql(*fx.ESSAYS))})"
_ESSAY_LINES = _ESSAYS + r", ls AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS n, unnest(string_split(text, chr(10))) AS l FROM e)"
_ESSAY_PARTS = _ESSAYS + r", ps AS (SELECT doc_id, trim(unnest(regexp_split_to_array(text, '[。！？!?；;…]+')), E' \n\t') AS s FROM e)"


def _essays(name: str, columns: str, sql: str) -> None:
    QUERIES[name] = lambda spark, d: docqc.scored(values(spark, *fx.ESSAYS)).selectExpr("doc_id", *columns.split(", "))
    SQL[name] = sql


_essays("zh_main_line", "n_prose_lines, n_pulled_back", rf"""WITH {_ESSAY_LINES}, h AS (
 SELECT doc_id, coalesce(nullif(title, ''), regexp_extract(text, '(?m)^# +(.+)$', 1)) AS head FROM e),
r AS (SELECT doc_id, unnest(regexp_extract_all(head, '[一-鿿]{{2,}}')) AS run FROM h),
w AS (SELECT DISTINCT doc_id, substr(run, i, 2) AS w FROM r, range(1, 40) AS t(i) WHERE i < length(run) AND NOT regexp_full_match(run, '第[一二三四五六七八九十]+章')),
x AS (SELECT doc_id, n, l FROM ls WHERE trim(l) <> '' AND NOT regexp_matches(l, '^ *([#|>]|[-*] )'))
SELECT e.doc_id, (SELECT count(*) FROM x WHERE x.doc_id = e.doc_id) AS n_prose_lines,
 (SELECT count(DISTINCT n) FROM x JOIN w USING (doc_id) WHERE x.doc_id = e.doc_id AND strpos(l, w) > 0) AS n_pulled_back FROM e""")
_essays("zh_unhedged_claims", "n_unhedged", rf"""WITH {_ESSAY_PARTS} SELECT e.doc_id, count(s) AS n_unhedged FROM e LEFT JOIN (SELECT * FROM ps
 WHERE length(s) BETWEEN 1 AND 120 AND regexp_matches(s, '未来|接下来|之后|以后|恢复|下一轮|下一步|长期看|短期内') AND regexp_matches(s, '一定会|必然|必将|百分百|肯定会')
 AND NOT regexp_matches(s, '可能|也许|大概|或许|推测|估计|猜测|预计|尚未|有待|待验证|证据有限|个案|我的判断|我认为')) q USING (doc_id) GROUP BY e.doc_id""")
_essays("zh_summary_endings", "n_paragraphs, n_summaries", rf"""WITH {_ESSAYS}, b AS (
 SELECT doc_id, unnest(regexp_split_to_array(text, '\n[ \n]*\n')) AS block FROM e),
k AS (SELECT * FROM b WHERE list_bool_or(list_transform(string_split(block, chr(10)), lambda l: trim(l) <> '' AND NOT regexp_matches(l, '^ *[#|>]')))),
t AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(block, '[。！？!?；;…]+'), lambda s: trim(s, E' \n')), lambda s: s <> '') AS ss FROM k)
SELECT e.doc_id, count(ss) FILTER (len(ss) > 0) AS n_paragraphs,
 count(ss) FILTER (regexp_matches(ltrim(ss[-1], '，,、"''“‘'), '^(所以|也就是说|这意味着|总的来说|总之|由此可见)')) AS n_summaries FROM e LEFT JOIN t USING (doc_id) GROUP BY e.doc_id""")
_essays("zh_list_runs", "lists_touch", rf"""WITH {_ESSAY_LINES}, m AS (
 SELECT doc_id, n, l, regexp_matches(l, '^ *[-*] ') AS item FROM ls WHERE trim(l) <> ''), g AS (
 SELECT doc_id, item AND lag(item) OVER (PARTITION BY doc_id ORDER BY n) AND n - lag(n) OVER (PARTITION BY doc_id ORDER BY n) > 1 AS touch FROM m)
SELECT e.doc_id, coalesce(bool_or(touch), false) AS lists_touch FROM e LEFT JOIN g USING (doc_id) GROUP BY e.doc_id""")
_BULLETS = f"""WITH @SRC@, l AS (SELECT doc_id, generate_subscripts({docqc.lines(DUCK)}, 1) - 1 AS pos, unnest({docqc.lines(DUCK)}) AS l FROM s),
b AS (SELECT doc_id, pos, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM l WHERE {docqc.bullet(DUCK, 'l')})
SELECT doc_id, min(pos) AS start, count(*) AS n FROM b GROUP BY doc_id, island"""
QUERIES["doc_bullet_runs"] = lambda spark, d: docqc.bullet_runs(read(spark, d, "documents"))
SQL["doc_bullet_runs"] = _BULLETS.replace("@SRC@", "s AS (SELECT doc_id, text FROM documents)")
QUERIES["zh_bullet_runs"] = lambda spark, d: docqc.bullet_runs(values(spark, *fx.DOCS))
SQL["zh_bullet_runs"] = _BULLETS.replace("@SRC@", f"s AS ({values_sql(*fx.DOCS)})")


@query("prose_mask", f"SELECT doc_id, CAST(length(text) AS BIGINT) AS n_prose FROM ({prose_sql('SELECT doc_id, text FROM documents')})")
def prose_mask(spark, d):
    return read(spark, d, "documents").select("doc_id", F.length(docqc.masked(F.col("text"))).cast("long").alias("n_prose"))


QUERIES["zh_prose_mask"] = lambda spark, d: values(spark, *fx.ESSAYS).select("doc_id", docqc.masked(F.col("text")).alias("prose"))
SQL["zh_prose_mask"] = f"SELECT doc_id, text AS prose FROM ({prose_sql(values_sql(*fx.ESSAYS))})"


# ---- evidence, contracts, lineage, workflow ----

_S = f"s AS (SELECT *, {url.host(DUCK)} AS host, {url.article_key(DUCK)} AS article, {url.source_key(DUCK)} AS key, {text.local_source(DUCK, 'name')} AS local, {url.aggregator(DUCK)} AS turned, {url.valid(DUCK)} AS valid FROM ({values_sql(*fx.SOURCES)}))"


def _repeat_sql(key: str, rule: str, where: str) -> str:
    return f"SELECT card, ord, '{rule}' AS rule, {key} AS key, first FROM (SELECT *, row_number() OVER w AS k, first_value(name) OVER w AS first FROM s WHERE {where} WINDOW w AS (PARTITION BY card, {key} ORDER BY ord)) WHERE k > 1"


@query("independence_warnings", f"WITH {_S} " + " UNION ALL ".join([
    _repeat_sql("original_source_id", "original", "original_source_id <> ''"),
    "SELECT card, ord, 'aggregator' AS rule, host AS key, name AS first FROM s WHERE url <> '' AND host IN (" + ", ".join(map(DUCK.lit, packs.AGGREGATORS)) + ")",
    _repeat_sql("article", "article", "url <> '' AND article IS NOT NULL"), _repeat_sql("host", "domain", "url <> '' AND article IS NULL"),
]))
def independence_warnings(spark, d):
    return evidence.independence(values(spark, *fx.SOURCES))


# pages as sources of cards: every fifth one an article, every seventh one with an original
_PAGE_SOURCES = """SELECT page_id, page_id % 9 AS card, CASE WHEN page_id % 5 = 0 THEN concat('https://arxiv.org/abs/2401.', CAST(page_id % 13 AS VARCHAR(9))) ELSE url END AS url,
 CASE WHEN page_id % 7 = 0 THEN concat('study-', CAST(page_id % 11 AS VARCHAR(9))) END AS original_source_id"""


@query("independent_groups", f"""WITH RECURSIVE src AS ({_PAGE_SOURCES} FROM pages), k AS (SELECT card, row_number() OVER (PARTITION BY card ORDER BY page_id) AS n, {url.host(DUCK)} AS host, {url.article_key(DUCK)} AS article, {url.source_key(DUCK)} AS key FROM src),
w AS (SELECT DISTINCT card, 0::BIGINT AS n, []::VARCHAR[] AS keys, []::VARCHAR[] AS hosts, 0::BIGINT AS n_key, 0::BIGINT AS n_domain FROM k
 UNION ALL SELECT card, n, CASE WHEN taken OR held THEN keys ELSE list_append(keys, key) END, CASE WHEN taken OR held OR host = '' THEN hosts ELSE list_append(hosts, host) END, n_key + taken::BIGINT, n_domain + held::BIGINT FROM (
  SELECT w.card, k.n, w.keys, w.hosts, k.key, k.host, w.n_key, w.n_domain, list_contains(w.keys, k.key) AS taken, NOT list_contains(w.keys, k.key) AND k.article IS NULL AND list_contains(w.hosts, k.host) AS held FROM w JOIN k ON k.card = w.card AND k.n = w.n + 1))
SELECT card, max(n) AS n_sources, len(arg_max(keys, n))::BIGINT AS groups, max(n_key) AS n_key, max(n_domain) AS n_domain FROM w GROUP BY card""")
def independent_groups(spark, d):
    """How many independent sources cards of pages have, in page order."""
    rows = read(spark, d, "pages").selectExpr(*[
        "page_id", "page_id % 9 AS card", "CASE WHEN page_id % 5 = 0 THEN concat('https://arxiv.org/abs/2401.', page_id % 13) ELSE url END AS url", "CASE WHEN page_id % 7 = 0 THEN concat('study-', page_id % 11) END AS original_source_id",
    ])
    return independence.groups(rows, order=("page_id",))


@query("confidence_grade", f"""WITH {_S}, f AS ({values_sql(*fx.FILES)}), c AS ({values_sql(*fx.CARDS)}),
a AS (SELECT * FROM s WHERE grade = 'high' AND NOT turned AND key IS NOT NULL AND CASE WHEN local THEN name IN (SELECT path FROM f) ELSE valid END),
k AS (SELECT *, row_number() OVER (PARTITION BY card, key ORDER BY ord) AS kn, row_number() OVER (PARTITION BY card, CASE WHEN host <> '' AND article IS NULL THEN host ELSE name END ORDER BY ord) AS hn FROM a),
g AS (SELECT card, count(*) AS groups FROM k WHERE kn = 1 AND (hn = 1 OR host = '' OR article IS NOT NULL) GROUP BY card)
SELECT c.card, coalesce(groups, 0) AS groups, CASE WHEN coalesce(groups, 0) = 0 THEN '低' WHEN groups >= 2 AND NOT has_conflict THEN '高' ELSE '中' END AS confidence FROM c LEFT JOIN g USING (card)""")
def confidence_grade(spark, d):
    return evidence.confidence(values(spark, *fx.CARDS), values(spark, *fx.SOURCES), values(spark, *fx.FILES))


@query("anti_refs", f"WITH e AS ({values_sql(*fx.EVIDENCE)}), c AS ({values_sql(*fx.CLAIMS)}) SELECT article, section, claim_id FROM e WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.article = e.article AND c.claim_id = e.claim_id)")
def anti_refs(spark, d):
    return evidence.unknown_references(values(spark, *fx.EVIDENCE), values(spark, *fx.CLAIMS))


@query("missing_quotes", f"SELECT claim_id, source_id, quote FROM ({values_sql(*fx.QUOTES)}) q JOIN ({values_sql(*fx.SNAPSHOTS)}) s USING (source_id) WHERE NOT contains(text, quote)")
def missing_quotes(spark, d):
    return evidence.missing_quotes(values(spark, *fx.QUOTES), values(spark, *fx.SNAPSHOTS))


@query("id_errors", f"SELECT article, ord, claim_id, error FROM (SELECT *, CASE WHEN NOT coalesce(regexp_matches(claim_id, '^[A-Za-z0-9][A-Za-z0-9_-]*$'), false) THEN 'malformed' WHEN row_number() OVER (PARTITION BY article, claim_id ORDER BY ord) > 1 THEN 'repeated' END AS error FROM ({values_sql(*fx.CLAIMS)})) WHERE error IS NOT NULL")
def id_errors(spark, d):
    return evidence.id_errors(values(spark, *fx.CLAIMS), "article", "claim_id")


@query("required_errors", f"WITH c AS ({values_sql(*fx.CLAIMS)}) SELECT ord, 'statement' AS field FROM c WHERE coalesce(trim(statement), '') = '' UNION ALL SELECT ord, 'claim_type' FROM c WHERE coalesce(trim(claim_type), '') = ''")
def required_errors(spark, d):
    return evidence.required_errors(values(spark, *fx.CLAIMS), "ord", ["statement", "claim_type"])


@query("criteria_checks", f"""WITH c AS ({values_sql(*fx.CRITERIA)}), n AS (SELECT article, criterion_id, count(*) AS n FROM ({values_sql(*fx.CHECKS)}) GROUP BY ALL)
SELECT article, criterion_id, error FROM (SELECT coalesce(c.article, n.article) AS article, coalesce(c.criterion_id, n.criterion_id) AS criterion_id, CASE WHEN n.n IS NULL THEN 'unchecked' WHEN c.article IS NULL THEN 'unknown' WHEN n.n > 1 THEN 'repeated' END AS error
FROM c FULL JOIN n ON c.article = n.article AND c.criterion_id = n.criterion_id) WHERE error IS NOT NULL""")
def criteria_checks(spark, d):
    return evidence.one_to_one(values(spark, *fx.CRITERIA), values(spark, *fx.CHECKS))


@query("stale_reports", f"SELECT r.report, r.path FROM ({values_sql(*fx.RECORDED)}) r LEFT JOIN ({values_sql(*fx.CURRENT)}) c USING (path) WHERE c.sha256 IS NULL OR c.sha256 <> r.sha256")
def stale_reports(spark, d):
    return evidence.stale_inputs(values(spark, *fx.RECORDED), values(spark, *fx.CURRENT))


# an edited version of the documents: some texts longer, some rows gone, some new
_NEWER = """n AS (SELECT doc_id, CASE WHEN doc_id % 89 = 3 THEN text || ' edited' ELSE text END AS text, source FROM documents WHERE doc_id % 97 <> 5
 UNION ALL SELECT doc_id + 1000000000, text, source FROM documents WHERE doc_id % 101 = 7)"""


def newer(docs: DataFrame) -> DataFrame:
    kept = docs.where("doc_id % 97 <> 5").withColumn("text", F.when(F.col("doc_id") % 89 == 3, F.concat("text", F.lit(" edited"))).otherwise(F.col("text")))
    return kept.unionByName(docs.where("doc_id % 101 = 7").withColumn("doc_id", F.col("doc_id") + 1000000000))


def _versions(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "text", "source")
    return docs, merkle.snapshot(docs, ["doc_id"]), merkle.snapshot(newer(docs), ["doc_id"])


@query("changed_documents", f"""WITH {_NEWER} SELECT coalesce(d.doc_id, n.doc_id) AS doc_id, CASE WHEN d.doc_id IS NULL THEN 'added' WHEN n.doc_id IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM documents d FULL JOIN n ON n.doc_id = d.doc_id WHERE d.doc_id IS NULL OR n.doc_id IS NULL OR d.text IS DISTINCT FROM n.text OR d.source IS DISTINCT FROM n.source""")
def changed_documents(spark, d):
    """Documents against an edited version, by trees of digests."""
    _, old, new = _versions(spark, d)
    return merkle.changes(old, new)


@query("stale_sources", f"""WITH {_NEWER} SELECT d.source, count(*) AS n_inputs, count(*) FILTER (n.doc_id IS NULL OR n.text IS DISTINCT FROM d.text) AS n_changed, n_changed = 0 AS fresh
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.source""")
def stale_sources(spark, d):
    """Per source, how many of its documents an edited version has changed or lost."""
    docs, old, new = _versions(spark, d)
    return merkle.stale(docs, merkle.changes(old, new), "source", "doc_id")


@query("fresh_reports", f"""WITH r AS ({values_sql(*fx.REPORTS)}), i AS ({values_sql(*fx.RECORDED)}), c AS ({values_sql(*fx.CURRENT)}), q AS ({values_sql(*fx.REQUIRED)})
SELECT report, version = 3 AND n_errors = 0 AND error_count = 0 AND warning_count = n_warnings AND status IN ('pass', 'minor')
 AND report IN (SELECT report FROM i) AND report NOT IN (SELECT i.report FROM i LEFT JOIN c USING (path) WHERE c.sha256 IS NULL OR c.sha256 <> i.sha256)
 AND report NOT IN (SELECT q.report FROM q LEFT JOIN i ON i.report = q.report AND i.path = q.path WHERE i.path IS NULL) AS fresh FROM r""")
def fresh_reports(spark, d):
    return evidence.fresh_reports(*[values(spark, *f) for f in (fx.REPORTS, fx.RECORDED, fx.CURRENT, fx.REQUIRED)])


_STAGES = values_sql("stage_idx int, stage string", list(enumerate(packs.STAGES)))


@query("stage_blockers", f"SELECT stage_idx, reason FROM ({values_sql(*fx.PREREQUISITES)}) p JOIN ({_STAGES}) s ON s.stage = p.min_stage WHERE stage_idx <= 7 AND NOT ok")
def stage_blockers(spark, d):
    return evidence.blocked(values(spark, *fx.PREREQUISITES), "stage6", spark)


@query("current_stage", f"SELECT tutorial, arg_min(stage, stage_idx) FILTER (NOT satisfied) AS stage, count(*) FILTER (satisfied) AS done FROM ({values_sql(*fx.STATUS)}) GROUP BY tutorial")
def current_stage(spark, d):
    return evidence.current_stage(values(spark, *fx.STATUS))


@query("rollback_gates", f"SELECT gate, confirmed FROM ({values_sql(*fx.GATES)}) WHERE gate IN ('topic')")
def rollback_gates(spark, d):
    return evidence.rolled_back(values(spark, *fx.GATES), "stage4", spark)


# ---- the question pipeline ----

_PROBLEMS = [
    ("P001", "到底减脂是什么？", "基础", "What", "confirmed", 3, 3, 2), ("PV001", "减脂平台期一般持续多久？", "旅程", "瓶颈期", "single_source", 1, 1, 0),
    ("PV002", "减脂期能不能喝酒？", "旅程", "瓶颈期", "single_source", 1, 1, 0), ("PV003", "减脂平台期怎么突破？", "旅程", "瓶颈期", "single_source", 1, 1, 0),
    ("P002", "减肥药有哪些副作用？", "争议时效", "争议", "confirmed", 1, 1, 0),
]


@query("zh_pipeline", values_sql("id string, text string, perspective string, sub_dimension string, status string, total_frequency long, source_count long, n_duplicates long", _PROBLEMS))
def zh_pipeline(spark, d):
    out = question_pipeline.run(values(spark, *fx.HITS), values(spark, *fx.PAGES), "减脂")
    return out.problems.select("id", "text", "perspective", "sub_dimension", "status", "total_frequency", "source_count", F.size("duplicates").cast("long").alias("n_duplicates"))


# the same plan over pages: a hit a URL, three of four fetched, cells dealt by page
_LATIN_Q = rf"""u AS (SELECT url, min(page_id) AS page_id FROM pages GROUP BY url), b AS (SELECT p.page_id, p.url, p.html, p.page_id % 4 <> 3 AS fetched, regexp_extract(p.html, '<h1[^>]*>([^<]*)</h1>', 1) AS title FROM pages p JOIN u USING (url, page_id)),
raw AS (SELECT page_id, url, 0 AS part, generate_subscripts(x, 1) AS pos, unnest(x) AS t FROM (SELECT *, regexp_extract_all(html, '<h[1-3][^>]*>([^<]*)</h[1-3]>', 1) AS x FROM b WHERE fetched)
 UNION ALL SELECT page_id, url, 1, generate_subscripts(x, 1), unnest(x) FROM (SELECT *, regexp_split_to_array(regexp_replace(regexp_replace(html, '(?s)<(script|style)[^>]*>.*?</(script|style)>', '', 'g'), '<[^>]*>', chr(10), 'g'), '[.!?\n]+') AS x FROM b WHERE fetched)
 UNION ALL SELECT page_id, url, 2, 0, title FROM b WHERE NOT fetched),
a AS (SELECT page_id, url, part, pos, trim(regexp_replace(t, '\s+', ' ', 'g')) AS text FROM raw), q AS (SELECT * FROM a WHERE regexp_matches(lower(text), '{latin.ASKS}') AND length(text) BETWEEN 12 AND 90),
f AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY part, pos) AS n FROM (SELECT *, row_number() OVER (PARTITION BY url, text ORDER BY part, pos) AS k FROM q) WHERE k = 1),
c AS (SELECT text, url, struct_pack(g := page_id % 16, p := page_id, n := CASE WHEN part = 2 THEN 0 ELSE n END) AS ord FROM f WHERE (n <= 50 OR part = 0) AND NOT regexp_matches(lower(text), '{latin.holds(packs.LATIN_ABSTRACT)}') AND NOT regexp_matches(lower(text), '{latin.holds(packs.LATIN_VALUES)}')),
t AS (SELECT text, min(ord) AS first, row_number() OVER (ORDER BY min(ord)) AS idx, lower(text) AS dk FROM c GROUP BY text),
i AS (SELECT dk, min(idx) AS idx, length(dk) AS len, list_distinct(list_filter(regexp_split_to_array(dk, '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')) AS w FROM t GROUP BY dk),
pair AS (SELECT x.idx AS a, y.idx AS b, len(list_intersect(x.w, y.w)) AS n, len(x.w) AS nx, len(y.w) AS ny, x.len AS lx, y.len AS ly FROM i x JOIN i y ON x.idx < y.idx),
good AS (SELECT a, b FROM pair WHERE n / (nx + ny - n) >= 0.85 OR (n = nx AND lx < ly) OR (n = ny AND ly < lx)), both_ways AS (SELECT a, b FROM good UNION SELECT b, a FROM good),
r(node, seen) AS (SELECT idx, idx FROM i UNION SELECT b.b, r.seen FROM r JOIN both_ways b ON b.a = r.node), k AS (SELECT i.idx, i.len, min(seen) AS component FROM r JOIN i ON i.idx = r.node GROUP BY ALL),
m AS (SELECT component, arg_min(idx, len * -1000000 + idx) AS kept, count(*) AS members FROM k GROUP BY component),
s AS (SELECT component, url, coalesce({url.tier(DUCK)}, 'tertiary') AS type, sum(n) AS frequency FROM (SELECT component, url, count(*) AS n FROM c JOIN t USING (text) JOIN k USING (idx) GROUP BY ALL) GROUP BY component, url),
gate AS (""" + _GATE.format(key="component") + f""")
SELECT concat(CASE WHEN status = 'confirmed' THEN 'P' ELSE 'PV' END, lpad(row_number() OVER (PARTITION BY status ORDER BY component)::VARCHAR, 3, '0')) AS id, t.text, cells.perspective, cells.sub_dimension, status, total_frequency, source_count, members - 1 AS n_duplicates
FROM m JOIN gate USING (component) JOIN t ON t.idx = m.kept JOIN cells ON cells.cell = t.first.g"""


@query("page_questions", f"WITH RECURSIVE {_CELLS}, {_LATIN_Q}")
def page_questions(spark, d):
    """The question pipeline over pages: extraction, judging, sources, near-duplicates, gate, ids."""
    pages = read(spark, d, "pages")
    one = pages.groupBy("url").agg(F.min("page_id").alias("page_id")).join(pages, ["url", "page_id"])
    cell = (F.col("page_id") % 16).cast("int")
    hits = one.select(cell.alias("cell"), cell.alias("group_idx"), F.col("page_id").alias("result_idx"), F.lit("").alias("query"), F.regexp_extract("html", "<h1[^>]*>([^<]*)</h1>", 1).alias("title"), "url", F.lit("").alias("snippet"))
    hits = hits.join(F.broadcast(questions.cells(spark)), "cell").drop("cell")
    fetched = one.where("page_id % 4 <> 3").select("url", "html")
    out = question_pipeline.run(hits, fetched, "pages", pack=question_pipeline.LATIN)
    return out.problems.select("id", "text", "perspective", "sub_dimension", "status", "total_frequency", "source_count", F.size("duplicates").cast("long").alias("n_duplicates"))


@query("zh_reachability", f"WITH h AS ({values_sql(*fx.HITS)}), p AS ({values_sql(*fx.PAGES)}) SELECT count(DISTINCT p.url) / count(DISTINCT h.url) AS reachability FROM h LEFT JOIN p ON p.url = h.url WHERE h.url <> ''")
def zh_reachability(spark, d):
    return question_pipeline.reachability(values(spark, *fx.HITS), values(spark, *fx.PAGES))


@query("source_upsert", f"WITH f AS (SELECT page_id, url, {url.canonical(DUCK)} AS c FROM pages), n AS (SELECT c, min(page_id) AS page_id FROM f WHERE page_id % 2 = 1 GROUP BY c) SELECT page_id FROM n WHERE c NOT IN (SELECT c FROM f WHERE page_id % 2 = 0)")
def source_upsert(spark, d):
    pages = read(spark, d, "pages").select("page_id", "url", F.col("page_id").alias("ord"))
    return sinks.upsert_sources(pages.where("page_id % 2 = 0"), pages.where("page_id % 2 = 1")).select("page_id")


@query("harvest_manifest", f"WITH {bare_pages_sql()} SELECT page_id, {url.layer(DUCK)} AS layer, {text.content_units(DUCK, 'bare')} AS units, {text.harvest_outcome(DUCK, 'bare')} AS outcome FROM bare")
def harvest_manifest(spark, d):
    h = bare_pages(spark, d).select(F.col("page_id").alias("title"), "url", F.expr(url.layer(SPARK)).alias("layer"), F.col("bare").alias("text"), F.lit("unknown").alias("value"))
    return sinks.harvest_entries(h).select(F.col("title").alias("page_id"), "layer", "units", "outcome")


@query("unique_cards", "SELECT b.item_id, CASE WHEN count(d.doc_id) = 1 THEN min(d.doc_id) END AS doc_id FROM benchmark b LEFT JOIN documents d ON d.text = b.text GROUP BY b.item_id")
def unique_cards(spark, d):
    outlines = read(spark, d, "benchmark").select("item_id", F.col("text").alias("question"))
    cards = read(spark, d, "documents").select("doc_id", F.col("text").alias("question"))
    return evidence.unique_match(outlines, cards).select("item_id", "doc_id")


_GRADED = f"""SELECT c.card, c.state, g.confidence, @BAD@ AS bad, c.card IN (SELECT card FROM ({SQL['independence_warnings']})) AS odd
 FROM ({values_sql(*fx.CARDS)}) c JOIN ({SQL['confidence_grade']}) g ON g.card = c.card"""
_BAD = f"c.card IN (SELECT card FROM ({values_sql(*fx.BROKEN)}))"
_REASONS = "SELECT card, confidence, CASE WHEN bad OR confidence = '低' THEN '待补采' ELSE state END AS state, list_filter([CASE WHEN confidence = '低' THEN '置信度低' END, CASE WHEN bad OR confidence = '低' OR state = '待补采' THEN '待补采' END, CASE WHEN odd THEN '独立性存疑' END], lambda r: r IS NOT NULL) AS reasons FROM"


def _manifest(spark, broken: bool) -> DataFrame:
    sources, cards, bad = values(spark, *fx.SOURCES), values(spark, *fx.CARDS), values(spark, *fx.BROKEN)
    graded = evidence.confidence(cards, sources, values(spark, *fx.FILES)).join(cards.select("card", "state"), "card")
    return evidence.answers_manifest(graded, bad if broken else bad.limit(0), evidence.independence(sources))


@query("watch_list", f"SELECT card, unnest(reasons) AS reason FROM ({_REASONS} ({_GRADED.replace('@BAD@', 'false')}))")
def watch_list(spark, d):
    sources, cards = values(spark, *fx.SOURCES), values(spark, *fx.CARDS)
    graded = evidence.confidence(cards, sources, values(spark, *fx.FILES)).join(cards.select("card", "state"), "card")
    return evidence.watch_list(graded, cards.limit(0), evidence.independence(sources))


@query("answers_manifest", f"SELECT card, confidence, state, array_to_string(reasons, '、') AS reasons FROM ({_REASONS} ({_GRADED.replace('@BAD@', _BAD)}))")
def answers_manifest(spark, d):
    return _manifest(spark, True).withColumn("reasons", F.array_join("reasons", "、"))


@query("answers_statistics", f"SELECT count(*) AS n_cards, count(*) FILTER (state = '达标') AS n_met, count(*) FILTER (state = '待补采') AS n_open, sum(len(reasons))::BIGINT AS n_watched FROM ({_REASONS} ({_GRADED.replace('@BAD@', _BAD)}))")
def answers_statistics(spark, d):
    return evidence.answers_statistics(_manifest(spark, True))


@query("regraded_cards", f"SELECT s.card, s.confidence AS stated, g.confidence AS graded FROM ({values_sql(*fx.STATED)}) s JOIN ({SQL['confidence_grade']}) g ON g.card = s.card WHERE coalesce(s.confidence, '') NOT IN ('', g.confidence)")
def regraded_cards(spark, d):
    return evidence.regraded(values(spark, *fx.STATED), evidence.confidence(values(spark, *fx.CARDS), values(spark, *fx.SOURCES), values(spark, *fx.FILES)))


@query("unmatched_articles", f"""WITH c AS ({values_sql(*fx.ASKING)}), o AS ({values_sql(*fx.PLANNED)}), h AS ({values_sql(*fx.CHAPTERS)})
SELECT question AS part, 'no_outline' AS rule FROM c WHERE question NOT IN (SELECT question FROM o)
UNION SELECT question, 'unknown_card' FROM o WHERE question NOT IN (SELECT question FROM c)
UNION SELECT question, 'repeated_outline' FROM o WHERE question IN (SELECT question FROM c) GROUP BY question HAVING count(*) > 1
UNION SELECT article_id, 'no_chapter' FROM o WHERE article_id NOT IN (SELECT article_id FROM h)
UNION SELECT article_id, 'unknown_chapter' FROM h WHERE article_id NOT IN (SELECT article_id FROM o)""")
def unmatched_articles(spark, d):
    return evidence.unmatched_articles(*[values(spark, *f) for f in (fx.ASKING, fx.PLANNED, fx.CHAPTERS)])


@query("unknown_card_fields", f"""WITH r AS ({values_sql(*fx.REFS)}), f AS ({values_sql(*fx.FIELDS)}), s AS ({values_sql(*fx.FIELD_SOURCES)}) SELECT article, section, ref FROM r
WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.article = r.article AND f.field = r.ref AND f.value <> '') AND NOT EXISTS (SELECT 1 FROM s WHERE s.article = r.article AND s.source_id = r.ref)""")
def unknown_card_fields(spark, d):
    return evidence.unknown_card_fields(*[values(spark, *f) for f in (fx.REFS, fx.FIELDS, fx.FIELD_SOURCES)])


@query("heading_anchors", "SELECT doc_id, pos, anchor FROM (VALUES (1, 0, '减脂平台期'), (1, 1, '怎么判断'), (2, 0, '步骤'), (2, 1, '跳级'), (6, 0, '只有一个'), (6, 1, '甲'), (6, 2, '乙')) AS t(doc_id, pos, anchor)")
def heading_anchors(spark, d):
    return contracts.slugs(values(spark, *fx.DOCS))


@query("markdown_lint")
def markdown_lint(spark, d):
    return contracts.lint(values(spark, *fx.DOCS))


# pages as Markdown: headings, list items and links of the markup, paragraphs apart
_MARKUP = [
    ("(?s)<(script|style)[^>]*>.*?</(script|style)>", ""), ("(?s)<!--.*?-->", ""), ("(?s)<title>.*?</title>", ""), ("\\s+", " "), ("<h1[^>]*>([^<]*)</h1>", "\n\n# \\1\n\n"), ("<b>([^<]*)<br>", "\n\n## \\1\n\n"),
    ("<a href=\"([^\"]*)\">([^<]*)</a>", "[\\2](\\1)"), ("<li>", "\n- "), ("</ul>|</?p>|<br>", "\n\n"), ("<[^>]*>", ""),
]


def page_markdown_sql() -> str:
    made = "html"
    for pattern, into in _MARKUP:
        made = f"regexp_replace({made}, {DUCK.lit(pattern)}, {DUCK.lit(into)}, 'g')"
    return f"p AS (SELECT page_id, {made} AS text FROM pages), l AS (SELECT page_id, generate_subscripts(string_split(text, chr(10)), 1) AS line, unnest(string_split(text, chr(10))) AS l FROM p)"


def page_markdown(spark, d) -> DataFrame:
    made = F.col("html")
    for pattern, into in _MARKUP:
        made = F.regexp_replace(made, pattern, into.replace("\\", "$"))
    return read(spark, d, "pages").select("page_id", made.alias("text"))


_HEADS = "h AS (SELECT page_id, line, length(regexp_extract(l, '^(#+) ', 1)) AS level, lower(trim(regexp_extract(l, '^#+ (.*)$', 1))) AS head FROM l WHERE regexp_matches(l, '^#{1,6} .*[^ ]'))"


@query("page_headings", rf"""WITH {page_markdown_sql()}, {_HEADS}, s AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(head, '( #+)+$', ''), '[^\w\p{{L}}\p{{N}}\s-]', '', 'g'), '\s+', '-', 'g') AS slug FROM h)
SELECT page_id, line, level, slug, row_number() OVER (PARTITION BY page_id, slug ORDER BY line) - 1 AS again FROM s""")
def page_headings(spark, d):
    """Headings of pages read as Markdown, with their anchors' slugs, from tokens."""
    found = markdown.tokens(page_markdown(spark, d), "page_id")
    a = markdown.anchors(found, "page_id").join(found.select("page_id", "pos", "line"), ["page_id", "pos"])
    parts = F.regexp_extract("anchor", "^(.*)-([0-9]+)$", 2)
    heads = found.where("kind = 'heading'").select("page_id", "pos", F.regexp_replace(F.regexp_replace(F.lower(F.trim("content")), r"(?U)[^\w\s-]", ""), r"(?U)\s+", "-").alias("slug"))
    return a.join(heads, ["page_id", "pos"]).select("page_id", "line", "level", "slug", F.when(F.col("anchor") == F.col("slug"), 0).otherwise(parts.cast("long")).cast("long").alias("again"))


@query("page_list_links", rf"""WITH {page_markdown_sql()} SELECT page_id, line, regexp_extract(l, '^- \[([^\]]*)\]\(([^)]*)\)', 2) AS target, regexp_extract(l, '^- \[([^\]]*)\]\(([^)]*)\)', 1) AS label FROM l WHERE regexp_matches(l, '^- \[[^\]]*\]\([^)]*\)')""")
def page_list_links(spark, d):
    """Links in list items of pages read as Markdown."""
    found = markdown.tokens(page_markdown(spark, d), "page_id")
    return markdown.links(found.where("depth = 2"), "page_id").where("kind = 'link'").select("page_id", "line", "target", "label")


@query("retry_schedule", "SELECT * FROM (VALUES (1::BIGINT, 0.0::DOUBLE), (2, 1.0), (3, 2.0)) AS t(attempt, wait_s)")
def retry_schedule(spark, d):
    return readers.retry_schedule(spark)


@query("coverage_gaps_acceptance", "WITH t AS (SELECT 10000 AS total) SELECT total >= 24000 AS material_ok, (24000 - total)::BIGINT AS needed_units, 'b、c' AS coverage_gaps FROM t")
def coverage_gaps_acceptance(spark, d):
    total = spark.createDataFrame([(10000,)], "total long")
    cover = spark.createDataFrame([("a", 2), ("b", 1), ("c", 0)], "question string, n_sources long")
    return evidence.acceptance(total, 8000, cover)


@query("question_coverage", "SELECT item_id, count(d.doc_id) AS n_sources FROM benchmark b LEFT JOIN documents d ON contains(d.text, b.text) GROUP BY item_id")
def question_coverage(spark, d):
    """Sources that mention each benchmark item; none is a gap."""
    n = benchmark_overlap(spark, d).groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    return read(spark, d, "benchmark").join(n, "item_id", "left").select("item_id", F.coalesce("n", F.lit(0).cast("long")).alias("n_sources"))


@query("gates_passed", f"""WITH g AS ({values_sql(*fx.GATES)}), b AS ({values_sql(*fx.BOUND)}), c AS ({values_sql(*fx.BOUND_NOW)}),
off AS (SELECT gate FROM (FROM b EXCEPT FROM c) UNION SELECT gate FROM (FROM c EXCEPT FROM b))
SELECT gate, confirmed <> '' AND (gate = 'topic' OR gate NOT IN (SELECT gate FROM off)) AS passed FROM g""")
def gates_passed(spark, d):
    return workflow.gates_passed(values(spark, *fx.GATES), values(spark, *fx.BOUND), values(spark, *fx.BOUND_NOW))


@query("confirm_gate", "SELECT * FROM (VALUES ('topic', 'yes'), ('outline', 'again')) AS t(gate, confirmed)")
def confirm_gate(spark, d):
    return workflow.confirmed(values(spark, *fx.GATES), "outline", "again", spark)


@query("differing_copies", f"SELECT name, count(DISTINCT sha256) AS versions, count(*) AS copies FROM ({values_sql(*fx.COPIES)}) GROUP BY name HAVING versions > 1")
def differing_copies(spark, d):
    return workflow.differing_copies(values(spark, *fx.COPIES))


@query("stage_status", f"SELECT stage_idx, s.stage, coalesce(ok, false) AS satisfied FROM ({_STAGES}) s LEFT JOIN (SELECT stage, bool_and(ok) AS ok FROM ({values_sql(*fx.ASSETS)}) GROUP BY stage) a ON a.stage = s.stage WHERE s.stage <> 'init'")
def stage_status(spark, d):
    return workflow.stage_status(values(spark, *fx.ASSETS), spark)


@query("dashboard", f"SELECT tutorial, concat(count(*) FILTER (satisfied), '/', count(*), ' ', string_agg(concat(CASE WHEN satisfied THEN '✅' ELSE '⬜' END, stage), ' → ' ORDER BY stage_idx)) AS line FROM ({values_sql(*fx.STATUS)}) GROUP BY tutorial")
def dashboard(spark, d):
    return workflow.dashboard(values(spark, *fx.STATUS))


@query("waived_cells", f"SELECT perspective, sub_dimension FROM ({values_sql(*fx.BACKFILLS)}) WHERE backfill GROUP BY ALL HAVING count(*) FILTER (found = 0) >= 2 AND sum(found) = 0")
def waived_cells(spark, d):
    return workflow.waived_cells(values(spark, *fx.BACKFILLS))


@query("blocker_hint", f"""SELECT tutorial, '⚠️ 当前阻塞：' || arg_min(reason, ord) || chr(10) || chr(10) || '你可以：' || chr(10)
 || CASE WHEN bool_or(contains(reason, '硬闸门')) THEN '- 拍板确认 → 我写入 confirmations.json 继续' || chr(10) || '- 回退修改 → 我重置对应闸门，旧产物保留可比' || chr(10) ELSE '' END
 || CASE WHEN bool_or(regexp_matches(reason, '缺 |没有|机检|不通过')) THEN '- 补齐产物 → 我先补跑/修到达标再继续' || chr(10) ELSE '' END || '- 暂停 → 进度已落 progress.md，随时 resume 恢复' AS text
FROM ({values_sql(*fx.REASONS)}) GROUP BY tutorial""")
def blocker_hint(spark, d):
    return workflow.blocker_hint(values(spark, *fx.REASONS))


@query("library_assets", f"SELECT tutorial, coalesce(trim(topic) <> '' AND tutorial IN (SELECT tutorial FROM ({values_sql(*fx.ENTRIES)})) AND material_ok AND coverage_gaps = '', false) AS ok FROM ({values_sql(*fx.LIBRARIES)})")
def library_assets(spark, d):
    return workflow.library_assets(values(spark, *fx.LIBRARIES), values(spark, *fx.ENTRIES))


@query("problem_assets", f"""WITH p AS ({values_sql(*fx.LISTED)}) SELECT tutorial, coalesce(trim(topic) <> '', false) AND tutorial IN (SELECT tutorial FROM p)
 AND tutorial NOT IN (SELECT tutorial FROM p WHERE coalesce(trim(text), '') = '') AS ok FROM ({values_sql(*fx.LIBRARIES)})""")
def problem_assets(spark, d):
    return workflow.problem_assets(values(spark, *fx.LIBRARIES).select("tutorial", "topic"), values(spark, *fx.LISTED))


@query("answer_assets", f"""WITH a AS ({values_sql(*fx.ANSWERS)}) SELECT tutorial, fresh AND tutorial IN (SELECT tutorial FROM a GROUP BY tutorial HAVING count(DISTINCT question) = count(*))
 AND tutorial NOT IN (SELECT tutorial FROM a WHERE version IS DISTINCT FROM 3 OR state IS DISTINCT FROM '达标' OR coalesce(confidence, '') NOT IN ('高', '中') OR coalesce(trim(question), '') = '') AS ok FROM ({values_sql(*fx.FRESH)})""")
def answer_assets(spark, d):
    return workflow.answer_assets(values(spark, *fx.ANSWERS), values(spark, *fx.FRESH))


@query("tutorial_dimensions", f"""WITH b AS ({values_sql(*fx.BREAKS)}), g AS (SELECT article, unnest(['可执行性', '可验证性', '覆盖完整性', '证据可靠性']) AS dimension FROM ({values_sql(*fx.ARTICLES)})),
n AS (SELECT g.*, (SELECT count(*) FROM b WHERE b.article = g.article AND b.dimension = g.dimension) AS n_errors FROM g)
SELECT article, dimension, n_errors, CASE dimension WHEN '可验证性' THEN coalesce((SELECT state FROM ({values_sql(*fx.STATES)}) s WHERE s.article = n.article), 'not_verified')
 WHEN '可执行性' THEN CASE WHEN n_errors > 0 THEN 'fail' WHEN article IN (SELECT article FROM ({values_sql(*fx.STEPPED)})) THEN 'pass' ELSE 'not_applicable' END
 ELSE CASE WHEN n_errors > 0 THEN 'fail' ELSE 'pass' END END AS status FROM n""")
def tutorial_dimensions(spark, d):
    return workflow.dimensions(*[values(spark, *f) for f in (fx.ARTICLES, fx.BREAKS, fx.STATES, fx.STEPPED)])


@query("qc_collection", f"""WITH a AS ({values_sql(*fx.ARTICLES)}), c AS ({values_sql(*fx.CHECKERS)}), d AS ({values_sql(*fx.GOOD_DIMS)}),
t AS (SELECT article, article IN (SELECT article FROM c WHERE checker = 'tutorial' AND fresh) AS t, article IN (SELECT article FROM d WHERE status IN ('pass', 'not_applicable') GROUP BY article HAVING count(*) = 4) AS g,
 article IN (SELECT article FROM c WHERE checker = 'render' AND fresh) AS r FROM a)
SELECT article, '教程质检不通过、缺失或已过期' AS reason FROM t WHERE NOT t UNION ALL SELECT article, '有未通过或未核验的教程维度' FROM t WHERE t AND NOT g
UNION ALL SELECT article, '成品渲染检查缺失、失败或已过期' FROM t WHERE NOT r""")
def qc_collection(spark, d):
    return workflow.qc_collection(*[values(spark, *f) for f in (fx.ARTICLES, fx.CHECKERS, fx.GOOD_DIMS)])


@query("missing_resources", f"""WITH e AS ({prose_sql(values_sql(*fx.LINKED))}), l AS (SELECT doc_id, unnest(regexp_extract_all(regexp_replace(text, '`[^`]*`', '', 'g'), '\\[[^\\]]*\\]\\(([^)\\s]+)', 1)) AS t FROM e),
f AS (SELECT DISTINCT doc_id, split_part(split_part(t, '#', 1), '?', 1) AS target FROM l WHERE NOT contains(t, ':') AND t NOT LIKE '//%')
SELECT doc_id, target FROM f WHERE target <> '' AND target NOT IN (SELECT path FROM ({values_sql(*fx.PRESENT)}))""")
def missing_resources(spark, d):
    return contracts.missing_resources(values(spark, *fx.LINKED), values(spark, *fx.PRESENT))


@query("stamped_reports", f"""WITH r AS ({values_sql(*fx.REPORTS)}), i AS ({values_sql(*fx.RECORDED)}) SELECT report, CASE WHEN n_errors > 0 THEN 'fail' WHEN n_warnings > 0 THEN 'minor' ELSE 'pass' END AS status, count(DISTINCT path) AS n_inputs, 3::BIGINT AS n_files FROM r LEFT JOIN i USING (report) GROUP BY report, n_errors, n_warnings""")
def stamped_reports(spark, d):
    out = workflow.stamped(values(spark, *fx.REPORTS).select("report", "n_errors", "n_warnings"), values(spark, *fx.RECORDED), values(spark, *fx.CURRENT), "tutorial")
    return out.select("report", "status", F.coalesce(F.size("inputs"), F.lit(0)).cast("long").alias("n_inputs"), F.size("files").cast("long").alias("n_files"))


_TITLE = "regexp_extract(html, '<title>([^<]*)</title>', 1)"


@query("page_tree", f"""WITH p AS (SELECT page_id, {url.layer(DUCK)} AS layer, {_TITLE} AS title, coalesce({text.strip_html(DUCK)}, '') AS text FROM pages)
SELECT page_id, layer, {text.safe_name(DUCK)} || '-' || page_id AS name, strlen(text) AS size, sha256(text) AS digest FROM p WHERE regexp_matches(text, '[^\\s\\p{{Z}}]')""")
def page_tree(spark, d):
    """Texts of pages as layered files, one each, read back without the blank ones."""
    pages = read(spark, d, "pages").select("page_id", F.expr(url.layer(SPARK)).alias("layer"), F.expr(_TITLE).alias("title"), F.expr(text.strip_html(SPARK)).alias("text"))
    folder = work_folder(spark, "page_tree")
    trees.write_tree(pages, folder, "page_id")
    files = trees.chapters(trees.read_tree(spark, folder))
    return files.select(F.regexp_extract("name", "-([0-9]+)$", 1).cast("long").alias("page_id"), "layer", "name", "size", F.sha2("text", 256).alias("digest"))


_LISTED = "SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '-') AS lang, coalesce(source, '-') AS source, coalesce(n_chars, 0) AS n_chars FROM documents"


@query("document_report", f"""WITH d AS (SELECT *, substring(regexp_extract(text, '^[^\n]*'), 1, 80) AS head, CASE WHEN n_chars >= 200 THEN 'confirmed' ELSE 'single_source' END AS status FROM ({_LISTED})),
h AS (SELECT source, min(doc_id) AS head FROM d GROUP BY source), l AS (
SELECT 0 AS p, 0 AS h, 0 AS o, 0 AS s, E'# documents — 真问题清单\n\n> 生成时间：2026-01-01\n' AS v
UNION ALL SELECT 1, head, head, 0, '## ' || source || E'视角\n\n| ID | 问题 | 子维度 | 来源数 | 状态 |\n|---|---|---|---|---|' FROM h
UNION ALL SELECT 1, h.head, doc_id, 1, '| D' || doc_id || ' | ' || d.head || ' | ' || lang || ' | 1 | ' || status || ' |' FROM d JOIN h USING (source)
UNION ALL SELECT 1, head, 9223372036854775807, 2, '' FROM h
UNION ALL SELECT 2, 0, -1, 0, E'## 16 格覆盖度\n'
UNION ALL SELECT 2, 0, min(doc_id), 0, '- ' || source || ' / ' || lang || ': ✅ (' || count(*) || ')' FROM d GROUP BY source, lang
UNION ALL SELECT 3, 0, -1, 0, E'\n## 详细问题'
UNION ALL SELECT 3, 0, doc_id, 0, E'\n### D' || doc_id || ' ' || head || E'\n- **原始文本**：' || text || E'\n- **视角 / 子维度**：' || source || ' / ' || lang || E'\n- **状态**：' || status
 || E'\n- **总频次 / 来源数**：' || n_chars || E' / 1\n- **来源**：\n  - [' || source || '] doc:' || doc_id || ' (频次 ' || n_chars || ')' FROM d),
n AS (SELECT row_number() OVER (ORDER BY p, h, o, s) AS k, string_split(v, chr(10)) AS parts FROM l), u AS (SELECT k, unnest(parts) AS value, generate_subscripts(parts, 1) AS j FROM n)
SELECT row_number() OVER (ORDER BY k, j) - 1 AS line, coalesce(sum(strlen(value) + 1) OVER (ORDER BY k, j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start, value FROM u""")
def document_report(spark, d):
    """A report of all documents, written in ordered parts and read back: number, offset and text of each line."""
    docs = read(spark, d, "documents").select("doc_id", *[F.coalesce(c, F.lit(v)).alias(c) for c, v in (("text", ""), ("lang", "-"), ("source", "-"), ("n_chars", 0))])
    head = F.substring(F.regexp_extract("text", r"^[^\n]*", 0), 1, 80)
    problems = docs.select(
        F.col("doc_id").alias("ord"), F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("id"), head.alias("text"), F.col("text").alias("original"),
        F.col("source").alias("perspective"), F.col("lang").alias("sub_dimension"), F.when(F.col("n_chars") >= 200, "confirmed").otherwise("single_source").alias("status"),
        F.col("n_chars").alias("total_frequency"), F.lit(1).alias("source_count"), F.array().cast("array<string>").alias("duplicates"),
        F.array(F.struct(F.col("source").alias("type"), F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("url"), F.col("n_chars").alias("frequency"))).alias("sources"),
    )
    matrix = problems.groupBy("perspective", "sub_dimension").agg(F.min("ord").alias("cell"), F.count(F.lit(1)).alias("n"))
    folder = work_folder(spark, "document_report")
    ordered_text.write_text(sinks.report_lines("documents", problems, matrix, "2026-01-01"), folder, *sinks.REPORT_ORDER)
    return ordered_text.read_text(spark, folder)
