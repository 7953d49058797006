"""Secret scans in DataFrame operations only: patterns and Markov likelihoods.

Three base patterns find assignments, access keys and hexadecimal runs. Beyond
them, every run of at least :data:`LEAST` key characters is scored by two first-order character
Markov models, one of random strings and one of ordinary identifiers and words:
the sum of log-likelihood ratios over its character pairs. Runs above the
threshold are added as spans of kind ``markov`` unless they touch a base span.

The models are counts of character pairs over labelled samples, made by
aggregation; the table of ratios has at most 128 x 128 cells and enters the plan
as one constant.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (kind, pattern, group whose length counts, least length), in listing order.
BASE = [
    ("assign", r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),  # runs are maximal, so shorter ones need not be listed and dropped
]
KEY_CHARS = "A-Za-z0-9+/_=-"
#: Shortest run of key characters that the models score: from here on nearly all random
#: strings are over the threshold, and few ordinary identifiers (figures in the README).
LEAST = 14
CANDIDATE = rf"(?<![{KEY_CHARS}])[{KEY_CHARS}]{{{LEAST},}}"
#: Log-likelihood ratio a character pair (nats) from which a run counts as random.
THRESHOLD = 1.0
#: Documents whose words are the sample of ordinary strings.
SAMPLE_DOCS = 400
#: Generated random strings of each form.
SAMPLE_RANDOM = 2000
SMOOTH = 0.5
#: Weight of single-character shares in pair probabilities.
BACKOFF = 4.0


def labelled_samples(docs: DataFrame, text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(sample, is_random): a bounded sample to train on.

    Random: digests of running numbers in five spellings. Ordinary: words of
    the ``sample_docs`` texts that come first by hash, two by two joined to
    identifiers (words with digits are left out, as they may be secrets), numbers, and
    runs of one mark.
    """
    spark = docs.sparkSession
    raw = F.unhex(F.sha2(F.col("id").cast("string"), 256))
    code = F.regexp_replace(F.base64(raw), "=+$", "")
    forms = F.array(
        code, F.translate(code, "+/", "-_"), F.sha2(F.col("id").cast("string"), 256),
        F.upper(F.translate(code, "+/", "")), F.lower(F.translate(code, "+/", "")),
    )
    random = spark.range(SAMPLE_RANDOM).select(F.explode(forms).alias("sample"), F.lit(True).alias("is_random"))

    texts = docs.select(F.col(text_col).cast("string").alias("t")).where("t is not null")
    hashed = texts.select("t", F.xxhash64("t").alias("h"))
    last = hashed.select("h").distinct().orderBy("h").limit(sample_docs).agg(F.max("h").alias("h")).first()["h"]
    sample = hashed.where(F.col("h") <= F.lit(last).cast("long")).dropDuplicates(["h"])  # equal texts count once
    pairs = F.regexp_extract_all("t", F.lit(r"\b[A-Za-z]{2,40}[^A-Za-z0-9][A-Za-z]{2,40}\b"), F.lit(0))
    two = sample.select(F.explode(pairs).alias("p"))
    spelt = F.array(
        *[F.regexp_replace("p", "[^A-Za-z]", c) for c in ("_", "-", "/", "")],
        F.upper(F.regexp_replace("p", "[^A-Za-z]", "_")), F.regexp_replace(F.initcap(F.regexp_replace("p", "[^A-Za-z]", " ")), " ", ""),
    )
    number = F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 15), 16, 10)
    plain = F.array(number, F.concat(number, number), *[F.lit(c * 24) for c in "-=_/+"])  # numbers and rules are no secrets
    dull = spark.range(SAMPLE_RANDOM).select(F.explode(plain).alias("sample"), F.lit(False).alias("is_random"))
    ordinary = two.select(F.explode(spelt).alias("sample"), F.lit(False).alias("is_random")).unionByName(dull)
    return random.unionByName(ordinary)


def train(samples: DataFrame) -> list[float]:
    """Ratios by ``128 * first + second`` of log pair probabilities, random minus ordinary."""
    chars = F.split("sample", "")
    pairs = F.transform(F.sequence(F.lit(1), F.length("sample") - 1), lambda i: F.struct(
        F.ascii(F.element_at(chars, i)).alias("x"), F.ascii(F.element_at(chars, i + 1)).alias("y")
    ))
    shaped = samples.where((F.length("sample") > 1) & F.col("sample").rlike(rf"^[{KEY_CHARS}]+$"))
    counts = shaped.select("is_random", F.explode(pairs).alias("p")).groupBy("is_random", "p.x", "p.y").count().collect()  # <= 2 x 128 x 128
    alphabet = [c for c in range(128) if chr(c).isalnum() or chr(c) in "+/_=-"]
    out = [0.0] * (128 * 128)
    seen = {(r["is_random"], r["x"], r["y"]): r["count"] for r in counts}
    singles = {k: [sum(seen.get((k, x, y), 0) for x in alphabet) + SMOOTH for y in alphabet] for k in (True, False)}
    share = {k: [n / sum(v) for n in v] for k, v in singles.items()}

    def log_p(k: bool, x: int, i: int) -> float:  # pairs, backed off to single characters
        row = sum(seen.get((k, x, y), 0) for y in alphabet)
        return math.log((seen.get((k, x, alphabet[i]), 0) + BACKOFF * share[k][i]) / (row + BACKOFF))

    for x in alphabet:
        for i, y in enumerate(alphabet):
            out[128 * x + y] = log_p(True, x, i) - log_p(False, x, i)
    return out


def _constant(model: list[float]) -> Column:
    return F.split(F.lit(",".join(f"{v:.5f}" for v in model)), ",").cast("array<double>")


def log_ratio(run: Column, model: Column) -> Column:
    """Mean log-likelihood ratio a pair of an ASCII run, in one pass."""
    start = F.struct(F.lit(0).alias("x"), F.lit(0.0).alias("s"))
    total = F.aggregate(
        F.split(run, ""), start,
        lambda a, c: F.struct(
            F.ascii(c).alias("x"),
            (a["s"] + F.when(a["x"] == 0, 0.0).otherwise(F.element_at(model, a["x"] * 128 + F.ascii(c) + 1))).alias("s"),
        ),
        lambda a: a["s"],
    )
    return total / (F.length(run) - 1)


def all_matches(text: Column, pattern: str) -> Column:
    """The matched strings, leftmost and non-overlapping."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _appended(values: Column, combine, zero, kind: str) -> Column:
    """Running totals of a short array; each step copies the array so far."""
    return F.aggregate(values, F.array().cast(f"array<{kind}>"), lambda acc, x: F.array_append(acc, combine(F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(zero)), x)))


#: Elements of an array that are added up step by step.
RUN = 128


def running(values: Column, combine, zero, kind: str = "int") -> Column:
    """Running totals of an array, the element's own included, for an associative ``combine``.

    Stretches of :data:`RUN` elements are added up apart and moved by the totals
    before them, so that work follows the length, not its square.
    """
    upto = lambda a: F.sequence(F.lit(0), F.floor((F.size(a) - 1) / RUN).cast("int"))

    def moved(parts: Column) -> Column:
        totals = F.transform(parts, lambda p: F.get(p, F.size(p) - 1))
        return _let(_appended(totals, combine, zero, kind), lambda t: F.flatten(F.transform(
            parts, lambda p, k: F.when(k == 0, p).otherwise(F.transform(p, lambda x: combine(F.get(t, k - 1), x)))
        )))

    def whole(a: Column) -> Column:
        return _let(F.transform(upto(a), lambda k: _appended(F.slice(a, k * RUN + 1, RUN), combine, zero, kind)), moved)

    return _let(values, lambda a: F.when(F.size(a) > RUN, whole(a)).otherwise(_appended(a, combine, zero, kind)))


def located(text: Column, pattern: str, found: Column) -> Column:
    """Where the strings of :func:`all_matches` lie: array of (s, e, m) in code points.

    What lies between matches comes from splitting by the same pattern, so
    positions are running sums of lengths; a text without match isn't split.
    """
    steps = F.arrays_zip(found.alias("m"), F.slice(F.split(text, pattern, -1), 1, F.size(found)).alias("g"))
    lengths = lambda z: F.transform(z, lambda x: F.length(x["g"]) + F.length(x["m"]))

    def placed(z: Column) -> Column:
        return _let(running(lengths(z), lambda a, b: a + b, 0), lambda ends: F.transform(
            z, lambda x, i: F.struct((F.get(ends, i) - F.length(x["m"])).alias("s"), F.get(ends, i).alias("e"), x["m"].alias("m"))
        ))

    nothing = F.array().cast("array<struct<s:int,e:int,m:string>>")
    return F.when(F.size(found) > 0, _let(steps, placed)).otherwise(nothing)


def apart_from(runs: Column, base: Column) -> Column:
    """The runs (sorted (s, e, m)) that touch no base span (sorted (start, ord, end, kind)).

    Both are merged by start; a run touches a span if one that starts before ends
    later than the run's start, or if the next one starts before its end.
    """
    far = F.lit(2147483647)
    spans = F.transform(base, lambda b: F.struct(b["start"].alias("s"), F.lit(0).alias("run"), b["end"].alias("e"), F.lit("").alias("m")))
    every = F.array_sort(F.concat(spans, F.transform(runs, lambda x: F.struct(x["s"].alias("s"), F.lit(1).alias("run"), x["e"].alias("e"), x["m"].alias("m")))))

    def clear(a: Column) -> Column:
        ends = running(F.transform(a, lambda x: F.when(x["run"] == 0, x["e"]).otherwise(0)), F.greatest, 0)
        begins = F.reverse(running(F.transform(F.reverse(a), lambda x: F.when(x["run"] == 0, x["s"]).otherwise(far)), F.least, 2147483647))
        kept = _let(ends, lambda e: _let(begins, lambda s: F.filter(a, lambda x, i: (x["run"] == 1) & (F.get(e, i) <= x["s"]) & (F.get(s, i) >= x["e"]))))
        return F.transform(kept, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m")))

    return F.when((F.size(base) == 0) | (F.size(runs) == 0), runs).otherwise(_let(every, clear))


_SPAN = "array<struct<start:int,ord:int,end:int,kind:string>>"


def _spans(found: Column, order: int, kind: str) -> Column:
    return F.transform(found, lambda x: F.struct(
        x["s"].alias("start"), F.lit(order).alias("ord"), x["e"].alias("end"), F.lit(kind).alias("kind")
    )).cast(_SPAN)


def scan(df: DataFrame, model: list[float], text_col: str = "text", into: str = "spans", base_into: str = "base_spans") -> DataFrame:
    """Adds two arrays of (start, ord, end, kind): base spans, and all spans.

    Positions are code points, end exclusive; both are sorted by start, then by
    kind as listed. Null text counts as empty: no spans. Other columns stay; a
    column that has one of the two names is replaced.
    """
    own = "__found"  # a name that no column begins with
    while any(c.startswith(own) for c in df.columns):
        own += "_"
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # columns of their own, so each pattern runs over a text once
    held = {f"{own}{i}": all_matches(text, p) for i, p in enumerate([*(b[1] for b in BASE), CANDIDATE])}
    df = df.withColumns(held)
    by_kind = []
    for order, (kind, pattern, group, least) in enumerate(BASE):
        found = located(text, pattern, F.col(f"{own}{order}"))
        if group:
            found = F.filter(found, lambda x: F.length(F.regexp_extract(x["m"], pattern, group)) >= least)
        elif kind == "access":
            found = F.filter(found, lambda x: F.length(x["m"]) >= least)
        by_kind.append(_spans(found, order, kind))
    base = F.array_sort(F.concat(*by_kind))
    out = df.withColumn(base_into, base)
    ratio = _constant(model)
    runs = F.filter(located(text, CANDIDATE, F.col(f"{own}{len(BASE)}")), lambda x: log_ratio(x["m"], ratio) > THRESHOLD)
    apart = apart_from(runs, F.col(base_into))
    return out.withColumn(into, F.array_sort(F.concat(F.col(base_into), _spans(apart, len(BASE), "markov")))).drop(*held)


def listed(spans: str) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


#: Code points of the blocks that a text is cut into, by levels, before pieces are taken of it.
BLOCKS = (1 << 20, 1 << 15, 1 << 10)


def _blocks(text: Column) -> Column:
    """The text in blocks of the last of :data:`BLOCKS` code points; taking one out of a string costs what lies before it."""

    def cut(size: int):
        number = lambda t: F.greatest(F.ceil(F.length(t) / size).cast("int") - 1, F.lit(0))
        return lambda t: F.transform(F.sequence(F.lit(0), number(t)), lambda i: F.substring(t, i * size + 1, F.lit(size)))

    parts = F.array(text)
    for size in BLOCKS:
        parts = F.flatten(F.transform(parts, cut(size)))
    return parts


def _piece(blocks: Column, begin: Column, end: Column) -> Column:
    """Code points ``begin`` to ``end`` (exclusive) of a text in blocks."""
    size = BLOCKS[-1]
    first, last = F.floor(begin / size).cast("int"), F.floor((end - 1) / size).cast("int")
    inside = F.substring(F.get(blocks, first), begin - first * size + 1, end - begin)
    ahead = F.substring(F.get(blocks, first), begin - first * size + 1, F.lit(size))
    behind = F.substring(F.get(blocks, last), F.lit(1), end - last * size)
    across = F.concat(ahead, F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), ""), behind)
    return F.when(end <= begin, "").when(first == last, inside).otherwise(across)


def redact(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span (sorted, may overlap) replaced by the mark.

    Spans that overlap give one mark; work follows the length of the text and the number of spans.
    """

    def masked(at: Column) -> Column:
        before = lambda i: F.when(i == 0, 0).otherwise(F.get(at, i - 1))
        return _let(_blocks(text), lambda b: F.concat(
            F.array_join(F.transform(spans, lambda x, i: F.when(x["start"] >= before(i), F.concat(_piece(b, before(i), x["start"]), F.lit(mark))).otherwise("")), ""),
            _piece(b, F.get(at, F.size(at) - 1), F.length(text)),
        ))

    ends = running(F.transform(spans, lambda x: x["end"]), F.greatest, 0)
    return F.when(F.size(spans) == 0, text).otherwise(_let(ends, masked))


def fit(docs: DataFrame, text_col: str = "text") -> list[float]:
    """The ratios trained on :func:`labelled_samples` of these documents."""
    return train(labelled_samples(docs, text_col))


def scan_documents(docs: DataFrame, model: list[float] | None = None) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov`` of every row."""
    rows = scan(docs.select("doc_id", "text"), model or fit(docs), "text", "_spans", "_base")
    of = lambda col, kind: F.size(F.filter(col, lambda x: x["kind"] == kind)).cast("long")
    return rows.select(
        "doc_id", of("_base", "assign").alias("n_assign"), of("_base", "access").alias("n_access"), of("_base", "hex").alias("n_hex"),
        F.sha2(listed("_base"), 256).alias("base_sha256"), listed("_spans").alias("spans"), of("_spans", "markov").alias("n_markov"),
    )
