"""The fold over sorted rows against the rule applied in a loop."""

import random

from corpusmill.operators import independence

SCHEMA = "card string, ord long, url string, original_source_id string, reason string"


def plain(rows):
    """Keys as the table functions name them, for the hosts used here."""
    out, state = {}, {}
    for card, ord_, url, original, _ in sorted(rows, key=lambda r: (r[0] or "", r[1], r[2] or "", r[3] or "")):
        keys, domains = state.setdefault(card, (set(), set()))
        domain = url.split("/")[2].removeprefix("www.") if url else ""
        article = f"arxiv:{url.rsplit('/', 1)[1]}" if domain == "arxiv.org" else None
        key = f"original:{original.strip().lower()}" if original else article or (f"domain:{domain}" if domain else None)
        if not key:
            why = "no_key"
        elif key in keys:
            why = "key"
        elif domain and domain in domains and not article:
            why = "domain"
        else:
            why = None
            keys.add(key)
            if domain:
                domains.add(domain)
        out.setdefault(card, []).append((ord_, why))
    return out


def test_fold_equals_loop(spark):
    rng = random.Random(4)
    urls = ["https://www.a.com/1", "https://a.com/2", "https://b.org/x", "https://arxiv.org/abs/2401.1", "https://arxiv.org/abs/2401.2", None, "https://c.net/"]
    rows = [(rng.choice(["p", "q", None]), i, rng.choice(urls), rng.choice([None, None, "O1", " o1 ", "o2", ""]), "own") for i in range(400)]
    rows += [("hot", i, "https://www.a.com/1", None, "own") for i in range(5000)]  # one domain holds most rows
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        df = spark.createDataFrame(rows, SCHEMA).drop("reason").repartition(5)
        got = {}
        for r in independence.judged(df).collect():
            got.setdefault(r.card, []).append((r.ord, r.reason))
            assert r.independent == (r.reason is None)
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in plain(rows).items()}
        hot = independence.groups(df).where("card = 'hot'").first()
        assert (hot.n_sources, hot.groups, hot.n_domain + hot.n_key) == (5000, 1, 4999)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert independence.groups(df.limit(0)).count() == 0


def test_order_decides(spark):
    a, b = ("https://a.com/", "o1"), ("https://b.com/", "o1")
    c = ("https://a.com/x", None)
    both = {}
    for name, order in (("first", (a, b, c)), ("last", (c, b, a))):
        df = spark.createDataFrame([("p", i, u, o) for i, (u, o) in enumerate(order)], "card string, ord long, url string, original_source_id string")
        both[name] = independence.groups(df).first().groups
    assert both == {"first": 1, "last": 2}
