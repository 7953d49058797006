"""Levels of coverage and distinct counts against counting by hand."""

import random
from itertools import product

from corpusmill.operators import coverage


def test_levels_equal_counting(spark):
    rng = random.Random(1)
    leaves = [("a", "x"), ("a", "y"), ("b", "z")]
    domain = [(p, s, t) for (p, s), t in product(leaves, ("u", "v"))]
    rows = [(*rng.choice(domain[:4]), i) for i in range(30)] + [("a", "none", "u", 1), (None, None, None, 2)]
    got = coverage.levels(spark.createDataFrame(rows, "p string, s string, t string, i int"), spark.createDataFrame(domain, "p string, s string, t string"), ["p", "s"], ["t"])
    want = []
    for keys, level in ((("p", "s", "t"), 0), (("p", "s"), 1), (("p", "t"), 2), (("p",), 3), (("t",), 6), ((), 7)):
        at = ["p", "s", "t"]
        cut = lambda d: tuple(v if k in keys else None for k, v in zip(at, d))
        for g in {cut(d) for d in domain}:
            below = [d for d in domain if cut(d) == g]
            n = [sum(r[:3] == d for r in rows) for d in below]
            want.append((*g, level, sum(n), len(below), n.count(0)))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_bitmaps_are_exact_and_merge(spark):
    rng = random.Random(2)
    rows = [("t", rng.randrange(6), rng.choice([0, 32767, 32768, 5_000_000_000, *range(50)])) for _ in range(400)] + [("u", 1, None), ("u", 1, -4), ("u", 2, 7)]
    df = spark.createDataFrame(rows, "topic string, round int, id long")
    whole = coverage.round_bitmaps(df, "topic", "round", "id")
    parts = coverage.merged_bitmaps(coverage.round_bitmaps(df.where("id % 3 = 0"), "topic", "round", "id"), coverage.round_bitmaps(df.where("id % 3 <> 0 OR id = 0"), "topic", "round", "id"), "topic", "round")
    want, seen = [], {}
    for topic, r in sorted({(t, r) for t, r, i in rows if i is not None and i >= 0}):
        ids = {i for t, q, i in rows if (t, q) == (topic, r) and i is not None and i >= 0}
        old = seen.setdefault(topic, set())
        want.append((topic, r, len(ids), len(ids - old), len(ids | old)))
        old |= ids
    for bits in (whole, parts):
        assert sorted(map(tuple, coverage.distinct_over_rounds(bits, "topic", "round").collect())) == want


def test_sketch_error(spark):
    """Unions of stored sketches are within three standard errors (1.6 % each) of the truth."""
    df = spark.range(60_000).selectExpr("'t' AS topic", "cast(id % 5 AS int) AS round", "concat('u', id div 2) AS id")
    halves = [coverage.round_sketches(df.where(f"round % 2 = {k}"), "topic", "round", "id") for k in (0, 1)]
    rows = {r.round: r.estimate for r in coverage.estimated_over_rounds(coverage.merged_sketches(*halves, "topic", "round"), "topic", "round").collect()}
    truth = {k: df.where(f"round <= {k}").select("id").distinct().count() for k in range(5)}
    assert all(abs(rows[k] - truth[k]) <= 3 * 0.0163 * truth[k] for k in truth)
