"""Changes found by digest trees against comparing all rows."""

import random
from collections import Counter

import pytest

from corpusmill.operators import merkle

SCHEMA = "a long, b string, text string, extra long"


def plain(old, new):
    def by_key(rows):
        out = {}
        for r in rows:
            out.setdefault(r[:2], Counter())[r] += 1
        return out

    x, y = by_key(old), by_key(new)
    return sorted(((*k, "added" if k not in x else "removed" if k not in y else "changed") for k in x.keys() | y.keys() if x.get(k) != y.get(k)), key=repr)


@pytest.mark.parametrize("n, leaf", [(0, 64), (5, 64), (400, 4), (400, 1)])
def test_equals_comparing_all(spark, n, leaf):
    """Null and repeated keys, null values, rows added, removed, changed, repeated once more."""
    rng = random.Random(n + leaf)
    old = [(rng.choice([None, *range(n)]), rng.choice([None, "", "x"]), rng.choice([None, "", "text", "t" * 50]), i) for i in range(n)]
    new = [r for r in old if rng.random() > 0.05]
    new = [(*r[:2], "edited", r[3]) if rng.random() < 0.05 else r for r in new] + [(10_000 + i, "x", None, i) for i in range(n // 20)] + new[:3]
    a, b = (merkle.snapshot(spark.createDataFrame(r, SCHEMA).repartition(3), ["a", "b"], leaf_rows=leaf) for r in (old, new))
    got = merkle.changes(a, b)
    assert got.columns == ["a", "b", "change"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(old, new)


def test_columns_that_count(spark):
    old, new = ([(i, "k", "same", i + d) for i in range(50)] for d in (0, 1))
    a, b = (merkle.snapshot(spark.createDataFrame(r, SCHEMA), ["a"], ["a", "text"]) for r in (old, new))
    assert merkle.changes(a, b).count() == 0


def test_null_is_not_empty(spark):
    a, b = (merkle.snapshot(spark.createDataFrame([(1, x, y, 1)], SCHEMA), ["a"]) for x, y in ((None, "v"), ("v", None)))
    assert [tuple(r) for r in merkle.changes(a, b).collect()] == [(1, "changed")]


def test_reads_follow_changes(spark):
    """Of 20,000 rows some leaves are read for seven changes, none for none; sizes of the trees may differ."""
    old = spark.range(20_000).selectExpr("id AS a", "cast(id % 7 AS string) AS b", "repeat('t', 20) AS text", "id AS extra")
    new = old.where("a <> 77").selectExpr("a", "b", "CASE WHEN a % 4000 = 1 THEN 'new' ELSE text END AS text", "extra").unionByName(old.where("a = 5").selectExpr("a + 90000 AS a", "b", "text", "extra"))
    a, b = merkle.snapshot(old, ["a"], leaf_rows=16), merkle.snapshot(new, ["a"], leaf_rows=400)
    assert (a.levels, b.levels) == (3, 2)
    assert merkle.changes(a, b).count() == 7
    c = merkle.snapshot(new, ["a"], leaf_rows=16)
    nodes = merkle.differing_nodes(a, c)
    read = merkle.rows_below(a, nodes, 3).count()
    assert nodes.count() == 7 and 0 < read < 7 * 16
    same = merkle.differing_nodes(a, merkle.snapshot(old.orderBy("extra"), ["a"], leaf_rows=16))
    assert same.count() == 0 and merkle.rows_below(a, same, 3).count() == 0


def test_scan_skips_folders(spark):
    rows = spark.range(5000).selectExpr("id AS a", "'b' AS b", "'t' AS text", "id AS extra")
    a = merkle.snapshot(rows, ["a"], leaf_rows=16)
    b = merkle.snapshot(rows.where("a <> 3"), ["a"], leaf_rows=16)
    plan = merkle.rows_below(a, merkle.differing_nodes(a, b), 3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(top" in plan or "PartitionFilters: [(top" in plan or "top" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]


def test_stale_reports(spark):
    inputs = spark.createDataFrame([("r", 1), ("r", 2), ("s", 3), ("s", 3), ("t", 9)], "report string, path long")
    changed = spark.createDataFrame([(2, "changed"), (9, "removed"), (3, "added")], "path long, change string")
    assert sorted(map(tuple, merkle.stale(inputs, changed, "report", "path").collect())) == [("r", 2, 1, False), ("s", 1, 0, True), ("t", 1, 1, False)]
