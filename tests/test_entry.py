"""Every query with SQL gives the rows that DuckDB gives."""

import glob
import math
import os

import pytest

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NAMES = list(entry.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def _plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float)) or hasattr(v, "as_tuple"):
        return None if math.isnan(float(v)) else round(float(v), 9)
    return v


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(_plain(v) for v in r) for r in df.select(*cols).collect()), key=repr)
    found = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == cols
    want = sorted((tuple(_plain(r[names.index(c)]) for c in cols) for r in found.fetchall()), key=repr)
    assert got == want


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
