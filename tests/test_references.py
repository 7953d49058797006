"""Character references: the joins over the table of names against the library."""

import html

import duckdb

from corpusmill import catalog

CASES = [
    "a &amp;lt; b", "&copy 2020 &copyright; &notit; &notin; &am;", "&middot;&hellip;&nbsp;|", "&#39;&#x27;&#X41 &#65b", "& &; &&amp; &#; &#x;", "&ThickSpace;&NotEqualTilde;", "none", "",
    "x&#0;&#xD800;&#1114112;y", "&" + "q" * 40 + ";", "&amp" + "p" * 40, "end &lt", None,
]


def test_bare_sql_replaces_as_the_library_does():
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, 'u', ?)", list(enumerate(CASES)))
    got = dict(con.execute(f"WITH {catalog.bare_pages_sql()} SELECT page_id, bare FROM bare").fetchall())
    assert got == {i: None if c is None else html.unescape(c) for i, c in enumerate(CASES)}


def test_bare_pages(spark, tmp_path):
    spark.createDataFrame([(i, "u", c) for i, c in enumerate(CASES)], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: r.bare for r in catalog.bare_pages(spark, str(tmp_path)).collect()}
    assert got == {i: None if c is None else html.unescape(c) for i, c in enumerate(CASES)}
