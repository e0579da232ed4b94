"""Every query of the engine against its SQL in DuckDB, at the smallest scale."""

from __future__ import annotations

import duckdb
import pytest

from quarry import queries as Q

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def ordered(columns, rows):
    names = sorted(columns)
    return sorted(repr([r[columns.index(n)] for n in names]) for r in rows)


@pytest.mark.parametrize("name", list(Q.QUERIES))
def test_query(spark, sf, duck, name):
    df = Q.QUERIES[name](spark, sf)
    got = ordered(df.columns, [tuple(r) for r in df.collect()])
    if name in Q.SQL:
        want = duck.sql(Q.SQL[name])
        assert sorted(want.columns) == sorted(df.columns)
        assert got == ordered(want.columns, want.fetchall())
    else:
        assert got


def test_plans_read_and_move_little(spark, sf):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    best = plan(Q.bm25_topk(spark, sf))
    assert "TakeOrderedAndProject" in best and "SortMergeJoin" not in best and "Python" not in best
    assert "Exchange hashpartitioning" not in best  # scores need no shuffle but the sums of the statistics
    assert "lang" not in plan(Q.token_stats(spark, sf)).split("ReadSchema")[1].splitlines()[0]
    variables = plan(Q.variable_definitions(spark, sf))
    assert "Python" not in variables and variables.count("Exchange hashpartitioning") <= 2


def test_titles_are_the_sqls_on_odd_pages(spark, tmp_path):
    titles = ["and&amp;&amp", "&amp;lt; &lt;b&gt; &quot;x&quot;", "&#39;&nbsp;&copy;", "\xa0 a\xa0\u3000b\x0bc\x85 \t\n\f\rd \u2003", "\x1c\u200bx\u2028", "", " ", "a<b>c</b>", "&lt", "&AMP;"]
    pages = [f"<html><title>{t}</title><h1>Head</h1></html>" for t in titles]
    pages += [None, "", "<h1>Only</h1>", "<TITLE>Big</TITLE>", "<title lang='en'>A</title><title>B</title>", "<title></title><title>C</title>", "<title>open", "<title>a<b</title>\n<title>\nd\n</title>"]
    spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert {tuple(r) for r in Q.page_titles(spark, str(tmp_path)).collect()} == set(con.sql("SELECT page_id, title FROM (" + Q.SQL["page_titles"] + ")").fetchall())
