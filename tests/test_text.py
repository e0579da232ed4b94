"""Scalars against plain Python, on chosen traps and on generated texts."""

from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions import html as H
from quarry.functions import text as X
from quarry.functions import urls as U
from quarry.operators import chunking


def column(spark, values, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", expr.alias("o")).collect()
    return [r["o"] for r in sorted(rows)]


TRICKY = ["", "  a  b\x1c\t", "É été 2019é 2019", "İstanbul I", "a b", "x" * 400 + " the end", "BENE_ID: Beneficiary id, also known as bene or BID, 2019; 2020."]


def test_collapse_and_strip_follow_python(spark):
    assert column(spark, TRICKY, X.collapse(F.col("v"))) == [re.sub(r"\s+", " ", v).strip() for v in TRICKY]
    assert column(spark, TRICKY, X.strip(F.col("v"))) == [v.strip() for v in TRICKY]


def test_tokens_follow_python(spark):
    assert column(spark, TRICKY, X.tokens(F.col("v"))) == [re.findall(r"[a-z0-9_]+", v.lower()) for v in TRICKY]


def test_lines_follow_splitlines(spark):
    values = ["a\nb\r\nc\rd\x0be\x0cf\x1cg\x1dh\x1ei\x85j k l", "", "\n\n x \n"]
    want = [[s for s in (re.sub(r"\s+", " ", x).strip() for x in v.splitlines()) if s] for v in values]
    assert column(spark, values, X.lines(F.col("v"))) == want


def test_slug(spark):
    assert column(spark, ["A b", "--", "É", "x_y.Z"], X.slug(F.col("v"))) == ["a-b", "unknown", "unknown", "x-y-z"]


@pytest.mark.parametrize(
    "line,name,want",
    [
        ("BENE_ID: Beneficiary id.", "BENE_ID", "Beneficiary id"),
        ("BENE_ID - the id", "BENE_ID", "the id"),
        ("BENE_ID means the id", "BENE_ID", "the id"),
        ("BENE_ID:id", "BENE_ID", None),
        ("BENE_ID", "BENE_ID", None),
        ("XBENE_ID BENE_ID = v", "BENE_ID", "v"),
        ("BENE_ID is ;", "BENE_ID", ""),
    ],
)
def test_definition(spark, line, name, want):
    assert column(spark, [line], X.definition(F.col("v"), F.lit(name)))[0] == want


def test_aliases_and_years(spark):
    line = "A_B: x, also known as bene id, BID or 2019. In 2020 and 1850 and 2020, formerly OLD_B;"
    assert column(spark, [line], X.aliases(F.col("v"))) == ["BID|OLD_B|bene id"]
    assert column(spark, [line], X.years(F.col("v"))) == ["2019|2020"]
    assert column(spark, ["é2019"], X.years(F.col("v"))) == [""]


def test_snippet(spark):
    text = "x " * 100 + "needle" + " y" * 200
    got = column(spark, [text, "short  text"], X.snippet(F.col("v"), ["needle"]))
    assert got[1] == "short text" and got[0].startswith("...") and got[0].endswith("...") and "needle" in got[0]


def test_safe_ids(spark):
    got = column(spark, ["ok-1", " ", "../x", ".x", "a/b", "a\n"], X.safe_id_error("dataset_id", F.col("v")))
    assert got[0] == "" and got[1] == "dataset_id must not be empty" and all("unsafe" in g for g in got[2:])


URLS = ["HTTP://WWW.Ex.org/A/b/?q=1#f", "https://ex.org/", "https://ex.org//", "https://ex.org/a;p?x", "ftp://ex.org", "https://ex.org/a?", "relative/x"]


def test_normalized_follows_the_parser(spark):
    whole = [u for u in URLS if "://" in u]
    assert column(spark, whole, U.normalized(F.col("v"))) == [U.resolve("", u) for u in whole]


def test_resolved_links(spark):
    df = spark.createDataFrame([("https://www.ex.org/a/b", "../c/"), ("https://ex.org/a", "//Other.org/x"), ("https://ex.org", "http://[bad")], "b string, h string")
    assert [r[0] for r in df.select(U.resolved("b", "h")).collect()] == ["https://ex.org/c", "https://other.org/x", None]


def test_relevant_links(spark):
    base = F.lit("https://www.ex.org/cms-data")
    got = column(spark, ["https://ex.org/cms-data/files/a", "https://other.org/cms-data/files/a", "https://other.org/x.PDF", "mailto:x.pdf", "https://ex.org/about"], U.is_relevant(base, F.col("v")))
    assert got == [True, False, True, False, False]


def test_archive_guard():
    assert U.archive_url_error("file:///etc/passwd") == U.NOT_HTTP
    assert all(U.archive_url_error(f"http://{h}/x") == U.PRIVATE for h in ("localhost", "127.0.0.1", "10.1.2.3", "169.254.1.1", "[::1]", "0.0.0.0", "224.0.0.1"))
    assert U.archive_url_error("https://8.8.8.8/x") == ""


def test_link_states(spark):
    df = spark.createDataFrame([(s,) for s in (None, 0, 200, 399, 404, 429, 503)], "s int")
    assert [r[0] for r in df.select(U.link_state(F.col("s"))).collect()] == ["unknown", "unknown", "live", "live", "dead", "unknown", "unknown"]


def test_pages():
    p = H.Page('<title>A &amp; B\n</title><h1>H</h1><a href="/x"> one <b>two</b></a><a>no</a><div class="views-field views-field-field-availability"><div class="field-content"> now </div></div>')
    assert (p.title, p.links, p.hrefs, p.fields["availability"]) == ("A & B", [("/x", "one two")], ["/x"], "now")
    assert H.Page("<h1>Only</h1>").title == "Only"
    assert H.main_text("<nav>n</nav><p>One <b>two</b></p><script>x</script><table><tr><td>a</td><td>b</td></tr></table><!-- c -->") == "One two\na | b"


def test_chunk_limits():
    for size, overlap in ((0, 0), (10, 10), (10, -1)):
        with pytest.raises(ValueError):
            chunking.chunks_of("text", size, overlap)
    assert chunking.chunks_of(" \n ") == [] and chunking.chunks_of("short") == ["short"]
    got = chunking.chunks_of("This is a sentence that is fifty characters long..", 20, 5)
    assert got[0] == "This is a sentence" and all(len(c) <= 20 for c in got)
    assert list(chunking.bounds("", 5, 1)) == [] and list(chunking.bounds("abcdefghij", 4, 1)) == [(0, 4), (3, 7), (6, 10)]
    assert list(chunking.bounds("ab cd ef gh", 5, 3)) == [(0, 2), (3, 5), (6, 11)]


@settings(max_examples=200, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.text("ab \n\tc", max_size=400), st.integers(1, 60), st.data())
def test_chunks_are_pieces_of_the_text(text, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    flat = re.sub(r"\s", "", text)
    chunks = chunking.chunks_of(text, size, overlap)
    assert all(len(c) <= size and c == c.strip() and c for c in chunks)
    assert all(re.sub(r"\s", "", c) in flat for c in chunks)
