"""Records, pages, text functions, and the pipelines end to end on small tables."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from rostrum.functions import text as T
from rostrum.operators import metadata
from rostrum.plans import catalog, pipelines

from .conftest import rows

RECORD = """<mods xmlns="u"><titleInfo><title> A Title </title></titleInfo><extension>
<congMember role="speaking" bioGuideId="B1" party="D" state="OH" chamber="H"><name type="parsed">Mr. SMITH</name><name type="authority-fnf">John Smith</name></congMember>
<congMember role="MENTIONED"><name type="parsed">Ms. X</name></congMember><congMember role="SPEAKING"><name type="other">no</name></congMember></extension></mods>"""


def test_records(spark):
    members, title = metadata.parse_record(RECORD)
    assert title == "A Title" and members == [(0, "Mr. SMITH", "B1", "John Smith", "D", "OH", "H")]
    for bad in (None, "", "<mods", "<a><b></a>"):
        assert metadata.parse_record(bad) == ([], "")
    df = spark.createDataFrame([(1, RECORD), (2, "<mods"), (3, None)], "id int, xml string")
    assert rows(metadata.speaking_members(df, ["id"], "xml").select("id", "parsed_name")) == [(1, "Mr. SMITH")]
    assert rows(metadata.record_titles(df, ["id"], "xml")) == [(1, "A Title"), (2, ""), (3, "")]


def test_pre_blocks():
    assert metadata.pre_blocks("<html><pre>a &amp; b</pre><PRE> </PRE><pre>c<b>d</b></pre></html>") == ["a & b", "cd"]
    assert metadata.pre_blocks(None) == metadata.pre_blocks("<p>x</p>") == []


def test_day_text_order_and_index(spark):
    pages = [("d", "10-G10.html", "<pre>ten</pre>"), ("d", "2-G2.html", "<pre>two</pre><pre>more</pre>"), ("d", "x-G.html", "<pre>last</pre>"), ("d", "1-G1.html", "<p/>")]
    row = metadata.day_texts(spark.createDataFrame(pages, "day string, filename string, html string"), "day", "filename", "html").collect()[0]
    assert [f.filename for f in row.files] == ["2-G2.html", "2-G2.html", "10-G10.html", "x-G.html"]
    assert all(row.text[f.start :].startswith("=== FILE: " + f.filename) for f in row.files)


def test_chamber_marker_starts_at_the_blank_lines_before(spark):
    df = spark.createDataFrame([(1, "text\n\n\nHOUSE\nx\nSENATE of\nSENATE")], "id int, text string")
    assert rows(metadata.chamber_markers(df, "id", "text").select("offset", "chamber")) == [(25, "S"), (5, "H")]


@pytest.mark.parametrize(
    "name, want",
    [
        ("1-Monday, May 4, 1925-x", date(1925, 5, 4)),
        ("MAY 4, 1925", date(1925, 5, 4)),
        ("Sept 4, 1925", None),
        ("February 30, 1925", None),
        ("Act 5, 1925 May 4, 1925", None),
        ("none", None),
    ],
)
def test_filename_dates(spark, name, want):
    assert spark.createDataFrame([(name,)], "f string").select(T.filename_date("f")).collect()[0][0] == want


def test_small_functions(spark):
    row = spark.createDataFrame(
        [("a\r\nb\x0cc\x85d\n", "\xa0 x\x1c ", "raw_1950/x/1950/y 2001", "2-CREC-pt1-PgH5-PgS.html", "GPO-CRECB-1950-pt12")],
        "a string, b string, c string, d string, e string",
    ).select(
        T.splitlines("a"), T.strip("b"), T.year_in_path("c"), T.granule_of_filename("d"), T.chamber_of_granule("d"), T.package_year("e"), T.package_part("e"),
        T.sanitize_filename(F.lit('a\\/*?:"<>|b')), T.gender(F.lit("Mrs. X")), T.gender(F.lit("Miss X")), T.decade(F.to_date(F.lit("1959-01-01"))),
    ).collect()[0]
    assert list(row) == [["a", "b", "c", "d"], "x", 1950, "CREC-pt1-PgH5-PgS", "H", 1950, 12, "ab", "F", "", "1950s"]


def test_daily_pipeline(spark):
    html = "<pre>\n  Mr. SMITH. First.\n  Ms. JONES. Second.\n</pre>"
    pages = spark.createDataFrame([(date(2001, 2, 3), "1-CREC-PgH1.html", html), (date(2001, 2, 3), "2-CREC-PgS2.html", "<pre>\n  Mr. SMITH. Third.\n</pre>")], "day date, filename string, html string")
    records = spark.createDataFrame([(date(2001, 2, 3), 1, RECORD)], "issue_day date, file_index int, mods_xml string")
    members = pipelines.members_of_records(records, ["issue_day", "file_index"])
    titles = pipelines.titles_of_granules(spark.createDataFrame([("CREC-PgH1", "old", 1), ("CREC-PgH1", "new", 2)], "granule_id string, title string, loaded_at int"))
    for way in ("exact", "compat"):
        got = pipelines.daily(pages, members, titles, way)
        assert got.columns == pipelines.CREC_COLUMNS
        assert rows(got.select("granule_id", "title", "speaker", "bioGuideId", "gender", "chamber")) == [
            ("CREC-PgH1", "new", "Mr. SMITH", "B1", "M", "H"),
            ("CREC-PgH1", "new", "Ms. JONES", "", "F", "H"),
            ("CREC-PgS2", "", "Mr. SMITH", "B1", "M", "S"),
        ]
    exact = pipelines.daily(pages, members, titles, "exact").select("text")
    assert rows(exact) == [("First.",), ("Second.",), ("Third.",)]


def test_bound_pipeline(spark):
    text = "HOUSE\nTHE TARIFF ACT OF 1890\n\nMr. SMITH. First.\nSENATE\nMs. JONES. Second."
    texts = spark.createDataFrame([("Monday, May 4, 1925", "1925", text), ("undated", "1925", text)], "filename string, folder string, text string")
    got = pipelines.bound(texts)
    assert rows(got.select("speaker", "date", "decade", "gender", "chamber", "speech")) == [
        ("Mr. SMITH", "1925-05-04", "1920s", "M", "H", "First."),
        ("Ms. JONES", "1925-05-04", "1920s", "F", "H", "Second."),
    ]
    raw = pipelines.bound(texts, chamber_source="raw")
    assert "S" in {r.chamber for r in raw.collect()} or raw.count() == 2


def test_catalog_names_and_oracles():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)
    assert catalog.FLAGSHIP in catalog.QUERIES
