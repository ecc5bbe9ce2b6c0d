"""The record service over a stub client, folders of files, numbering and resuming."""

import os
from contextlib import contextmanager
from datetime import date

import pytest

from rostrum.sources import files, govinfo, ocr
from rostrum.streaming import incremental

from .conftest import rows

CLIENT = "tests.stub_service:make"


@pytest.fixture(scope="module")
def service(spark):
    spark.sparkContext.addPyFile(os.path.join(os.path.dirname(__file__), "stub_service.py"))
    govinfo.register(spark)
    return lambda **options: spark.read.format("record_service").options(client="stub_service:make", **options).load()


def test_listing(service):
    got = service(mode="search", end="2001-02-03", start="2001-02-02", years="1").distinct()
    assert rows(got) == [(d, p, None) for d in ("2001-02-02", "2001-02-03") for p in ("P1", "P2")]
    assert rows(service(mode="published", startYear="1960", end="2001-01-01").select("package_id")) == [("B1960",), ("B1985",)]
    assert rows(service(mode="granules", packages="P1,P2").select("package_id", "granule_id")) == [(p, g) for p in ("P1", "P2") for g in ("G1", "G2")]


def test_fetch_goes_on_over_errors(spark, service):
    keys = spark.createDataFrame([("P1", "G1")], "package_id string, granule_id string")
    got = govinfo.parsed_summary(govinfo.fetch(keys, {"client": "stub_service:make", "apiKeys": "a,b"}))
    row = got.collect()[0]
    assert (row.mods, row.htm, row.dateissued[:10], row.title) == ("", "<html><pre>x</pre></html>", "2001-02-03", "T")
    day = got.withColumn("day", got.dateissued.substr(1, 10))
    assert govinfo.same_day(day, "day").count() == 1


def test_keys_take_turns_and_calls_are_spaced():
    seen, slept = [], []
    client = govinfo.Client(["a", "b"], per_hour=1800, open_url=lambda url, body: seen.append(url[-1]) or b"{}", sleep=slept.append)
    for _ in range(3):
        client.json("/x")
    assert seen == ["a", "b", "a"] and len(slept) == 2 and all(0.5 < s <= 1 for s in slept)


def test_busy_service_is_given_up_after_retries():
    calls = []

    def busy(url, body):
        calls.append(url)
        raise govinfo.TooManyRequests(None)

    with pytest.raises(govinfo.TooManyRequests):
        govinfo.Client(["a"], open_url=busy, sleep=lambda s: None).json("/x")
    assert len(calls) == govinfo.RETRIES + 1


def test_days_and_chunks():
    assert govinfo.days(date(2024, 2, 29), 1)[-1] == date(2023, 2, 28)
    assert govinfo.days(date(2001, 1, 3), 0) == [date(2001, 1, 3)]
    assert govinfo.date_chunks(1960, date(1990, 6, 1)) == [(date(1960, 1, 1), date(1984, 12, 31)), (date(1985, 1, 1), date(1990, 6, 1))]


def test_text_folder(spark, tmp_path):
    (tmp_path / "1901").mkdir()
    (tmp_path / "1901" / "a+b c.TXT").write_bytes(b"one\r\ntwo\rthree\xff")
    (tmp_path / "x.csv").write_text("no")
    assert rows(files.read_texts(spark, str(tmp_path)).select("filename", "folder", "text")) == [("a+b c.TXT", "1901", "one\ntwo\nthree�")]


def test_csv_round_trip(spark, tmp_path):
    data = [("a", 'x "quoted"\nline, two', ""), ("b", "é", "z")]
    files.write_csv(spark.createDataFrame(data, "k string, t string, e string"), str(tmp_path / "out"), one_file=True)
    assert rows(files.read_csv(spark, str(tmp_path / "out"))) == sorted(data)


def test_numbering_counts_only_what_is_there(spark):
    df = spark.createDataFrame([("d", "G10", "h", None), ("d", "G2", "", "m"), ("d", "G3", "h", "m"), ("e", "G1", None, "")], "day string, gid string, html string, mods string")
    got = files.number_granules(df, "day", "gid", {"html": "html", "mods": "xml"}).select("gid", "html_file", "mods_file")
    assert rows(got) == [("G1", None, None), ("G10", "1-G10.html", None), ("G2", None, "1-G2.xml"), ("G3", "2-G3.html", "2-G3.xml")]
    named = files.number_in_year(df, "day", ["gid"], "day", "gid", "html").select("file_name")
    assert ("1-h-d_G10",) in rows(named)


def test_resume(spark):
    jobs = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    done = spark.createDataFrame([(2,), (2,)], "k int")
    assert rows(files.not_done(jobs, done, ["k"])) == [(1,), (3,)]
    assert rows(files.merge_previous(done.distinct(), jobs, ["k"])) == [(1,), (2,), (3,)]


class FakeEngine:
    @contextmanager
    def open(self, content):
        if content == b"bad":
            raise ValueError

        def text(page):
            if page == 2:
                raise ValueError
            return f"page {page}"

        yield 3, text


def test_ocr_skips_failed_pages_and_files(spark, tmp_path):
    (tmp_path / "1950").mkdir()
    (tmp_path / "1950" / "a.pdf").write_bytes(b"ok")
    (tmp_path / "1950" / "b.pdf").write_bytes(b"bad")
    (tmp_path / "c.pdf").write_bytes(b"no year")
    spark.sparkContext.addPyFile(__file__)
    got = ocr.read_pages(files.read_scans(spark, str(tmp_path)), FakeEngine()).select("year", "text")
    assert rows(got) == [(1950, "page 1\n\npage 3")]


def test_new_files_are_segmented_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for name in ("a.txt", "b.txt"):
        (source / name).write_text("Mr. SMITH. I rise.\r\n")
        incremental.follow(spark, str(source), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("speaker", "speech")) == [("Mr. SMITH", "I rise.")] * 2


def test_acquisition_and_command_line(spark, service, tmp_path):
    from rostrum import cli
    from rostrum.plans import acquire

    options = {"client": "stub_service:make", "end": "2001-02-03", "start": "2001-02-02", "years": "1"}
    got = acquire.daily_granules(spark, options, tasks=2)
    # summaries name 3 February; records can't be fetched
    assert rows(got.select("day", "package_id", "granule_id", "htm_file", "mods_file")) == [
        ("2001-02-03", "P1", "G1", "1-G1.html", None), ("2001-02-03", "P1", "G2", "3-G2.html", None),
        ("2001-02-03", "P2", "G1", "2-G1.html", None), ("2001-02-03", "P2", "G2", "4-G2.html", None),
    ]
    out = tmp_path / "bound"
    counts = cli.main(["crecb", str(out), "--api-keys", "a,b", "--start-year", "2020", "--client", "stub_service:make"])
    assert counts["granules"] == counts["pdf"] == 2 and counts["mods"] == 0
    assert sorted(p.name for p in (out / "2001" / "raw_pdf_2001").iterdir()) == ["1-T-B2020_G1.pdf", "2-T-B2020_G2.pdf"]


def test_stages_from_the_command_line(spark, tmp_path):
    from rostrum import cli

    source = tmp_path / "in" / "1901"
    source.mkdir(parents=True)
    (source / "Record May 4, 1901.txt").write_text("SENATE\n\nTHE TARIFF BILL AND MORE\n\n  Mr. SMITH. I rise.\nTHE TARIFF BILL AND MORE\n  Mr. JONES. Yes.\n")
    (source / "undated.txt").write_text("  Mr. SMITH. No.\n")
    counts = cli.main(["preclean", str(tmp_path / "in"), str(tmp_path / "clean")])
    assert counts["texts"] == 2 and counts["lines_removed"] == 1
    assert "SENATE" not in (tmp_path / "clean" / "texts" / "1901" / "Record May 4, 1901.txt").read_text()
    log = files.read_csv(spark, str(tmp_path / "clean" / "removed_lines"))
    assert [r.log for r in log.collect()] == ["1901__Record May 4, 1901.txt.removed.tsv"]
    counts = cli.main(["speeches", str(tmp_path / "clean" / "texts"), str(tmp_path / "speeches")])
    assert counts == {"speeches": 2, "undated": 1}
    assert rows(files.read_csv(spark, str(tmp_path / "speeches_quarantine"))) == [("undated.txt", "1901", "no date in the file name")]
    assert cli.main(["debates", str(tmp_path / "speeches"), str(tmp_path / "debates")]) == {"speeches": 2}
    titled = files.read_csv(spark, str(tmp_path / "debates"))
    assert rows(titled.select("speaker", "title")) == [("Mr. JONES", "THE TARIFF BILL AND MORE"), ("Mr. SMITH", "")]


def test_limit_is_shared_by_the_tasks():
    reader = govinfo.RecordServiceReader({"mode": "granules", "packages": "a,b,c,d", "apiKeys": "k", "perHour": "3600"})
    parts = reader.partitions()
    assert [p.tasks for p in parts] == [4] * 4
    assert govinfo._client(reader.options, 0, parts[0].tasks).gap == 4.0
