"""Label grammars, end markers and the segmentation of both dialects."""

import random

import pytest
from pyspark.sql import functions as F

from rostrum.operators import metadata, segment
from rostrum.operators.segment import DIALECTS, joined_labels, speeches, without_notes

from .conftest import rows

DAILY, BOUND = DIALECTS["daily"], DIALECTS["bound"]


def labels(text, dialect=DAILY):
    return [label for label, _, _ in speeches(text, dialect)]


@pytest.mark.parametrize(
    "text, want",
    [
        ("  Mr. SMITH. I rise.", ["Mr. SMITH"]),
        (" Ms. DE LEON of New York. I rise.", ["Ms. DE LEON of New York"]),
        ("   Mr. SMITH. I rise.", []),
        ("Mr. SMITH. I rise.", []),
        ("\nMr. SMITH. I rise.", ["Mr. SMITH"]),
        ("text\nMr. SMITH. I rise.", []),
        ("  Mr. SMITH (during the vote). I rise.", ["Mr. SMITH (during the vote)"]),
        ("  Mr. SMITH [continuing]. I rise.", ["Mr. SMITH [continuing]"]),
        ("  Mr. VAN\nHOLLEN. I rise.", ["Mr. VAN\nHOLLEN"]),
        ("  The SPEAKER pro tempore. Order.", ["The SPEAKER pro tempore"]),
        ("  The PRESIDENT. Order.", []),
        ("  Mr. President. I rise.", ["Mr. President"]),
        ("  Mr. José. I rise.", []),
        ("  HON. J. P. SMITH-JONES. I rise.", ["HON. J. P. SMITH-JONES"]),
        ("  Mr, SMITH. I rise.", ["Mr, SMITH"]),
        ("  Mr; SMITH. I rise.", []),
    ],
)
def test_daily_labels(text, want):
    assert labels(text) == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("Mr.SMITH. I rise.", ["Mr.SMITH"]),
        ("Mr: SMITH. I rise.", ["Mr: SMITH"]),
        ("Fhe SPEARER. Order.", ["Fhe SPEARER"]),
        ("The WICE PRESIDENT. Order.", ["The WICE PRESIDENT"]),
        ("The PRESIDINGOFFICER. Order.", ["The PRESIDINGOFFICER"]),
        (" Miss SMI-\nTHERS. I rise.", ["Miss SMITHERS"]),
        (" Mr.SMI-\nTHERS. I rise.", ["Mr.SMITHERS"]),
        (" Mr. SMI-\nTHERS. I rise.", []),
        ("The PRESIDENT. Order.", []),
    ],
)
def test_bound_labels(text, want):
    assert labels(text, BOUND) == want


def test_joined_label_keeps_the_rest_of_the_line():
    assert joined_labels(" Miss SMI-\nTHERS. I rise.\nMore", BOUND) == " Miss SMITHERS.\n I rise.\nMore"


@pytest.mark.parametrize(
    "end",
    ["____", "  ----  ", "[Congressional Record Volume 1]", "\n      A Deep Title", " " * 16 + "May 4, 1999.", "====="],
)
def test_end_markers_close_a_speech(end):
    found = speeches(f"  Mr. SMITH. I rise.\n{end}\nlost\n  Ms. JONES. And I.", DAILY)
    assert [(a, b) for a, b, _ in found][0] == ("Mr. SMITH", "I rise.")
    assert found[-1][:2] == ("Ms. JONES", "And I.") or end == "====="


@pytest.mark.parametrize(
    "line, ends",
    [("\n   A Title", True), ("\n   a title", False), ("\n   Half title", True), ("text\n   A Title", False), ("\n  A Title", False), ("\n\t\tA Title", True)],
)
def test_indented_titles(line, ends):
    found = speeches(f"  Mr. SMITH. I rise.\n{line}\nmore", DAILY)[0][1]
    assert ("more" not in found) == ends


def test_notes_are_stripped_in_pairs_and_to_the_end_when_odd():
    assert without_notes("a\n=====\nb\n=====\nc") == "a\n=====\n=====\nc"
    assert without_notes("a\n=====\nb\nc") == "a\n=====\n"


def test_cleaning_order_and_tags_over_lines():
    text = "  Mr. SMITH. One (Mr. X asked and was given permission to go) two {time} 1045 [Roll No. 5] [[Page H12]] a < b\nand c > d --- e"
    assert speeches(text, DAILY)[0][1] == "One two    a  d  e"


def test_empty_speech_is_kept():
    assert [b for _, b, _ in speeches("  Mr. SMITH.\n  Ms. JONES. Yes.", DAILY)] == ["", "Yes."]


def fold(events, end):
    """The state machine the event table stands for."""
    out, current = [], None
    for start, kind, stop in events:
        if current is not None:
            out.append((current[0], current[1], max(current[1], start)))
            current = None
        if kind == 0:
            current = (start, stop)
    if current is not None:
        out.append((current[0], current[1], end))
    return out


def test_segments_equal_the_fold():
    draw = random.Random(3)
    for _ in range(500):
        events = sorted((draw.randrange(60), draw.choice((0, 0, 1, 3)), 0) for _ in range(draw.randrange(1, 12)))
        events = [(s, k, s + 4 if k == 0 else 0) for s, k, _ in events]
        direct = [(s, e, max(e, n[0])) for (s, k, e), n in zip(events, [*events[1:], (80, 9, 0)], strict=True) if k == 0]
        assert direct == fold(events, 80)


def test_operator_over_rows(spark):
    df = spark.createDataFrame([(1, "  Mr. SMITH. I rise.", 5), (2, None, 6), (3, "", 7), (4, "no label", 8)], "id long, text string, speaker int")
    got = [tuple(r) for r in segment.segment(df, "id", "text").collect()]
    assert got == [(1, 1, "Mr. SMITH", "I rise.", 0)]
    assert segment.segment(df.limit(0), "id", "text").count() == 0


def test_table_function(spark):
    segment.register(spark)
    got = spark.sql("select speaker, speech from scrape_speeches('  Mr. SMITH. I rise.', 'daily')").collect()
    assert [tuple(r) for r in got] == [("Mr. SMITH", "I rise.")]


def test_placed_equals_cursor_and_asof(spark):
    from rostrum.operators.asof import asof_backward, cursor_offsets

    text = "\n HOUSE\n  Mr. SMITH. One.\n\n SENATE \n  Ms. JONES. One.\n  Mr. LEE. (Mr. LEE asked and was given permission to speak) Two.\n"
    df = spark.createDataFrame([("a", text), ("b", ""), ("c", None), ("d", "  Mr. SMITH. One.")], "k string, text string")
    marks = metadata.chamber_marks("text")
    got = segment.placed(df.withColumn("m", marks), ["k"], "text", "m", "daily")
    found = segment.segment(df, "k", "text", "daily")
    parts = found.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("speech_no", "speech"))).alias("s"))
    joined = df.join(parts, "k").withColumn("p", F.transform("s", lambda x: x["speech"]))
    places = cursor_offsets(joined, "k", "text", "p").select("k", (F.col("part_no") + 1).alias("speech_no"), "offset")
    want = asof_backward(found.join(places, ["k", "speech_no"]), metadata.chamber_markers(df, "k", "text"), ["k"], "offset", ["chamber"])
    assert rows(got) == rows(want.select("k", "speech_no", "speaker", "speech", "chamber")) and got.count() == 4


def test_notes_and_broken_labels():
    assert segment.without_notes("a\n=====\nb\n ======x\nc\n=====\nd") == "a\n=====\n ======x\nc\n=====\n"
    assert segment.without_notes("a\x0c=====\x0cb\r\n=====") == "a\x0c=====\x0c====="
    bound = segment.DIALECTS["bound"]
    assert segment.joined_labels("  Miss SMI-\nTH. I rise.\nnext", bound) == "  Miss SMITH.\n I rise.\nnext"
    assert segment.joined_labels("  Miss SMI-\r\nTH. I rise.", bound) == "  Miss SMITH.\n I rise.\n"
    for kept in ("  Miss SMITH. A half-\ntruth.", "some half-\nTH. of it", "  Miss SMI-", "  Miss SMI-\n\nTH. I"):
        assert segment.joined_labels(kept, bound) == kept
