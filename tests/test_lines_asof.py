"""Line windows, as-of joins and the cursor fold against plain Python."""

import random

from rostrum.operators import asof, lines

from .conftest import rows


def test_offsets_and_parity(spark):
    df = spark.createDataFrame([(1, "ab\n=====\nx\n\n=====\nend"), (2, ""), (3, None)], "id int, text string")
    got = lines.with_offsets(lines.explode_lines(df, ["id"], "text"), ["id"]).orderBy("id", "line_no").collect()
    assert [(r.id, r.line_no, r.start) for r in got] == [(1, 0, 0), (1, 1, 3), (1, 2, 9), (1, 3, 11), (1, 4, 12), (1, 5, 18), (2, 0, 0)]
    kept = lines.strip_notes(lines.explode_lines(df, ["id"], "text"), ["id"]).where("id = 1").orderBy("line_no").collect()
    assert [r.line for r in kept] == ["ab", "=====", "=====", "end"]


def test_asof_backward_ties_and_none(spark):
    left = spark.createDataFrame([(1, 0, "a"), (1, 5, "b"), (1, 9, "c"), (2, 3, "d"), (None, 1, "e")], "g int, at int, x string")
    right = spark.createDataFrame([(1, 5, "M"), (1, 7, "N"), (None, 0, "Z")], "g int, at int, mark string")
    got = {r.x: r.mark for r in asof.asof_backward(left, right, ["g"], "at", ["mark"]).collect()}
    assert got == {"a": None, "b": "M", "c": "N", "d": None, "e": "Z"}


def test_asof_equals_scan(spark):
    draw = random.Random(5)
    left = [(draw.randrange(4), draw.randrange(50), i) for i in range(300)]
    right = list({(draw.randrange(4), draw.randrange(50)) for _ in range(40)})
    got = asof.asof_backward(spark.createDataFrame(left, "g int, at int, i int"), spark.createDataFrame([(g, a, a) for g, a in right], "g int, at int, m int"), ["g"], "at", ["m"])
    want = sorted((i, max((a for h, a in right if h == g and a <= at), default=None)) for g, at, i in left)
    assert sorted((r.i, r.m) for r in got.collect()) == want


def test_section_is_half_open(spark):
    left = spark.createDataFrame([("f", p) for p in (0, 3, 5, 8, 9)], "f string, at int")
    sections = spark.createDataFrame([("f", 3, 5, "A"), ("f", 5, 9, "B")], "f string, s int, e int, t string")
    got = {r.at: r.t for r in asof.within_section(left, sections, ["f"], "at", "s", "e", ["t"]).collect()}
    assert got == {0: None, 3: "A", 5: "B", 8: "B", 9: None}


def test_cursor_fold_equals_find(spark):
    draw = random.Random(7)
    data = []
    for i in range(60):
        text = "".join(draw.choice("ab é😀") for _ in range(40))
        parts = []
        for _ in range(draw.randrange(6)):
            a = draw.randrange(40)
            parts.append(draw.choice([text[a : a + draw.randrange(6)], "zz", ""]))
        data.append((i, text, parts))
    got = asof.cursor_offsets(spark.createDataFrame(data, "id int, text string, parts array<string>"), "id", "text", "parts")
    want = []
    for i, text, parts in data:
        cursor = 0
        for n, p in enumerate(parts):
            found = text.find(p, cursor)
            at = found if found >= 0 else cursor
            want.append((i, n, p, at))
            cursor = at + len(p)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_last_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, None)], "k string, n int, v string")
    assert rows(asof.last_per_key(df, "k", ["n"]).select("k", "v")) == [("a", "y"), ("b", None)]


def test_spread_small_scans_only(spark):
    from rostrum.runtime import spread

    cores = spark.sparkContext.defaultParallelism
    small, large = spark.range(10, numPartitions=1), spark.range(10, numPartitions=cores + 1)
    assert spread(small).rdd.getNumPartitions() == cores and spread(large) is large
    assert rows(spread(small)) == rows(small)
