"""Repeated lines against brute force; name variants and their parts."""

import random
import re

import pytest

from rostrum.llm import repeated_lines
from rostrum.llm.name_variants import given_fits, lcs_ratio, link_names, parse_label, slips, suffix_keys

from ..conftest import rows


def key(line):
    return tuple(re.findall("[a-z]+", line.lower()))


def brute(data, share=6, least=4):
    found = []
    for folder in {f for _, f, _ in data}:
        mine = [(i, t) for i, f, t in data if f == folder and t is not None]
        count = {}
        for _, t in mine:
            for k in {key(x) for x in t.split("\n")} - {()}:
                count[k] = count.get(k, 0) + 1
        often = {k for k, n in count.items() if n >= least and n * 100 >= share * len(mine)}
        found += [(i, n) for i, t in mine for n, x in enumerate(t.split("\n"), 1) if key(x) in often]
    return sorted(found, key=repr)


def test_repeated_lines_equal_brute_force(spark):
    draw = random.Random(2)
    pool = ["For sale by the Office; price %d cents.", "Do not detach %d", "", "12 34", "All rights. %d", "é %d"]
    data = []
    for i in range(300):
        lines = [draw.choice(pool).replace("%d", str(draw.randrange(99))) for _ in range(draw.randrange(4))]
        data.append((i, draw.choice(["a", "a", "b", None]), "\n".join([f"own {''.join(draw.choice('abcdefgh') for _ in range(5))}", *lines])))
    data += [(400, "c", None), (401, "c", ""), (402, "d", "once"), (402, "d", "once"), (None, "a", "Do not detach 1")]
    df = spark.createDataFrame(data, "speech_id long, folder string, speech string")
    got = repeated_lines.repeated_lines(df, "speech_id", "speech", "folder").select("id", "line_no")
    assert rows(got) == brute(data)
    clean = {r.speech_id: r.clean_text for r in repeated_lines.without_repeated_lines(df.withColumn("_keys2", df.folder), "speech", "folder").where("speech_id < 300").collect()}
    hit = set(brute(data))
    for i, _, t in data[:300]:
        assert clean[i] == "\n".join(x for n, x in enumerate(t.split("\n"), 1) if (i, n) not in hit)
    assert repeated_lines.repeated_lines(df.limit(0), "speech_id", "speech", "folder").count() == 0


def test_lcs_and_slips():
    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b, 1):
                new.append(row[j - 1] + 1 if x == y else max(new[-1], row[j]))
            row = new
        return row[-1]

    draw = random.Random(1)
    for _ in range(400):
        a, b = ("".join(draw.choice("ABC") for _ in range(draw.randrange(12))) for _ in "ab")
        assert lcs_ratio(a, b) == pytest.approx(2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0)
    assert slips("SMITH", "SMIHT", 2) == 1 and slips("SMITH", "SMTHH", 2) == 2 and slips("A", "ABCD", 2) == 3


def test_labels():
    assert parse_label("The CLERK") is None
    assert parse_label("Mr. SMI- THERS of Ohio")["splits"][0] == ["SMITHERS", []]
    assert parse_label("Mr.\xa0O'HARA (WI)")["state"] == "WI"
    assert parse_label("JONES, Robert B.")["splits"] == [["JONES", ["ROBERT", "B"]]]
    assert parse_label("HON. BOB VAN JONES")["splits"][1] == ["VANJONES", ["BOB"]]
    assert given_fits(["BOB"], ["ROBERT", "C"]) == 0 and given_fits(["R"], ["ROBERT"]) == 1 and given_fits([], ["X"]) == 2 and given_fits(["MARY"], ["ROBERT"]) is None


def test_links(spark):
    people = [
        ("K1", "Mr. KOLMANLEY", "Robert C. Kolmanley", "OH"),
        ("K1", "Mr. KOLMANLEY", "", None),
        ("P1", "Mr. PELLOUBY of Nevada", "James P. Pellouby", "NV"),
        ("P2", "Mr. PELLOUBY of Utah", "Henry Pellouby", "UT"),
        (None, "Mr. NOBODY", "No Body", "OH"),
        ("X1", None, "Only Full", "OH"),
    ]
    want = {
        "Mr. KOLMANLEY": "K1", "Mr. KOLMNALEY": "K1", "KOLMANLEY, Bob": "K1", "R. C. KOLMANLEY": "K1", "HON. BOB KOLMANLEY": "K1", "Mr, K0LMANLEY [continuing]": "K1",
        "Mr. PELLOUBY of Utah": "P2", "JIM PELLOUBY": "P1", "PELLOUBY (Nevada)": "P1",
    }
    others = ["Mr. PELLOUBY", "Mrs. KOLMANLEY", "HENRY KOLMANLEY", "The CHAIRMAN", "", " ", None, "Mr. DELLIMSTEAD", "Dr. KOLMANLAY", "Mr. KOLMANLAY", "Mr. KOLMANLEY of Utah", "Mr.", "12"]
    labels = spark.createDataFrame([(x, "m") for x in [*want, *want, *others]], "speaker string, sex string")
    persons = spark.createDataFrame(people, "bio string, label string, full string, st string")
    got = link_names(labels, "speaker", persons, "bio", "label", "full", "st")
    assert dict(rows(got)) == want and got.count() == len(want)
    assert link_names(labels.limit(0), "speaker", persons, "bio", "label", "full", "st").count() == 0
    assert link_names(labels, "speaker", persons.limit(0), "bio", "label", "full", "st").count() == 0


def test_short_names_and_shared_misspellings(spark):
    people = [("S1", "Mr. SMITH", "John Smith", "UT"), ("S2", "Mrs. SMITH", "Ann Smith", "NV"), ("K1", "Mr. KING", "Paul King", "UT"), ("R1", "Mr. REED", "Carl Reed", "UT")]
    want = {"Mr. SMIHT": "S1", "Mrs. SMIHT": "S2", "Mr. KIMG": "K1", "Mr. KIG": "K1", "Mr. RECD": "R1", "Mr." + " " * 400 + "REED": "R1"}
    labels = spark.createDataFrame([(x,) for x in want], "speaker string")
    persons = spark.createDataFrame(people, "bio string, label string, full string, st string")
    assert dict(rows(link_names(labels, "speaker", persons, "bio", "label", "full", "st"))) == want


def test_suffix_keys():
    assert suffix_keys("KING") == ["<GNIK^", "<IK^", "<NIK^", "ING", "ING$", "KIN", "KING", "KING$", "NG$"]
    assert suffix_keys("AB") == ["<BA^", "AB$"] and suffix_keys("") == []
    # one slip anywhere leaves a shared suffix
    name = "PELLIMSTEAD"
    for i in range(len(name)):
        for slip in (name[:i] + name[i + 1 :], name[:i] + "X" + name[i:], name[:i] + "X" + name[i + 1 :]):
            assert set(suffix_keys(name)) & set(suffix_keys(slip))


def test_common_suffixes_are_refined(spark):
    # all persons share beginning and end of the surname, so every short suffix is common
    middles = ["BORUN", "CADEL", "DOVIM", "FAGON", "GETIR", "HILUS", "JOMAX", "KANEP", "LERIT", "MOSUB", "NADIC", "PETOG", "RUVAL", "SEKOM"]
    people = [(f"P{i}", f"Mr. STR{m}STEAD", f"John Str{m.lower()}stead", "UT" if i % 2 else None) for i, m in enumerate(middles)]
    want = {}
    for i, m in enumerate(middles):
        want[f"Mr. STR{m[:-1]}STEAD"] = f"P{i}"
        want[f"Mr. SRT{m}STEAD of Utah"] = f"P{i}"
        want[f"STR{m}STEDA, J."] = f"P{i}"
    labels = spark.createDataFrame([(x,) for x in want], "speaker string")
    persons = spark.createDataFrame(people, "bio string, label string, full string, st string")
    assert dict(rows(link_names(labels, "speaker", persons, "bio", "label", "full", "st"))) == want
