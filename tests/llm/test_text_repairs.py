"""Scanned pages, speaker turns, template residue."""

import random

import numpy as np
import pyarrow as pa
import pytest

from rostrum.llm import residue, scan_repair, shingles, speaker_turns
from rostrum.llm.peg import find, many, node, seq, token

from ..conftest import rows

WORDS = "the member will examine every municipal budget before this committee and harbor council should improve their western settlement without delay because national policy requires careful ship-building reform".split()


@pytest.fixture(scope="module")
def corpus(spark):
    draw = random.Random(3)
    texts = [" ".join(draw.choice(WORDS) for _ in range(300)) + "." for _ in range(30)]
    return [(i, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def lexicon(spark, corpus):
    return scan_repair.learn(spark.createDataFrame(corpus, "id long, text string"), "text")


PAGE = """The member will examine every munici-
pal budgct before this committee and the

1905 CONGRESSIONAL REC0RD-SENATE 4016
[4016]
May 8, 1905
western ship-
building council should impr|ove their settle-
4017
ment without de1ay because policy requires
careful reform."""


def test_faulty_lines(lexicon):
    assert scan_repair.faults(PAGE, lexicon) == [
        (1, "split"), (2, "glyph"), (4, "header"), (5, "folio"), (6, "header"), (8, "glyph"), (8, "split"), (9, "folio"), (10, "glyph"),
    ]


def test_repaired_text(lexicon):
    assert scan_repair.repaired(PAGE, lexicon) == (
        "The member will examine every municipal budget before this committee and the western ship-building council should improve "
        "their settlement without delay because policy requires careful reform."
    )
    plain = "A paragraph that is no scan, with a budgct.\nAnother one."
    assert scan_repair.faults(plain, lexicon) == [] and scan_repair.repaired(plain, lexicon) == plain


@pytest.mark.parametrize(
    "line, kind",
    [
        ("JUNF 12", "header"), ("CONGR ESSIONAL RECORD - HOUSE", "header"), ("p. 12", "folio"), ("- 12 -", "folio"), ("H 5158", "folio"),
        ("The CONGRESSIONAL RECORD of May 4, page 5, shows", None), ("[11:08]", None), ("ORDINARY MORTGAGE ACT", None), ("", None), ("Section 12", None),
    ],
)
def test_furniture(line, kind):
    assert scan_repair.furniture(line) == kind


def test_scan_operator_rows(spark, corpus):
    data = [*corpus, (100, PAGE), (100, PAGE), (101, None), (102, ""), (None, PAGE), (103, "x" * 2_000_000 + "\n" + "y z " * 1000)]
    df = spark.createDataFrame([(i, t, "c") for i, t in data], "speech_id long, speech string, kind string")
    got = scan_repair.faulty_lines(df, "speech_id", "speech")
    assert got.where("id = 100").count() == 18 and got.where("id is null").count() == 9 and got.where("id <> 100").count() == 0
    out = scan_repair.repair(df, "speech").where("speech_id in (101, 102)").select("speech_id", "repaired_text")
    assert rows(out) == [(101, None), (102, "")]
    assert scan_repair.faulty_lines(df.limit(0), "speech_id", "speech").count() == 0


def test_pathological_texts(lexicon):
    page = PAGE + "\n" + "x" * 500_000 + "\n" + "y" * 300_000 + "-\nend of it"
    assert [f for f in scan_repair.faults(page, lexicon) if f[0] < 11] == scan_repair.faults(PAGE, lexicon)
    deep = "(" * 3000 + "laughter" + ")" * 3000
    assert speaker_turns.clean(deep) and len(speaker_turns.turns("[" * 5000 + "Mr. SMITH. " * 5000, "x" * 100_000)) == 1


def test_peg():
    word = node("word", token(r"[a-z]+"))
    tree = many(seq(word, token(r"\s*")))("ab cd", 0)
    assert tree[0] == 5 and [n.name for n in tree[1]] == ["word", "word"] and find(tree[1], "none") is None


TALK = """I rise. uh, The bill [Applause.] is good.
Ms. JONES. I thank (nested [Laughter] applause) him.
{time} 1045 Mr. SMITH of Ohio [continuing]. Well, uh, I go on.
[10:42 a.m.] >> Mrs. VAN
DOREN: I ask.
The PRESIDING OFFICER. Order.
Mr. President, I object.
Mr. LEE told us so.
[Ms. ROEDER] Yes.
ROEDER: Still me.
Mr. Lee -- No."""


def test_turns():
    got = [(n, w) for n, w, _, _ in speaker_turns.turns(TALK, "Mr. SMITH")]
    assert got == [(1, "SMITH"), (2, "JONES"), (3, "SMITH"), (4, "VAN DOREN"), (5, "PRESIDING OFFICER"), (6, "ROEDER"), (6, "ROEDER"), (7, "LEE")]


def test_own_label_opens_no_turn():
    assert [n for n, *_ in speaker_turns.turns("Mr. PELLOUBY. I rise.\nPELLOUBY: Yes.", "HON. BENJAMIN G. PELLUOBY")] == [1, 1, 1]
    assert [w for _, w, *_ in speaker_turns.turns("Hello.\nMr. A. B. SMITH. Yes.", None)] == [None, "A. B. SMITH"]


def test_clean_utterances():
    assert speaker_turns.clean("I, uh, rise [Laughter (and applause)] at 10:45:12 to (see H. 5) speak, you know, <inaudible> now.") == "I, rise at to (see H. 5) speak, now."


def test_turn_operator(spark):
    df = spark.createDataFrame([(1, "Mr. SMITH", TALK), (2, None, None), (3, "", ""), (None, "x", "Ms. ROE. Hi.")], "speech_id long, speaker string, turn_no string")
    out = speaker_turns.speaker_turns(df, "speech_id", "speaker", "turn_no")
    assert out.where("id = 1").count() == 7
    assert [r.utterance for r in out.where("id = 1 and turn_no <= 2").orderBy("turn_no").collect()] == ["I rise. The bill is good.", "I thank him."]
    assert rows(out.where("id in (2, 3)")) == [(2, 1, None, ""), (3, 1, None, "")]
    assert rows(speaker_turns.turn_starts(df, "speech_id", "speaker", "turn_no").where("id is null")) == [(None, 2, "ROE")]
    assert speaker_turns.speaker_turns(df.limit(0), "speech_id", "speaker", "turn_no").count() == 0


@pytest.mark.parametrize("slot", ["{{ name }}", "{0}", "%(x)s", "${x}", "$$$NAME$$$", "<%= x %>", "<<x y>>", "[[name]]", "[insert name here]", "[Volume to come]", "[X TBD]", "[name?]", "@@x@@", "#NAME#", "~Name~", "«Name»", "XX/XX/XXXX", "[insert\nname here]"])
def test_slots(slot):
    assert residue.has_slot(f"The bill of {slot} was read.")


@pytest.mark.parametrize("text", ["{time} 1045", "[Roll No. 5]", "[[Page H12]]", "I, ______, swear", "costs $5,000 or 5% of it", "[Retry]", "see #5 and <b>", "J. XX. Doe", "a@b.c"])
def test_no_slots(text):
    assert not residue.has_slot(text)


def test_residue_operator(spark):
    draw = random.Random(5)
    content = [" ".join(draw.choice(WORDS) for _ in range(40)) + "." for _ in range(200)]
    bad = ["404 Not Found\nSorry, that page is gone.", "Please enable JavaScript to go on.\nSwitch it on in your browser.", "Lorem ipsum dolor sit amet.\nConsectetur lorem ipsum elit.", "Dummy text. Dummy text. Dummy text. Dummy text."] * 6
    bad += ["TITLE OF AN ACT\n\nSorry, that page is gone.", "Home > Search\nSwitch it on in your browser."]
    good = [content[0] + "\nMy staff met \"404 Not Found\" before this committee and harbor council.", content[1] + "\nPlease enable JavaScript to go on.", None, "", "  ", "TITLE ONLY"]
    texts = [*content, *bad, *good, "The {{ name }} will improve."]
    df = spark.createDataFrame([(i, t, True) for i, t in enumerate(texts)], "doc_id long, text string, has_slot boolean")
    want = [(i,) for i in range(len(content), len(content) + len(bad))] + [(len(texts) - 1,)]
    assert rows(residue.residue(df, "doc_id", "text").select("id")) == sorted(want, key=repr)
    assert residue.residue(df.limit(0), "doc_id", "text").count() == 0


def _residue_texts():
    draw = random.Random(6)
    content = [" ".join(draw.choice(WORDS) for _ in range(40)) + "." for _ in range(300)]
    framed = [f"{m}\nBack to the start, or report this problem." for m in ("Sorry, that page is not here.", "404 Not Found", "Too many calls were made with this key.")] * 4
    held_out = ["The gateway had no answer for you.\nBack to the start, or report this problem."] * 4
    return content, framed, held_out


def _slices_of(spark, texts):
    return residue.parsed(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), "id", "text")


def test_residue_learning(spark):
    content, framed, held_out = _residue_texts()
    slices = _slices_of(spark, [*content, *framed, *held_out])
    first, model = residue.learn(slices, rounds=1), residue.learn(slices)
    # companions of trusted passages are learned, content beside a notice isn't residue
    assert all(residue.verdict(t, model)[0] for t in [*framed, "Back to the start, or report this problem."])
    assert not residue.verdict(content[0] + "\nPlease enable JavaScript to go on.", model)[0]
    # rounds move the model
    assert residue.verdict(held_out[0], model)[1] > residue.verdict(held_out[0], first)[1]
    # unknown words speak against residue, in whatever language
    for prose in (
        "Les travaux du canal avancent lentement, car les pluies ont abîmé la digue.",
        "Die Behörde prüft den Haushalt der Gemeinde erst nach der Ernte.",
        "Eigenvalues of a Hermitian operator are real; eigenvectors of distinct eigenvalues are orthogonal.",
        "Zorbic quandle yttrix pomplet varnash ekkilo drubbing.",
    ):
        assert not residue.verdict(prose, model)[0]


def test_residue_verdicts_do_not_depend_on_size():
    draw = np.random.default_rng(1)
    size = 1 << residue.BUCKET_BITS
    bad, good = draw.poisson(0.02, size).astype(float), draw.poisson(1.0, size).astype(float)
    one = residue.Model(bad, good, 40.0, 1000.0, 3.0, 5000.0)
    many = residue.Model(100 * bad, 100 * good, 4000.0, 100_000.0, 300.0, 500_000.0)
    assert np.allclose(one.odds, many.odds) and np.isclose(one.prior, many.prior) and np.isclose(one.stray, many.stray)


def test_pieces_of_words():
    hashed, start, pieces = shingles.words_and_pieces(pa.array(["Testing Tes ing", None, "x TESTED"]))
    assert start.tolist() == [0, 3, 3, 5] and (hashed == shingles.words(pa.array(["Testing Tes ing", None, "x TESTED"]))[0]).all()
    assert pieces[0, 0] == pieces[4, 0] and pieces[0, 1] != pieces[4, 1] and not pieces[1:4].any()


def test_misread_words_in_long_chains(lexicon):
    chain = "before—this—committee—and—harbor—council—should—improve—their—budgct—settlement"
    assert len(chain) > 60
    assert (2, "glyph") in scan_repair.faults(f"The member will examine every\n{chain}\nand the western\nreform.", lexicon)


def test_fillers_behind_marks_and_long_titles():
    assert residue.passages("- Dummy text. Dummy text. Dummy text.") == [("- Dummy text. Dummy text. Dummy text.", True)]
    assert residue.passages("TITLE OF AN ACT " * 12) == []


def test_long_remarks_and_notes():
    remark = "speaking on behalf of the committee on the whole state of the Union, and for the clerk"
    got = speaker_turns.turns(f"I rise.\nMr. ROE ({remark}). I object.", "Mr. SMITH")
    assert [w for _, w, *_ in got][1:] == ["ROE"]
    note = "[" + "the galleries being full, " * 15 + "applause]"
    assert speaker_turns.clean(f"I rise {note} to speak.") == "I rise to speak."


def test_labels_without_form_of_address():
    said = "I rise.\nVan Doren -- I yield.\nROE: No.\nFrankly -- I object.\nResolved: That it be so.\nLee -- and others.\n[10:41] O'Lee -- Yes.\n*Applause in the galleries of the House, continued for some minutes*"
    assert [w for _, w, *_ in speaker_turns.turns(said, "Mr. SMITH")][1:] == ["VAN DOREN", "O'LEE"]
    assert speaker_turns.clean(said).endswith("Yes.\n")
    # a name in the middle of a sentence, however many furniture and blank lines stand between
    broken = "I was told by\n" + "\n[4016]\n" * 30 + "Mr. ROE. He said so."
    assert len(speaker_turns.turns(broken, "Mr. SMITH")) == 1


def test_vectors_decide(spark, monkeypatch):
    draw = random.Random(11)
    texts = [f"on the {draw.choice(['first', 'second', 'third'])} day the {draw.choice(['council', 'committee', 'court'])} met before noon." for _ in range(600)]
    texts += [f"pots of {draw.choice(['red', 'white', 'wet'])} clay and {draw.choice(['fine', 'coarse'])} sand were fired." for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    lexicon = scan_repair.learn(df, "text")
    lexicon.surely = 100
    # a known word that a glyph edit makes of a frequent one, but which stands in other company
    assert lexicon.links("clay") == [("day", 600)] and not lexicon.alike("clay", "day") and lexicon.alike("noon", "noon")
    page = "on the first duy the council met, and on the second\nclay the court mct before\nnoon with pots of red clay and fine\nsand."
    assert scan_repair.faults(page.replace("duy", "dny"), lexicon) == [(2, "glyph")]
    monkeypatch.setattr(scan_repair, "ALIKE", -2)
    assert scan_repair.faults(page, lexicon) == [(2, "glyph")]  # it doesn't fit the words around, either
    # precision without vectors' say
    monkeypatch.setattr(scan_repair, "FIT", -99)
    assert scan_repair.faults(page, lexicon) == [(2, "glyph"), (3, "glyph")]
    # recall without vectors
    lexicon.vectors = None
    lexicon.placed.clear(), lexicon.fine.clear()
    assert scan_repair.faults(page, lexicon) == []


def test_a_link_that_fits_nothing_around_is_refused(spark, lexicon):
    assert lexicon.choose("budgct", ["municipal", "before"]) == "budget"
    assert lexicon.choose("budgct", ["zzz"]) is None and lexicon.choose("budgct", []) is None
    worst = lexicon.contexts @ lexicon.vectors[lexicon.place("budget")[0]]
    at = int(worst.argmin())
    lexicon.placed["against"] = (0, at)
    lexicon.contexts[at] *= 50
    assert worst[at] < 0 and lexicon.choose("budgct", ["against"]) is None
    lexicon.contexts[at] /= 50
