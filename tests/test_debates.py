"""Title blocks against a plain state machine, sections and title removal."""

import random
import re

from rostrum.operators import debates


def share(line):
    letters = "".join(x for x in (re.sub("[^A-Za-z]", "", t) for t in line.split()) if x.lower() != "report")
    return sum(c.isupper() for c in letters) / len(letters) if letters else 0.0


def blocks(text):
    """(title, start, end) by walking through the lines once."""
    lines = [x + "\n" for x in text.split("\n")[:-1]]
    out, held, place = [], [], 0

    def close():
        body = "".join(x for x, _, _ in held)
        if held and not body.lstrip().startswith(("Mr.", "Ms.", "Mrs.")):
            out.append((body, held[0][1], held[-1][2]))
        held.clear()

    for i, line in enumerate(lines):
        start, place = place, place + len(line)
        body = line.strip()
        count = len(re.findall("[A-Za-z]", body))
        letters = re.sub("[^a-z]", "", line.lower())
        tokens = re.findall("[a-z]+", line.lower())
        seal = {"gpo", "authenticated", "authentication", "authentic", "information"}
        if not body:
            after = next((x.strip() for x in lines[i + 1 :] if x.strip()), "")
            if held and len(re.findall("[A-Za-z]", after)) >= 8 and share(after) >= 0.6:
                held.append((line, start, place))
            else:
                close()
        elif "congressionalrecord" in letters or letters in ("usgovernment", "usgoverment") or tokens and set(tokens) <= seal:
            close()
        elif len([w for w in body.split() if re.search("[A-Za-z]", w)]) >= 2 and share(body) >= 0.6 and count >= 8:
            held.append((line, start, place))
        else:
            words = [w for w in body.split() if re.search("[A-Za-z]", w)]
            bare = [w.strip(",.;:!?—–-()[]{}<>\"'`") for w in body.split()]
            if held and len(words) == 1 and any(len(re.findall("[A-Za-z]", w)) >= 2 and not re.search("[a-z]", w) for w in bare):
                held.append((line, start, place))
            else:
                close()
    close()
    return out


KINDS = ["THE TARIFF ACT OF 1890", "ACT", "", "plain words of a speech", "CONGRESSIONAL RECORD", "Mr. SMITH OF OHIO", "REPORT of a THING HERE", "GPO", "A", "  DEEP TITLE LINE, "]


def test_titles_equal_the_state_machine(spark):
    draw = random.Random(11)
    files = [(f"f{i}", "\n".join(draw.choice(KINDS) for _ in range(draw.randrange(1, 12))) + "\n\n") for i in range(150)]
    got = debates.titles(spark.createDataFrame(files, "filename string, text string"), "filename").collect()
    want = sorted((f, *b) for f, t in files for b in blocks(t))
    assert sorted((r.filename, r.title, r.start, r.end) for r in got) == want


def test_assignment(spark):
    data = [
        ("f", 1, "before any title"),
        ("f", 2, "THE TARIFF ACT\nfirst"),
        ("f", 3, "second\nthe tariff act and more"),
        ("g", 1, None),
        ("g", 2, ""),
    ]
    got = debates.assign_titles(spark.createDataFrame(data, "filename string, n int, speech string"), "filename", "n", "speech")
    assert sorted((r.filename, r.n, r.title, r.speech) for r in got.where("speech is not null").collect()) == [
        ("f", 1, "", "before any title"),
        ("f", 2, "", "THE TARIFF ACT\nfirst"),
        ("f", 3, "THE TARIFF ACT", "second"),
        ("g", 2, "", ""),
    ]


def test_line_kinds():
    assert debates.capital_share("REPORT Of THE Thing") == 5 / 10 and debates.capital_share("") == 0.0
    assert "".join(map(debates.line_kind, KINDS)) == "skbnxssnns"
