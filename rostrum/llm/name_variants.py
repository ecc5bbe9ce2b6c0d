"""Variant spellings of names typed by people, linked to a list of known persons.

Each distinct label is parsed once into title, state and the possible splits into
given names and surname.  Blocking is by suffixes of all lengths from ``MIN_SUFFIX``
of the surname token: of the token with its end marked, of the token without its last
letters, of which up to ``CUT`` may hold a slip, and of the token read backwards with
its beginning marked.  A suffix that more than ``COMMON`` persons share is refined by
other fields: by the label's state where it has one (and the persons of unknown
state), else by the title's sex and the surname's length.  Only then is the common
suffix itself discarded; persons stand in the blocks of the next longer suffix, too.
Longer suffixes of one that isn't common hold nobody new and aren't indexed.  Pairs in a
block are compared by the ratio of their longest common subsequence, those that reach
``LEAST_RATIO`` are verified by the number of slips (insertion, deletion,
substitution, exchange of neighbours) and by title, state and given names.

A label is linked if exactly one person fits best.  A misspelt surname that also
occurs with a title that contradicts the person's (another sex, or a title no
known person bears) is a stranger's own name and isn't linked.

Defined results: NULL and empty labels, officers and labels without a name are
never linked; persons without surname or id are left out; repeated person rows
are merged by id, their given names are all valid; empty tables give no links.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import ship

LONGEST_LABEL = 300  #: characters; what is longer is a text, not a name
MIN_SUFFIX, CUT, COMMON, LEAST_RATIO, MOST_SLIPS = 3, 3, 12, 0.72, 2

#: Postal codes of the states and territories.
STATES = {
    "ALABAMA": "AL", "ALASKA": "AK", "ARIZONA": "AZ", "ARKANSAS": "AR", "CALIFORNIA": "CA", "COLORADO": "CO", "CONNECTICUT": "CT",
    "DELAWARE": "DE", "FLORIDA": "FL", "GEORGIA": "GA", "HAWAII": "HI", "IDAHO": "ID", "ILLINOIS": "IL", "INDIANA": "IN", "IOWA": "IA",
    "KANSAS": "KS", "KENTUCKY": "KY", "LOUISIANA": "LA", "MAINE": "ME", "MARYLAND": "MD", "MASSACHUSETTS": "MA", "MICHIGAN": "MI",
    "MINNESOTA": "MN", "MISSISSIPPI": "MS", "MISSOURI": "MO", "MONTANA": "MT", "NEBRASKA": "NE", "NEVADA": "NV", "NEW HAMPSHIRE": "NH",
    "NEW JERSEY": "NJ", "NEW MEXICO": "NM", "NEW YORK": "NY", "NORTH CAROLINA": "NC", "NORTH DAKOTA": "ND", "OHIO": "OH", "OKLAHOMA": "OK",
    "OREGON": "OR", "PENNSYLVANIA": "PA", "RHODE ISLAND": "RI", "SOUTH CAROLINA": "SC", "SOUTH DAKOTA": "SD", "TENNESSEE": "TN",
    "TEXAS": "TX", "UTAH": "UT", "VERMONT": "VT", "VIRGINIA": "VA", "WASHINGTON": "WA", "WEST VIRGINIA": "WV", "WISCONSIN": "WI",
    "WYOMING": "WY", "PUERTO RICO": "PR", "GUAM": "GU",
}

#: Short forms of given names (public knowledge), by their full forms.
SHORT_FORMS = {
    "ALBERT": "AL BERT BERTIE", "ALEXANDER": "ALEX SANDY", "ANDREW": "ANDY DREW", "ANTHONY": "TONY", "ARTHUR": "ART ARTIE",
    "BARBARA": "BARB BARBIE BABS", "BENJAMIN": "BEN BENNY BENNIE", "CATHERINE": "CATHY KATE", "CHARLES": "CHARLIE CHUCK CHAS",
    "CHRISTOPHER": "CHRIS KIT", "DANIEL": "DAN DANNY", "DAVID": "DAVE", "DONALD": "DON DONNIE", "DOROTHY": "DOT DOTTIE DOLLY",
    "EDWARD": "ED EDDIE NED TED", "ELEANOR": "NELL ELLIE NORA", "ELIZABETH": "BETTY BETH LIZ LIZZIE LIBBY BESS ELIZA", "EUGENE": "GENE",
    "FLORENCE": "FLO FLORA FLOSSIE", "FRANCES": "FRAN FANNY", "FRANCIS": "FRANK", "FRANKLIN": "FRANK", "FREDERICK": "FRED FREDDIE",
    "GEORGE": "GEO", "GERALD": "JERRY GERRY", "GREGORY": "GREG", "HAROLD": "HAL HARRY", "HENRY": "HANK HARRY HAL", "HERBERT": "HERB BERT",
    "JAMES": "JIM JIMMY JIMMIE JAS", "JEFFREY": "JEFF", "JENNIFER": "JENNY JEN", "JOHN": "JACK JOHNNY", "JOSEPH": "JOE JOEY JOS",
    "JOSHUA": "JOSH", "KATHERINE": "KATE KATHY KATIE KAY KIT", "KENNETH": "KEN KENNY", "LAWRENCE": "LARRY LARS", "LEONARD": "LEN LENNY",
    "LOUIS": "LOU", "MARGARET": "PEGGY MAGGIE MEG MARGE", "MARTHA": "PATTY MATTIE", "MARY": "MOLLY POLLY", "MATTHEW": "MATT",
    "MICHAEL": "MIKE MICK", "NATHANIEL": "NATE NAT NATHAN", "NICHOLAS": "NICK", "PATRICIA": "PAT PATTY PATSY TRISH TRICIA",
    "PATRICK": "PAT PADDY", "PETER": "PETE", "PHILIP": "PHIL", "RAYMOND": "RAY", "REBECCA": "BECKY BECCA", "RICHARD": "DICK RICK RICH RICHIE",
    "ROBERT": "BOB BOBBY ROB ROBBIE BERT", "RONALD": "RON RONNIE", "SAMUEL": "SAM SAMMY", "STEPHEN": "STEVE", "STEVEN": "STEVE",
    "SUSAN": "SUE SUSIE", "THEODORE": "TED TEDDY THEO", "THOMAS": "TOM TOMMY THOS", "TIMOTHY": "TIM", "VICTORIA": "VICKY VICKI VICKIE TORI",
    "VINCENT": "VINCE VIN", "WALTER": "WALT WALLY", "WILLIAM": "BILL BILLY WILL WILLIE WM",
}
_FULL = {}
for _full, _shorts in SHORT_FORMS.items():
    for _short in _shorts.split():
        _FULL.setdefault(_short, set()).add(_full)

_TITLE = re.compile(
    r"^(MRS|MR|MS|MISS|MADAM|HON(?:ORABLE)?|SENATOR|REPRESENTATIVE|REP|SEN|DR|DOCTOR|CHAIRMAN|CHAIRWOMAN|GOVERNOR|GENERAL|PROF|REV)(?![A-Z'])\s*[.,:;]*\s*"
)
_SEX = {"MR": "M", "MRS": "F", "MS": "F", "MISS": "F", "MADAM": "F", "CHAIRWOMAN": "F"}
_NEUTRAL = {"HON", "HONORABLE", "SENATOR", "REPRESENTATIVE", "REP", "SEN", ""}
_LETTER_OF = str.maketrans("0158", "OISB")
_JUNIOR = {"JR", "SR", "II", "III", "IV"}


def parse_label(label: str) -> dict | None:
    """title, sex, state and the possible [surname letters, given names] of a label; None for officers and non-names."""
    text = re.sub(r"[\s  -​ ﻿]+", " ", label).strip().upper().replace("’", "'")
    if len(text) > LONGEST_LABEL:
        return None
    text = re.sub(r"(?<=[A-Z])- (?=[A-Z])", "", text)  # a word broken at a line's end
    if re.match(r"^[TF]HE\b", text):
        return None
    state = None
    for remark in re.findall(r"[(\[]([^)\]]*)[)\]]?", text):
        remark = remark.strip(" .")
        if remark in STATES or remark in _CODES:
            state = STATES.get(remark, remark)
    text = re.sub(r"[(\[][^)\]]*[)\]]?", " ", text).strip(" .:;,-")
    title = ""
    while found := _TITLE.match(text):
        title, text = (title if title in _SEX else found[1]), text[found.end() :]
    if of := re.search(r"\bOF (?:THE )?([A-Z][A-Z .]+)$", text):
        place = of[1].strip(" .")
        state = STATES.get(place, state)
        text = text[: of.start()]
    surname, comma, given = text.partition(",")
    if comma and _letters(surname):
        return {"title": title, "sex": _SEX.get(title), "state": state, "splits": [[_letters(surname), _names(given)]]}
    tokens = [t for t in re.findall(r"[A-Z0-9']+(?:-[A-Z0-9']+)*\.?", text) if t.rstrip(".") not in _JUNIOR]
    if tokens and tokens[-1] == "'":
        tokens.pop()
    splits = []
    for k in range(1, min(3, len(tokens)) + 1):
        name = _letters("".join(tokens[-k:]))
        if len(name) > 1:
            splits.append([name, _names(" ".join(tokens[:-k]))])
    return {"title": title, "sex": _SEX.get(title), "state": state, "splits": splits} if splits else None


_CODES = set(STATES.values())


def _letters(s: str) -> str:
    return re.sub(r"[^A-Z]", "", s.translate(_LETTER_OF))


def _names(s: str) -> list[str]:
    return [x for x in (_letters(t) for t in re.findall(r"[A-Z0-9']+", s)) if x and x not in _JUNIOR]


def given_fits(said: list[str], full: list[str]) -> int | None:
    """0: a given name fits, 1: only initials do, 2: none is said; None: they contradict the person's."""
    if not said:
        return 2
    if not full:
        return None if len(said[0]) > 1 else 1
    a, b = said[0], full[0]
    if len(a) == 1 or len(b) == 1:
        level = 1 if a[0] == b[0] else None
    elif a == b or b in _FULL.get(a, ()) or a in _FULL.get(b, ()) or slips(a, b, 1) <= 1:
        level = 0
    else:
        level = None
    if level is None or len(said) > 1 and len(full) > 1 and said[1][0] != full[1][0]:
        return None
    return level


def lcs_ratio(a: str, b: str) -> float:
    """2 * longest common subsequence / (|a| + |b|), bit-parallel."""
    places: dict[str, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        hit = row & places.get(y, 0)
        row = ((row + hit) | (row - hit)) & full
    return 2 * (len(a) - row.bit_count()) / (len(a) + len(b)) if a or b else 1.0


def slips(a: str, b: str, most: int) -> int:
    """Insertions, deletions, substitutions and exchanges of neighbours between a and b; most + 1 if there are more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return min(last[-1], most + 1)


def suffix_keys(name: str) -> list[str]:
    """Suffixes of the marked name, of the name without its last letters, and of the name backwards ("<": another index)."""
    forms = [f"{name}$", *(name[: len(name) - cut] for cut in range(CUT + 1)), f"<{name[::-1]}^"]
    keys = set()
    for form in forms:
        body, mark = form.lstrip("<"), form[: form.startswith("<")]
        keys |= {mark + body[i:] for i in range(len(body) - MIN_SUFFIX + 1)}
    return sorted(keys)


_PARSED = "title string, sex string, state string, splits array<struct<surname:string, given:array<string>, keys:array<string>>>"


def _parse_labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("surname", pa.string()), ("given", pa.list_(pa.string())), ("keys", pa.list_(pa.string()))]))
    for batch in batches:
        rows = [(label, parse_label(label)) for label in batch.column(0).to_pylist()]
        rows = [(label, p) for label, p in rows if p]
        splits = [[{"surname": s, "given": g, "keys": suffix_keys(s)} for s, g in p["splits"]] for _, p in rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string())]
            + [pa.array([p[c] for _, p in rows], pa.string()) for c in ("title", "sex", "state")]
            + [pa.array(splits, kind)],
            names=["label", "title", "sex", "state", "splits"],
        )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        c = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
        at, score, slip = [], [], []
        for i, (a, b) in enumerate(zip(c["surname"], c["person_surname"], strict=True)):
            if abs(len(a) - len(b)) > MOST_SLIPS:
                continue
            if a == b:
                d = 0
            elif lcs_ratio(a, b) < LEAST_RATIO or (d := slips(a, b, MOST_SLIPS)) > MOST_SLIPS:
                continue
            if d and c["title"][i] not in _SEX and c["title"][i] not in _NEUTRAL:
                continue  # no known person bears such a title: only an exact name would do
            if c["state"][i] and c["person_state"][i] and c["state"][i] != c["person_state"][i]:
                continue
            if c["sex"][i] and c["person_sex"][i] and c["sex"][i] != c["person_sex"][i]:
                continue
            fits = [given_fits(c["given"][i], g.split()) for g in c["person_given"][i] or [""]]
            fits = [f for f in fits if f is not None]
            if not fits:
                continue
            at.append(i)
            score.append(d * 10 + min(fits))
            slip.append(d)
        out = batch.take(pa.array(at, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [out.column("label"), out.column("person_id"), out.column("surname"), out.column("person_surname"), out.column("person_sex"), pa.array(score, pa.int32()), pa.array(slip, pa.int32())],
            names=["label", "person_id", "surname", "person_surname", "person_sex", "score", "slips"],
        )


def link_names(labels: DataFrame, label_col: str, persons: DataFrame, id_col: str, name_col: str, full_col: str, state_col: str) -> DataFrame:
    """(label, person_id) for each distinct label that denotes exactly one person of ``persons``.

    ``name_col`` holds a person's own label (title and surname), ``full_col`` the
    full name in natural order, ``state_col`` the state's code.
    """
    ship(labels.sparkSession)
    distinct = labels.select(F.col(label_col).alias("label")).where("trim(label) <> ''").distinct()
    parsed = distinct.mapInArrow(_parse_labels, f"label string, {_PARSED}").select("*", F.explode("splits").alias("s")).select(
        "label", "title", "sex", "state", "s.surname", "s.given", "s.keys"
    )

    own = persons.select(
        F.col(id_col).alias("person_id"), F.col(name_col).alias("label"), F.col(full_col).alias("full"), F.col(state_col).alias("person_state")
    ).where("trim(person_id) <> ''")
    names = own.select("label").where("trim(label) <> ''").distinct().mapInArrow(_parse_labels, f"label string, {_PARSED}")
    # the person's own label has no given names: the longest split is the whole surname
    names = names.select("label", "sex", F.element_at("splits", -1).alias("s")).select("label", "sex", "s.surname", "s.keys")
    given = F.upper(F.regexp_replace(F.regexp_extract("full", r"^(\S+(?:\s+\S\.?(?=\s))?)\s", 1), r"[^A-Za-z ]", ""))
    known = (
        own.join(names, "label")
        .groupBy("person_id", "surname", "keys")
        .agg(
            F.max("sex").alias("person_sex"),
            F.max("person_state").alias("person_state"),
            F.array_sort(F.collect_set(F.when(given != "", given))).alias("person_given"),
        )
        .withColumnRenamed("surname", "person_surname")
    )
    entries = known.select("*", F.explode("keys").alias("key")).drop("keys")
    common = entries.groupBy("key").count().where(F.col("count") > COMMON).select("key", F.lit(True).alias("common"))
    # a suffix is indexed if it is one of the shortest or the next shorter one is common
    back = F.col("key").startswith("<")
    letters = F.when(back, F.substring("key", 2, 1 << 20)).otherwise(F.col("key"))
    entries = entries.withColumn("letters", letters).withColumn(
        "shorter", F.concat(F.when(back, F.lit("<")).otherwise(F.lit("")), F.substring("letters", 2, 1 << 20))
    )
    entries = (
        entries.join(common.select(F.col("key").alias("shorter"), F.col("common").alias("go_on")), "shorter", "left")
        .where((F.length("letters") == MIN_SUFFIX) | F.col("go_on"))
        .join(common, "key", "left")
    )
    key, any_of = F.col("key"), F.lit("*")
    lengths = F.sequence(F.length("person_surname") - MOST_SLIPS, F.length("person_surname") + MOST_SLIPS)
    sexes = F.when(F.col("person_sex").isNull(), F.array(F.lit("M"), F.lit("F"), any_of)).otherwise(F.array("person_sex", any_of))
    by_length = F.flatten(F.transform(lengths, lambda n: F.transform(sexes, lambda x: F.concat(key, F.lit(":"), n.cast("string"), x))))
    refined = F.array_append(by_length, F.concat(key, F.lit("#"), F.coalesce("person_state", any_of)))
    indexed = entries.select(
        "person_id", "person_surname", "person_sex", "person_state", "person_given",
        F.explode(F.when(F.col("common"), refined).otherwise(F.array(key))).alias("block"),
    )
    probes = parsed.select("label", "title", "sex", "state", "surname", "given", F.explode("keys").alias("key")).join(common, "key", "left")
    refined = F.when(F.col("state").isNotNull(), F.array(F.concat(key, F.lit("#"), F.col("state")), F.concat(key, F.lit("#*")))).otherwise(
        F.array(F.concat(key, F.lit(":"), F.length("surname").cast("string"), F.coalesce("sex", any_of)))
    )
    probes = probes.select(
        "label", "title", "sex", "state", "surname", "given", F.explode(F.when(F.col("common"), refined).otherwise(F.array(key))).alias("block")
    )
    pairs = (
        probes.join(indexed, "block")
        .where(F.abs(F.length("surname") - F.length("person_surname")) <= MOST_SLIPS)
        .drop("block")
        .distinct()
    )
    compared = pairs.mapInArrow(_compare, "label string, person_id string, surname string, person_surname string, person_sex string, score int, slips int")
    # titles with which each surname occurs
    borne = parsed.groupBy("surname").agg(
        F.collect_set("sex").alias("sexes"), F.max((~F.coalesce("title", F.lit("")).isin(*_SEX, *_NEUTRAL)).cast("int")).alias("foreign")
    )
    # sexes of the members of a near surname whom labels of this spelling fit
    near = compared.groupBy("surname", "person_surname").agg(F.collect_set("person_sex").alias("near_sexes"))
    fitting = (
        compared.join(borne, "surname", "left")
        .join(near, ["surname", "person_surname"], "left")
        .where((F.col("slips") == 0) | ((F.col("foreign") == 0) & (F.size(F.array_except("sexes", "near_sexes")) <= 0)))
        .groupBy("label", "person_id")
        .agg(F.min("score").alias("score"))
    )
    # per label only the best score and who has it, not a list of candidates
    best = fitting.groupBy("label", "score").agg(F.min("person_id").alias("person_id"), F.count("*").alias("persons"))
    return (
        best.groupBy("label")
        .agg(F.min(F.struct("score", "persons", "person_id")).alias("b"))
        .where("b.persons = 1")
        .select("label", F.col("b.person_id").alias("person_id"))
    )
