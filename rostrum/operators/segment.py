"""Speeches cut out of transcripts by speaker labels, in the dialects of the daily and the bound edition.

A label may run over a line's end, so labels are found by one regular expression
over the text in Python; everything else of a text is decided in the same pass over
its events, sorted by place.  The operator is narrow: a text is never shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import EXTRANEOUS, SPACE
from ..runtime import ship
from .asof import cursor

# --- label grammars, put together from their parts; fixed values -------------

#: How names, double names and places are written in labels.
_NAME = r"[A-Z][a-z]{0,3}[A-Za-z'’]+"
_HYPHEN = r"(?:-[A-Za-z'’]+)*"
_PLACE = r"(?:\sof\s[A-Z][a-zA-Z]+(?:\s[A-Z][a-zA-Z]+)*)?"

#: The offices that speak by title. ``~`` stands for a blank, which the bound edition may lack.
_OFFICES = [
    "CLERK", "Acting~CHAIR", "ACTING~CHAIR", "CHAIR", "CHAIRMAN(?:~pro~tempore)?", "PRESIDING~OFFICER", "SPEAKER(?:~pro~tempore)?",
    "VICE~PRESIDENT", "VICE-PRESIDENT", "PRESIDENT~pro~tempore", "ACTING~PRESIDENT~pro~tempore", "CHIEF~JUSTICE", "OFFICER",
]
#: The same as scanners read them in the bound edition.
_READ = {"SPEAKER": "SPEA[KR]ER", "VICE": "[VW]ICE"}
_MORE = [r"SP\.~pro~tempore", r"PRESID\.~pro~tempore"]


#: Characters at which lines end, and one line end.
_BREAKS = r"\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029"
_LINE_END = rf"(?:\r\n|[{_BREAKS}])"


@dataclass(frozen=True)
class Dialect:
    name: str
    label: re.Pattern
    broken: re.Pattern | None = None  #: a line that ends in a hyphen and may begin a label, and the line behind it (looked at only)


def _dialect(name: str) -> Dialect:
    bound = name == "bound"
    blank = r"\s?" if bound else r"\s"
    offices = list(_OFFICES)
    if bound:
        for printed, read in _READ.items():
            offices = [re.sub(rf"\b{printed}\b", read, o) for o in offices]
        offices += _MORE
    offices = [o.replace("~", blank) for o in offices]
    title = r"(?:M(?:r|rs|s)[.,:;]|Miss|Chairman|Chairwoman|H(?:ON|on)[.,:;]|Dr[.,:;])" if bound else r"(?:M(?:r|rs|s)[.,]|Miss|Chairman|Chairwoman|HON\.|Hon|Dr\.)"
    remark = rf"(?:{blank}\([^)]*\))?"
    person = (
        rf"{title}{blank}(?:Counsel{blank})?(?:[A-Z]\.{blank})*{_NAME}(?:\s[A-Z]\.)*{_HYPHEN}(?:\s{_NAME}{_HYPHEN})*{_PLACE}(?:\s\[continuing\])?{remark}\."
    )
    officer = rf"{'[TF]he' if bound else 'The'}\s(?:{'|'.join(offices)}){remark}\."
    label = re.compile(rf"^\s{{{0 if bound else 1},2}}(?:{person}|{officer})", re.M)
    if not bound:
        return Dialect(name, label)
    plain = "|".join(o.replace("~", r"\s") for o in _OFFICES)
    opens = rf"(?=\s{{1,2}}(?:M(?:r|rs|s)[.,]|Miss|Chairman|Chairwoman|HON\.|Hon|Dr\.|The\s(?:{plain}))\b)"
    return Dialect(name, label, re.compile(rf"(?:\A|(?<=[{_BREAKS}])){opens}(?P<head>[^{_BREAKS}]*)-(?:\r\n|[\r\n])(?=(?P<rest>[^{_BREAKS}]*)(?P<end>{_LINE_END}?))"))


DIALECTS = {n: _dialect(n) for n in ("daily", "bound")}

#: Lines that end a speech, and what is printed in a speech but wasn't said.
_RULE = re.compile(r"^[ _\-]*_{3,}[ _\-]*$|^[ _\-]*-{3,}[ _\-]*$", re.M)
_HEADER = re.compile(r"^\[Congressional Record Volume.*\]$", re.M)
_NOTE = re.compile(r"^[ \t]*={5,}.*$", re.M)
_DATE = re.compile(r"\d{1,2}, \d{4}\.?$")
_WORD = re.compile(r"\b\w[\w'-]*\b")
_EXTRANEOUS = [re.compile(p.replace(SPACE, r"\s")) for p in EXTRANEOUS]


def clean(text: str) -> str:
    for pattern in _EXTRANEOUS:
        text = pattern.sub("", text)
    return text


_MARKER = re.compile(rf"((?:\A|(?<=[{_BREAKS}]))[ \t]*={{5,}}[^{_BREAKS}]*{_LINE_END}?)")


def without_notes(text: str) -> str:
    """The text without what stands between pairs of marker lines; the markers stay."""
    # text, marker, note, marker, text, ...
    return "".join(piece for i, piece in enumerate(_MARKER.split(text)) if i % 4 != 2) if "=====" in text else text


def _indent(line: str, tab: int) -> int:
    lead = line[: len(line) - len(line.lstrip(" \t"))]
    return len(lead) + lead.count("\t") * (tab - 1)


def line_ends(text: str) -> Iterator[tuple[int, int]]:
    """(place, kind) of indented titles (3) and right-justified dates (4), both at their line's start."""
    place, blank_before = 0, None
    for line in text.splitlines(keepends=True):
        body = line.strip()
        if body:
            if blank_before and _indent(line, 2) > 2:
                found = _WORD.findall(line)
                if found and sum(w[0].isupper() for w in found) * 2 >= len(found):
                    yield place, 3
            if _indent(line, 15) >= 15 and _DATE.search(body):
                yield place, 4
        blank_before = not body
        place += len(line)


def joined_labels(text: str, dialect: Dialect) -> str:
    """Labels broken by a hyphen at a line's end put together, each on its own line."""
    if dialect.broken is None or "-" not in text:
        return text
    done, parts = 0, []
    for m in dialect.broken.finditer(text):
        whole = m["head"] + m["rest"]
        label = dialect.label.match(whole)
        if label and m.start() >= done and not dialect.label.match(m["head"] + "-"):
            parts += [text[done : m.start()], whole[: label.end()], "\n", whole[label.end() :], m["end"] or "\n"]
            done = m.end("end")
    return "".join(parts) + text[done:]


def speeches(text: str, dialect: Dialect) -> list[tuple[str, str, int]]:
    """(label, speech, place of the label) in order; the place is in the text after notes were stripped and labels joined."""
    text = joined_labels(without_notes(text).replace("\xa0", " "), dialect)
    events = [(m.start(), 0, m.end()) for m in dialect.label.finditer(text)]
    if not events:
        return []
    for kind, pattern in ((1, _RULE), (2, _HEADER), (5, _NOTE)):
        events += [(m.start(), kind, 0) for m in pattern.finditer(text)]
    events += [(place, kind, 0) for place, kind in line_ends(text)]
    events.sort(key=lambda e: e[:2])
    out = []
    for (start, kind, end), following in zip(events, [*events[1:], (len(text), 9, 0)], strict=True):
        if kind == 0:
            out.append((text[start:end].strip()[:-1], clean(text[end : max(end, following[0])].strip()).strip(), start))
    return out


def segment(df: DataFrame, key: str, text: str, dialect: str = "daily") -> DataFrame:
    """key, speech_no (from 1), speaker, speech, place: the speeches of each text in order.  NULL texts have none."""
    ship(df.sparkSession)
    chosen = DIALECTS[dialect]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, no, who, said, place = [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                for n, (label, speech, start) in enumerate(speeches(text, chosen), 1):
                    at.append(i), no.append(n), who.append(label), said.append(speech), place.append(start)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(no, pa.int32()), pa.array(who, pa.string()), pa.array(said, pa.string()), pa.array(place, pa.int32())],
                names=[key, "speech_no", "speaker", "speech", "place"],
            )

    source = df.select(key, F.col(text).alias("_text")).where("_text is not null")
    return source.mapInArrow(run, f"`{key}` {source.schema[key].dataType.simpleString()}, speech_no int, speaker string, speech string, place int")


def placed(df: DataFrame, keys: list[str], text: str, marks: str, dialect: str = "daily") -> DataFrame:
    """keys, speech_no, speaker, speech, mark: the speeches of each text and the mark at or before the place where each is found again.

    A speech is looked for, cleaned as it is, from the end of the one before; one that
    isn't found lies there.  ``marks`` is a column of (start, value) in the order of
    their starts.  One narrow pass: neither texts nor speeches are shuffled.
    """
    ship(df.sparkSession)
    chosen = DIALECTS[dialect]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, no, who, said, mark = [], [], [], [], []
            for i, (text, found) in enumerate(zip(batch.column(len(keys)).to_pylist(), batch.column(len(keys) + 1).to_pylist(), strict=True)):
                starts = [m["start"] for m in found or ()]
                spoken = speeches(text, chosen)
                places = cursor(text, (speech for _, speech, _ in spoken))
                for n, ((label, speech, _), place) in enumerate(zip(spoken, places, strict=True), 1):
                    before = bisect_right(starts, place) - 1
                    at.append(i), no.append(n), who.append(label), said.append(speech), mark.append(found[before]["value"] if before >= 0 else None)
            rows = pa.array(at, pa.int64())
            own = [batch.column(c).take(rows) for c in range(len(keys))]
            columns = [*own, pa.array(no, pa.int32()), pa.array(who, pa.string()), pa.array(said, pa.string()), pa.array(mark, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, "speech_no", "speaker", "speech", "mark"])

    source = df.select(*keys, F.col(text).alias("_text"), F.col(marks).alias("_marks")).where("_text is not null")
    kinds = "".join(f"`{k}` {source.schema[k].dataType.simpleString()}, " for k in keys)
    return source.mapInArrow(run, f"{kinds}speech_no int, speaker string, speech string, mark string")


def register(spark) -> None:
    """``scrape_speeches(text, dialect)`` as a table function for SQL: LATERAL scrape_speeches(...)."""
    from pyspark.sql.functions import udtf

    ship(spark)

    class Scrape:
        def eval(self, text: str, dialect: str):
            for n, (label, speech, start) in enumerate(speeches(text or "", DIALECTS[dialect]), 1):
                yield n, label, speech, start

    spark.udtf.register("scrape_speeches", udtf(Scrape, returnType="speech_no int, speaker string, speech string, place int"))
