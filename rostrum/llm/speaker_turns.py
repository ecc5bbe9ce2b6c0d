"""Speech transcripts as clean, ordered speaker turns, by parsing-expression grammars.

A transcript is parsed line by line: a line either opens a turn (blanks, time notes,
a label, which may run on into the next line) or is running text.  Who is addressed
or spoken of, what only looks like a name, and lines that need the next one are
decided by rules of the grammar.  A second grammar finds the notes inside an
utterance (nested brackets, times, sounds) and hesitations.  Parse trees are
transformed into turns and cleaned utterances.

Defined results: a NULL or empty text is one empty turn of the row's speaker; a
NULL speaker leaves turn 1 without a name; rows with equal ids are taken as they
are; an empty table gives no turns; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import ship
from .name_variants import STATES, parse_label, slips
from .peg import Node, ahead, find, first, later, many, maybe, node, seq, token, unless
from .scan_repair import furniture

# --- what opens a turn -------------------------------------------------------

blank = token(r"[ \t\xa0]+")
gap = token(r"[ \t\xa0]*\r?\n[ \t\xa0]*|[ \t\xa0]+")
clock = token(r"\d{1,2}[:.]\d\d(?:[:.]\d\d)?(?:[ \t]*[apAP]\.?[ \t]?[mM]\.?)?")
stamp = first(
    seq(token(r"\{[ \t]*time[ \t]*\}[ \t]*"), token(r"\d{3,4}")),
    seq(token(r"\["), clock, token(r"\]")),
    seq(token(r"\("), clock, token(r"\)")),
    seq(token(r"<"), clock, token(r">")),
    token(r"\d{1,2}:\d\d:\d\d"),
    token(r"\d{1,2}:\d\d[ \t]*[apAP]\.?[mM]\.?"),
)
stamps = node("stamps", many(seq(stamp, maybe(blank))))
chevron = node("chevron", token(r">{1,3}[ \t]*|»[ \t]*"))
honorific = token(
    r"(?:(?:Mrs|Mr|Ms|MRS|MR|MS|Miss|MISS|Madam|Dr|DR)\b[.,:]?|(?:Senator|SENATOR|Sen\.|Rep\.|Representative|Congressman|Congresswoman|Chairman|Chairwoman)\b|Hon\.?|HON\.?)"
    r"(?:[ \t\xa0]*\r?\n[ \t\xa0]*|[ \t\xa0]*)"
)
_BROKEN = r"(?:[-‐¬\xad][ \t]*\r?\n[ \t]*[A-Za-z'’]+|-[A-Z][A-Za-z'’]+)*"
#: Titles by which somebody is addressed, and words that open notes and no turns.
addressed = token(r"(?:President|Speaker|Chair(?:man|woman)?|Secretary|Clerk|Leader|Vice|Madam|Justice)\b", re.I)
heading = token(
    r"(?:NOTE|NOTICE|REPORTER|CONTINUED|SECTION|TITLE|RESOLVED|WHEREAS|ARTICLE|AMENDMENT|RECORD|CONGRESSIONAL|HOUSE|SENATE|YEAS|NAYS|ORDERED)\b", re.I
)
place = token(rf"(?:{'|'.join(STATES)})\b(?=\s*[:(\[])")
upper_word = seq(unless(addressed), token(rf"(?:[A-Z]'|[A-Z]’)?[A-Z][A-Z0-9'’|~^·†]*{_BROKEN}(?![a-z])"))
initial = token(r"[A-Z]\.")
mixed_word = seq(unless(addressed), token(rf"(?:[A-Z]['’])?[A-Z][A-Za-z'’]*{_BROKEN}"))
several = token(r"(?=[A-Z]\.|[A-Z]['’]?[A-Za-z0-9])")
upper_name = node("name", seq(several, many(seq(initial, gap)), upper_word, many(seq(gap, unless(token(r"of\b")), first(initial, upper_word)))))
mixed_name = node("name", seq(several, many(seq(initial, gap)), mixed_word, many(seq(gap, unless(token(r"of\b")), first(initial, mixed_word)))))
# without a form of address: up to three words, the last of which has four letters
another = ahead(token(r"[A-Z]"))
bare_word = seq(unless(heading), first(initial, upper_word), gap, another)
bare_upper = node("name", seq(unless(place), maybe(bare_word), maybe(bare_word), token(r"(?=[A-Z'’0-9|~^·†]{4})"), unless(heading), upper_word))
opener = token(
    r"(?:However|Therefore|Indeed|Thus|Hence|Yes|No|Well|Now|And|But|So|First|Second|Third|Finally|Frankly|Again|Moreover|Otherwise|Meanwhile|Still|Then|Here"
    r"|That|This|These|Those|It|We|You|He|She|They|There|If|When|What|Why|How|Order|Question|Provided)\b"
)
mixed_part = seq(unless(heading), mixed_word, blank, another)
bare_mixed = node("name", seq(maybe(mixed_part), maybe(mixed_part), token(r"(?=[A-Za-z'’]{4})"), unless(heading), mixed_word))
state = node("state", seq(gap, token(r"of\b"), gap, token(r"[A-Z][A-Za-z]+(?:\s+[A-Z][a-z]+)?")))
remark = node("remark", seq(maybe(gap), first(token(r"\[[^\]\[]*\]"), token(r"\([^()]*\)"))))
dash = token(r"[ \t]*(?:--+|—|–)")
full_stop = seq(token(r"\."), ahead(token(r"\s|$|[\[(*<{]")))
colon = token(r"[ \t]*:(?=\s|$)")
role = token(
    r"(?:CLERK|(?:ACTING\s+)?CHAIR(?:MAN|WOMAN)?(?:\s+pro\s+tem(?:pore|\.)?)?|PRESID[IlL1]NG\s+OFFICER|SPEA[KR]ER(?:\s+pro\s+tem(?:-\s*pore|pore|\.)?)?"
    r"|[VW]ICE[\s-]PRESIDENT|(?:ACTING\s+)?PRESIDENT(?:\s+pro\s+tem(?:-\s*pore|pore|\.)?)?|CHIEF\s+JUSTICE|OFFICER|SECRETARY)(?![A-Za-z])",
)
officer = node("officer", seq(token(r"[TF]h?e(?:[ \t\xa0]*\r?\n[ \t\xa0]*|[ \t\xa0]+)|[TF]HE[ \t\xa0]+"), node("role", role)))
closed = node("mark", first(full_stop, colon, dash))
strong = node("mark", first(colon, dash))
tail = seq(maybe(state), many(remark))
# a name in capitals, or one to three words before a dash: looked for before words are read one by one
capitals = token(r"(?=[A-Z][A-Z'’.0-9|~^·†])")
dashed = token(r"(?=[A-Z]['’]?[A-Za-z'’-]+(?:[ \t\xa0]+[A-Z]['’]?[A-Za-z'’-]+){0,2}[ \t]*(?:--|—|–))")
label = first(
    seq(officer, many(remark), closed),
    seq(honorific, upper_name, tail, closed),
    seq(honorific, mixed_name, tail, strong),
    seq(capitals, bare_upper, tail, colon),
    # a new sentence follows the dash
    seq(dashed, unless(first(officer, opener)), bare_mixed, node("mark", dash), ahead(token(r"\s+[\"“'(\[<{]?[A-Z\d]"))),
)
enclosed = seq(token(r"\["), first(officer, seq(honorific, first(upper_name, mixed_name), maybe(state))), token(r"\]"), maybe(closed))
opening = seq(
    maybe(blank),
    first(
        seq(ahead(token(r"[A-Z]")), node("label", label)),
        seq(stamps, maybe(chevron), maybe(stamps), node("label", first(enclosed, label))),
    ),
)

#: Line starts with which an opening can begin.
_LINE = re.compile(r"^[ \t\xa0]*(?=[A-Z\[({<>»\d])", re.M)
#: Running text that needs another word, so that a name behind it belongs to its sentence.
unfinished = token(
    r".*(?<!-)\b(?:of|that|the|to|and|or|by|from|with|for|in|on|at|than|as|but|told|asked|friend|gentleman,|gentlewoman,|Senator|colleague,?)\s*$", re.S
)


def plain_name(text: str) -> str:
    """A name in upper case without line breaks, stray marks and hyphens of a line's end."""
    text = re.sub(r"[-‐¬\xad][ \t]*\r?\n[ \t]*", "", text)
    text = re.sub(r"[|~^·†]", "", text)
    return re.sub(r"\s+", " ", text).strip(" .,:;-").upper().replace("’", "'")


def _speaker_of(text: str, tree: tuple) -> str | None:
    """The name of the label in a parse tree."""
    found = find(tree, "role")
    if found is not None:
        return re.sub(r"TEM- ?PORE|TEM\.?$", "TEMPORE", plain_name(text[found.start : found.end]))
    found = find(tree, "name")
    name = plain_name(text[found.start : found.end])
    return name if len(_letters(name)) > 1 else None


def _letters(name: str) -> str:
    return re.sub(r"[^A-Z]", "", name)


def same_name(a: set[str], b: str) -> bool:
    """Whether the name b is one of the names a, but for slips of the pen."""
    own = _letters(b)
    return any(x == own or min(len(x), len(own)) >= 6 and slips(x, own, 2) <= 2 for x in a)


def own_names(speaker: str | None) -> set[str]:
    """The possible names (letters) of a row's own speaker."""
    if not speaker or not speaker.strip():
        return set()
    parsed = parse_label(speaker)
    if parsed:
        return {s for s, _ in parsed["splits"]}
    return {_letters(plain_name(re.sub(r"^\s*[TFtf][Hh]?[Ee]\s+", "", re.sub(r"[(\[].*", "", speaker.replace("l", "I") if speaker.isupper() else speaker))))}


def _goes_on(text: str, at: int) -> bool:
    """Whether the running text before a line needs another word."""
    while at > 0:
        begin = text.rfind("\n", 0, at - 1) + 1
        line = text[begin : at - 1]
        if line.strip() and (line := clean(line)).strip() and not furniture(line):
            return unfinished(line, 0) is not None
        at = begin
    return False


def turns(text: str | None, speaker: str | None) -> list[tuple[int, str | None, int, int]]:
    """(turn_no, name, start, end) of each turn of a text; turn 1 is the row's own speaker's."""
    names = own_names(speaker)
    out: list[list] = [[1, _first_name(speaker), 0, 0]]
    if not text:
        return [tuple(out[0])]
    done = 0
    for m in _LINE.finditer(text):
        if m.start() < done or (found := opening(text, m.start())) is None:
            continue
        end, tree = found
        said = _speaker_of(text, tree)
        if said is None:
            continue
        marked = find(tree, "chevron") is not None or (s := find(tree, "stamps")) is not None and s.end > s.start
        bracketed = text[find(tree, "label").start] == "["
        if not marked and not bracketed and _goes_on(text, m.start()):
            continue
        done = end
        out[-1][3] = m.start() if out[-1][3] == 0 else out[-1][3]
        if same_name(names, said):
            out.append([out[-1][0], out[-1][1], end, 0])  # the same turn goes on behind the label
            continue
        names = {_letters(said)}
        out.append([out[-1][0] + 1, said, end, 0])
    out[-1][3] = len(text)
    return [tuple(x) for x in out]


def _first_name(speaker: str | None) -> str | None:
    if not speaker or not speaker.strip():
        return None
    parsed = parse_label(speaker)
    if parsed is None:
        return plain_name(re.sub(r"^\s*[TFtf][Hh]?[Ee]\s+", "", re.sub(r"[(\[].*", "", speaker)))
    text = re.sub(r"\s+", " ", re.sub(r"(?<=[A-Za-z])- (?=[A-Za-z])", "", speaker.replace("\xa0", " "))).strip()
    found = seq(honorific, first(upper_name, mixed_name))(text, 0)
    if found is None:
        return plain_name(re.sub(r"[(\[].*|,.*| of .*", "", text))
    name = find(found[1], "name")
    return plain_name(text[name.start : name.end])


# --- what is cleaned out of an utterance -------------------------------------

_SOUNDS = (
    r"(?:applau\w*|laugh\w*|cheer\w*|inaudible|unintelligible|indiscernible|crosstalk|pauses?|silence|coughs?|coughing|gavel|bells?|rings?|music|singing"
    r"|sounds?|noise|disturbance|demonstration|shouts?|booing|hisses|whispers?|interruption|recess|murmurs?|chatter|sighs?|clears throat)"
)
inner = later(lambda: bracket)
bracket = first(
    seq(token(r"\["), many(first(inner, token(r"[^\[\](){}<>]+"))), token(r"\]")),
    seq(token(r"\("), many(first(inner, token(r"[^\[\](){}<>]+"))), token(r"\)")),
    seq(token(r"<"), many(first(inner, token(r"[^\[\](){}<>\n]+"))), token(r">")),
    seq(token(r"\*"), token(r"[A-Za-z][A-Za-z ,.'-]+"), token(r"\*")),
)
_SOUND = re.compile(rf"\b{_SOUNDS}\b", re.I)


_BRACKETS = re.compile(r"[\[\](){}<>]")
_CLOSED_BY = {"[": "]", "(": ")", "<": ">"}
_DEEP = 100


def _close(text: str, at: int) -> int | None:
    """End of the bracket that opens at a place; None if it isn't closed, or more than ``_DEEP`` deep (then it is no note)."""
    waiting = []
    for m in _BRACKETS.finditer(text, at):
        if m[0] in _CLOSED_BY and len(waiting) < _DEEP:
            waiting.append(_CLOSED_BY[m[0]])
        elif not waiting or m[0] != waiting.pop():
            return None
        if not waiting:
            return m.end()
    return None


def _sounding(text: str, at: int):
    """A bracket that names a sound somewhere inside."""
    if text[at : at + 1] == "*":
        end = text.find("*", at + 1) + 1 or None
    else:
        end = _close(text, at)
    if end is None or not _SOUND.search(text, at, end):
        return None
    found = bracket(text[at:end], 0)
    return (at + found[0], ()) if found is not None and _SOUND.search(text, at, at + found[0]) else None


sound = node("sound", _sounding)
time_note = node("time", seq(stamp, unless(token(r"\d"))))
hesitation = node(
    "hesitation",
    first(
        token(r"(?<![\w'-])(?:uh+|um+|erm?|mm+|hm+|ah)(?![\w'-])[ \t]*(?:,|--|—|\.\.\.|…)?", re.I),
        token(r"(?<![\w'-])(?:you\s+know|I\s+mean),", re.I),
        token(r"(?<![\w'-])well,(?=\s*(?:uh|um|er|mm|hm|ah)\b)", re.I),
    ),
)
note = first(sound, time_note, hesitation)
_NOTE_START = re.compile(r"[\[(<*{]|(?<![\w:.$-])\d{1,2}:\d\d|(?<![\w'-])(?:[Uu]h|[Uu]m|[Ee]r|[Mm]m|[Hh]m|[Aa]h|[Yy]ou\s+know|I\s+mean|[Ww]ell,)", re.M)


def notes(text: str) -> Iterator[Node]:
    """The notes and hesitations of an utterance, as nodes."""
    at = 0
    while (m := _NOTE_START.search(text, at)) is not None:
        found = note(text, m.start())
        if found is None:
            at = m.start() + 1
            continue
        yield found[1][0]
        at = max(found[0], m.start() + 1)


def clean(text: str) -> str:
    """The utterance without notes and hesitations; blanks are closed up, lines stay."""
    parts, at = [], 0
    for n in notes(text):
        parts.append(text[at : n.start])
        at = n.end
    parts.append(text[at:])
    out = re.sub(r"[ \t\xa0]+", " ", " ".join(p.strip(" \t") if 0 < i < len(parts) - 1 else p for i, p in enumerate(parts)))
    out = re.sub(r" +([,.;:?!])", r"\1", out)
    return re.sub(r" *\n *", "\n", out).strip(" ")


def speaker_turns(df: DataFrame, id_col: str, speaker_col: str, text_col: str) -> DataFrame:
    """(id, turn_no, turn_speaker, utterance): all turns in order, with clean utterances.  No shuffle."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, no, name, said = [], [], [], []
            for i, (speaker, text) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                last = 0
                for turn, who, start, end in turns(text, speaker):
                    body = clean((text or "")[start:end])
                    if turn == last:
                        said[-1] = f"{said[-1]}\n{body}".strip("\n")
                        continue
                    at.append(i), no.append(turn), name.append(who), said.append(body.strip("\n"))
                    last = turn
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(no, pa.int32()), pa.array(name, pa.string()), pa.array(said, pa.string())],
                names=["id", "turn_no", "turn_speaker", "utterance"],
            )

    source = df.select(F.col(id_col).alias("id"), F.col(speaker_col).alias("speaker"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, turn_no int, turn_speaker string, utterance string")


def turn_starts(df: DataFrame, id_col: str, speaker_col: str, text_col: str) -> DataFrame:
    """(id, turn_no, turn_speaker): the turns after the first, without utterances."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, no, name = [], [], []
            for i, (speaker, text) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                last = 1
                for turn, who, _, _ in turns(text, speaker):
                    if turn > last:
                        at.append(i), no.append(turn), name.append(who)
                        last = turn
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(no, pa.int32()), pa.array(name, pa.string())], names=["id", "turn_no", "turn_speaker"]
            )

    source = df.select(F.col(id_col).alias("id"), F.col(speaker_col).alias("speaker"), F.col(text_col).alias("text")).where("text is not null")
    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, turn_no int, turn_speaker string")
