"""Debate titles found in reconstructed files and given to the speeches below them.

Titles are islands of lines.  Each line of a file is one letter for its kind; a
regular expression over these letters finds the islands.  One narrow pass over the
files, linear in their lines: no line is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from ..runtime import ship
from .asof import within_section

_LETTERS, _CAPITALS = re.compile("[A-Za-z]"), re.compile("[A-Z]")
_NOT_SMALL = re.compile("[^a-z]+")
#: Words of the printer's seal, and what a line of the publisher's name reads without other characters.
_SEAL = {"gpo", "authenticated", "authentication", "authentic", "information"}
_PUBLISHER = {"usgovernment", "usgoverment"}
_OUTER = ",.;:!?—–-()[]{}<>\"'`"
#: s opens a title or goes on with it, k goes on with an open one, as blank lines (b) before title-like lines do; j and x are like k and n, but title-like.
_ISLAND = re.compile("s(?:[sjk]|b+(?=[sjx]))*")


def capital_share(body: str) -> float:
    """Share of capitals in the A-Z letters of a line's words, without the word "report"; 0 without letters."""
    if "report" in body.lower():
        body = " ".join(w for w in body.split() if "".join(_LETTERS.findall(w)).lower() != "report")
    letters = len(_LETTERS.findall(body))
    return len(_CAPITALS.findall(body)) / letters if letters else 0.0


def line_kind(line: str) -> str:
    """The letter of a line in ``_ISLAND``: s, k, j, b, x or n."""
    body = line.strip()
    if not body:
        return "b"
    capitals = len(_CAPITALS.findall(body))
    if not capitals:
        return "n"
    low = body.lower()
    looks = len(_LETTERS.findall(body)) >= 8 and capital_share(body) >= 0.60
    if not looks and len(body) > 40 and " " in body:
        return "n"  # more than one word
    plain = _NOT_SMALL.sub("", low)
    if "congressionalrecord" in plain or plain in _PUBLISHER or (words := set(_NOT_SMALL.split(low)) - {""}) and words <= _SEAL:
        return "x" if looks else "n"
    lettered = sum(_LETTERS.search(w) is not None for w in body.split())
    if lettered >= 2 and looks:
        return "s"
    if lettered == 1 and any(len(_LETTERS.findall(w)) >= 2 and not re.search("[a-z]", w) for w in (w.strip(_OUTER) for w in body.split())):
        return "j" if looks else "k"
    return "x" if looks else "n"


def title_blocks(text: str) -> list[tuple[str, int, int]]:
    """(title, start, end) of each title block, in characters."""
    lines = text.split("\n")
    starts = list(accumulate((len(x) + 1 for x in lines), initial=0))
    found = ((m.start(), m.end()) for m in _ISLAND.finditer("".join(map(line_kind, lines))))
    blocks = ((text[starts[a] : starts[b] - 1] + "\n", starts[a], starts[b]) for a, b in found)
    return [b for b in blocks if not b[0].lstrip().startswith(("Mr.", "Ms.", "Mrs."))]


def reconstruct(speeches: DataFrame, file: str, order: str, speech: str) -> tuple[DataFrame, DataFrame]:
    """(files, starts): each file's speeches joined by blank lines, and where each begins in it."""
    one = speeches.select(file, order, F.concat(F.coalesce(F.col(speech), F.lit("")), F.lit("\n\n")).alias("_s"))
    before = W.partitionBy(file).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    starts = speeches.select(
        "*", F.coalesce(F.sum(F.length(F.coalesce(F.col(speech), F.lit(""))) + 2).over(before), F.lit(0)).alias("start")
    )
    rows = one.groupBy(file).agg(F.array_sort(F.collect_list(F.struct(order, "_s"))).alias("_l"))
    return rows.select(file, F.array_join(F.transform("_l", lambda x: x["_s"]), "").alias("text")), starts


def titles(files: DataFrame, file: str, text: str = "text") -> DataFrame:
    """file, title, start, end: the title blocks of each file, in characters."""
    ship(files.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, *block) for i, text in enumerate(batch.column(1).to_pylist()) for block in title_blocks(text)]
            at, title, start, end = zip(*found, strict=True) if found else ((), (), (), ())
            columns = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(title, pa.string()), pa.array(start, pa.int32()), pa.array(end, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[file, "title", "start", "end"])

    source = files.select(file, F.col(text).alias("_text")).where("_text is not null")
    return source.mapInArrow(run, f"`{file}` {source.schema[file].dataType.simpleString()}, title string, start int, end int")


def sections(found: DataFrame, files: DataFrame, file: str, text: str = "text") -> DataFrame:
    """file, title, start, end: from a title's end to the next title, or to the file's end."""
    length = files.select(file, F.length(text).alias("_length"))
    following = F.lead("start").over(W.partitionBy(file).orderBy("start"))
    return found.withColumn("_next", following).join(length, file).select(
        file, T.strip("title").alias("title"), F.col("end").alias("start"), F.coalesce("_next", "_length").alias("end")
    )


def assign_titles(speeches: DataFrame, file: str, order: str, speech: str) -> DataFrame:
    """``speeches`` with ``title`` ('' outside sections), the title's own lines taken out of ``speech``."""
    files, starts = reconstruct(speeches, file, order, speech)
    spans = sections(titles(files, file), files, file)
    titled = within_section(starts, spans, [file], "start", "start", "end", ["title"])
    named = titled.withColumn("title", F.coalesce("title", F.lit("")))
    return named.withColumn(speech, T.without_title(speech, "title")).drop("start")
