"""Lines of texts as rows, with offsets, and operators on sequences of lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import SPACE


def explode_lines(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, line_no (from 0), line: the LF-separated lines of each text.  No shuffle."""
    return df.select(*keys, F.posexplode(F.split(F.col(text), "\n", -1)).alias("line_no", "line"))


def _window(keys: list[str], order: str = "line_no"):
    return W.partitionBy(*keys).orderBy(order)


def with_offsets(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``start``: where the line begins in its text, in characters."""
    before = _window(keys).rowsBetween(W.unboundedPreceding, -1)
    return lines.withColumn("start", F.coalesce(F.sum(F.length("line") + 1).over(before), F.lit(0)))


def strip_notes(lines: DataFrame, keys: list[str], marker: Column | None = None) -> DataFrame:
    """Without the lines between pairs of note markers; the markers stay.  After an odd last marker all is dropped."""
    marker = F.col("line").rlike("^[ \t]*={5,}") if marker is None else marker
    so_far = F.sum(marker.cast("int")).over(_window(keys).rowsBetween(W.unboundedPreceding, 0))
    return lines.withColumn("_m", marker).withColumn("_n", so_far).where(F.col("_m") | (F.col("_n") % 2 == 0)).drop("_m", "_n")


def is_rule(line: Column) -> Column:
    """Lines of underscores or dashes."""
    return line.rlike("^[ _-]*_{3,}[ _-]*$") | line.rlike("^[ _-]*-{3,}[ _-]*$")


def is_document_header(line: Column) -> Column:
    return line.rlike(r"^\[Congressional Record Volume.*\]$")


def is_note_marker(line: Column) -> Column:
    return line.rlike("^[ \t]*={5,}")


def indent(line: Column, tab: int) -> Column:
    lead = F.regexp_extract(line, "^[ \t]*", 0)
    return F.length(lead) + F.regexp_count(lead, F.lit("\t")) * (tab - 1)


def is_indented_title(line: Column, before: Column) -> Column:
    """Below a blank line, indented by more than two, at least half of its words capitalized."""
    words = F.regexp_extract_all(line, F.lit(r"(?U)\b\w[\w'-]*\b"), 0)
    capital = F.filter(words, lambda w: w.rlike(r"^\p{Lu}"))
    blank_before = F.regexp_replace(before, SPACE, "") == ""
    found = blank_before & (indent(line, 2) > 2) & (F.size(words) > 0) & (F.size(capital) * 2 >= F.size(words))
    return F.coalesce(found, F.lit(False))


def is_right_date(line: Column) -> Column:
    """Indented by 15 or more and ending in a day and a year."""
    return (indent(line, 15) >= 15) & F.regexp_replace(line, f"{SPACE}+$", "").rlike(r"[0-9]{1,2}, [0-9]{4}\.?$")


def end_markers(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Each line that ends a speech, with the kinds of marker it is."""
    line, before = F.col("line"), F.lag("line").over(_window(keys))
    kinds = {
        "rule": is_rule(line),
        "header": is_document_header(line),
        "note": is_note_marker(line),
        "title": is_indented_title(line, F.col("_before")),
        "date": is_right_date(line),
    }
    marked = lines.withColumn("_before", before).select("*", *[c.alias(k) for k, c in kinds.items()]).drop("_before")
    return marked.where(" or ".join(kinds))


#: Fixed value: labels that stand in one line, as the daily edition prints them.
LINE_LABEL = (
    r"^ {1,2}((?:M(?:r|rs|s)[.,]|Miss|Chairman|Chairwoman|HON\.|Hon|Dr\.) (?:[A-Z]\. )*[A-Z][a-z]{0,3}[A-Za-z'’]+(?: [A-Z][a-z]{0,3}[A-Za-z'’]+)*"
    r"(?: of [A-Z][a-zA-Z]+(?: [A-Z][a-zA-Z]+)*)?)\."
)


def line_speeches(df: DataFrame, key: str, text: str, label: str = LINE_LABEL) -> DataFrame:
    """Speeches by labels that stand in one line: key, start, speaker, speech.  Each ends where the next label stands or the text ends."""
    lines = with_offsets(explode_lines(df, [key], text), [key])
    named = lines.withColumn("speaker", F.regexp_extract("line", label, 1)).where("speaker <> ''")
    following = F.lead("start").over(W.partitionBy(key).orderBy("start"))
    spans = named.select(key, "start", "speaker", F.length(F.regexp_extract("line", label, 0)).alias("_long"), following.alias("_next"))
    whole = df.select(key, F.col(text).alias("_text"))
    spans = spans.join(whole, key)
    body = F.substring("_text", F.col("start") + F.col("_long") + 1, F.coalesce("_next", F.length("_text")) - F.col("start") - F.col("_long"))
    return spans.select(key, "start", "speaker", F.trim(body, F.lit(" \n")).alias("speech"))
