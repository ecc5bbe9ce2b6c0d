"""Boilerplate lines out of scanned volumes: which line goes, and why.

Rules are tried in a fixed order and the first that fits names the reason.  All but
the similarity ratio are native expressions; one Python call scores the lines whose
length and letters allow a hit, the others are NULL to it.
"""

from __future__ import annotations

from difflib import SequenceMatcher
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..functions.text import more_than_half_capitals, normalize_characters, normalize_line, splitlines, strip
from ..runtime import ship

#: Words that may stand in a heading beside the record's name.
DATE_WORDS = (
    "JANUARY JAN FEBRUARY FEB MARCH MAR APRIL APR MAY JUNE JUN JULY JUL AUGUST AUG SEPTEMBER SEP SEPT OCTOBER OCT NOVEMBER NOV DECEMBER DEC "
    "SUNDAY SUN MONDAY MON TUESDAY TUES WEDNESDAY WEDS THURSDAY THURS FRIDAY FRI SATURDAY SAT"
).split()
#: Words of the printer's seal.
SEAL_WORDS = ["AUTHENTICATED", "AUTHENTICATE", "AUTHENTICATION", "AUTHENTIC", "INFORMATION", "GPO"]
RECORD, HOUSE, SENATE = "CONGRESSIONAL RECORD", "HOUSE OF REPRESENTATIVES", "SENATE"


def ratio(a: str, b: str) -> float:
    """Ratcliff and Obershelp's ratio of a to b; the order of the two matters."""
    return SequenceMatcher(None, a, b).ratio()


#: name: (text, least ratio, lengths between which it can be reached).
_ALIKE = {"house": (HOUSE, 0.90, 20, 29), "senate": (SENATE, 0.83, 5, 8), "record": (RECORD, 0.90, 17, 24)}
_SCORED = ArrayType(StringType())


@F.pandas_udf(_SCORED)
def _alike(up: pd.Series) -> pd.Series:
    """Names of the headings that a line resembles."""

    def names(x: str) -> list[str]:
        return [n for n, (target, least, low, high) in _ALIKE.items() if low <= len(x) <= high and ratio(x, target) >= least]

    return up.map(cache(names), na_action="ignore")


def _scored(lines: DataFrame) -> DataFrame:
    """Adds ``_is``: the headings that ``_up`` resembles, by one call; lines that can't resemble any are NULL to it."""
    size = F.length("_up")
    possible = F.lit(False)
    for target, least, low, high in _ALIKE.values():
        # of the target's letters at least this share must be there
        letters = F.length(F.regexp_replace("_up", f"[^{''.join(sorted(set(target)))}]+", ""))
        possible = possible | (size.between(low, high) & (letters >= F.floor(least * (size + len(target)) / 2)))
    return lines.withColumn("_is", F.coalesce(_alike(F.when(possible, F.col("_up"))), F.array().cast(_SCORED)))


def names_only_record(line: Column) -> Column:
    words = F.regexp_extract_all(F.upper(line), F.lit("[A-Z]+"), 0)
    return F.size(F.array_except(words, F.array(*map(F.lit, ["CONGRESSIONAL", "RECORD", *DATE_WORDS])))) == 0


def is_seal(line: Column, up: Column) -> Column:
    # the first word alone rules most lines out
    likely = up.rlike(f"^[^A-Za-z]*(?:{'|'.join(SEAL_WORDS)})(?![A-Za-z])")
    words = F.regexp_extract_all(up, F.lit("[A-Za-z]+"), 0)
    return likely & (F.size(words) > 0) & (F.size(F.array_except(words, F.array(*map(F.lit, SEAL_WORDS)))) == 0) & more_than_half_capitals(line)


def is_heading_word(line: Column) -> Column:
    """First word all capitals, or long and all capitals but one letter."""
    first = F.regexp_extract(line, "[A-Za-z]+", 0)
    return (first.rlike("^[A-Z]{3,}$")) | ((F.length(first) >= 6) & (F.regexp_count(first, F.lit("[a-z]")) <= 1))


def nearly_contains_record(line: Column) -> Column:
    """Whether some 19 to 21 characters, but letters and blanks dropped, are within one edit of the record's name."""
    up = F.upper(line)

    def near(size: int) -> Column:
        places = F.sequence(F.lit(1), F.length(up) - size + 1)
        hit = F.exists(places, lambda i: F.levenshtein(F.regexp_replace(F.substring(up, i, F.lit(size)), "[^A-Z ]", ""), F.lit(RECORD), 1) >= 0)
        return F.coalesce(F.when(F.length(up) >= size, hit), F.lit(False))

    # one edit leaves one half of the name as it is
    between = "[^A-Z ]*"
    possible = up.rlike("|".join(between.join(half) for half in ("CONGRESSI", "NAL RECORD", "ONAL RECOR")))
    return F.when(possible, near(19) | near(20) | near(21)).otherwise(F.lit(False))


def reasons(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``clean_line`` and ``reason`` (NULL: the line stays) to lines (keys, line_no, line)."""
    ship(lines.sparkSession)
    line = F.col("clean_line")
    up, bare = F.col("_up"), F.col("_bare")
    year = F.when(bare.rlike("^[0-9]{4}$"), bare.cast("int"))
    house = F.array_contains("_is", "house") & more_than_half_capitals(line)
    senate = F.array_contains("_is", "senate") & more_than_half_capitals(line)
    named = lines.withColumn("clean_line", normalize_line("line")).withColumn("_bare", strip(line)).withColumn("_up", F.upper("_bare"))
    named = _scored(named)
    first = (
        F.when(year.between(1873, 1994), "hdr_year_1873_1994")
        .when(up.contains(RECORD) & names_only_record(line), "hdr_contains_CONGRESSIONAL_RECORD")
        .when(house, "hdr_fuzzy_HOUSE_OF_REPRESENTATIVES")
        .when(senate, "hdr_fuzzy_SENATE")
        .when(F.array_contains("_is", "record") & names_only_record(line), "hdr_fuzzy_CONGRESSIONAL_RECORD")
        .when(is_seal(line, up), "hdr_auth_gpo_line")
    )
    named = named.withColumn("_first", first)
    # a chamber's heading reaches to the next line that no other rule takes
    heading = F.col("_first").isin("hdr_fuzzy_HOUSE_OF_REPRESENTATIVES", "hdr_fuzzy_SENATE")
    chain = F.col("_first").isNull() | heading
    before = W.partitionBy(*keys, "_chain").orderBy("line_no")
    named = named.withColumn("_chain", chain).withColumn("_after", F.col("_chain") & F.coalesce(F.lag(heading).over(before), F.lit(False)))
    skipped = F.col("_first").isNull() & F.col("_after") & is_heading_word(line)
    reason = F.coalesce(
        F.col("_first"),
        F.when(skipped, "hdr_skip_next_after_chamber_header"),
        F.when(nearly_contains_record(line), "fuzzy_CONGRESSIONAL_RECORD_lev_leq1"),
    )
    return named.withColumn("reason", reason).drop("_first", "_chain", "_after", "_bare", "_up", "_is")


def text_lines(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """The lines the rules look at: of the text with odd characters normalized."""
    return df.select(*keys, F.posexplode(splitlines(normalize_characters(text))).alias("line_no", "line"))


def precleaned(judged: DataFrame, keys: list[str]) -> DataFrame:
    """keys, text: the lines that stay, joined again; texts that lose all lines are empty."""
    kept = F.when(F.col("reason").isNull(), F.struct("line_no", "clean_line"))
    rows = judged.groupBy(*keys).agg(F.array_sort(F.collect_list(kept)).alias("_l"))
    return rows.select(*keys, F.array_join(F.transform("_l", lambda x: x["clean_line"]), "\n").alias("text"))


def removed(judged: DataFrame, keys: list[str]) -> DataFrame:
    return judged.where("reason is not null").select(*keys, "line_no", "reason", F.col("clean_line").alias("removed_line"))


def removed_log(judged: DataFrame, log: str) -> DataFrame:
    """Removed lines in the order of their logs' names, and in each by line."""
    return judged.where("reason is not null").select(log, "line_no", "reason", F.col("clean_line").alias("removed_line")).orderBy(log, "line_no")


def summary(judged: DataFrame) -> DataFrame:
    return judged.where("reason is not null").groupBy("reason").count()


def byte_totals(before: DataFrame, text: str, after: DataFrame, clean_text: str) -> DataFrame:
    """Bytes before and after, and the percentage kept."""
    a = before.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("bytes_in"))
    b = after.agg(F.coalesce(F.sum(F.octet_length(clean_text)), F.lit(0)).alias("bytes_out"))
    one = F.lit(1)
    both = a.withColumn("_k", one).join(b.withColumn("_k", one), "_k").drop("_k")
    return both.withColumn("kept_percent", F.when(F.col("bytes_in") > 0, F.col("bytes_out") * 100.0 / F.col("bytes_in")).otherwise(F.lit(0.0)))
