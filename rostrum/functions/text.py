"""Native column functions over transcript text, file names and dates.

Python's idea of white space, line ends and trimming is kept where results depend
on it; Java's differs (see ``SPACE``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Every character Python's str.strip() removes, as a Java character class.
SPACE = "[\\t-\\r\\x1c-\\x1f \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
#: Every line end Python's str.splitlines() knows.
LINE_END = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029]"

MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: The same characters one by one, for trimming.
SPACES = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(c: Column | str) -> Column:
    return F.btrim(_col(c), F.lit(SPACES))


def universal_newlines(c: Column | str) -> Column:
    """What reading a file in text mode makes of its line ends."""
    return F.regexp_replace(_col(c), "\r\n?", "\n")


def _unless_ascii(c: Column, changed: Column) -> Column:
    """``changed`` where the text has characters beyond ASCII, for which alone it is worth while to look."""
    return F.when(F.octet_length(c) == F.length(c), c).otherwise(changed)


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def splitlines(c: Column | str) -> Column:
    """Array of lines without their ends; no element for what follows a last line end."""
    # by plain replacements, which are far cheaper than a regular expression where there is nothing to replace
    lines = _col(c)
    for end in ("\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", "\u2028", "\u2029"):
        lines = F.replace(lines, F.lit(end), F.lit("\n"))
    parts = _bound(lines, lambda x: F.split(F.when(x.endswith("\n"), F.left(x, F.length(x) - 1)).otherwise(x), "\n", -1))
    return F.when(_col(c) == "", F.array().cast("array<string>")).otherwise(parts)


# --- cleaning ----------------------------------------------------------------

#: What is deleted from a speech, in this order.
EXTRANEOUS = (
    r"\([^)]*asked and was given permission[^)]*\)" + SPACE + "*",
    r"[-_]{3,}",
    r"\{time\}" + SPACE + r"*[0-9]{2,4}",
    r"\[Roll[^\]\r\n]*\]",
    r"\[\[Page [A-Za-z0-9]{1,10}\]\]",
    r"(?is)<title>.*?</title>",
    r"</?[^>]+>",
)


def clean_extraneous(c: Column | str) -> Column:
    out = _col(c)
    for pattern in EXTRANEOUS:
        out = F.regexp_replace(out, pattern, "")
    return out


def normalize_characters(c: Column | str) -> Column:
    """Odd blanks to blanks, invisible marks deleted, curly quotes straightened, an ellipsis to three dots."""
    blanks, quotes = "\xa0\u2009\u202f\u2007", "\u2019\u2018\u201c\u201d"
    gone = "\ufeff\u2060\u200e\u200f\u202a\u202b\u202c\u202d\u202e"
    changed = F.replace(F.translate(_col(c), blanks + quotes + gone, "    ''\"\""), F.lit("\u2026"), F.lit("..."))
    return _unless_ascii(_col(c), changed)


def normalize_line(c: Column | str) -> Column:
    """Zero-width characters and soft or fixed hyphens deleted, long dashes to hyphens."""
    return _unless_ascii(_col(c), F.translate(_col(c), "\u2014\u2013\u200b\u200c\u200d\xad\u2011", "--"))


# --- names, files, dates -----------------------------------------------------


def gender(speaker: Column | str) -> Column:
    s = _col(speaker)
    return F.when(s.startswith("Ms.") | s.startswith("Mrs."), "F").when(s.startswith("Mr."), "M").otherwise("")


def sanitize_filename(c: Column | str) -> Column:
    return F.translate(_col(c), '\\/*?:"<>|', "")


def granule_of_filename(filename: Column | str) -> Column:
    """What stands between the first hyphen and the last ``.html``."""
    return F.regexp_replace(F.regexp_replace(_col(filename), "^[^-]*-", ""), r"\.html$", "")


def file_order(filename: Column | str) -> Column:
    """The number before the first hyphen, NULL where there is none."""
    return F.expr("try_cast(split_part({}, '-', 1) as int)".format(filename)) if isinstance(filename, str) else F.try_to_number(
        F.split_part(filename, F.lit("-"), F.lit(1)), F.lit("999999999")
    ).cast("int")


def filename_date(filename: Column | str) -> Column:
    """The first long-form date of a file name; NULL if there is none or it is no date."""
    found = F.regexp_extract(_col(filename), rf"(?i)([A-Za-z]+) ([0-9]{{1,2}}), ([0-9]{{4}})", 0)
    return F.try_to_date(F.initcap(F.lower(found)), "MMMM d, yyyy")


def decade(date: Column | str) -> Column:
    return F.concat((F.floor(F.year(_col(date)) / 10) * 10).cast("string"), F.lit("s"))


def year_in_path(path: Column | str) -> Column:
    """The first year from 1800 to 2000 that stands alone in a path, NULL without one."""
    return F.try_to_number(F.nullif(F.regexp_extract(_col(path), r"\b(18[0-9]{2}|19[0-9]{2}|2000)\b", 1), F.lit("")), F.lit("9999")).cast("int")


def is_general_with_date(filename: Column | str) -> Column:
    """A file name with a long-form date and no chamber's name."""
    f = _col(filename)
    dated = f.rlike(rf"(?i)\b({MONTHS})\s+[0-9]{{1,2}},\s*[0-9]{{4}}\b")
    return dated & ~f.rlike(r"(?i)\bHouse(?:\s+of\s+Representatives)?\b") & ~f.rlike(r"(?i)\bSenate\b")


def chamber_of_granule(granule_id: Column | str) -> Column:
    g = _col(granule_id)
    return F.when(g.contains("PgH"), "H").when(g.contains("PgS"), "S").otherwise("")


def section_of_granule(granule_id: Column | str) -> Column:
    g = _col(granule_id)
    return F.when(g.contains("PgH"), "House").when(g.contains("PgS"), "Senate").otherwise("")


def issue_year(date_issued: Column | str) -> Column:
    """The text before the first hyphen of the part before ``T``."""
    return F.split_part(F.split_part(_col(date_issued), F.lit("T"), F.lit(1)), F.lit("-"), F.lit(1))


def package_year(package_id: Column | str) -> Column:
    return F.regexp_extract(_col(package_id), r"([0-9]{4})", 1).cast("int")


def package_part(package_id: Column | str) -> Column:
    """The number behind ``-pt``, 0 without one."""
    part = F.regexp_extract(_col(package_id), r"-pt([0-9]+)", 1)
    return F.when(part == "", 0).otherwise(part.cast("int"))


# --- line predicates ---------------------------------------------------------


def more_than_half_capitals(c: Column | str) -> Column:
    s = _col(c)
    return F.regexp_count(s, F.lit(r"\p{Lu}")) * 2 > F.regexp_count(s, F.lit(r"\p{L}"))


def normalize_title(c: Column | str) -> Column:
    return F.upper(strip(F.regexp_replace(_col(c), SPACE + "+", " ")))


def without_title(speech: Column | str, title: Column | str) -> Column:
    """The speech without the lines that begin with its title; unchanged without one."""
    wanted = normalize_title(title)
    kept = F.filter(splitlines(speech), lambda line: ~normalize_title(line).startswith(wanted))
    return F.when(F.coalesce(_col(title), F.lit("")) == "", _col(speech)).otherwise(F.array_join(kept, "\n"))
