"""What a granule's MODS record and HTML page tell: members, title, printed text."""

from __future__ import annotations

import re
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ..runtime import ship
from .asof import last_per_key

#: Columns of a speaking member, behind its number in the record.
MEMBER_COLUMNS = ("parsed_name", "bioguideid", "full_name", "party", "state", "speaker_chamber")
_MEMBER = StructType([StructField("no", IntegerType()), *[StructField(c, StringType()) for c in MEMBER_COLUMNS]])
_RECORD = StructType([StructField("members", ArrayType(_MEMBER)), StructField("title", StringType())])


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def parse_record(xml: str | None) -> tuple[list[tuple], str]:
    """(speaking members in document order, first title); ([], '') for what is no well-formed XML."""
    if not xml:
        return [], ""
    try:
        root = ElementTree.fromstring(xml)
    except (ElementTree.ParseError, ValueError):
        return [], ""
    members: list[tuple] = []
    title = None
    for element in root.iter():
        kind = _local(element.tag)
        if title is None and kind == "title":
            title = (element.text or "").strip()
        if kind == "congMember" and (element.get("role") or "").upper() == "SPEAKING":
            names: dict[str, str] = {}
            for child in element:
                if _local(child.tag) == "name" and child.get("type") not in names:
                    names[child.get("type")] = (child.text or "").strip()
            if names.get("parsed"):
                attributes = [element.get(a) or "" for a in ("party", "state", "chamber")]
                members.append((len(members), names["parsed"], element.get("bioGuideId") or "", names.get("authority-fnf", ""), *attributes))
    return members, title or ""


@F.pandas_udf(_RECORD)
def _records(xml: pd.Series) -> pd.DataFrame:
    found = [parse_record(x) for x in xml]
    keys = ("no", *MEMBER_COLUMNS)
    return pd.DataFrame({"members": [[dict(zip(keys, m, strict=True)) for m in ms] for ms, _ in found], "title": [t for _, t in found]})


def record_titles(df: DataFrame, keys: list[str], xml: str) -> DataFrame:
    ship(df.sparkSession)
    return df.select(*keys, _records(xml)["title"].alias("title"))


def speaking_members(df: DataFrame, keys: list[str], xml: str) -> DataFrame:
    """keys and the members that speak in each record, in document order (``no``)."""
    ship(df.sparkSession)
    return df.select(*keys, F.explode(_records(xml)["members"]).alias("m")).select(*keys, "m.*")


def members_by_name(members: DataFrame, order: list[str]) -> DataFrame:
    """One row per name, the last in the order given."""
    return last_per_key(members, "parsed_name", order)


class _Printed(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.depth, self.parts, self.blocks = 0, [], []

    def handle_starttag(self, tag, attrs):
        if tag == "pre":
            self.depth += 1
            if self.depth == 1:
                self.parts = []

    def handle_endtag(self, tag):
        if tag == "pre" and self.depth:
            self.depth -= 1
            if not self.depth:
                self.blocks.append("".join(self.parts))

    def handle_data(self, data):
        if self.depth:
            self.parts.append(data)


def pre_blocks(html: str | None) -> list[str]:
    """The text of each <pre> element that isn't blank."""
    if not html:
        return []
    reader = _Printed()
    reader.feed(html)
    reader.close()
    if reader.depth:
        reader.blocks.append("".join(reader.parts))
    return [b for b in reader.blocks if b.strip()]


@F.pandas_udf(ArrayType(StringType()))
def pre_blocks_of(html: pd.Series) -> pd.Series:
    return html.map(pre_blocks)


def day_texts(pages: DataFrame, day: str, filename: str, html: str) -> DataFrame:
    """day, text, files: each day's printed blocks in file order, every one below a marker that names its file.

    ``files`` is the array of (start, filename) of the markers.
    """
    ship(pages.sparkSession)
    order = F.expr(f"try_cast(split_part({filename}, '-', 1) as int)")
    blocks = pages.select(day, filename, F.coalesce(order, F.lit(2**31 - 1)).alias("_order"), F.posexplode(pre_blocks_of(html)).alias("_no", "_block"))
    piece = F.concat(F.lit("=== FILE: "), F.col(filename), F.lit(" ===\n"), F.col("_block"), F.lit("\n\n"))
    blocks = blocks.withColumn("_piece", piece)
    # one shuffle by day serves the running lengths and the texts
    before = W.partitionBy(day).orderBy("_order", filename, "_no").rowsBetween(W.unboundedPreceding, -1)
    placed = blocks.withColumn("_start", F.coalesce(F.sum(F.length("_piece")).over(before), F.lit(0)).cast("int"))
    rows = placed.groupBy(day).agg(F.array_sort(F.collect_list(F.struct("_order", filename, "_no", "_start", "_piece"))).alias("_p"))
    starts = F.transform("_p", lambda x: F.struct(x["_start"].alias("start"), x[filename].alias("filename")))
    return rows.select(day, F.array_join(F.transform("_p", lambda x: x["_piece"]), "").alias("text"), starts.alias("files"))


_CHAMBER = re.compile(r"^\s*(HOUSE|SENATE)\s*$", re.M)
_MARKS = ArrayType(StructType([StructField("start", IntegerType()), StructField("value", StringType())]))


@F.pandas_udf(_MARKS)
def _chambers(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: [{"start": m.start(), "value": m[1][0]} for m in _CHAMBER.finditer(t or "")])


def chamber_marks(text: str) -> Column:
    """(start, value) of the lines that are only HOUSE or SENATE, as H or S.  A start lies at the first of the blank lines before."""
    likely = F.col(text).contains("HOUSE") | F.col(text).contains("SENATE")
    return F.coalesce(_chambers(F.when(likely, F.col(text))), F.array().cast(_MARKS))


def chamber_markers(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, offset, chamber: the ``chamber_marks`` of each text as rows."""
    ship(df.sparkSession)
    return df.select(key, F.explode(chamber_marks(text)).alias("m")).select(key, F.col("m.start").alias("offset"), F.col("m.value").alias("chamber"))
