"""As-of and interval joins by sorting, O(n log n), without candidate pairs."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..runtime import ship


def asof_backward(left: DataFrame, right: DataFrame, by: list[str], on: str, value: list[str]) -> DataFrame:
    """``left`` with the ``value`` columns of the last row of ``right`` in the same group whose ``on`` isn't greater.

    One shuffle by ``by``: both sides are laid together and the last marker is
    carried on.  Rows without a marker before them get NULL.
    """
    marks = right.select(*by, on, F.struct(*value).alias("_mark"), F.lit(0).alias("_side"))
    rows = left.select(*by, on, F.struct(*left.columns).alias("_row"), F.lit(1).alias("_side"))
    both = marks.unionByName(rows, allowMissingColumns=True)
    carried = F.last("_mark", ignorenulls=True).over(W.partitionBy(*by).orderBy(on, "_side").rowsBetween(W.unboundedPreceding, 0))
    return both.withColumn("_last", carried).where("_side = 1").select("_row.*", *[F.col(f"_last.{v}").alias(v) for v in value])


def within_section(left: DataFrame, sections: DataFrame, by: list[str], on: str, start: str, end: str, value: list[str]) -> DataFrame:
    """``left`` with the values of the section [start, end) that holds ``on``, NULL outside; sections of a group don't overlap."""
    marks = sections.select(*by, F.col(start).alias(on), F.col(end).alias("_end"), *value)
    found = asof_backward(left, marks, by, on, ["_end", *value])
    inside = F.col(on) < F.col("_end")
    return found.select(*left.columns, *[F.when(inside, F.col(v)).alias(v) for v in value])


def last_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key in the order given; partial aggregation, no sort."""
    rest = [c for c in df.columns if c != key]
    picked = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(key, "_row.*")


def cursor(text: str, parts: Iterable[str | None]) -> Iterator[int]:
    """Where each part is found when searched from the end of the one before; one that isn't found lies there.

    Both ways the cursor moves on by the part's length, as reading on does.
    """
    at = 0
    for part in parts:
        found = text.find(part or "", at)
        place = at if found < 0 else found
        yield place
        at = place + len(part or "")


def cursor_offsets(df: DataFrame, key: str, text: str, parts: str) -> DataFrame:
    """key, part_no, part, offset: the ``cursor``'s place for each part of an array.  Linear in a narrow pass; NULL texts have none."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, no, part, place = [], [], [], []
            for i, (whole, pieces) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                for n, (piece, offset) in enumerate(zip(pieces, cursor(whole, pieces), strict=True)):
                    at.append(i), no.append(n), part.append(piece), place.append(offset)
            columns = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(no, pa.int32()), pa.array(part, pa.string()), pa.array(place, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "part_no", "part", "offset"])

    source = df.select(key, F.col(text).alias("_text"), F.col(parts).alias("_parts")).where("_text is not null and _parts is not null")
    return source.mapInArrow(run, f"`{key}` {source.schema[key].dataType.simpleString()}, part_no int, part string, offset int")
