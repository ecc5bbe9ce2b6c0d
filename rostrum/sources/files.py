"""Folders of pages, records, scans and tables as DataFrames, and their sinks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..runtime import ship
from ..functions.text import sanitize_filename, universal_newlines, year_in_path


def read_texts(spark: SparkSession, folder: str, suffix: str = ".txt") -> DataFrame:
    """path, filename, folder, text of all files below a folder, ends in any case; bad bytes become U+FFFD, line ends LF."""
    pattern = "*" + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(folder, wholetext=True)
    path = F.col("_metadata.file_path")
    parts = F.split(path, "/")
    name = F.url_decode(F.replace(F.element_at(parts, -1), F.lit("+"), F.lit("%2B")))
    above = F.url_decode(F.replace(F.element_at(parts, -2), F.lit("+"), F.lit("%2B")))
    return raw.select(path.alias("path"), name.alias("filename"), above.alias("folder"), universal_newlines("value").alias("text"))


def read_scans(spark: SparkSession, folder: str) -> DataFrame:
    """path, content, year of the PDF files below a folder; those of no known year are left out."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.pdf").load(folder)
    return raw.select("path", "content", year_in_path("path").alias("year")).where("year is not null")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A table with line ends in fields; missing values are '' as written."""
    return spark.read.csv(path, header=True, multiLine=True, escape='"', quote='"').na.fill("")


def write_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """A CSV export with header; ``one_file`` gathers small results into one part."""
    flat = df.select([F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])
    (flat.coalesce(1) if one_file else flat).write.mode("overwrite").csv(path, header=True, escape='"', quote='"', emptyValue="")


def write_days(df: DataFrame, day: str, path: str) -> None:
    """Parquet below year, month and day."""
    parts = df.withColumn("year", F.year(day)).withColumn("month", F.month(day)).withColumn("day_of_month", F.dayofmonth(day))
    parts.write.mode("overwrite").partitionBy("year", "month", "day_of_month").parquet(path)


def number_granules(df: DataFrame, day: str, order: str | list[str], kinds: dict[str, str]) -> DataFrame:
    """Adds for each kind of content a file name 'N-granule.ext'; N counts the day's granules that have that content.

    ``order``: the granule's column, and others that tell its rows apart.
    """
    order = [order] if isinstance(order, str) else order
    granule, out = order[0], df
    for column, extension in kinds.items():
        has = F.coalesce(F.length(column) > 0, F.lit(False))
        number = F.sum(has.cast("int")).over(W.partitionBy(day).orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
        out = out.withColumn(f"{column}_file", F.when(has, F.concat(number.cast("string"), F.lit("-"), F.col(granule), F.lit(f".{extension}"))))
    return out


def number_in_year(df: DataFrame, year: str, order: list[str], package: str, granule: str, title: str) -> DataFrame:
    """Adds ``file_name`` 'N-title-package_granule', N counting in each year."""
    number = F.row_number().over(W.partitionBy(year).orderBy(*order))
    name = F.concat_ws("-", number.cast("string"), sanitize_filename(F.coalesce(F.col(title), F.lit(""))), F.concat_ws("_", F.col(package), F.col(granule)))
    return df.withColumn("file_name", name)


def not_done(jobs: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Jobs whose result isn't there yet."""
    return jobs.join(done.select(*keys).distinct(), keys, "left_anti")


def merge_previous(current: DataFrame, previous: DataFrame, keys: list[str]) -> DataFrame:
    """What the current run has, and of the previous one what is still missing."""
    return current.unionByName(previous.join(current.select(*keys).distinct(), keys, "left_anti").select(current.columns))


def relative_path(path: Column | str, root: str) -> Column:
    """A file's path below a folder, however the folder was written."""
    tail = root.rstrip("/").split(":", 1)[-1].lstrip("/") + "/"
    decoded = F.url_decode(F.replace(F.col(path) if isinstance(path, str) else path, F.lit("+"), F.lit("%2B")))
    return F.substring_index(decoded, tail, -1)


def log_name(relative: Column | str) -> Column:
    """The name of the log of a file's removed lines."""
    c = F.col(relative) if isinstance(relative, str) else relative
    return F.concat(F.regexp_replace(c, r"[/\\]+", "__"), F.lit(".removed.tsv"))


def text_name(path: Column | str, year: Column | str) -> Column:
    """year/stem.txt of a scan."""
    parts = F.split(F.col(path) if isinstance(path, str) else path, "/")
    stem = F.regexp_replace(F.url_decode(F.replace(F.element_at(parts, -1), F.lit("+"), F.lit("%2B"))), r"\.[^.]*$", "")
    return F.concat((F.col(year) if isinstance(year, str) else year).cast("string"), F.lit("/"), stem, F.lit(".txt"))


def write_files(df: DataFrame, name: str, content: str, root: str) -> int:
    """Writes each row's text or bytes to its own file below ``root`` (a folder or URI that all executors reach); returns how many.

    A file appears under its name only when it is whole, so a task that is run again does no harm.
    """
    ship(df.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid

        from pyarrow import fs as pafs

        target, base = pafs.FileSystem.from_uri(root) if ":" in root else (pafs.LocalFileSystem(), root)
        done = 0
        for batch in batches:
            for file, body in zip(batch["name"], batch["content"], strict=True):
                place = f"{base.rstrip('/')}/{file}"
                target.create_dir(place.rpartition("/")[0], recursive=True)
                part = f"{place}.{uuid.uuid4().hex}.part"
                with target.open_output_stream(part) as out:
                    out.write(body.encode() if isinstance(body, str) else bytes(body))
                target.move(part, place)
                done += 1
        yield pd.DataFrame({"n": [done]})

    rows = df.select(F.col(name).alias("name"), F.col(content).alias("content")).where("name is not null and content is not null")
    return rows.mapInPandas(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_csv_if_any(df: DataFrame, path: str) -> bool:
    """``write_csv`` only where there is a row."""
    if df.isEmpty():
        return False
    write_csv(df, path)
    return True
