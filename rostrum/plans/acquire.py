"""Acquisition end to end: from the service to numbered files, as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..runtime import cut
from ..sources import files, govinfo


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` and its number of rows, which is known (``observation.get["rows"]``) once it was written."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def daily_granules(spark: SparkSession, options: dict[str, str], tasks: int = govinfo.TASKS) -> DataFrame:
    """The daily edition: day, package_id, granule_id, dateissued, title, htm, mods, and a file name for each content that is there.

    Packages of each day are searched, their granules listed and their summaries
    fetched; only granules issued on the day are fetched whole, and numbered by day.
    What came from the service is written before it is used again.
    """
    packages = cut(govinfo.discover(spark, "search", options))
    listed = cut(govinfo.granules_of(packages, options, tasks))
    summaries = govinfo.parsed_summary(cut(govinfo.fetch(listed, options, ("summary",), tasks)))
    known = packages.join(summaries.drop("summary"), "package_id")
    issued = govinfo.same_day(known, "day").distinct()
    pages = cut(govinfo.fetch(issued.select("package_id", "granule_id").distinct(), options, ("htm", "mods"), tasks))
    whole = issued.join(pages, ["package_id", "granule_id"])
    return files.number_granules(whole, "day", ["granule_id", "package_id"], {"htm": "html", "mods": "xml"})


def bound_granules(spark: SparkSession, options: dict[str, str], tasks: int = govinfo.TASKS) -> DataFrame:
    """The bound edition: package_id, granule_id, title, issue_year, pdf, mods and file_name (without ending), numbered by year."""
    packages = cut(govinfo.discover(spark, "published", options))
    listed = cut(govinfo.granules_of(packages, options, tasks))
    fetched = cut(govinfo.fetch(listed, options, ("summary", "pdf", "mods"), tasks))
    dated = govinfo.parsed_summary(fetched).withColumn("issue_year", T.issue_year("dateissued"))
    numbered = files.number_in_year(dated.where("issue_year <> ''"), "issue_year", ["package_id", "granule_id"], "package_id", "granule_id", "title")
    return numbered.select("package_id", "granule_id", "title", "issue_year", "pdf", "mods", "file_name")
