"""The three pipelines end to end, from tables to tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import debates, metadata, preclean, segment
from ..operators.asof import last_per_key
from ..runtime import ship

CREC_COLUMNS = [
    "date", "granule_id", "title", "speaker", "text", "bioGuideId", "full_name", "party", "state", "gender", "chamber", "speaker_chamber",
]


def enrich(speeches: DataFrame, members: DataFrame, granule_titles: DataFrame) -> DataFrame:
    """Speeches (date, granule_id, speaker, text) in the daily edition's twelve columns; what is missing is ''.

    ``members`` has one row per parsed_name, ``granule_titles`` one per granule_id.
    Spark broadcasts them where they are small.
    """
    who = members.select(
        F.col("parsed_name").alias("_name"), F.col("bioguideid").alias("bioGuideId"), "full_name", "party", "state", "speaker_chamber"
    )
    named = speeches.join(who, F.col("speaker") == F.col("_name"), "left")
    titled = named.join(granule_titles.select("granule_id", "title"), "granule_id", "left")
    full = titled.withColumn("gender", T.gender("speaker")).withColumn("chamber", T.chamber_of_granule("granule_id"))
    return full.select([F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in CREC_COLUMNS])


def daily(pages: DataFrame, members: DataFrame, granule_titles: DataFrame, attribution: str = "compat") -> DataFrame:
    """The daily edition: pages (day, filename, html) to the twelve-column speech table.

    attribution 'compat' finds each speech again in the day's text from a cursor, as
    a reader of the cleaned speeches would, and gives it to the file whose marker
    stands before; 'exact' cuts each file by itself.
    """
    if attribution == "exact":
        blocks = metadata.day_texts(pages.withColumn("_key", F.concat_ws("\n", F.col("day").cast("string"), "filename")), "_key", "filename", "html")
        found = segment.segment(blocks, "_key", "text", "daily")
        parts = F.split("_key", "\n")
        rows = found.select(parts[0].alias("date"), T.granule_of_filename(parts[1]).alias("granule_id"), "speaker", F.col("speech").alias("text"))
        return enrich(rows, members, granule_titles)
    texts = metadata.day_texts(pages, "day", "filename", "html")
    marks = F.transform("files", lambda f: F.struct(f["start"].alias("start"), f["filename"].alias("value")))
    placed = segment.placed(texts.withColumn("_m", marks), ["day"], "text", "_m", "daily").withColumnRenamed("mark", "filename")
    rows = placed.select(
        F.col("day").cast("string").alias("date"), T.granule_of_filename("filename").alias("granule_id"), "speaker", F.col("speech").alias("text")
    )
    return enrich(rows, members, granule_titles)


def bound_speeches(texts: DataFrame, chamber_source: DataFrame | None = None) -> DataFrame:
    """The bound edition: texts (filename, folder, text) to speeches with date, decade, gender and chamber.

    Files without a readable date are left out; ``dated_texts`` names them.  ``chamber_source`` gives the texts
    (filename, folder, text) in which chamber markers are looked for, where they
    aren't those of ``texts`` itself.
    """
    keys = ["filename", "folder", "date"]
    dated, marked = dated_texts(texts)[0], "text"
    if chamber_source is not None:
        raw = chamber_source.select(F.col("filename").alias("_f"), F.col("folder").alias("_d"), F.col("text").alias("_raw"))
        dated, marked = dated.join(raw, (F.col("filename") == F.col("_f")) & F.col("folder").eqNullSafe(F.col("_d")), "left"), "_raw"
    ship(texts.sparkSession)
    found = segment.placed(dated.withColumn("_m", metadata.chamber_marks(marked)), keys, "text", "_m", "bound")
    return found.select(
        "filename",
        "folder",
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        T.decade("date").alias("decade"),
        "speaker",
        T.gender("speaker").alias("gender"),
        F.coalesce("mark", F.lit("")).alias("chamber"),
        "speech",
        "speech_no",
    )


def dated_texts(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(texts with the date of their file name, quarantine: filename, folder, reason of the others)."""
    marked = texts.withColumn("date", T.filename_date("filename"))
    reason = F.when(F.col("filename").isNull(), "no file name").otherwise("no date in the file name")
    return marked.where("date is not null"), marked.where("date is null").select("filename", "folder", reason.alias("reason"))


def precleaned_texts(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(texts without boilerplate, removed lines with reasons) of texts (filename, folder, text)."""
    keys = ["folder", "filename"]
    judged = preclean.reasons(preclean.text_lines(texts, keys, "text"), keys)
    return preclean.precleaned(judged, keys), preclean.removed(judged, keys)


def bound(texts: DataFrame, chamber_source: str = "precleaned") -> DataFrame:
    """Texts of scanned volumes to titled speeches; chamber markers from the precleaned or the 'raw' text."""
    clean, _ = precleaned_texts(texts)
    spoken = bound_speeches(clean, texts if chamber_source == "raw" else None)
    ordered = spoken.withColumn("_order", F.row_number().over(W.partitionBy("filename").orderBy("folder", "speech_no")))
    return debates.assign_titles(ordered, "filename", "_order", "speech").drop("_order")


def members_of_records(records: DataFrame, order: list[str], xml: str = "mods_xml") -> DataFrame:
    """One row per parsed name from MODS records, the last by ``order`` and the document's own order."""
    found = metadata.speaking_members(records, order, xml)
    return metadata.members_by_name(found, [*order, "no"]).drop(*order, "no")


def titles_of_granules(summaries: DataFrame) -> DataFrame:
    """One title per granule: that of the summary loaded last."""
    return last_per_key(summaries.select("granule_id", "title", "loaded_at"), "granule_id", ["loaded_at", "title"]).select("granule_id", "title")
