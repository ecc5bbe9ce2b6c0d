"""Lines repeated across the documents of one source.

A line's key is the hash of its a-z runs.  Each document contributes each key
once; keys are counted per source with map-side partial aggregation, and those
that reach a share of the source's documents are taken out of the documents.

A source can have at most (mean lines per document) / share frequent keys, for
every one of them takes up that share of the documents' lines.  So they are
joined back as one array per source, to whole documents: lines aren't shuffled.

Defined results: a NULL text has no lines and isn't counted among its source's
documents; a NULL source is a source of its own; rows with equal ids are counted
as the rows they are; lines without letters are never frequent; an empty table
has no lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut


def line_key(line: Column) -> Column:
    """64-bit hash of the sequence of a-z runs of the lower-cased line; NULL without any."""
    letters = F.trim(F.regexp_replace(F.lower(line), "[^a-z]+", " "))
    return F.when(letters != "", F.xxhash64(letters))


def frequent_keys(df: DataFrame, text_col: str, source_col: str, share_percent: int = 6, least: int = 4) -> DataFrame:
    """(source, keys): per source the array of keys found in ``share_percent`` of its documents and in ``least`` of them."""
    source = df.select(F.col(source_col).alias("source"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    keys = F.array_distinct(F.transform(F.split("text", "\n"), line_key))
    counts = source.select("source", F.explode(keys).alias("key")).where("key is not null").groupBy("source", "key").count()
    # documents are counted by themselves, without looking into their texts, so lines are hashed and shuffled once
    total = source.groupBy("source").agg(F.count("*").alias("documents")).withColumnRenamed("source", "of")
    often = counts.where(f"count >= {int(least)}").join(total, F.col("source").eqNullSafe(F.col("of")))
    return (
        often.where(F.col("count") * 100 >= F.col("documents") * share_percent)
        .groupBy("source")
        .agg(F.collect_set("key").alias("keys"))
    )


#: Keys (8 bytes each) of all sources together that are broadcast; more are joined by a shuffle.
BROADCAST_KEYS = 500_000


def _with_keys(df: DataFrame, text_col: str, source_col: str, share_percent: int, least: int) -> DataFrame:
    keys = cut(frequent_keys(df, text_col, source_col, share_percent, least).select(F.col("source").alias("_source"), F.col("keys").alias("_keys")))
    held = keys.agg(F.sum(F.size("_keys"))).first()[0] or 0
    if held <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    return df.join(keys, F.col(source_col).eqNullSafe(F.col("_source")), "left").drop("_source")


def repeated_lines(
    df: DataFrame, id_col: str, text_col: str, source_col: str, share_percent: int = 6, least: int = 4
) -> DataFrame:
    """(id, line_no, line): each occurrence of a frequent line; lines count from 1."""
    narrow = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(source_col).alias("source"))
    marked = _with_keys(narrow, "text", "source", share_percent, least).where("_keys is not null")
    lines = marked.select("id", "_keys", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    return lines.where(F.array_contains("_keys", line_key(F.col("line")))).select(
        "id", (F.col("at") + 1).alias("line_no"), "line"
    )


def without_repeated_lines(
    df: DataFrame, text_col: str, source_col: str, share_percent: int = 6, least: int = 4, out_col: str = "clean_text"
) -> DataFrame:
    """``df`` with ``out_col``: the text without its source's frequent lines (the text itself where there are none)."""
    marked = _with_keys(df, text_col, source_col, share_percent, least)
    kept = F.filter(F.split(F.col(text_col), "\n"), lambda x: ~F.coalesce(F.array_contains("_keys", line_key(x)), F.lit(False)))
    return marked.withColumn(
        out_col, F.when(F.col("_keys").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    ).drop("_keys")
