"""Queries over the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import spread, table
from . import mixing, name_variants, neardup, packing, repeated_lines, residue, scan_repair, speaker_turns

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return add


def _speeches(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "parsed_crecb_speeches").select("speech_id", "folder", "speaker", "speech"))


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents").select("doc_id", "text", "source"))


#: Problem 1 as TESTDATA.md states it: runs of three words, 60 %, at least 40 words.
VERSIONS = {"k": 3, "threshold": 0.6, "min_words": 40}


@query()
def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    found = neardup.near_duplicates(_speeches(spark, folder), "speech_id", "speech", **VERSIONS)
    pairs = neardup.near_duplicate_pairs(*found)
    return pairs.select(F.col("id_a").alias("speech_id_a"), F.col("id_b").alias("speech_id_b"))


@query()
def p1_classes(spark: SparkSession, folder: str) -> DataFrame:
    """One row per speech of 40 words or more: its class of equal texts and the number of classes that are versions of it."""
    found = neardup.near_duplicates(_speeches(spark, folder), "speech_id", "speech", **VERSIONS)
    return neardup.near_duplicate_degrees(*found).withColumnRenamed("id", "speech_id")


@query(
    r"""
    with lines as (
        select speech_id, folder, unnest(string_split(speech, chr(10))) as line,
               generate_subscripts(string_split(speech, chr(10)), 1) as line_no
        from parsed_crecb_speeches where speech is not null),
    keyed as (
        select *, trim(regexp_replace(lower(line), '[^a-z]+', ' ', 'g')) as k from lines),
    total as (select folder, count(*) as n from parsed_crecb_speeches where speech is not null group by folder),
    often as (
        select folder, k, count(distinct speech_id) as d from keyed where k <> '' group by folder, k having count(distinct speech_id) >= 4)
    select keyed.speech_id, cast(keyed.line_no as integer) as line_no
    from keyed join often on keyed.folder is not distinct from often.folder and keyed.k = often.k
    join total on total.folder is not distinct from keyed.folder
    where often.d * 100 >= 6 * total.n
    """
)
def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    found = repeated_lines.repeated_lines(_speeches(spark, folder), "speech_id", "speech", "folder")
    return found.select(F.col("id").alias("speech_id"), "line_no")


@query(
    r"""
    with lines as (
        select speech_id, folder, unnest(string_split(speech, chr(10))) as line,
               generate_subscripts(string_split(speech, chr(10)), 1) as line_no
        from parsed_crecb_speeches where speech is not null),
    keyed as (
        select *, trim(regexp_replace(lower(line), '[^a-z]+', ' ', 'g')) as k from lines),
    total as (select folder, count(*) as n from parsed_crecb_speeches where speech is not null group by folder),
    often as (
        select o.folder, k from (select folder, k, count(distinct speech_id) as d from keyed where k <> '' group by folder, k having count(distinct speech_id) >= 4) o
        join total on total.folder is not distinct from o.folder where o.d * 100 >= 6 * total.n),
    kept as (
        select speech_id, string_agg(line, chr(10) order by line_no) as clean_speech from keyed
        where not exists (select 1 from often where often.folder is not distinct from keyed.folder and often.k = keyed.k) group by speech_id)
    select p.speech_id, p.folder, case when p.speech is not null then coalesce(clean_speech, '') end as clean_speech
    from parsed_crecb_speeches p left join kept using (speech_id)
    """
)
def p3_clean(spark: SparkSession, folder: str) -> DataFrame:
    narrow = _speeches(spark, folder).select("speech_id", "folder", "speech")
    clean = repeated_lines.without_repeated_lines(narrow, "speech", "folder", out_col="clean_speech")
    return clean.select("speech_id", "folder", "clean_speech")


@query()
def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    members = table(spark, folder, "mods_members")
    found = name_variants.link_names(_speeches(spark, folder), "speaker", members, "bioguideid", "parsed_name", "full_name", "state")
    return found.select(F.col("label").alias("speaker"), F.col("person_id").alias("bioguideid"))


@query()
def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return scan_repair.faulty_lines(_speeches(spark, folder), "speech_id", "speech").withColumnRenamed("id", "speech_id")


@query()
def p4_repaired(spark: SparkSession, folder: str) -> DataFrame:
    narrow = _speeches(spark, folder).select("speech_id", "speech")
    return scan_repair.repair(narrow, "speech", "paragraphs").select("speech_id", "paragraphs")


@query()
def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return speaker_turns.turn_starts(_speeches(spark, folder), "speech_id", "speaker", "speech").withColumnRenamed("id", "speech_id")


@query()
def p6_turns(spark: SparkSession, folder: str) -> DataFrame:
    return speaker_turns.speaker_turns(_speeches(spark, folder), "speech_id", "speaker", "speech").withColumnRenamed("id", "speech_id")


@query()
def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return residue.residue(_documents(spark, folder), "doc_id", "text").select(F.col("id").alias("doc_id"))


def _containers(spark: SparkSession, folder: str) -> DataFrame:
    # one row per container class
    classes = [tuple(r) for r in table(spark, folder, "container_sizes").select("container_class", "capacity_tokens").collect()]
    return packing.pack(_documents(spark, folder), "doc_id", "text", classes)


@query()
def p7_containers(spark: SparkSession, folder: str) -> DataFrame:
    return _containers(spark, folder).withColumnRenamed("id", "doc_id")


@query()
def p7_fill(spark: SparkSession, folder: str) -> DataFrame:
    return packing.fill(_containers(spark, folder))


def _mixture(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    # one row per target source
    targets = [tuple(r) for r in table(spark, folder, "mix_targets").select("source", "target_share", "max_repeats").collect()]
    # target_share is of all tokens of the table, so a source that can't fill its share stops at its cap
    return mixing.mixture(_documents(spark, folder), "doc_id", "text", "source", targets, size=mixing.ALL)


@query()
def p8_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return _mixture(spark, folder)[0].withColumnRenamed("id", "doc_id")


@query()
def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    return _mixture(spark, folder)[1]
