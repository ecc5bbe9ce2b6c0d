"""Command line: ``python -m rostrum STAGE ...`` runs one stage of the pipelines on the session's cluster."""

from __future__ import annotations

import argparse
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import debates, preclean
from .plans import acquire, pipelines
from .runtime import cut, ship
from .sources import files, govinfo, ocr


def _options(args: argparse.Namespace) -> dict[str, str]:
    named = {"apiKeys": args.api_keys, "perHour": args.per_key_hourly_limit, "client": args.client}
    return {k: str(v) for k, v in named.items() if v is not None}


def crec(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    """The daily edition: pages and records as files by day, members, and the speech table."""
    end = date(args.year_start, 12, 31) if args.year_start else date.today() - timedelta(1)
    options = _options(args) | {"years": str(args.years), "end": args.end or end.isoformat()}
    got = cut(acquire.daily_granules(spark, options, args.tasks))
    for kind in ("htm", "mods"):
        named = got.withColumn("_name", F.concat_ws("/", "day", F.lit(kind), f"{kind}_file")).where(f"{kind}_file is not null")
        files.write_files(named, "_name", kind, f"{args.output}/files")
    pages = got.where("htm_file is not null").select(F.to_date("day").alias("day"), F.col("htm_file").alias("filename"), F.col("htm").alias("html"))
    index = F.split_part("mods_file", F.lit("-"), F.lit(1)).cast("int")
    records = got.where("mods_file is not null").select(F.to_date("day").alias("issue_day"), index.alias("file_index"), F.col("mods").alias("mods_xml"))
    members = pipelines.members_of_records(records, ["issue_day", "file_index"])
    titles = got.groupBy("granule_id").agg(F.max("title").alias("title"))
    speeches = pipelines.daily(pages, members, titles)
    if args.previous:
        speeches = files.merge_previous(speeches, files.read_csv(spark, args.previous), ["date"])
    counted, seen = acquire.counted(speeches, "speeches")
    wrote = files.write_csv_if_any(cut(counted), f"{args.output}/speeches")
    days = got.agg(F.countDistinct("day").alias("days"), F.countDistinct("package_id").alias("packages"), F.count("*").alias("granules")).first()
    return days.asDict() | {"speeches": seen.get["rows"] if wrote else 0}


def crecb(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    """The bound edition: PDFs and records as files by year."""
    got = cut(acquire.bound_granules(spark, _options(args) | {"startYear": str(args.start_year)}, args.tasks))
    out = {"granules": got.count()}
    for kind, folder, ending in (("pdf", "raw_pdf_", "pdf"), ("mods", "raw_xml_", "xml")):
        place = F.concat(F.col("issue_year"), F.lit(f"/{folder}"), F.col("issue_year"), F.lit("/"), F.col("file_name"), F.lit(f".{ending}"))
        out[kind] = files.write_files(got.where(F.length(kind) > 0).withColumn("_name", place), "_name", kind, args.output)
    return out


def read_scans(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    """PDFs below a folder to text files by year."""
    texts = ocr.read_pages(files.read_scans(spark, args.input), ocr.CommandEngine(args.language))
    return {"texts": files.write_files(texts.withColumn("_name", files.text_name("path", "year")), "_name", "text", args.output)}


def clean(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    """Text files without boilerplate in the same tree, and a log of the removed lines."""
    texts = files.read_texts(spark, args.input).withColumn("rel_path", files.relative_path("path", args.input))
    judged = cut(preclean.reasons(preclean.text_lines(texts, ["rel_path"], "text"), ["rel_path"]))
    out = preclean.precleaned(judged, ["rel_path"])
    log = preclean.removed_log(judged.withColumn("log", files.log_name("rel_path")), "log")
    files.write_csv(log, f"{args.output}/removed_lines")
    files.write_csv(preclean.summary(judged), f"{args.output}/removed_summary")
    totals = preclean.byte_totals(texts, "text", out, "text").first().asDict()
    return {"texts": files.write_files(out, "rel_path", "text", f"{args.output}/texts"), "lines_removed": log.count(), **totals}


def _undated(found: DataFrame, output: str) -> int:
    _, rest = pipelines.dated_texts(found)
    files.write_csv_if_any(rest, f"{output}_quarantine")
    return rest.count()


def speeches(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    """Text files of volumes to the table of speeches; files without a date are named in a quarantine."""
    texts = files.read_texts(spark, args.input)
    counted, seen = acquire.counted(pipelines.bound_speeches(texts), "speeches")
    files.write_csv(counted, args.output)
    return {"speeches": seen.get["rows"], "undated": _undated(texts, args.output)}


def titles(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    """The table of speeches with debate titles."""
    table = files.read_csv(spark, args.input)
    ordered = table.withColumn("_order", F.struct("folder", F.col("speech_no").cast("int").alias("n")))
    counted, seen = acquire.counted(debates.assign_titles(ordered, "filename", "_order", "speech").drop("_order"), "titled")
    files.write_csv(counted, args.output)
    return {"speeches": seen.get["rows"]}


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(prog="rostrum", description=__doc__)
    stages = main.add_subparsers(dest="stage", required=True)

    def stage(function, name: str, inputs: bool = True) -> argparse.ArgumentParser:
        added = stages.add_parser(name, help=function.__doc__)
        added.set_defaults(run=function)
        if inputs:
            added.add_argument("input")
        added.add_argument("output")
        return added

    for function, name in ((crec, "crec"), (crecb, "crecb")):
        online = stage(function, name, inputs=False)
        online.add_argument("--api-keys", required=True, help="separated by commas")
        online.add_argument("--per-key-hourly-limit", type=int)
        online.add_argument("--tasks", type=int, default=govinfo.TASKS, help="tasks that share the limit")
        online.add_argument("--client", help="module:factory of another client")
        if name == "crec":
            online.add_argument("--years", type=int, default=2)
            online.add_argument("--year-start", type=int, help="year of the last day")
            online.add_argument("--end", help="last day")
            online.add_argument("--previous", help="table of an earlier run, kept for the days that this one lacks")
        else:
            online.add_argument("--start-year", type=int, default=1873)
    stage(read_scans, "ocr").add_argument("--language", default="eng")
    stage(clean, "preclean")
    stage(speeches, "speeches")
    stage(titles, "debates")
    return main


def main(arguments: list[str] | None = None) -> dict[str, int]:
    args = parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"rostrum {args.stage}").getOrCreate()
    ship(spark)
    counts = args.run(spark, args)
    print(" ".join(f"{k}={v}" for k, v in counts.items()))
    return counts
