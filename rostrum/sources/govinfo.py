"""A paged, rate-limited document service as a Spark data source, and fetch stages.

``spark.read.format("record_service")`` lists packages or granules, one partition
per day or package; the fetch stage adds each granule's summary, page and record to
a table of keys.  All network access goes through a client object, so tests (and
other services) can bring their own.
"""

from __future__ import annotations

import importlib
import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from urllib.parse import urlencode

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..runtime import ship

#: Fixed values of the service's public interface.
BASE = "https://api.govinfo.gov"
PAGE_SIZE, RETRIES, RETRY_SECONDS, CHUNK_YEARS = 1000, 3, 15, 25

SUMMARY = "dateIssued string, title string"


class TooManyRequests(Exception):
    def __init__(self, wait: float | None):
        super().__init__("429")
        self.wait = wait


class Client:
    """GET and POST of JSON and text.  One key per call, kept over the call's retries; keys take turns.

    ``per_hour`` is the limit of one key; calls of one client are spaced so that all
    its keys together stay below it.  A 429 answer is tried again after the time it
    names (``honour_wait``) or after 15 seconds, at most ``RETRIES`` times.
    """

    def __init__(self, keys: list[str], per_hour: float | None = None, delay: float = 0.0, first_key: int = 0, open_url: Callable | None = None, sleep=time.sleep):
        self.keys, self.turn = keys or [""], first_key
        self.gap = 3600.0 / (per_hour * len(self.keys)) if per_hour else delay
        self.last, self.sleep, self.open_url = 0.0, sleep, open_url or self._open

    def _pace(self) -> None:
        wait = self.last + self.gap - time.time()
        if self.gap and wait > 0:
            self.sleep(wait)
        self.last = time.time()

    @staticmethod
    def _open(url: str, body: bytes | None) -> bytes:
        request = urllib.request.Request(url, data=body, headers={"Content-Type": "application/json"} if body else {})
        try:
            with urllib.request.urlopen(request, timeout=60) as answer:
                return answer.read()
        except urllib.error.HTTPError as error:
            if error.code == 429:
                named = error.headers.get("Retry-After", "")
                raise TooManyRequests(float(named) if named.isdigit() else None) from error
            raise

    def call(self, path: str, parameters: dict | None = None, body: dict | None = None, honour_wait: bool = True) -> bytes:
        key = self.keys[self.turn % len(self.keys)]
        self.turn += 1
        url = path if path.startswith("http") else BASE + path
        url += ("&" if "?" in url else "?") + urlencode((parameters or {}) | {"api_key": key})
        for attempt in range(RETRIES + 1):
            self._pace()
            try:
                return self.open_url(url, json.dumps(body).encode() if body is not None else None)
            except TooManyRequests as error:
                if attempt == RETRIES:
                    raise
                self.sleep(error.wait if honour_wait and error.wait is not None else RETRY_SECONDS)
        raise AssertionError("unreachable")

    def json(self, path: str, parameters: dict | None = None, body: dict | None = None) -> dict:
        return json.loads(self.call(path, parameters, body) or b"{}")

    def content(self, path: str) -> bytes:
        return self.call(path, honour_wait=False)

    def text(self, path: str) -> str:
        return self.content(path).decode("utf-8", "replace")


def search_query(day: date) -> str:
    """The daily edition's granules of both chambers of one day."""
    return f"collection:(CREC) AND docClass:(CREC) AND section:(House OR Senate) AND publishdate:range({day.isoformat()},{day.isoformat()})"


def search_packages(client: Client, query: str, page_size: int = PAGE_SIZE) -> Iterator[str]:
    mark = "*"
    while mark:
        page = client.json("/search", body={"query": query, "pageSize": page_size, "offsetMark": mark, "sorts": [{"field": "publishdate", "sortOrder": "DESC"}]})
        found = page.get("results") or []
        yield from (r["packageId"] for r in found if r.get("packageId"))
        mark = page.get("nextOffsetMark") if found else None


def published_packages(client: Client, start: date, end: date, collection: str = "CRECB") -> Iterator[str]:
    mark = "*"
    while mark:
        page = client.json(f"/published/{start.isoformat()}/{end.isoformat()}", {"collection": collection, "pageSize": PAGE_SIZE, "offsetMark": mark})
        found = page.get("packages") or []
        yield from (p["packageId"] for p in found if p.get("packageId"))
        mark = page.get("nextOffsetMark") if found else None


def package_granules(client: Client, package: str) -> Iterator[str]:
    """Follows a named next page before a next mark."""
    path, parameters = f"/packages/{package}/granules", {"pageSize": PAGE_SIZE, "offsetMark": "*"}
    while True:
        page = client.json(path, parameters)
        yield from (g["granuleId"] for g in page.get("granules") or [] if g.get("granuleId"))
        if page.get("nextPage"):
            path, parameters = page["nextPage"], {}
        elif page.get("nextOffsetMark"):
            parameters = {"pageSize": PAGE_SIZE, "offsetMark": page["nextOffsetMark"]}
        else:
            return


def date_chunks(start_year: int, today: date, years: int = CHUNK_YEARS) -> list[tuple[date, date]]:
    """Spans of ``years`` years from ``start_year`` to today."""
    out, year = [], start_year
    while year <= today.year:
        out.append((date(year, 1, 1), min(date(year + years - 1, 12, 31), today)))
        year += years
    return out


def days(end: date, years: int) -> list[date]:
    """The days of the last ``years`` years, newest first; 29 February falls back to the 28th."""
    try:
        start = end.replace(year=end.year - years)
    except ValueError:
        start = end.replace(year=end.year - years, day=28)
    return [end - timedelta(n) for n in range((end - start).days + 1)]


def _client(options: dict, number: int, tasks: int) -> Client:
    """From the option ``client`` ("module:factory"), or the standard one with the keys named, for one of ``tasks`` tasks."""
    named = options.get("client")
    keys = [k for k in options.get("apikeys", options.get("apiKeys", "")).split(",") if k]
    if named:
        module, _, factory = named.partition(":")
        return getattr(importlib.import_module(module), factory)(keys, number)
    limit = options.get("perhour", options.get("perHour"))
    # each task has an equal share of the limit
    tasks = int(options.get("tasks", tasks))
    return Client(keys, float(limit) / tasks if limit else None, float(options.get("delay", "0")), first_key=number)


class _Part(InputPartition):
    def __init__(self, number: int, mode: str, value: str, tasks: int):
        super().__init__((number, mode, value))
        self.number, self.mode, self.wanted, self.tasks = number, mode, value, tasks


class RecordServiceReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = {k.lower(): v for k, v in dict(options).items()}

    def partitions(self):
        mode = self.options.get("mode", "search")
        if mode == "search":
            end = date.fromisoformat(self.options.get("end") or (date.today() - timedelta(1)).isoformat())
            start = self.options.get("start")
            wanted = [d.isoformat() for d in days(end, int(self.options.get("years", "1"))) if not start or d.isoformat() >= start]
        elif mode == "published":
            today = date.fromisoformat(self.options.get("end") or date.today().isoformat())
            wanted = [f"{a.isoformat()}/{b.isoformat()}" for a, b in date_chunks(int(self.options["startyear"]), today)]
        else:
            wanted = [p for p in self.options.get("packages", "").split(",") if p]
        return [_Part(i, mode, w, len(wanted)) for i, w in enumerate(wanted)]

    def read(self, partition):
        client = _client(self.options, partition.number, partition.tasks)
        if partition.mode == "search":
            for package in search_packages(client, search_query(date.fromisoformat(partition.wanted))):
                yield partition.wanted, package, None
        elif partition.mode == "published":
            start, end = map(date.fromisoformat, partition.wanted.split("/"))
            for package in published_packages(client, start, end):
                yield None, package, None
        else:
            for granule in package_granules(client, partition.wanted):
                yield None, partition.wanted, granule


class RecordService(DataSource):
    """Options: mode (search, published, granules), start, end, years, startYear, packages, apiKeys, perHour, delay, client."""

    @classmethod
    def name(cls):
        return "record_service"

    def schema(self):
        return "day string, package_id string, granule_id string"

    def reader(self, schema):
        return RecordServiceReader(self.options)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(RecordService)


def discover(spark: SparkSession, mode: str, options: dict[str, str]) -> DataFrame:
    """(day, package_id), each once, in order: the packages found by ``search`` or ``published``."""
    register(spark)
    found = spark.read.format("record_service").options(mode=mode, **options).load()
    return found.select("day", "package_id").distinct().orderBy("day", "package_id")


TASKS = 4  #: tasks that talk to the service at a time; they share its limit


def granules_of(packages: DataFrame, options: dict[str, str], tasks: int = TASKS) -> DataFrame:
    """package_id, granule_id: the granules of each package of a table; what can't be listed has none."""
    ship(packages.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        client = _client({k.lower(): v for k, v in options.items()}, TaskContext.get().partitionId(), tasks)
        for batch in batches:
            rows = []
            for package in batch["package_id"]:
                try:
                    rows += [(package, g) for g in package_granules(client, package)]
                except Exception:
                    continue
            yield pd.DataFrame(rows, columns=["package_id", "granule_id"])

    listed = packages.select("package_id").distinct().repartition(tasks)
    return listed.mapInPandas(run, "package_id string, granule_id string").distinct()


#: Parts that aren't text.
_BINARY = {"pdf"}


def fetch(keys: DataFrame, options: dict[str, str], parts: tuple[str, ...] = ("summary", "htm", "mods"), tasks: int = TASKS) -> DataFrame:
    """package_id, granule_id with the ``parts`` named, of which ``pdf`` is binary; what can't be fetched is empty, and the job goes on."""
    ship(keys.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        client = _client({k.lower(): v for k, v in options.items()}, TaskContext.get().partitionId(), tasks)
        for batch in batches:
            out = {p: [] for p in parts}
            for package, granule in zip(batch["package_id"], batch["granule_id"], strict=True):
                for p in parts:
                    read = client.content if p in _BINARY else client.text
                    try:
                        out[p].append(read(f"/packages/{package}/granules/{granule}/{p}"))
                    except Exception:
                        out[p].append(b"" if p in _BINARY else "")
            yield pd.DataFrame({"package_id": batch["package_id"], "granule_id": batch["granule_id"], **out})

    kinds = [f"{p} {'binary' if p in _BINARY else 'string'}" for p in parts]
    wanted = keys.select("package_id", "granule_id").repartition(tasks)
    return wanted.mapInPandas(run, ", ".join(["package_id string", "granule_id string", *kinds]))


def parsed_summary(df: DataFrame, summary: str = "summary") -> DataFrame:
    """Adds ``dateissued`` and ``title`` from a summary's JSON, '' where it lacks them."""
    fields = F.from_json(summary, SUMMARY)
    return df.withColumn("dateissued", F.coalesce(fields["dateIssued"], F.lit(""))).withColumn("title", F.coalesce(fields["title"], F.lit("")))


def same_day(df: DataFrame, day: str, issued: str = "dateissued") -> DataFrame:
    """Rows issued on the day itself; unreadable dates are dropped."""
    return df.where(F.try_to_date(F.substring(issued, 1, 10), "yyyy-MM-dd") == F.to_date(day))
