"""Readers: JSON pages, latest snapshot, optional tables, paged HTTP, object stores."""

from __future__ import annotations

import datetime as dt
import json
import time
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThanOrEqual, InputPartition, LessThan
from pyspark.sql.types import StructType

from lotline.sources.spec import SourceSpec


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob matches anything."""
    fs, p = _fs(spark, path)
    return bool(fs.globStatus(p))


def finished_folders(spark: SparkSession, glob: str) -> list[str]:
    """The folders matching a glob that hold a _SUCCESS file."""
    fs, p = _fs(spark, f"{glob}/_SUCCESS")
    return sorted(s.getPath().getParent().toString() for s in fs.globStatus(p) or [])


def read_pages(spark: SparkSession, globs: list[str], spec: SourceSpec, require_marker: bool = False) -> DataFrame:
    """Pages that are JSON arrays of flat objects, from every glob that matches; texts throughout, missing fields NULL.

    ``_file`` is the path, from which a delivery's run can be read. With ``require_marker`` only the folders that have a
    _SUCCESS file of their own count. No match gives an empty frame.
    """
    found = [g for g in globs if exists(spark, g)]
    if require_marker:
        found = [f"{folder}/{g.rsplit('/', 1)[1]}" for g in found for folder in finished_folders(spark, g.rsplit("/", 1)[0])]
        found = [g for g in found if exists(spark, g)]
    schema = spec.schema()
    if not found:
        return spark.createDataFrame([], schema).withColumn("_file", F.lit(None).cast("string"))
    return spark.read.schema(schema).option("multiLine", True).json(found).select("*", F.col("_metadata.file_path").alias("_file"))


def run_stamp(path_column: str = "_file"):
    """The run=<stamp> part of a path, '' for a path without one."""
    return F.regexp_extract(path_column, r"run=([^/]+)", 1)


def latest_version(spark: SparkSession, root: str) -> str:
    """The version=<v> folder under ``root`` whose _SUCCESS marker is newest."""
    fs, p = _fs(spark, f"{root}/version=*/_SUCCESS")
    marks = list(fs.globStatus(p) or [])
    if not marks:
        raise FileNotFoundError(f"no finished version under {root}")
    newest = max(marks, key=lambda s: (s.getModificationTime(), s.getPath().toString()))
    return newest.getPath().getParent().getName().split("=", 1)[1]


def single_version(df: DataFrame, column: str = "snapshot_version") -> str:
    """The one version a frame holds; none or several are an error."""
    seen = [r[0] for r in df.where(F.col(column).isNotNull()).select(column).distinct().limit(2).collect()]
    if len(seen) != 1:
        raise ValueError(f"{len(seen)} versions where one is wanted")
    return seen[0]


def require_version(seen: str, pinned: str) -> str:
    """The version a source offers, if it is the pinned one; else an error before anything is read."""
    if seen != pinned:
        raise ValueError(f"version {seen} where {pinned} is pinned")
    return seen


def already_loaded(spark: SparkSession, root: str, version: str) -> bool:
    """Whether ``root`` holds the version with its marker."""
    return exists(spark, f"{root}/version={version}/_SUCCESS")


def optional(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A parquet table, or an empty one of the schema where it does not exist."""
    return spark.read.parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def retry(call: Callable, attempts: int = 3, wait_s: float = 5.0, sleep: Callable[[float], None] = time.sleep):
    """``call()``, tried again after 1, 2, ... times ``wait_s``; the last error goes through."""
    for k in range(1, attempts + 1):
        try:
            return call()
        except Exception:
            if k == attempts:
                raise
            sleep(wait_s * k)


def _fetch(url: str) -> list[dict]:
    with urllib.request.urlopen(url, timeout=120) as r:
        return json.loads(r.read())


@dataclass
class Page(InputPartition):
    offset: int
    last: bool


class PagedReader(DataSourceReader):
    """Pages of a query service with $where, $order, $limit and $offset; bounds on the time column are pushed down.

    The number of pages comes from a count request under the same filters, and the last page's task reads on until a page
    is not full, so rows that arrive in between are read too. With option count=false nothing is counted and one task
    reads all pages. A schema of the one column ``page`` gives each page as its JSON text.
    """

    def __init__(self, schema: StructType, options: dict[str, str]) -> None:
        self.names = schema.names
        self.o = options
        self.size = int(options.get("pagesize", 1000))
        self.where: list[str] = [options["where"]] if options.get("where") else []

    def pushFilters(self, filters: list[Filter]):
        text = lambda v: "'" + str(v).replace("'", "''") + "'"
        ops = {EqualTo: "=", GreaterThanOrEqual: ">=", LessThan: "<"}
        for f in filters:
            if type(f) in ops and len(f.attribute) == 1:
                self.where.append(f"{f.attribute[0]} {ops[type(f)]} {text(f.value)}")
            yield f  # Spark checks again

    def _ask(self, **query: str) -> list[dict]:
        if self.where:
            query["$where"] = " AND ".join(self.where)
        url = self.o["url"] + "?" + urllib.parse.urlencode(query)
        return retry(lambda: _fetch(url), wait_s=float(self.o.get("wait", 5)))

    def partitions(self) -> list[InputPartition]:
        pages = 1
        if self.o.get("count", "true") == "true":
            pages = max(1, -(-int(self._ask(**{"$select": "count(*) as n"})[0]["n"]) // self.size))
        return [Page(k * self.size, k == pages - 1) for k in range(pages)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        at = partition.offset
        while True:
            rows = self._ask(**{"$limit": str(self.size), "$offset": str(at), "$order": self.o.get("order", ":id")})
            if self.names == ["page"]:
                if rows:
                    yield (json.dumps(rows),)
            else:
                for r in rows:
                    yield tuple(None if r.get(n) is None else str(r.get(n)) for n in self.names)
            if not partition.last or len(rows) < self.size:
                return
            at += self.size


class PagedSource(DataSource):
    """``spark.read.format("paged_http").schema(texts).option("url", ...).load()``"""

    @classmethod
    def name(cls) -> str:
        return "paged_http"

    def schema(self) -> str:
        raise ValueError("give the schema")

    def reader(self, schema: StructType) -> DataSourceReader:
        return PagedReader(schema, dict(self.options))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedSource)


def remote_counts(spark: SparkSession, url: str, group: str, where: str | None = None, limit: int = 100) -> DataFrame:
    """(group, total), the ``limit`` most frequent values of a column, grouped and counted by the service itself."""
    q = {"$select": f"{group}, count(*) as total", "$group": group, "$order": "total DESC", "$limit": str(limit)}
    rows = retry(lambda: _fetch(url + "?" + urllib.parse.urlencode(q | ({"$where": where} if where else {}))))
    return spark.createDataFrame([(r.get(group), int(r["total"])) for r in rows], f"`{group}` string, total bigint")


def ingest_window(spark: SparkSession, url: str, folder: str, time_column: str, start: str, end: str, order: str, pagesize: int = 1000, **options: str) -> str:
    """The raw pages of [start, end) as JSON files in ``folder``; the marker is written after the last page."""
    where = f"{time_column} >= '{start}' AND {time_column} < '{end}'"
    pages = spark.read.format("paged_http").schema("page string").options(url=url, where=where, order=order, pagesize=pagesize, **options).load()
    pages.write.mode("overwrite").text(folder)
    return folder


def backfill_days(spark: SparkSession, url: str, root: str, time_column: str, first: dt.date, last: dt.date, order: str, **options) -> list[str]:
    """Load every day from ``first`` to ``last`` whose folder has no marker yet; returns the folders that were written.

    A day that failed half-way has no marker and is written anew, so running again completes the rest.
    """
    done = []
    for k in range((last - first).days + 1):
        day = first + dt.timedelta(days=k)
        folder = f"{root}/year={day:%Y}/month={day:%m}/day={day:%d}/backfill"
        if not exists(spark, f"{folder}/_SUCCESS"):
            done.append(ingest_window(spark, url, folder, time_column, f"{day}T00:00:00", f"{day + dt.timedelta(days=1)}T00:00:00", order, **options))
    return done


def look_back(spark: SparkSession, url: str, root: str, time_column: str, now: dt.datetime, days: int, order: str, zone: str = "America/New_York", **options) -> str:
    """Load the last ``days`` whole local days again into a run folder of its own; later runs overlap and win by run."""
    local = now.astimezone(ZoneInfo(zone))
    start, end = local.date() - dt.timedelta(days=days), local.date()
    return ingest_window(spark, url, f"{root}/daily/run={now:%Y%m%dT%H%M%S}", time_column, f"{start}T00:00:00", f"{end}T00:00:00", order, **options)


def object_store_conf(endpoint: str, access_key: str, secret_key: str, secure: bool = False, local_alias: str | None = None) -> dict[str, str]:
    """Session settings for an S3-compatible store; an endpoint on this machine gets ``local_alias`` where Spark runs in a container."""
    host = endpoint
    for name in ("localhost", "127.0.0.1"):
        if local_alias and host.startswith(name):
            host = host.replace(name, local_alias, 1)
    p = "spark.hadoop.fs.s3a."
    return {
        p + "endpoint": f"{'https' if secure else 'http'}://{host}",
        p + "access.key": access_key,
        p + "secret.key": secret_key,
        p + "path.style.access": "true",
        p + "connection.ssl.enabled": str(secure).lower(),
        p + "aws.credentials.provider": "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider",
    }


def object_path(bucket: str, path: str = "") -> str:
    return f"s3a://{bucket}/{path.lstrip('/')}".rstrip("/")
