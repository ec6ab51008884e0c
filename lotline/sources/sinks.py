"""Sinks: partitioned and versioned tables, publish by gate and swap, bulk HTTP."""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.operators.quality import Expectation, GateError, check
from lotline.operators.serving import documents_json
from lotline.sources.readers import _fs, retry


def write_partitioned(df: DataFrame, path: str, by: tuple[str, ...] = ("event_year", "event_month"), rows_per_file: int = 2_000_000) -> None:
    """Overwrite a table partitioned by ``by``; rows are gathered by partition first, so that files are few and not small.

    Gathering is by a rebalance, which splits a partition that holds many rows over several tasks.
    """
    df.hint("rebalance", *by).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy(*by).parquet(path)


def write_version(df: DataFrame, root: str, version: str) -> str:
    path = f"{root}/version={version}"
    df.write.mode("overwrite").parquet(path)
    return path


POINTER = "_CURRENT"


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder name a published table's pointer names, or None."""
    fs, p = _fs(spark, f"{path}/{POINTER}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The version the pointer names."""
    name = current_version(spark, path)
    if name is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    return spark.read.parquet(f"{path}/{name}")


def publish(spark: SparkSession, df: DataFrame, path: str, expectations: list[Expectation]) -> DataFrame:
    """Write a new version, check what was written, move the pointer, check again what readers now get.

    The pointer is replaced by one rename, so there is always a table and never one that failed its gate: a first failure
    leaves the pointer, a second one moves it back. The version before stays until the next publishing.
    """
    before = current_version(spark, path)
    number = int(before.split("=")[1]) + 1 if before else 1
    name = f"version={number:06d}"
    df.write.mode("overwrite").parquet(f"{path}/{name}")
    check(spark.read.parquet(f"{path}/{name}"), expectations, path)
    _point(spark, path, name)
    try:
        out = check(read_published(spark, path), expectations, path)
    except Exception:
        if before:
            _point(spark, path, before)
        raise
    fs, _ = _fs(spark, path)
    P = spark._jvm.org.apache.hadoop.fs.Path
    for s in fs.globStatus(P(f"{path}/version=*")) or []:
        if s.getPath().getName() not in (name, before):
            fs.delete(s.getPath(), True)
    return out


def _point(spark: SparkSession, path: str, name: str) -> None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs, target = _fs(spark, f"{path}/{POINTER}")
    fresh = jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}.new")
    out = fs.create(fresh, True)
    out.write(bytearray(name.encode()))
    out.close()
    rename = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    rename[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(fresh), fs.makeQualified(target), rename)


def _post(url: str, body: bytes) -> dict:
    req = urllib.request.Request(url, body, {"Content-Type": "application/x-ndjson"})
    with urllib.request.urlopen(req, timeout=120) as r:
        return json.loads(r.read())


def bulk_load(df: DataFrame, url: str, index: str, id_column: str, batch: int = 500, writers: int = 2, post: Callable[[str, bytes], dict] = _post, wait_s: float = 2.0, pause_s: float = 0.0) -> int:
    """Send rows as documents in bulk from the executors, ``writers`` at a time; returns how many were taken.

    A failed batch is tried five times; errors of single documents raise. What was sent is compared with what there was.
    ``pause_s`` is waited after each batch, for services that need air (batches of 250 and 0.05 s, say).
    """
    texts = documents_json(df.withColumn("_id", F.col(id_column).cast("string")))

    def send(rows: Iterator) -> Iterator[tuple[int]]:
        buffer: list[str] = []

        def flush() -> int:
            lines = []
            for t in buffer:
                doc = json.loads(t)
                lines += [json.dumps({"index": {"_index": index, "_id": doc.pop("_id")}}), json.dumps(doc)]
            answer = retry(lambda: post(url, ("\n".join(lines) + "\n").encode()), attempts=5, wait_s=wait_s)
            if answer.get("errors"):
                raise RuntimeError("documents were refused")
            n = len(buffer)
            buffer.clear()
            if pause_s:
                time.sleep(pause_s)
            return n

        done = 0
        for r in rows:
            buffer.append(r.document)
            if len(buffer) >= batch:
                done += flush()
        if buffer:
            done += flush()
        yield (done,)

    sent = sum(n for (n,) in texts.coalesce(writers).rdd.mapPartitions(send).collect())
    there = df.count()
    if sent != there:
        raise GateError(f"{sent} documents sent of {there}")
    return sent


def _request(method: str, url: str, body: dict | None = None) -> dict:
    req = urllib.request.Request(url, None if body is None else json.dumps(body).encode(), {"Content-Type": "application/json"}, method=method)
    with urllib.request.urlopen(req, timeout=120) as r:
        return json.loads(r.read() or b"{}")


def full_refresh(df: DataFrame, url: str, alias: str, id_column: str, mappings: dict, stamp: str, request: Callable[..., dict] = _request, **load) -> int:
    """Load all documents into a new index, compare its count with the rows, then switch the alias to it in one step.

    The new index has no replicas and no refreshing while it is loaded. A load or count that fails drops the new index and
    leaves the alias; the indexes the alias named before are deleted after the switch. Returns the number of documents.
    """
    index = f"{alias}-{stamp}"
    request("PUT", f"{url}/{index}", {"settings": {"number_of_replicas": 0, "refresh_interval": "-1"}, "mappings": mappings})
    try:
        sent = bulk_load(df, f"{url}/_bulk", index, id_column, **load)
        request("PUT", f"{url}/{index}/_settings", {"index": {"number_of_replicas": 1, "refresh_interval": "1s"}})
        request("POST", f"{url}/{index}/_refresh")
        there = int(request("GET", f"{url}/{index}/_count")["count"])
        if there != sent:
            raise GateError(f"{there} documents in {index} of {sent} sent")
    except Exception:
        request("DELETE", f"{url}/{index}")
        raise
    old = [k for k in request("GET", f"{url}/_alias") if k != index and k.startswith(f"{alias}-")]
    request("POST", f"{url}/_aliases", {"actions": [*[{"remove": {"index": k, "alias": alias}} for k in old], {"add": {"index": index, "alias": alias}}]})
    for k in old:
        request("DELETE", f"{url}/{k}")
    return sent
