from __future__ import annotations

import datetime as dt
import json
import threading
import urllib.parse
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from lotline.functions import numbers as N
from lotline.operators import quality as Q
from lotline.sources import readers as R
from lotline.sources import sinks as K
from lotline.sources.spec import SPECS, SourceSpec, clean, latest
from lotline.streaming import feeds


def page(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(rows))


def test_pages_to_clean_table(spark, tmp_path):
    spec = SPECS["housing"]
    a = dict(violationid="1", bbl=" 1000010010 ", inspectiondate="2027-01-05T00:00:00.000", violationstatus="open", boro="bronx ", latitude="40.5", extra="z")
    page(tmp_path / "year=2027/backfill/page_0.json", [a, dict(violationid="2", boroid="2", block="3309", lot="23", inspectiondate="bad", latitude="x")])
    page(tmp_path / "daily/run=20270301/page_0.json", [dict(a, violationstatus="close")])
    df = R.read_pages(spark, [f"{tmp_path}/year=*/backfill/*.json", f"{tmp_path}/daily/run=*/*.json", f"{tmp_path}/none/*.json"], spec)
    assert df.count() == 3
    stamped = clean(df, spec).withColumn("run", R.run_stamp())
    rows = {r.violationid: r for r in latest(stamped, spec, ["run"]).collect()}
    assert rows["1"].violationstatus == "CLOSE"
    assert (rows["1"].bbl, rows["1"].bbl_source, rows["1"].latitude, rows["1"].event_month, rows["1"].boro) == ("1000010010", "SOURCE", 40.5, 1, "BRONX")
    assert (rows["2"].bbl, rows["2"].bbl_source, rows["2"].latitude, rows["2"].inspectiondate) == ("2033090023", "CONSTRUCTED", None, None)
    none = R.read_pages(spark, [f"{tmp_path}/none/*.json"], spec)
    assert none.count() == 0
    assert clean(none, spec).columns == clean(df, spec).columns
    assert R.read_pages(spark, [f"{tmp_path}/daily/run=20270301/*.json"], spec, require_marker=True).count() == 0


def test_lots_and_names(spark):
    lots = spark.createDataFrame([("1000010010.00000000", "0", "3.00000000", "27v1"), ("x", "1931", "abc", "27v1")], "bbl string, yearbuilt string, unitsres string, version string")
    got = [(r.bbl, r.bbl_source, r.yearbuilt, r.unitsres, r.snapshot_version) for r in clean(lots, SPECS["lots"]).collect()]
    assert got == [("1000010010", "SOURCE_NORMALIZED", None, 3, "27v1"), (None, "MISSING", 1931, None, "27v1")]
    safety = spark.createDataFrame([("V1", "Queens", "12", "3")], "violation_number string, borough string, block string, lot string")
    assert clean(safety, SPECS["safety"]).first().bbl == "4000120003"


def test_versions_and_gated_publish(spark, tmp_path):
    df = spark.createDataFrame([("a", "v1")], "k string, snapshot_version string")
    K.write_version(df, f"{tmp_path}/lots", "27v1")
    K.write_version(df, f"{tmp_path}/lots", "27v2")
    assert R.latest_version(spark, f"{tmp_path}/lots") == "27v2"
    assert R.single_version(df) == "v1"
    with pytest.raises(ValueError):
        R.single_version(df.unionByName(spark.createDataFrame([("b", "v2")], df.schema)))
    with pytest.raises(FileNotFoundError):
        R.latest_version(spark, f"{tmp_path}/nothing")
    assert R.optional(spark, f"{tmp_path}/nothing", df.schema).count() == 0
    target = f"{tmp_path}/published"
    assert K.publish(spark, df, target, [Q.missing("k")]).count() == 1
    with pytest.raises(Q.GateError):
        K.publish(spark, df.withColumn("k", F.lit(None).cast("string")), target, [Q.missing("k")])
    assert K.read_published(spark, target).first().k == "a"
    for k in "bcd":
        K.publish(spark, df.withColumn("k", F.lit(k)), target, [Q.missing("k")])
        assert K.read_published(spark, target).first().k == k
    kept = sorted(p.name for p in (tmp_path / "published").glob("version=*"))
    assert len(kept) == 2 and K.current_version(spark, target) == kept[-1]
    with pytest.raises(FileNotFoundError):
        K.read_published(spark, f"{tmp_path}/nothing")
    assert R.already_loaded(spark, f"{tmp_path}/lots", "27v2") and not R.already_loaded(spark, f"{tmp_path}/lots", "27v3")
    assert R.require_version("27v2", "27v2") == "27v2"
    with pytest.raises(ValueError, match="pinned"):
        R.require_version("27v3", "27v2")
    part = df.withColumns({"event_year": F.lit(2027), "event_month": F.lit(3)})
    K.write_partitioned(part, f"{tmp_path}/parts")
    assert spark.read.parquet(f"{tmp_path}/parts").where("event_year = 2027 and event_month = 3").count() == 1


def test_retry():
    waits, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return 7

    assert R.retry(flaky, wait_s=5, sleep=waits.append) == 7
    assert waits == [5, 10]
    with pytest.raises(OSError):
        R.retry(lambda: (_ for _ in ()).throw(OSError()), attempts=2, sleep=waits.append)


@pytest.fixture
def server():
    seen = {"bulk": [], "queries": []}

    class Handler(BaseHTTPRequestHandler):
        def log_message(self, *a):
            pass

        def answer(self, body):
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps(body).encode())

        def do_GET(self):
            q = dict(urllib.parse.parse_qsl(urllib.parse.urlparse(self.path).query))
            seen["queries"].append(q)
            if "$group" in q:
                return self.answer([{"kind": "noise", "total": "7"}, {"total": "2"}][: int(q["$limit"])])
            if q.get("$select") == "count(*) as n":
                return self.answer([{"n": seen.get("counted", "25")}])
            lo, n = int(q["$offset"]), int(q["$limit"])
            self.answer([{"id": str(k), "created": f"2027-01-{k + 1:02d}"} for k in range(lo, min(lo + n, 25))])

        def do_POST(self):
            seen["bulk"].append(self.rfile.read(int(self.headers["Content-Length"])).decode())
            self.answer({"errors": False})

    s = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}", seen
    s.shutdown()


def test_paged_source(spark, server):
    url, seen = server
    R.register(spark)
    df = spark.read.format("paged_http").schema("id string, created string, gone string").option("url", url).option("pagesize", 10).option("order", "created").load()
    assert df.count() == 25
    assert df.where("gone is not null").count() == 0
    assert df.where("created >= '2027-01-05' and created < '2027-01-07'").count() == 2
    assert any("created >= '2027-01-05'" in q.get("$where", "") for q in seen["queries"])


def test_paged_source_reads_to_the_end(spark, server):
    """No page is left out: not beyond the first, not what arrives after counting, not without a count."""
    url, seen = server
    R.register(spark)
    read = lambda **o: spark.read.format("paged_http").schema("id string").options(url=url, **o).load().count()
    assert read(pagesize=4) == 25
    seen["counted"] = "9"
    assert read(pagesize=4) == 25
    assert read(pagesize=4, count="false") == 25
    assert read(pagesize=25) == 25
    assert [tuple(r) for r in R.remote_counts(spark, url, "kind", "a = 'b'", 5).collect()] == [("noise", 7), (None, 2)]
    assert seen["queries"][-1]["$order"] == "total DESC" and seen["queries"][-1]["$where"] == "a = 'b'"


def test_backfill_by_days(spark, server, tmp_path):
    url, seen = server
    R.register(spark)
    root, day = f"{tmp_path}/raw", dt.date(2027, 1, 1)
    first = R.backfill_days(spark, url, root, "created", day, day + dt.timedelta(days=1), "created", pagesize=10)
    assert len(first) == 2 and R.backfill_days(spark, url, root, "created", day, day + dt.timedelta(days=2), "created", pagesize=10) == [f"{root}/year=2027/month=01/day=03/backfill"]
    assert any(q.get("$where") == "created >= '2027-01-01T00:00:00' AND created < '2027-01-02T00:00:00'" for q in seen["queries"])
    spec = SourceSpec("s", ("id", "created"), "id", lot=None)
    pages = R.read_pages(spark, [f"{root}/year=*/month=*/day=*/backfill/part-*"], spec, require_marker=True)
    assert pages.count() == 75 and pages.where("id = '24' and created = '2027-01-25'").count() == 3
    run = R.look_back(spark, url, root, "created", dt.datetime(2027, 1, 10, 3, tzinfo=dt.timezone.utc), 7, "created", pagesize=100)
    assert run.endswith("daily/run=20270110T030000")
    assert seen["queries"][-1]["$where"] == "created >= '2027-01-02T00:00:00' AND created < '2027-01-09T00:00:00'"  # still the 9th in New York


def test_marker_of_each_folder(spark, tmp_path):
    spec = SourceSpec("s", ("id",), "id", lot=None)
    page(tmp_path / "day=1/page_0.json", [{"id": "done"}])
    (tmp_path / "day=1/_SUCCESS").write_text("")
    page(tmp_path / "day=2/page_0.json", [{"id": "half"}])
    assert [r.id for r in R.read_pages(spark, [f"{tmp_path}/day=*/page_*.json"], spec, require_marker=True).collect()] == ["done"]
    assert R.read_pages(spark, [f"{tmp_path}/day=*/page_*.json"], spec).count() == 2


def test_object_store():
    conf = R.object_store_conf("localhost:9000", "k", "s", local_alias="host.docker.internal")
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://host.docker.internal:9000"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert R.object_store_conf("s3.example", "k", "s", secure=True)["spark.hadoop.fs.s3a.endpoint"] == "https://s3.example"
    assert (R.object_path("b", "/x/y"), R.object_path("b")) == ("s3a://b/x/y", "s3a://b")


def test_local_days(spark):
    row = spark.sql("select timestamp_ntz'2027-07-01 03:30:00' as t, date'2027-07-01' as d").select(N.local_time(F.col("t")).alias("t"), N.local_day_start(F.col("d")).alias("d")).first()
    assert (row.t, row.d) == (dt.datetime(2027, 6, 30, 23, 30), dt.datetime(2027, 7, 1, 4))


def test_full_refresh(spark):
    df = spark.range(7).selectExpr("id as bbl")
    store = {"lots-1": 7}
    log = []

    def request(method, url, body=None):
        log.append((method, url.split("//x/")[1]))
        name = log[-1][1].split("/")[0]
        if method == "PUT" and "/" not in log[-1][1]:
            store[name] = 0
        if method == "DELETE":
            del store[name]
        if log[-1][1].endswith("_count"):
            return {"count": store[name]}
        return {k: {} for k in store} if log[-1][1] == "_alias" else {}

    import tempfile

    folder = tempfile.mkdtemp()

    def post(url, body):  # runs in executors: documents are counted in files
        import uuid

        with open(f"{folder}/{uuid.uuid4()}", "w") as f:
            f.write(str(body.count(b'"_index"')))
        return {"errors": False}

    def counted(method, url, body=None):
        import os

        if url.endswith("_count"):
            store["lots-2"] = sum(int(open(f"{folder}/{p}").read()) for p in os.listdir(folder))
        return request(method, url, body)

    assert K.full_refresh(df, "http://x", "lots", "bbl", {}, "2", counted, batch=3, post=post, pause_s=0.001) == 7
    assert set(store) == {"lots-2"}
    with pytest.raises(Q.GateError, match="14 documents"):
        K.full_refresh(df, "http://x", "lots", "bbl", {}, "3", lambda m, u, b=None: {"count": 14} if u.endswith("_count") else request(m, u, b), batch=3, post=post)
    assert set(store) == {"lots-2"}


def test_bulk_sink(spark, server):
    url, seen = server
    df = spark.range(23).selectExpr("id as bbl", "double('nan') as score", "cast(null as string) as note")
    assert K.bulk_load(df, url, "lots", "bbl", batch=5) == 23
    docs = [json.loads(x) for b in seen["bulk"] for x in b.splitlines()]
    assert {d["index"]["_id"] for d in docs if "index" in d} == {str(k) for k in range(23)}
    assert all(d["score"] is None and "note" in d for d in docs if "index" not in d)


def test_stream_once(spark, tmp_path):
    schema = "producer string, key string, body string"
    src, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    batches = [[("p", "1", "a"), ("p", "1", "b"), ("p", "x", "c")], [("p", "1", "d"), ("p", "2", "e"), ("p", "x", "f"), ("q", "1", "g")]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        feeds.run_once_stream(stream, state, out, f"{tmp_path}/ck", [F.col("body")]).awaitTermination(120)
    got = {tuple(r)[:3] for r in spark.read.parquet(f"{out}/batch=*").select("producer", "key", "body").collect()}
    assert got == {("p", "1", "b"), ("p", "x", "c"), ("p", "2", "e"), ("q", "1", "g")}


def test_stream_state_is_small_and_forgets(spark, tmp_path, monkeypatch):
    """A batch writes the blocks it touched; all blocks come together now and then, and what is older goes."""
    monkeypatch.setattr(feeds, "COMPACT_EVERY", 2)
    state, out = f"{tmp_path}/state", f"{tmp_path}/out"
    far = 1 << 20
    for n, keys in enumerate([["1", "2", str(far), "odd"], ["2", "3"], [str(far), "4", "odd"], ["1", "5"], ["6", "3"], ["6", "7"]]):
        feeds.accept_batch(spark, spark.createDataFrame([("p", k, str(n)) for k in keys], "producer string, key string, body string"), n, state, [F.col("body")], out)
        if n == 1:
            assert {r.block for r in spark.read.parquet(f"{state}/ranges/batch=1").collect()} == {0}
    got = sorted((r.key, r.body) for r in spark.read.parquet(f"{out}/batch=*").collect())
    assert got == sorted([("1", "0"), ("2", "0"), (str(far), "0"), ("odd", "0"), ("3", "1"), ("4", "2"), ("5", "3"), ("6", "4"), ("7", "5")])
    assert sorted(p.name for p in (tmp_path / "state/ranges").glob("batch=*")) == ["batch=2", "batch=3", "batch=4", "batch=5"]


def test_stream_windows(spark, tmp_path):
    df = spark.sql("select 'e' as entity, timestamp'2027-01-01 05:00:00' as at union all select 'e', timestamp'2027-01-01 09:00:00' union all select 'f', timestamp'2027-01-02 01:00:00'")
    df.write.parquet(f"{tmp_path}/in")
    s = feeds.counts_by_window(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), "at", "entity")
    q = s.writeStream.format("memory").queryName("w").outputMode("update").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/ck").start()
    q.awaitTermination(120)
    assert {(r.entity, r.n) for r in spark.sql("select * from w").collect()} == {("e", 2), ("f", 1)}


def test_late_totals(spark):
    nodes = feeds.tree_nodes(spark.createDataFrame([("e", 10, 2)], "entity string, day int, n int"))
    late = spark.sql("select 'e' as who, date_from_unix_date(10) as at union all select 'e', null union all select null, date_from_unix_date(1)")
    out = {(r.level, r.node): r.n for r in feeds.late_totals(nodes, late, "who", "at").collect()}
    assert out[0, 10] == 3
    assert out[7, 0] == 3
