"""Orphans, trailing totals and snapshots against plain Python."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from lotline.operators.orphans import missing_keys, orphan_references, orphan_report
from lotline.operators.snapshots import snapshot_changes, versions_in_order
from lotline.operators.trailing import SegmentForest, correct_nodes, daily_counts, last_day, totals_of_nodes, trailing_totals, tree_nodes


def test_missing_keys(spark):
    refs = spark.createDataFrame([("a", str(k)) for k in range(300)] + [("a", "7")] * 500 + [("b", "x"), (None, "1"), ("a", None)], "kind string, key string").repartition(5)
    parents = spark.createDataFrame([("a", str(k)) for k in range(0, 300, 2)] + [("a", "4"), ("c", "1"), ("a", None)], "kind string, key string")
    got = {(r.kind, r.key) for r in missing_keys(refs, parents).collect()}
    assert got == {("a", str(k)) for k in range(1, 300, 2)} | {("b", "x")}
    assert missing_keys(refs.limit(0), parents).count() == 0
    assert missing_keys(refs, parents.limit(0)).count() == 301


def test_orphans(spark):
    f = spark.createDataFrame([("e1", "P1", "B1", "x"), ("e2", "P9", " ", "x"), ("e3", None, "B9", "x"), ("e3", None, "B9", "x"), ("e4", "p1", "B1 ", None)], "id string, property_id string, building_id string, kind string")
    f = f.withColumn("at", F.lit("2027-03-05").cast("timestamp"))
    parents = spark.createDataFrame([("property", "P1"), ("building", "B1")], "kind string, key string")
    o = orphan_references({"f": (f, "id", F.col("at"))}, {"property_id": "property", "building_id": "building"}, parents)
    assert sorted((r.event_id, r.field_name) for r in o.collect()) == [("e2", "property_id"), ("e3", "building_id"), ("e4", "building_id"), ("e4", "property_id")]
    known = spark.createDataFrame([("P9", "1"), ("P9", "3")], "key string, version string")
    rep = {(r.field_name, r.lot_status): r.orphans for r in orphan_report(o, known, "2").collect()}
    assert rep == {("property_id", "known_before_and_later"): 1, ("property_id", "never_known"): 1, ("building_id", "never_known"): 2}


def test_segment_forest():
    rng = np.random.default_rng(1)
    leaves = rng.integers(0, 5, (7, 157)).astype(np.int64)
    forest = SegmentForest(leaves.copy())
    first = rng.integers(0, 150, 40)
    last = np.minimum(156, first + rng.integers(0, 60, 40))
    want = np.stack([[leaves[e, a : b + 1].sum() for a, b in zip(first, last, strict=True)] for e in range(7)])
    assert (forest.range_sums(first, last) == want).all()
    forest.correct(np.array([2, 2, 0]), np.array([9, 9, 156]), np.array([4, 1, -1]))
    leaves[2, 9] += 5
    leaves[0, 156] -= 1
    want = np.stack([[leaves[e, a : b + 1].sum() for a, b in zip(first, last, strict=True)] for e in range(7)])
    assert (forest.range_sums(first, last) == want).all()


def test_trailing(spark):
    rng = random.Random(8)
    events = [(rng.choice(["a", "b", "c"]), rng.randint(100, 520)) for _ in range(300)] + [("hot", 300)] * 500 + [(" ", 300), (None, 300), ("a", None)]
    df = spark.createDataFrame(events, "e string, d int").withColumn("at", F.date_from_unix_date("d").cast("timestamp"))
    daily = daily_counts([(df, "e", F.col("at"))])
    got = {(r.entity, r.day): (r.total_7, r.total_30, r.avg_7) for r in trailing_totals(daily, shard_days=64, entities_per_group=2).collect()}
    n = Counter((e, d) for e, d in events if e and e.strip() and d is not None)
    end = max(d for _, d in n)
    want = {}
    for e in {k[0] for k in n}:
        for d in range(min(k[1] for k in n if k[0] == e), end + 1):
            t7, t30 = (sum(n[e, x] for x in range(d - w + 1, d + 1)) for w in (7, 30))
            want[e, d] = (t7, t30, t7 / 7)
    assert got == want
    assert trailing_totals(daily.limit(0)).count() == 0
    later = trailing_totals(daily, shard_days=64, until=end + 70).where(F.col("day") > end)
    assert later.count() == 70 * len({e for e, _ in n})
    assert later.where(F.col("day") > end + 30).agg(F.sum("total_30")).first()[0] == 0
    wide = {(r.entity, r.day): r.total_200 for r in trailing_totals(daily, (200,), shard_days=64).collect()}
    assert wide["hot", end] == sum(n["hot", x] for x in range(end - 199, end + 1))


def test_last_day_counts_every_row(spark):
    df = spark.createDataFrame([("a", 5), (None, 9), (" ", 7), ("a", None)], "e string, d int").withColumn("at", F.date_from_unix_date("d"))
    assert last_day([(df, "e", F.col("at")), (df.limit(0), "e", F.col("at"))]) == 9
    assert last_day([(df.limit(0), "e", F.col("at"))]) is None


def test_late_corrections(spark):
    a = spark.createDataFrame([("x", 5, 2), ("x", 200, 1), ("y", 7, 4)], "entity string, day int, n int")
    b = spark.createDataFrame([("x", 5, 3), ("z", 1, 1)], "entity string, day int, n int")
    now = {tuple(r) for r in correct_nodes(tree_nodes(a), b).collect()}
    assert now == {tuple(r) for r in tree_nodes(a.unionByName(b)).collect()}


def test_snapshots(spark):
    rows = [("1", "v1", "A", 1900), ("1", "v2", "A", 1900), ("1", "v3", "B", None), ("2", "v1", "C", 5), ("2", "v3", "C", 5), ("3", "v2", None, None), ("3", "v3", None, 7), ("4", "v1", "D", 1), ("4", "v1", "D", 1), ("4", "v2", "D", 1), ("4", "v3", "D", 1), (None, "v1", "E", 1), ("5", "v9", "F", 1)]
    df = spark.createDataFrame(rows, "k string, v string, a string, y int").withColumn("key", F.lit("clash"))
    ch = snapshot_changes(df, F.col("k"), F.col("v"), ["v1", "v2", "v3"], {"a": F.col("a"), "y": F.col("y")})
    got = {tuple(r) for r in ch.collect()}
    assert got == {("1", "v2", "v3", "changed", "a,y"), ("2", "v1", "v2", "removed", ""), ("2", "v2", "v3", "added", ""), ("3", "v1", "v2", "added", ""), ("3", "v2", "v3", "changed", "y")}
    assert snapshot_changes(df.limit(0), F.col("k"), F.col("v"), ["v1", "v2"], {"a": F.col("a")}).count() == 0


def test_versions_come_from_the_data(spark):
    rows = [("k", v) for v in ("27v10", "27v2", "28v1", "27v2", "9v3")] + [("k", None)]
    df = spark.createDataFrame(rows, "k string, v string")
    assert versions_in_order(df, "v") == ["9v3", "27v2", "27v10", "28v1"]
    assert versions_in_order(df.limit(0), "v") == []


def test_stored_trees_answer_after_corrections(spark):
    """Totals from corrected nodes are those of all events counted anew, values too, before 1970 too."""
    rng = random.Random(3)
    early = [(rng.choice("abc"), rng.randint(-400, 90), rng.randint(1, 9) / 4) for _ in range(120)]
    late = [(rng.choice("abcd"), rng.randint(-380, 130), rng.randint(1, 9) / 4) for _ in range(40)]
    frame = lambda rows: spark.createDataFrame(rows, "e string, d int, v double").withColumn("at", F.date_from_unix_date("d"))
    daily = lambda rows: daily_counts([(frame(rows), "e", F.col("at"), F.col("v"))])
    nodes = correct_nodes(tree_nodes(daily(early), 32), daily(late), 32)
    got = {tuple(r) for r in totals_of_nodes(nodes, (7, 45), shard_days=32, entities_per_group=2).collect()}
    counted = trailing_totals(daily(early + late), (7, 45), shard_days=32).collect()
    want = {tuple(r) for r in counted}
    assert got == want
    every = {}
    for e, d, v in early + late:
        n, s = every.get((e, d), (0, 0.0))
        every[e, d] = n + 1, s + v
    rows = {(r.entity, r.day): r for r in counted}
    end, days = max(d for _, d in every), {e: min(d for x, d in every if x == e) for e, _ in every}
    assert set(rows) == {(e, d) for e, first in days.items() for d in range(first, end + 1)}
    for (e, d), r in rows.items():
        for w in (7, 45):
            there = [every.get((e, x), (0, 0.0)) for x in range(d - w + 1, d + 1)]
            assert r[f"total_{w}"] == sum(n for n, _ in there)
            assert abs(r[f"value_{w}"] - sum(v for _, v in there)) < 1e-9
            assert abs(r[f"value_avg_{w}"] * w - r[f"value_{w}"]) < 1e-9
    changed = correct_nodes(tree_nodes(daily(early), 32), daily(late), 32, only_changed=True)
    assert changed.count() == tree_nodes(daily(late), 32).count() < nodes.count()


def test_days_before_1970_end_there(spark):
    daily = spark.createDataFrame([("a", -100, 1)], "entity string, day int, n int")
    assert trailing_totals(daily).count() == 1
    assert trailing_totals(daily, until=-90).count() == 11


def test_probe_of_long_and_foreign_keys(spark):
    keys = ["é", "a\0", "a", "x" * 100, "zz", "Z", "\U0001f600", ""]
    parents = spark.createDataFrame([("k", k) for k in keys[::2]], "kind string, key string")
    refs = spark.createDataFrame([("k", k) for k in keys], "kind string, key string")
    assert {r.key for r in missing_keys(refs, parents).collect()} == set(keys[1::2])
