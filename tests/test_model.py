from __future__ import annotations

import datetime as dt
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from lotline.operators import model as M
from lotline.operators import quality as Q
from lotline.operators import serving as S


def test_event_ages(spark):
    day = dt.date(2027, 6, 1)
    ages = [-1, 0, 30, 31, 90, 91, 365, 366]
    df = spark.createDataFrame([("e", day - dt.timedelta(days=a), "Open") for a in ages] + [("e", None, "Open"), (None, day, "Open")], "e string, at date, s string")
    as_of = spark.createDataFrame([(day,)], "as_of date")
    r = M.event_features(df, "e", "at", as_of, flags={"open": F.col("s") == "Open"}).collect()
    assert [tuple(x) for x in r] == [("e", 2, 2, 2, 7)]


def test_canonical(spark):
    rows = [("b1", "k1", "A", "2027-01-02", "HPD"), ("b1", "k2", "A", "2027-01-03", "HPD"), ("b1", "k1", "A", "2027-01-01", "HPD"), ("b2", "k", "A", None, "HPD"), ("b2", "k", "B", "2026-01-01", "DOB"), ("b3", "k", "A", "2027-01-01", "HPD"), ("b3", "k", "A", "2027-01-01", "DOB"), (" ", "k", "A", None, "x"), (None, "k", "A", None, "x")]
    df = spark.createDataFrame(rows, "bin string, bbl string, address string, at string, source string")
    got = {r.bin: (r.bbl, r.address, r.source, list(r.bbls), r.identity_status) for r in M.canonicalize(df, "bin", ["bbl", "address"], "at", "source", {"bbl": ("bbls", "BBL_HISTORY"), "address": ("addresses", "ADDRESS_ALIAS")}).collect()}
    assert got == {"b1": ("k2", "A", "HPD", ["k1", "k2"], "BBL_HISTORY"), "b2": ("k", "B", "DOB", ["k"], "ADDRESS_ALIAS"), "b3": ("k", "A", "DOB", ["k"], "STABLE")}


def test_levels_and_missing(spark):
    model = M.ScoreModel((M.Component("a", {"x": 1.0}, 10, 0.5), M.Component("b", {"y": 1.0}, 100, 0.5, scale="linear", missing=60)), (("HIGH", 50.0), ("MEDIUM", 30.0)))
    df = spark.createDataFrame([(10, 100), (0, None), (0, 0)], "x int, y int")
    assert [(r.score, r.level) for r in model.apply(df).collect()] == [(100.0, "HIGH"), (30.0, "MEDIUM"), (0.0, "LOW")]
    assert spark.range(1).select(model.level(F.lit(None).cast("double"))).first()[0] == "NO_DATA"


def test_arbitration(spark):
    rows = [("P1", "P1", "B"), ("P1", "P2", "B"), (None, "P2", "B"), (None, "P2", None), (None, None, None)]
    df = spark.createDataFrame(rows, "own string, src string, b string")
    got = [tuple(r) for r in df.select(*M.arbitrate(F.col("own"), F.col("src"), F.col("b"))).collect()]
    assert got == [("P1", "BUILDING_CANONICAL", 0), ("P1", "BUILDING_CANONICAL", 1), (None, "UNRESOLVED", 0), ("P2", "SOURCE_BBL", 0), (None, "UNRESOLVED", 0)]


def test_gates(spark):
    df = spark.createDataFrame([("a", 5.0), ("a", 200.0), (None, None)], "k string, s double")
    rows = {r.name: (r.value, r.ok) for r in Q.evaluate(df, [Q.not_empty(), Q.missing("k"), Q.duplicates("k"), Q.outside("s", 0, 100), Q.not_in("k", ["a"])]).collect()}
    assert rows == {"rows": (3, True), "missing_k": (1, False), "duplicate_k": (1, False), "outside_s": (2, False), "invalid_k": (1, False)}
    with pytest.raises(Q.GateError, match="missing_k=1"):
        Q.check(df, [Q.missing("k")])
    assert Q.check(df, [Q.not_empty()]) is df
    empty = df.limit(0)
    assert {r.name: r.ok for r in Q.evaluate(empty, [Q.not_empty(), Q.missing("k")]).collect()} == {"rows": False, "missing_k": True}


def test_profiles_rollup_lookup(spark):
    df = spark.createDataFrame([("x", "x"), ("x", "y"), ("x", None), (None, "y"), (None, None)], "a string, b string")
    assert tuple(Q.key_agreement(df, "a", "b").first()) == (2, 1, 1, 1, 1, 1)
    c = spark.createDataFrame([("p", 1.0), ("p", 4.0), (None, 9.0)], "p string, s double")
    assert [tuple(r) for r in M.rollup(c, "p", "s").collect()] == [("p", 2, 4.0, 2.5)]
    q = spark.createDataFrame([(" 1 main  st",), ("2 OAK ST",), ("none",), (None,), ("2 OAK ST",)], "query string")
    b = spark.createDataFrame([("B2", "1 Main St"), ("B1", "1 MAIN ST"), ("B3", None)], "id string, address string")
    p = spark.createDataFrame([("P1", "1 MAIN ST"), ("P2", "2 Oak  St")], "id string, address string")
    assert {tuple(r) for r in S.lookup(q, b, p).collect()} == {(" 1 main  st", "B1", "BUILDING"), ("2 OAK ST", "P2", "PROPERTY")}
    d = spark.createDataFrame([(1.5, None), (float("nan"), "x"), (float("inf"), "y")], "v double, s string")
    assert [r[0] for r in S.documents_json(d).collect()] == ['{"v":1.5,"s":null}', '{"v":null,"s":"x"}', '{"v":null,"s":"y"}']
    s = S.serving(spark.createDataFrame([(" ", 1.0, None), ("1 a ", 1.0, 2.0)], "address string, latitude double, longitude double"), "X", "address").collect()
    assert [(r.search_address, r.location and tuple(r.location)) for r in s] == [(None, None), ("1 A", (1.0, 2.0))]


def test_documents_are_clean_at_any_depth(spark):
    df = spark.sql("select named_struct('a', double('nan'), 'b', array(named_struct('c', double('inf'), 'd', date'2027-01-02'))) as s, map('k', double('-inf')) as m, 1.50BD as x, timestamp_ntz'2027-01-02 03:04:05.006' as t, cast(null as struct<z: double>) as n, array(double('nan'), 1.0D) as v")
    assert json.loads(S.documents_json(df).first()[0]) == {"s": {"a": None, "b": [{"c": None, "d": "2027-01-02"}]}, "m": {"k": None}, "x": 1.5, "t": "2027-01-02T03:04:05.006", "n": None, "v": [None, 1.0]}


def test_processing_time_on_request(spark):
    df = spark.createDataFrame([("1 a", 1.0, 2.0)], "address string, latitude double, longitude double")
    assert "serving_calculated_at" not in S.serving(df, "X", "address").columns
    assert S.serving(df, "X", "address", stamp=True).where("serving_calculated_at > timestamp'2020-01-01'").count() == 1


def test_calibration_without_gathering(spark):
    rng = random.Random(4)
    for values in ([rng.randint(1, 40) / 4 for _ in range(500)], [1.0], [5.0, -1.0, 0.0, None, 7.0]):
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
        up = sorted(v for v in values if v and v > 0)
        probs = [0.0001, 0.25, 0.5, 0.9, 0.999, 1.0]
        got = {r.p: r.value for r in M.calibrate(df, "x", probs).collect()}
        assert got == {p: up[max(0, math.ceil(p * len(up)) - 1)] for p in probs}
    near = {r.p: r.value for r in M.calibrate(df, "x", [0.5], error=0.01).collect()}
    assert near == {0.5: 5.0}
    assert [r.value for r in M.calibrate(df.limit(0), "x", [0.5]).collect()] == [None]


def test_facts_keep_every_event(spark):
    events = spark.createDataFrame([("1", " 7 ", "A"), ("2", None, "B"), ("3", "9", None), ("4", "404", "A"), ("5", "8", "A")], "k string, bin string, lot string")
    buildings = spark.createDataFrame([("7", "BLD:7", "PROP:A"), ("8", "BLD:8", None), ("9", "BLD:9", "PROP:B")], "bin string, building_id string, property_id string")
    properties = spark.createDataFrame([("A", "PROP:A"), ("B", "PROP:B")], "bbl string, property_id string")
    rows = {r.k: (r.event_id, r.building_id, r.property_id, r.property_resolution_method, r.building_resolution_status) for r in M.build_fact(events, "event_id", "X", "k", "bin", "lot", buildings, properties).collect()}
    assert rows == {
        "1": ("X:1", "BLD:7", "PROP:A", "BUILDING_CANONICAL", "RESOLVED"),
        "2": ("X:2", None, "PROP:B", "SOURCE_BBL", "UNRESOLVED"),
        "3": ("X:3", "BLD:9", "PROP:B", "BUILDING_CANONICAL", "RESOLVED"),
        "4": ("X:4", None, "PROP:A", "SOURCE_BBL", "UNRESOLVED"),
        "5": ("X:5", "BLD:8", None, "UNRESOLVED", "RESOLVED"),
    }


def test_gates_over_several_tables(spark):
    identity = spark.createDataFrame([("1",), ("2",)], "bin string")
    properties = spark.createDataFrame([("P1", "1"), ("P1", "2")], "property_id string, bbl string")
    buildings = spark.createDataFrame([("B1", "P1"), ("B2", "P9")], "building_id string, property_id string")
    bridge = spark.createDataFrame([("P1", "B1"), ("P9", "B2"), ("P1", "B7")], "property_id string, building_id string")
    bad = {r.name: r.value for r in Q.star_gate(properties, buildings, bridge, identity).where("not ok").collect()}
    assert bad == {"property_repeated_id": 1, "bridge_rows": 3, "building_property_orphans": 1, "bridge_property_orphans": 1, "bridge_building_orphans": 1}
    fact = spark.createDataFrame([("e1", "B1", "P1", "1"), ("e1", None, "P9", "2")], "event_id string, building_id string, property_id string, resolved_bin string")
    source = spark.createDataFrame([("1",), ("2",), (None,)], "k string")
    bad = {r.name: r.value for r in Q.fact_gate(source, "k", fact, "event_id", properties, buildings, "resolved_bin").where("not ok").collect()}
    assert bad == {"source_null_k": 1, "fact_rows": 2, "fact_repeated_event_id": 1, "property_orphans": 1, "resolved_without_building": 1}
    with pytest.raises(Q.GateError, match="property_orphans=1"):
        Q.pass_gate(Q.fact_gate(source, "k", fact, "event_id", properties, buildings))
    assert Q.entity_gate(identity, identity, "bin", [Q.when_wrong("odd", F.col("bin") == "3")]).where("not ok").count() == 0
    assert [r.ok for r in Q.single_value(fact, "event_id").collect()] == [True, True]
    assert [r.ok for r in Q.reconcile(spark, 3, 3, Q.rows_of(fact)).collect()] == [True, False]
    assert Q.gate(spark, [Q.Measure("none", F.lit(None).cast("double"))]).first().ok is False
