from __future__ import annotations

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lotline.functions import numbers as N
from lotline.functions import text as T
from lotline.functions.keys import lot_with_source
from lotline.operators import resolve as R


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "f,value,want",
    [
        (T.address_light, "12 West 34th-Street  ", "12 WEST 34TH STREET"),
        (T.address_full, "12 West 34th Street", "12 W 34TH ST"),
        (T.address_full, "WESTERN AVENUE", "WESTERN AVE"),
        (T.address_full, None, None),
        (T.house_number, "123-45 Queens Boulevard", "123-45"),
        (T.house_number, "Queens Boulevard", None),
        (T.street_part, "12A Main St", "MAIN ST"),
        (T.borough, " mn", "MANHATTAN"),
        (T.borough, "5", "STATEN ISLAND"),
        (T.borough, "elsewhere ", "ELSEWHERE"),
        (T.borough, None, None),
        (T.borough_to_code, "queens", "4"),
        (T.borough_to_code, "nowhere", None),
        (T.blank_to_null, "  ", None),
        (T.blank_to_null, " a ", " a "),
        (N.safe_int, "3.00000000", 3),
        (N.safe_int, "abc", None),
        (N.safe_int, "", None),
    ],
)
def test_functions(spark, f, value, want):
    assert one(spark, value, f) == want


def test_lot_keys(spark):
    rows = [(" 1000010010 ", None, None, None), (None, "2", "3309", "23"), (None, "6", "1", "1"), (None, "1", "123456", "1"), ("100001001", "1", "1", "1"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "bbl string, b string, k string, l string")
    got = [tuple(r) for r in df.select(*lot_with_source(*map(F.col, ("bbl", "b", "k", "l")))).collect()]
    assert got == [("1000010010", "SOURCE"), ("2033090023", "CONSTRUCTED"), (None, "MISSING"), (None, "MISSING"), ("1000010001", "CONSTRUCTED"), (None, "MISSING")]


def test_scores(spark):
    df = spark.createDataFrame([(0.0,), (96.0,), (500.0,), (None,)], "x double")
    got = [r[0] for r in df.select(N.log_score(F.col("x"), 96)).collect()]
    assert got[:2] == [0.0, pytest.approx(100)]
    assert [r[0] for r in df.select(N.linear_score(F.col("x"), 160)).collect()][:3] == [0.0, 60.0, 100.0]
    m = spark.createDataFrame([(1.0, 3.0), (None, 3.0), (None, None)], "a double, b double").select(N.available_mean([(F.col("a"), 1.0), (F.col("b"), 3.0)]))
    assert [r[0] for r in m.collect()] == [2.5, 3.0, None]


def test_unique_target(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x"), ("b", "y"), ("c", None), (None, "z")], "k string, t string")
    assert [tuple(r) for r in R.unique_target(df, ["k"], "t").collect()] == [("a", "x")]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6)), min_size=1, max_size=25, unique_by=lambda x: x))
def test_cascades_partition_the_rows(spark, pairs):
    df = spark.createDataFrame([(str(i), str(a), str(b)) for i, (a, b) in enumerate(pairs)], "id string, a string, b string")
    first, second = (spark.createDataFrame([(str(k), f"{n}{k}") for k in ks], f"{n} string, target string") for n, ks in (("a", (0, 1, 2)), ("b", (1, 2, 3, 4))))
    stages = [R.Stage("A", lambda d: d.join(first, "a")), R.Stage("B", lambda d: d.join(second, "b"))]
    x = {tuple(r) for r in R.run_cascade(df, "id", stages).collect()}
    y = {tuple(r) for r in R.cascade_by_priority(df, "id", stages).collect()}
    assert x == y
    assert len(x) == len(pairs)
    for r in x:
        a, b = pairs[int(r[0])]
        assert r[2] == ("A" if a <= 2 else "B" if 1 <= b <= 4 else "UNRESOLVED")


def test_grid_finds_every_pair(spark):
    rng = random.Random(9)
    pts = [(k, 40.7 + rng.random() * 0.01, -74 + rng.random() * 0.01) for k in range(120)] + [(500, None, -74.0)]
    a = spark.createDataFrame(pts, "i int, la double, lo double")
    b = spark.createDataFrame(pts, "j int, lb double, lob double")
    from lotline.operators.spatial import haversine

    want = {(p[0], q[0]) for p in pts[:-1] for q in pts[:-1] if haversine(p[1], p[2], q[1], q[2]) <= 100}
    got = [(r.i, r.j) for r in R.grid_pairs(a, b, 100, ("la", "lb"), ("lo", "lob")).collect()]
    assert len(got) == len(set(got))
    assert set(got) == want


@pytest.mark.parametrize("n,d1,d2,want", [(1, 24.0, None, "GEO_UNIQUE_25M"), (1, 26.0, None, None), (2, 9.0, 30.0, "GEO_DOMINANT_10M"), (2, 9.0, 28.0, None), (2, 11.0, 80.0, None)])
def test_geo_rules(spark, n, d1, d2, want):
    df = spark.createDataFrame([(n, d1, d2)], "n int, a double, b double")
    assert df.select(R.geo_method(F.col("n"), F.col("a"), F.col("b"))).first()[0] == want


def test_classification(spark):
    rows = [("one", "c1", 100, 5.0, True, True, True, 1.0), ("one", "c2", 50, 1.0, False, True, True, 1.0), ("two", "c1", 100, 5.0, True, True, True, 1.0), ("two", "c2", 100, 2.0, True, True, True, 1.0), ("mid", "c1", 79, 40.0, True, False, True, 0.95), ("low", "c1", 10, None, False, False, True, 0.1)]
    df = spark.createDataFrame(rows, "k string, c string, score int, distance double, house boolean, street boolean, same_borough boolean, similarity double")
    got = {r.k: (r.c, r.status, r.confidence) for r in R.classify_candidates(df, "k", "c").collect()}
    assert got == {"one": ("c1", "AUTO_RESOLVED", "HIGH"), "two": ("c2", "AMBIGUOUS", "REVIEW"), "mid": ("c1", "REVIEW_REQUIRED", "MEDIUM"), "low": ("c1", "REVIEW_REQUIRED", "LOW")}


def test_similarity_and_fuzzy(spark):
    df = spark.createDataFrame([("abcd", "bcde"), (None, "a")], "a string, b string")
    assert [r[0] for r in df.select(R.street_similarity("a", "b")).collect()] == [0.75, None]
    q = spark.createDataFrame([("MAIN ST", "MAINN ST"), ("MAIN ST", "MAIN RD"), ("A ST", "B ST")], "q string, d string")
    assert [r[0] for r in q.select(T.fuzzy_tokens_match(F.col("q"), F.col("d"))).collect()] == [True, False, False]


def test_lookup_cascade(spark):
    rows = [("1", "a", "x"), ("2", None, "x"), ("3", "b", None), ("4", None, None), ("5", "q", "z")]
    df = spark.createDataFrame(rows, "id string, a string, b string")
    first = spark.createDataFrame([("a", "T1")], "a string, target string")
    second = spark.createDataFrame([("b", "x", "no"), ("q", "z", "T2")], "a string, b string, target string")
    third = spark.createDataFrame([("x", "T3")], "b string, target string")
    got = {r.id: (r.target, r.method) for r in R.lookup_cascade(df, "id", [("A", ["a"], first), ("AB", ["a", "b"], second), ("B", ["b"], third)]).collect()}
    assert got == {"1": ("T1", "A"), "2": ("T3", "B"), "3": (None, "UNRESOLVED"), "4": (None, "UNRESOLVED"), "5": ("T2", "AB")}


def brute_fuzzy(queries, docs):
    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    near = lambda q, d: edits(q, d) <= (0 if len(q) <= 2 else 1 if len(q) <= 5 else 2)
    return {(q, d, b) for q, b in queries for d, c in docs if b is not None and b == c and all(any(near(x, y) for y in d.split(" ")) for x in q.split(" "))}


def test_fuzzy_pairs_lose_nothing(spark):
    import random

    rng = random.Random(5)
    words = ["".join(rng.choice("ABC") for _ in range(n)) for n in (1, 2, 3, 3, 4, 5, 6, 6, 7, 8, 9, 12, 60) for _ in range(4)]

    def slip(w):
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(w) + 1)
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + "Z" + w[i + 1 :], w[:i] + "Q" + w[i:]])
        return w or "A"

    docs = {(" ".join(rng.choice(words) for _ in range(rng.randint(1, 3))), rng.choice("xy")) for _ in range(150)} | {("", "x"), ("ABC", None)}
    queries = {(" ".join(slip(w) for w in rng.sample(d.split(" "), rng.randint(1, d.count(" ") + 1))), b) for d, b in list(docs) * 2}
    a, b = spark.createDataFrame(sorted(queries, key=str), "query string, boro string"), spark.createDataFrame(sorted(docs, key=str), "street string, boro string")
    got = [tuple(r) for r in R.fuzzy_pairs(a, b, "boro").select("query", "street", "boro").collect()]
    want = brute_fuzzy(queries, docs)
    assert len(want) > 200
    assert len({p for p in want if p[0][:3] != p[1][:3]}) > 50
    assert len(got) == len(set(got)) and set(got) == want


def test_fuzzy_match_of_streets_beyond_their_first_letters(spark, tmp_path):
    from lotline.plans import catalog

    lots = [("12 OAKFIELD STREET", "BRONX"), ("3 OLD OAKFIELD STREET", "BX"), ("4 BIRCH AVENUE", "BRONX"), ("5 OAKFIELD STREET", "QUEENS"), (None, "BRONX")]
    here = [("7 AOKFIELD STREET", "BRONX"), ("8 STREET OAKFIELD", "BRONX"), ("9 BIRCH AVENUE", "BRONX"), (None, "BRONX")]
    spark.createDataFrame(lots, "property_address string, borough string").write.parquet(str(tmp_path / "dim_property.parquet"))
    spark.createDataFrame(here, "current_address string, borough string").write.parquet(str(tmp_path / "building_identity.parquet"))
    got = {(r["query"], r.street, r.boro) for r in catalog.queries()["q42_fuzzy_token_match"](spark, str(tmp_path)).collect()}
    oaks = {(q, s, "BRONX") for q in ("AOKFIELD ST", "ST OAKFIELD") for s in ("OAKFIELD ST", "OLD OAKFIELD ST")}
    assert got == oaks | {("BIRCH AVE", "BIRCH AVE", "BRONX")}


@pytest.mark.parametrize("lat,lon,metres", [(40.7, -74.0, 100), (70.0, 25.0, 100), (89.999, 10.0, 100), (-75.0, 179.9999, 100), (0.0, 180.0, 5000), (60.5, -179.99, 2000)])
def test_grid_loses_no_pair_at_any_latitude(spark, lat, lon, metres):
    from lotline.operators.spatial import haversine

    rng = random.Random(2)
    spread = metres / 111_000 * 2.2
    pts = []
    for k in range(70):
        y = max(-90.0, min(90.0, lat + rng.uniform(-spread, spread)))
        x = lon + rng.uniform(-spread, spread) / max(0.01, math.cos(math.radians(lat)))
        pts.append((k, y, (x + 180) % 360 - 180))
    a, b = spark.createDataFrame(pts, "i int, la double, lo double"), spark.createDataFrame([*pts, (99, None, 1.0), (98, float("nan"), 1.0)], "j int, lb double, lob double")
    want = {(p[0], q[0]) for p in pts for q in pts if haversine(p[1], p[2], q[1], q[2]) <= metres}
    got = [(r.i, r.j) for r in R.grid_pairs(a, b, metres, ("la", "lb"), ("lo", "lob")).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert len(want) > 100


def test_missing_coordinates_have_no_distance(spark):
    df = spark.createDataFrame([(40.0, -74.0, 40.0, -74.0), (None, -74.0, 40.0, -74.0), (40.0, -74.0, 40.0, None)], "a double, b double, c double, d double")
    assert [r[0] for r in df.select(N.haversine(*map(F.col, "abcd"))).collect()] == [0.0, None, None]
    far = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0)], "a double, b double, c double, d double")
    assert far.select(N.haversine(*map(F.col, "abcd"))).first()[0] == pytest.approx(math.pi * 6_371_000)


def test_geo_profile_of_ties(spark):
    rows = [("e", "b2", 5.0), ("e", "b1", 5.0), ("e", "b3", 9.0), ("e", "b1", 7.0), ("f", "b1", 1.0)]
    got = {tuple(r) for r in R.geo_profile(spark.createDataFrame(rows, "k string, c string, distance_m double"), "k", "c").collect()}
    assert got == {("e", 3, "b1", 5.0, 5.0), ("f", 1, "b1", 1.0, None)}


def test_every_asked_key_is_classified(spark):
    scored = spark.createDataFrame([("one", "c1", 100, 5.0, True, True, True, 1.0)], "k string, c string, score int, distance double, house boolean, street boolean, same_borough boolean, similarity double")
    asked = spark.createDataFrame([("one", True), ("none", True), ("blank", False)], "k string, has_input boolean")
    got = {r.k: (r.c, r.status, r.confidence) for r in R.classify_candidates(scored, "k", "c", asked).collect()}
    assert got == {"one": ("c1", "AUTO_RESOLVED", "HIGH"), "none": (None, "NO_CANDIDATE", "NONE"), "blank": (None, "NO_INPUT", "NONE")}


def test_event_cascade_stages(spark, tmp_path):
    """One complaint for each method and reason, and the arbitration of its lot."""
    from lotline.plans import catalog

    call = "unique_key string, created_date timestamp, closed_date timestamp, agency string, complaint_type string, status string, incident_address string, borough string, city string, bbl string, latitude double, longitude double, run_id string, ingested_at timestamp"
    rows = [("1", "x", "BRONX", "2000000001", None), ("2", "12 West Oak Street", "bronx", "2000000002", None), ("3", "9 Elm Ave", "BX", None, None), ("4", None, "BRONX", "2000000009", 40.7001), ("5", None, "BRONX", "bad", 40.7101), ("6", None, "QUEENS", None, 40.7001), (" 1.0 ", "y", "BRONX", None, None), (None, "z", "BRONX", None, None)]
    calls = [(k, None, None, "HPD", "noise", "open", a, b, None, lot, la, -74.0 if la else None, f"run{i}", None) for i, (k, a, b, lot, la) in enumerate(rows)]
    # the same message again, older
    calls[6] = (*calls[6][:12], "run", None)
    spark.createDataFrame(calls, call).write.parquet(str(tmp_path / "nyc_311.parquet"))
    who = "bin string, current_bbl string, resolved_bbl string, bbl_aliases array<string>, current_address string, address_aliases array<string>, borough string, latitude double, longitude double"
    b = [("B1", "2000000001", None, None, "1 A St", None, "2", None, None), ("B2", "2000000002", None, [], "12 W OAK ST", None, "BRONX", None, None), ("B3", "2000000002", None, None, "13 W OAK ST", ["9 ELM AVENUE"], "BX", None, None), ("B4", None, None, None, None, None, "BRONX", 40.7, -74.0), ("B5", None, None, None, None, None, "BRONX", 40.71005, -74.0), ("B6", None, None, None, None, None, "BRONX", 40.7105, -74.0)]
    spark.createDataFrame(b, who).write.parquet(str(tmp_path / "building_identity.parquet"))
    got = {r.unique_key: (r.bbl_resolution_reason, r.resolved_bin, r.match_method, r.resolution_status) for r in catalog.queries()["q38_event_resolution_cascade"](spark, str(tmp_path)).collect()}
    assert got == {
        "1": ("UNIQUE_BBL", "B1", "UNIQUE_BBL", "RESOLVED"),
        "2": ("MULTI_BIN_BBL", "B2", "BBL_EXACT_ADDRESS", "RESOLVED"),
        "3": ("MISSING_BBL", "B3", "EXACT_ADDRESS_BOROUGH", "RESOLVED"),
        "4": ("BBL_NOT_FOUND", "B4", "GEO_UNIQUE_25M", "AUTO_RESOLVED"),
        "5": ("MISSING_BBL", "B5", "GEO_DOMINANT_10M", "AUTO_RESOLVED"),
        "6": ("MISSING_BBL", None, None, None),
    }
