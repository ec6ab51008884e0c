from __future__ import annotations

import random

import numpy as np

from lotline.llm.entities import NEAR_STEPS, VECTORS, MatchMixture, _expect, match_entities
from lotline.llm.queries import NEAR_M, p2_found


def frames(spark, a, k, p, has):
    return (
        spark.createDataFrame(a, "record string, target string, similarity double"),
        spark.createDataFrame(k, "record string, target string"),
        spark.createDataFrame(p, "record string, target string, metres double, similarity double"),
        spark.createDataFrame(has, "record string, has_address boolean, has_key boolean, has_point boolean"),
    )


def crowd():
    """Records that mostly agree in everything with one target and have neighbours, and a few odd ones."""
    rng = random.Random(3)
    a, k, p, has = [], [], [], []
    for i in range(400):
        r, t = f"r{i}", f"t{i}"
        what = i % 8  # most have all; some lack address, key or point
        if what != 1:
            a.append((r, t, 0.95 + 0.05 * rng.random()))
        if what not in (2, 3):
            k.append((r, t))
        if what != 4:
            p += [(r, t, rng.random() * 3, 0.8 if what not in (2, 3) else None), *[(r, f"n{i}.{j}", 9 + 15 * rng.random(), rng.choice([0.2, 0.5])) for j in range(3)]]
        has.append((r, what != 1, what not in (2, 3), what != 4))
    for i in range(30):  # only a point: the nearest target, others farther off
        p += [(f"p{i}", f"z{i}", rng.random() * 3, None), (f"p{i}", f"y{i}", 12 + rng.random() * 9, None)]
        has.append((f"p{i}", False, False, True))
    a += [("two", "x1", 1.0), ("two", "x2", 1.0), (None, "x1", 1.0), ("r0", "t0", 0.95), ("r0", None, 1.0), ("conflict", "y1", 1.0)]
    k += [("two", "x1"), ("conflict", "y2"), ("r0", "t0")]
    p += [("tie", "z1", 2.0, None), ("tie", "z2", 2.0, None), ("far", "z1", 21.0, None)]
    has += [("two", True, True, False), ("conflict", True, True, False), ("tie", False, False, True), ("far", False, False, True), ("nothing", True, True, True)]
    return a, k, p, has


def test_posteriors_choose(spark):
    got = {r.record: r for r in match_entities(*frames(spark, *crowd()), 6.0).collect()}
    assert all(got[f"r{i}"].target == f"t{i}" and got[f"r{i}"].confidence > 0.9 for i in range(400))
    assert all(got[f"p{i}"].target == f"z{i}" and got[f"p{i}"].method == "PLACE" for i in range(30))
    assert (got["two"].target, got["two"].method) == ("x1", "KEY")
    assert (got["conflict"].target, got["conflict"].method) == ("y1", "ADDRESS")
    assert not {"tie", "nothing"} & set(got)
    assert "far" not in got or got["far"].method == "UNCONFIRMED"
    assert all(0.5 < r.confidence <= 1 for r in got.values())
    assert {r.method for r in got.values()} >= {"ADDRESS", "KEY", "PLACE"}


def test_without_the_mixture_the_rows_are_others(spark, monkeypatch):
    """Odds that tell nothing leave no record with several candidates a match."""
    fs = frames(spark, *crowd())
    want = {(r.record, r.target) for r in match_entities(*fs, 6.0).collect()}
    monkeypatch.setattr(MatchMixture, "odds", lambda self: np.ones(len(VECTORS)))
    got = {(r.record, r.target) for r in match_entities(*fs, 6.0).collect()}
    assert len(got) < len(want) / 2


def test_expectation_against_plain_python(spark):
    rng = random.Random(5)
    odds = np.array([rng.random() * 5 for _ in VECTORS])
    profiles = [([rng.randrange(len(VECTORS)) for _ in range(rng.randint(1, 5))], rng.randint(1, 9)) for _ in range(60)]
    rows = [(v, [rng.randint(1, 3) for _ in v], n) for v, n in profiles]
    df = spark.createDataFrame(rows, "vectors array<int>, counts array<bigint>, records bigint").repartition(3)
    got = df.mapInArrow(_expect(odds), "vector int, seen double, matched double").groupBy("vector").sum("seen", "matched").collect()
    seen, matched = np.zeros(len(VECTORS)), np.zeros(len(VECTORS))
    for v, c, n in rows:
        total = 1 + sum(k * odds[x] for x, k in zip(v, c, strict=True))
        for x, k in zip(v, c, strict=True):
            seen[x] += n * k
            matched[x] += n * k * odds[x] / total
    for r in got:
        assert abs(r["sum(seen)"] - seen[r.vector]) < 1e-9 and abs(r["sum(matched)"] - matched[r.vector]) < 1e-9
    assert len(got) == (seen > 0).sum()


def test_parameters_stay_regular():
    """Rounds on few and on no pairs keep every covariance positive and every weight a share."""
    for seen in (np.zeros(len(VECTORS)), np.eye(len(VECTORS))[5] * 3):
        m = MatchMixture()
        for _ in range(5):
            m.maximise(seen * 0.5, seen)
        assert np.allclose(m.weights.sum(0), 1) and (m.weights > 0).all()
        assert all(np.linalg.eigvalsh(c).min() > 0 for _, c in m.components)
        assert np.isfinite(m.odds()).all()


def test_neighbours_fill_the_grid():
    assert NEAR_M == NEAR_STEPS[-1]


def test_empty(spark):
    assert match_entities(*frames(spark, [], [], [], []), 6.0).count() == 0


def test_agrees_with_the_facts(spark, sf):
    """Buildings found are mostly those the fact table names, where both exist."""
    from pyspark.sql import functions as F

    from lotline.session import table

    found = p2_found(spark, sf)
    facts = table(spark, sf, "fact_311_event").where(F.col("building_id").rlike("^BLD:[0-9]{7}$")).select("unique_key", F.substring("building_id", 5, 7).alias("named"))
    known = table(spark, sf, "building_identity").select(F.col("bin").alias("named"))
    both = found.join(facts, "unique_key").join(known, "named")
    n, same = both.count(), both.where("bin = named").count()
    assert n > 50
    assert same >= 0.97 * n
