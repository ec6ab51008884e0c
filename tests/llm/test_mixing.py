from __future__ import annotations

import math

import pytest

from lotline.llm.mixing import fill, mean_copies, mix_sources, poisson_steps, rate_for, source_key


def test_poisson():
    least, steps = poisson_steps(1.3, 50)
    assert least == 0
    assert steps[0] == pytest.approx(math.exp(-1.3))
    assert steps[2] == pytest.approx(math.exp(-1.3) * (1 + 1.3 + 1.3**2 / 2))
    assert mean_copies(1.3, 50) == pytest.approx(1.3)
    assert mean_copies(1.3, 1) == pytest.approx(1 - math.exp(-1.3))
    for mean, cap in ((1e-7, 1), (0.3, 1), (2.5, 3), (40.0, 1000), (90_000.0, 1_000_000)):
        assert mean_copies(rate_for(mean, cap), cap) == pytest.approx(mean, rel=1e-6)
    assert rate_for(2.0, 2) is None
    least, steps = poisson_steps(250_000.0, 1_000_000)  # no array as long as the number of repeats
    assert least > 200_000 and len(steps) < 20_000
    assert fill({"a": 1, "b": 1, "c": 2}, {"a": 5, "b": 100, "c": 100}, 100) == {"a": 5, "b": pytest.approx(95 / 3), "c": pytest.approx(190 / 3)}


def test_small_shares_are_drawn(spark):
    """A ten-thousandth of a source, and less, comes out at its size, and equal documents are not drawn alike."""
    sized = spark.range(300_000).selectExpr("id as doc_id", "'s' as source", "10 as n_tokens")
    kinds = "mix_name string, source string, weight double, max_repeats int, size_share double"
    wanted = [0.0001, 0.00002, 0.015, 0.5, 2.5]
    plan = spark.createDataFrame([(f"m{i}", "s", 1.0, 4, w) for i, w in enumerate(wanted)], kinds)
    draws, report = mix_sources(sized, plan)
    got = {r.mix_name: r for r in report.collect()}
    for i, w in enumerate(wanted):
        assert abs(got[f"m{i}"].tokens - w * 3_000_000) <= 10, (w, got[f"m{i}"])
    assert draws.where("mix_name = 'm4'").agg({"copy": "max"}).first()[0] == 4


def test_uneven_documents_meet_the_size(spark):
    """Sizes that differ by powers of ten: what is drawn, not only what is expected, has the wanted size."""
    sized = spark.range(40_000).selectExpr("id as doc_id", "if(id % 3 = 0, 'a', 'b') as source", "cast(pow(10, (id * 7919 % 1000) / 250.0) as int) as n_tokens")
    plan = spark.createDataFrame([("m", "a", 1.0, 2, 0.3), ("m", "b", 2.0, 5, 0.3)], "mix_name string, source string, weight double, max_repeats int, size_share double")
    for r in mix_sources(sized, plan)[1].collect():
        assert r.tokens == pytest.approx(r.planned_tokens, rel=0.001)


def test_long_plans_and_caps(spark):
    """More rows than any plan is likely to have, and a number of repeats that is none."""
    sized = spark.range(5_000).selectExpr("id as doc_id", "concat('s', id % 2500) as source", "1 as n_tokens")
    plan = spark.range(2_500).selectExpr("'m' as mix_name", "concat('s', id) as source", "1.0 as weight", "2000000000 as max_repeats", "0.5 as size_share")
    rep = mix_sources(sized, plan)[1]
    assert rep.count() == 2_500
    assert rep.agg({"tokens": "sum"}).first()[0] == pytest.approx(2_500, rel=0.15)


def test_mix(spark):
    docs = [(k, ["big", " Big", "SMALL-ONE", "small_one", None, "other"][k % 6] if k % 100 else "tiny", 10 + k % 7) for k in range(6000)] + [(10_000, "big", None), (10_001, " ", 5)]
    sized = spark.createDataFrame(docs, "doc_id bigint, source string, n_tokens int")
    plan = spark.createDataFrame([("m", "big", 3.0, 1, 0.4), ("m", "small one", 3.0, 3, 0.4), ("m", "tiny", 2.0, 4, 0.4), ("m", "ghost", 1.0, 2, 0.4), ("m", "other", 0.0, 2, 0.4), ("n", "tiny", 1.0, 9, 0.01), (None, "big", 1.0, 1, 1.0)], "mix_name string, source string, weight double, max_repeats int, size_share double")
    draws, report = mix_sources(sized, plan)
    rep = {(r.mix_name, r.source_key): r for r in report.collect()}
    total = sum(t or 0 for _, _, t in docs)
    for key in (("m", "big"), ("m", "small_one")):
        assert rep[key].tokens == pytest.approx(0.4 * total * 3 / 9, rel=0.01)
    assert rep["m", "tiny"].copies == 60 * 4  # all it has at the largest number of repeats
    assert rep["m", "ghost"].tokens == rep["m", "other"].tokens == 0
    assert rep["n", "tiny"].tokens == pytest.approx(0.01 * total, rel=0.05)
    rows = draws.collect()
    assert len({(r.mix_name, r.doc_id, r.copy) for r in rows}) == len(rows)
    assert max(r.copy for r in rows if r.mix_name == "m" and r.source_key == "big") == 1
    assert sum(r.n_tokens for r in rows if (r.mix_name, r.source_key) == ("m", "small_one")) == rep["m", "small_one"].tokens
    order = [r.position_key for r in rows]
    assert order == sorted(order)
    again, _ = mix_sources(sized.repartition(5), plan)
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in rows}
    assert sum(r.actual_share for k, r in rep.items() if k[0] == "m") == pytest.approx(1)


def test_refill_and_empty(spark):
    sized = spark.createDataFrame([(k, "a" if k < 10 else "b", 10) for k in range(1000)], "doc_id bigint, source string, n_tokens int")
    plan = spark.createDataFrame([("m", "a", 1.0, 1, 0.5), ("m", "b", 1.0, 1, 0.5)], "mix_name string, source string, weight double, max_repeats int, size_share double")
    rep = {r.source_key: r.tokens for r in mix_sources(sized, plan, refill=True)[1].collect()}
    assert rep["a"] == 100
    assert rep["b"] == pytest.approx(4900, rel=0.02)
    draws, report = mix_sources(sized.limit(0), plan)
    assert draws.count() == 0
    assert {r.tokens for r in report.collect()} == {0}
    draws, report = mix_sources(sized, plan.limit(0))
    assert draws.count() == report.count() == 0


def test_source_key(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(" Inspection-Note ",), ("inspection note",), ("INSPECTION_NOTE",), (" ",), (None,)], "s string")
    assert [r[0] for r in df.select(source_key(F.col("s"))).collect()] == ["inspection_note"] * 3 + [None, None]
