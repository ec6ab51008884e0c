from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lotline.llm.address import block_keys, borough_code, read_addresses, read_line, street_forms
from lotline.llm.linkage import estimate_weights, link_addresses, zip_boroughs


@pytest.mark.parametrize(
    "line,house,form",
    [
        ("285 ST BURIJOGARTH RD.", "285", ("BURIJOGARTH", "SAINT", "ROAD")),
        ("OLD TOMMAKEIGH TERRACE, 69-42", "6942", ("TOMMAKEIGH", "OLD", "TERRACE")),
        ("0283 MT. ZOFBI-PCLOUGH AVE", "283", ("ZOFBIPCLOUGH", "MOUNT", "AVENUE")),
        ("137-A EAST FOLRIBWICK PLACE", "137A", ("FOLRIBWICK", "EAST", "PLACE")),
        ("56 A SECOND BEGVURVALE STREET", "56A", ("BEGVURVALE", "SECOND", "STREET")),
        ("2 ND RAVFITHOLT ST. 90", "90", ("RAVFITHOLT", "SECOND", "STREET")),
        ("182  CIWFEJCLOUGH RD. OLD, BROOKLYN, NY 10009", "182", ("CIWFEJCLOUGH", "OLD", "ROAD")),
        ("311, JUFFEMCLOUGH R0AD, 2ND FL", "311", ("JUFFEMCLOUGH", "", "ROAD")),
        ("25–86 gizemiarbor st #9F", "2586", ("GIZEMIARBOR", "", "STREET")),
        ("VUNEMATARN PLACE #211", "211", ("VUNEMATARN", "", "PLACE")),
        ("323 Upper Ravfitholt Stret (Rear Bldg)", "323", ("RAVFITHOLT", "UPPER", "STREET")),
        ("VILWOGTARN TERRACE NEAR THE CORNER", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_reading(line, house, form):
    got = read_line(line)
    assert got[0] == house
    if form:
        assert street_forms(got[1])[0] == form


def test_one_slip_keeps_a_block():
    import random
    import string

    rng = random.Random(6)
    for _ in range(2000):
        name = "".join(rng.choice(string.ascii_uppercase) for _ in range(rng.randint(6, 14)))
        i = rng.randrange(len(name) - 1)
        slip = rng.choice([name[:i] + name[i + 1 :], name[:i] + name[i + 1] + name[i] + name[i + 2 :], name[:i] + "Q" + name[i + 1 :], name[:i] + name[i] + name[i:]])
        if len(name) >= 9 or 0 < i < len(name) - 2:
            assert len(name) < 9 or set(block_keys(name)) & set(block_keys(slip)), (name, slip)


def test_weights():
    pats = {(3, 2, 2): 900.0, (2, 2, 2): 80.0, (3, 2, 1): 40.0, (3, 0, 0): 300.0, (3, 1, 0): 400.0, (1, 0, 0): 90.0}
    w, p = estimate_weights(pats)
    assert w[3, 2, 2] > w[3, 2, 1] > w[3, 0, 0]
    assert p[3, 2, 2] > 0.9 > 0.1 > p[3, 0, 0]
    assert estimate_weights({}) == ({}, {})


def lines(spark, records, lots):
    rows = [("record", k, b, t) for k, b, t in records] + [("target", k, b, t) for k, b, t in lots]
    df = spark.createDataFrame(rows, "side string, id string, borough string, line string")
    return read_addresses(df, "line", ["side", "id", "borough"]).drop("named")


def test_links(spark):
    lots = [(f"E{k}", "1", f"{k} EAST FARNHOLT STREET") for k in range(10, 40)] + [(f"W{k}", "1", f"{k} WEST FARNHOLT STREET") for k in range(10, 40)]
    lots += [(f"A{k}", "2", f"{k} MARDLEIGH AVENUE") for k in range(10, 40)] + [(f"S{k}", "2", f"{k} MARDLEIGH STREET") for k in range(10, 30)] + [("typo", "2", "50 MARDLEIHG AVENUE"), ("none", "2", "MARDLEIGH AVENUE"), (None, "2", "11 MARDLEIGH AVENUE")]
    records = [
        ("r1", "1", "12 E. Farnholt St"),
        ("r2", "1", "FARNHOLT STRT WEST, 12"),
        ("r3", "1", "12 FARNHOLT STREET"),  # East or West: both have number 12
        ("r4", "2", "35 MARDLEIGH"),  # only the avenue has number 35
        ("r5", "2", "12 MARDLIEGH AVE, APT 4B"),
        ("r6", "2", "50 MARDLEIGH AV"),
        ("r7", "2", "MARDLEIGH AVENUE"),
        ("r8", "3", "12 MARDLEIGH AVENUE"),
        ("r9", None, "12 MARDLEIGH AVENUE"),
        ("r10", "2", None),
        ("r11", "2", "12A MARDLEIGH AVENUE"),
        ("r1", "1", "12 E. Farnholt St"),
        (None, "2", "12 MARDLEIGH AVENUE"),
        ("r12", "2", "x" * 20000 + " 12"),
    ]
    got = {(r.record_id, r.target_id) for r in link_addresses(lines(spark, records, lots)).collect()}
    assert got == {("r1", "E12"), ("r2", "W12"), ("r4", "A35"), ("r5", "A12"), ("r6", "typo")}
    assert link_addresses(lines(spark, records, [])).count() == 0
    assert link_addresses(lines(spark, [], lots)).count() == 0


def test_small_streets_beside_large_ones(spark):
    street = lambda b, ks, name: [(f"{name} {k}", b, f"{k} {name}") for k in ks]
    lots = street("1", range(10, 50), "OAKFIELD STREET") + street("1", (12, 61, 62), "OAKFIELD AVENUE")
    lots += street("2", range(10, 50), "EAST FARNHOLT ROAD") + street("2", (12,), "WEST FARNHOLT ROAD")
    lots += street("3", range(10, 110), "BARTONHAM LANE") + street("3", range(10, 20), "BURTONHAM LANE")
    lots += street("4", range(10, 50), "OLD MARDLEIGH PLACE") + street("4", (60,), "MARDLEIGH PLACE") + street("4", (61,), "OLD MARDLEIHG PLACE")
    lots += [(f"same house {k}", "4", "62 OLD MARDLIEGH PLACE") for k in range(5)]
    records = [
        ("r1", "1", "12 OAKFIELD AVE"), ("r2", "1", "12 OAKFIELD ST"), ("r3", "1", "62 OAKFIELD AV"), ("r4", "1", "40 OAKFIELD AVENUE"),
        ("r5", "2", "12 W FARNHOLT RD"), ("r6", "2", "12 E FARNHOLT RD"),
        ("r7", "3", "12 BURTONHAM LN"), ("r8", "3", "12 BARTONHAM LN"), ("r9", "3", "90 BURTONHAM LANE"),
        ("r10", "4", "60 OLD MARDLEIGH PL"), ("r11", "4", "61 OLD MARDLEIGH PL"), ("r12", "4", "62 OLD MARDLEIGH PL"),
    ]
    got = {(r.record_id, r.target_id) for r in link_addresses(lines(spark, records, lots)).collect()}
    want = {("r1", "OAKFIELD AVENUE 12"), ("r2", "OAKFIELD STREET 12"), ("r3", "OAKFIELD AVENUE 62")}
    want |= {("r5", "WEST FARNHOLT ROAD 12"), ("r6", "EAST FARNHOLT ROAD 12"), ("r7", "BURTONHAM LANE 12"), ("r8", "BARTONHAM LANE 12")}
    want |= {("r10", "MARDLEIGH PLACE 60"), ("r11", "OLD MARDLEIHG PLACE 61")} | {("r12", f"same house {k}") for k in range(5)}
    assert got == want


def test_boroughs(spark):
    df = spark.createDataFrame([(" mn ", None), ("x", "BROOKLYN "), (None, "5"), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(borough_code(F.col("a"), F.col("b"))).collect()] == ["1", "3", "5", None]
    z = spark.createDataFrame([("10001", "1"), ("10001-33", "1"), ("10001", "2"), (None, "3"), ("bad", "3")], "z string, b string")
    assert [tuple(r) for r in zip_boroughs(z, F.col("z"), F.col("b")).collect()] == [("10001", "1")]
