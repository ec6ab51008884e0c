from __future__ import annotations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lotline.functions.keys import lot_number, message_key
from lotline.operators.once import RANGES, accept_new, deliver_once, keep_one, merge_ranges, repeated_messages, seen_ranges, sweep, to_ranges

MSG = "producer string, key string, body string"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=120), st.integers(1, 6))
def test_sweep_counts_like_a_counter(numbers, parts):
    chunks = [np.array(numbers[k::parts], np.int64) for k in range(parts)]
    r = [to_ranges(c, bits=5) for c in chunks if c.size]
    if not r:
        return
    lo, hi, n = sweep(*(np.concatenate(x) for x in zip(*r, strict=True)))
    got = {k: c for a, b, c in zip(lo, hi, n, strict=True) for k in range(a, b + 1)}
    assert got == {k: numbers.count(k) for k in set(numbers)}
    assert all(b < a2 for b, a2 in zip(hi, lo[1:], strict=False))


def test_keys(spark):
    rows = [(" 007 ", "7"), ("7.0", "7"), ("7.", "7"), ("\t12\n", "12"), ("000", "0"), ("A-1 ", "A-1"), ("", None), ("  ", None), (None, None), ("7.5", "7.5")]
    got = spark.createDataFrame(rows, "k string, want string").select(message_key(F.col("k")).alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]
    lots = [("1000010001", "1000010001"), (" 1000010001.00 ", "1000010001"), ("3/9/6", "3000090006"), ("4 00007 0009", "4000070009"), ("1-00007-0014", "1000070014"), ("0", None), ("6000010001", None), ("", None), (None, None)]
    got = spark.createDataFrame(lots, "k string, want string").select(lot_number(F.col("k")).alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_repeated(spark):
    rows = [("a", "5", "x")] * 400 + [("a", str(k), "y") for k in range(65530, 65545)] + [("a", "65540", "z"), ("b", "5", "x"), ("b", "odd-1", "x"), ("b", "odd-1", "x"), ("b", "12345678901234567890123", "x"), (None, "9", "x"), ("a", None, "x"), ("a", None, "x")]
    df = spark.createDataFrame(rows, MSG + "").repartition(7).withColumn("copies", F.lit(1))
    got = {(r.producer, r.key): r.copies for r in repeated_messages(df).collect()}
    assert got == {("a", "5"): 400, ("a", "65540"): 2, ("b", "odd-1"): 2}
    assert repeated_messages(df.limit(0)).count() == 0


def test_accept_across_batches(spark):
    empty, odd = spark.createDataFrame([], RANGES), spark.createDataFrame([], "producer string, key string")
    one = spark.createDataFrame([("p", "1", "a"), ("p", "2", "b"), ("p", "2", "c"), ("p", "x", "d")], MSG)
    new, seen = accept_new(one, empty, odd, [F.col("body")])
    assert {tuple(r) for r in new.collect()} == {("p", "1", "a"), ("p", "2", "c"), ("p", "x", "d")}
    two = spark.createDataFrame([("p", "2", "z"), ("p", "3", "e"), ("q", "1", "f"), ("p", "x", "g"), ("p", None, "h")], MSG)
    new2, seen2 = accept_new(two, seen, odd.unionByName(spark.createDataFrame([("p", "x")], "producer string, key string")), [F.col("body")])
    assert {tuple(r) for r in new2.collect()} == {("p", "3", "e"), ("q", "1", "f")}
    assert {(r.producer, r.lo, r.hi) for r in seen2.collect()} >= {("q", 1, 1)}
    assert seen_ranges(one.limit(0)).count() == 0


def test_keep_one_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 1), (1, "b", 1), (2, None, None), (None, "z", 9)], "k int, v string, n int")
    assert sorted(map(tuple, keep_one(df, F.col("k"), [F.col("n")]).collect()), key=str) == [(1, "b", 1), (2, None, None)]


def test_deliver_once(spark):
    rows = [("a", "5", "x")] * 50 + [("a", str(k), "y") for k in range(100)] + [("a", "odd", "1"), ("a", "odd", "2"), ("a", "o", "3"), ("b", "5", "only"), ("b", str(10**17), "far"), ("b", str(10**17), "late"), (None, "5", "z"), ("a", None, "z")]
    df = spark.createDataFrame(rows, MSG).repartition(5)
    got = sorted(map(tuple, deliver_once(df, F.col("producer"), F.col("key"), [F.col("body")]).collect()))
    want = {}
    for p, k, b in rows:
        if p and k:
            want[p, k] = max(want.get((p, k), ""), b)
    assert got == sorted((p, k, b) for (p, k), b in want.items())
    assert deliver_once(df.limit(0), F.col("producer"), F.col("key"), []).count() == 0


def test_sparse_blocks_stream_through(spark):
    """One number a block, every block twice, over many batches: nothing is lost where a batch ends."""
    rows = [("p", k, k << 16, k << 16, 1) for k in range(3000)] * 2 + [("q", 0, 0, 65535, 1), ("q", 1, 65536, 65540, 1)]
    df = spark.createDataFrame(rows, RANGES).repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = sorted(map(tuple, merge_ranges(df).collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == sorted([("p", k, k << 16, k << 16, 2) for k in range(3000)] + rows[-2:])
