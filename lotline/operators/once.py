"""Messages delivered more than once: disjoint seen ranges per producer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotline.functions.keys import is_sequence_key
from lotline.session import ship

BLOCK_BITS = 16
RANGES = "producer string, block bigint, lo bigint, hi bigint, copies bigint"


def to_ranges(numbers: np.ndarray, counts: np.ndarray | None = None, bits: int = BLOCK_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lo, hi, copies) of runs of consecutive numbers seen equally often, none crossing a block of 2**bits."""
    if numbers.size == 0:
        return numbers, numbers, numbers
    if counts is None:
        numbers, counts = np.unique(numbers, return_counts=True)
    new = np.ones(numbers.size, bool)
    new[1:] = (numbers[1:] != numbers[:-1] + 1) | (counts[1:] != counts[:-1]) | (numbers[1:] >> bits != numbers[:-1] >> bits)
    at = np.flatnonzero(new)
    return numbers[at], numbers[np.r_[at[1:] - 1, numbers.size - 1]], counts[at]


def sweep(lo: np.ndarray, hi: np.ndarray, copies: np.ndarray, bits: int = BLOCK_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Disjoint (lo, hi, copies) covering all given ranges, adding the copies where they overlap; none crosses a block."""
    edges, at = np.unique(np.concatenate([lo, hi + 1]), return_inverse=True)
    step = np.zeros(edges.size, np.int64)
    np.add.at(step, at[: lo.size], copies)
    np.add.at(step, at[lo.size :], -copies)
    depth = np.cumsum(step)[:-1]
    start, end = edges[:-1], edges[1:] - 1
    there = depth > 0
    start, end, depth = start[there], end[there], depth[there]
    if start.size:  # join neighbours that are covered equally often
        new = np.r_[True, (start[1:] != end[:-1] + 1) | (depth[1:] != depth[:-1]) | (start[1:] >> bits != end[:-1] >> bits)]
        first = np.flatnonzero(new)
        start, end, depth = start[first], end[np.r_[first[1:] - 1, end.size - 1]], depth[first]
    return start, end, depth


#: Numbers a task gathers before it turns them into ranges.
GATHER = 2_000_000


def _range_batch(name: str, lo: np.ndarray, hi: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([name] * lo.size, pa.string()), pa.array(lo >> BLOCK_BITS), pa.array(lo), pa.array(hi), pa.array(n.astype(np.int64))], names=["producer", "block", "lo", "hi", "copies"])


def _local_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[str, list[np.ndarray]] = {}
    held = 0

    def out() -> Iterator[pa.RecordBatch]:
        for name, parts in seen.items():
            lo, hi, n = to_ranges(np.concatenate(parts))
            if lo.size:
                yield _range_batch(name, lo, hi, n)

    for b in batches:
        names = b.column("producer").dictionary_encode()
        who, num = names.indices.to_numpy(), b.column("number").to_numpy()
        for k, name in enumerate(names.dictionary.to_pylist()):
            seen.setdefault(name, []).append(num[who == k])
        held += b.num_rows
        if held >= GATHER:
            yield from out()
            seen, held = {}, 0
    yield from out()


def seen_ranges(messages: DataFrame) -> DataFrame:
    """Disjoint ranges (producer, block, lo, hi, copies) of the sequence numbers in ``messages`` (producer, key).

    Each task first makes its own ranges, and the ranges of a block of 65,536 numbers are merged where they meet; so a
    number delivered millions of times moves as one row a task.
    """
    numbers = messages.where(F.col("producer").isNotNull() & is_sequence_key(F.col("key"))).select("producer", F.col("key").cast("bigint").alias("number"))
    ship(messages.sparkSession)
    return merge_ranges(numbers.mapInArrow(_local_ranges, RANGES))


def _merge_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges sorted by producer and block; the last block of a batch waits for the next one."""
    left: pa.Table | None = None

    def merged(t: pa.Table) -> Iterator[pa.RecordBatch]:
        names = t.column("producer").combine_chunks().dictionary_encode()
        who = names.indices.to_numpy()
        lo, hi, n = (t.column(c).to_numpy() for c in ("lo", "hi", "copies"))
        for k, name in enumerate(names.dictionary.to_pylist()):
            own = who == k
            yield _range_batch(name, *sweep(lo[own], hi[own], n[own]))

    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        t = pa.concat_tables([left, t]) if left is not None else t
        names, block = t.column("producer").combine_chunks().dictionary_encode(), t.column("block").to_numpy()
        who = names.indices.to_numpy()
        last = np.flatnonzero((who != who[-1]) | (block != block[-1]))
        at = int(last[-1]) + 1 if last.size else 0
        if at:
            yield from merged(t.slice(0, at))
        left = t.slice(at)
    if left is not None:
        yield from merged(left)


def merge_ranges(ranges: DataFrame) -> DataFrame:
    """Disjoint ranges from overlapping ones; ranges don't cross blocks.

    Blocks are sent to tasks by hash and stream through sorted, many to a task, so sparse identifiers cost no more than
    dense ones and no more than a block is held at a time.
    """
    ship(ranges.sparkSession)
    names = ["producer", "block", "lo", "hi", "copies"]
    return ranges.select(*names).repartition("producer", "block").sortWithinPartitions("producer", "block", "lo").mapInArrow(_merge_sorted, RANGES)


def repeated_messages(messages: DataFrame) -> DataFrame:
    """(producer, key, copies) of the keys delivered more than once; rows with NULL keys or producers are no messages.

    Sequence numbers go through merged ranges, other identifiers through exact keyed counts.
    Empty input gives an empty result; extra columns are ignored.
    """
    keyed = messages.where("producer is not null and key is not null")
    many = seen_ranges(keyed).where("copies > 1").select("producer", F.explode(F.sequence("lo", "hi")).alias("key"), "copies").withColumn("key", F.col("key").cast("string"))
    odd = keyed.where(~is_sequence_key(F.col("key"))).groupBy("producer", "key").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    return many.unionByName(odd.select("producer", "key", "copies"))


def keep_one(df: DataFrame, key: Column, newest: list[Column]) -> DataFrame:
    """One row for each non-NULL key: the greatest by ``newest`` (NULL least), ties by the whole row.

    Ranked with a limit of one in each task before rows move, so that a key of many copies moves once a task.
    Columns must be orderable. Repeated rows give one; an empty input gives an empty result.
    """
    cols = df.columns
    order = [*[c.desc_nulls_last() for c in newest], *[F.col(f"`{c}`").desc_nulls_last() for c in cols]]
    keyed = df.withColumn("_key", key).where("_key is not null")
    return keyed.withColumn("_nth", F.row_number().over(Window.partitionBy("_key").orderBy(*order))).where("_nth = 1").select(*[f"`{c}`" for c in cols])


def deliver_once(df: DataFrame, producer: Column, key: Column, newest: list[Column]) -> DataFrame:
    """``df`` with one row for each message: the greatest by ``newest``, ties by the whole row.

    The seen ranges tell which numbers came more than once (other identifiers are counted exactly). A number that its
    range covers once is accepted as it stands; only rows of repeated messages are gathered by key and ranked. Rows
    without producer or key are no messages. Repeated rows give one; an empty input gives an empty result.
    """
    cols = [f"`{c}`" for c in df.columns]
    named = df.withColumns({"_producer": producer, "_message": key}).where("_producer is not null and _message is not null")
    many = repeated_messages(named.select(F.col("_producer").alias("producer"), F.col("_message").alias("key"))).select(F.col("producer").alias("_producer"), F.col("key").alias("_message"))
    once = named.join(many, ["_producer", "_message"], "left_anti").select(*cols)
    rest = named.join(many, ["_producer", "_message"], "left_semi")
    return once.unionByName(keep_one(rest, F.struct("_producer", "_message"), newest).select(*cols))


def accept_new(batch: DataFrame, seen: DataFrame, odd: DataFrame, newest: list[Column]) -> tuple[DataFrame, DataFrame]:
    """Rows of ``batch`` (producer, key, ...) with keys not seen before, one for each key, and the new seen ranges.

    Sequence numbers are looked up in the disjoint ranges ``seen``, malformed identifiers exactly in ``odd`` (producer,
    key). NULL keys are no messages; of repeated rows the greatest by ``newest`` stays. Empty state accepts all.
    """
    one = keep_one(batch.where("producer is not null and key is not null"), F.struct("producer", "key"), newest)
    number = F.when(is_sequence_key(F.col("key")), F.col("key").cast("bigint"))
    tagged = one.withColumn("_number", number).withColumn("_block", F.shiftright("_number", BLOCK_BITS))
    s = seen.select(F.col("producer").alias("_p"), F.col("block").alias("_b"), "lo", "hi")
    covered = (F.col("producer") == F.col("_p")) & (F.col("_block") == F.col("_b")) & F.col("_number").between(F.col("lo"), F.col("hi"))
    new = tagged.join(s, covered, "left_anti").join(odd.select("producer", "key"), ["producer", "key"], "left_anti").select(*batch.columns)
    return new, merge_ranges(seen.unionByName(seen_ranges(batch.select("producer", "key"))))
