"""Totals over trailing periods for every entity and day, from segment trees per entity and time shard."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.functions.keys import not_blank
from lotline.session import ship

SHARD_DAYS = 128


class SegmentForest:
    """One segment tree over ``width`` days for each of ``entities``; level 0 holds the leaves."""

    def __init__(self, leaves: np.ndarray) -> None:
        self.levels = [leaves]
        while self.levels[-1].shape[1] > 1:
            below = self.levels[-1]
            if below.shape[1] % 2:
                below = self.levels[-1] = np.pad(below, ((0, 0), (0, 1)))
            self.levels.append(below[:, 0::2] + below[:, 1::2])

    @classmethod
    def of_levels(cls, levels: list[np.ndarray]) -> SegmentForest:
        """A forest whose nodes are given."""
        forest = cls.__new__(cls)
        forest.levels = levels
        return forest

    def correct(self, entity: np.ndarray, day: np.ndarray, delta: np.ndarray) -> None:
        """Add late corrections; only the ancestors of the corrected leaves change."""
        at = np.asarray(day)
        for level in self.levels:
            np.add.at(level, (entity, at), delta)
            at = at >> 1

    def range_sums(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """For each entity (rows) the sums over the day ranges [first, last] (columns)."""
        lo, hi = first.copy(), last + 1
        out = np.zeros((self.levels[0].shape[0], lo.size), self.levels[0].dtype)
        for level in self.levels:
            open_ = lo < hi
            if not open_.any():
                break
            left = np.flatnonzero(open_ & (lo % 2 == 1))
            out[:, left] += level[:, lo[left]]
            lo[left] += 1
            right = np.flatnonzero(open_ & (hi % 2 == 1))
            out[:, right] += level[:, hi[right] - 1]
            hi[right] -= 1
            lo, hi = lo >> 1, hi >> 1
        return out


def daily_counts(sources: list[tuple], blank: bool = False) -> DataFrame:
    """(entity, day, n[, value]): events of every source per entity and day, and the sum of their values if sources have one.

    A source is (frame, entity column, time) or (frame, entity column, time, value). NULL and blank entities don't count,
    or with ``blank`` stay in for what asks for all days. NULL times don't count, NULL values add nothing.
    """
    valued = any(len(s) > 3 for s in sources)
    both = None
    for df, entity, when, *value in sources:
        more = [(value[0].cast("double") if value else F.lit(None).cast("double")).alias("value")] if valued else []
        part = df.select(F.col(entity).cast("string").alias("entity"), F.unix_date(F.to_date(when)).alias("day"), *more)
        both = part if both is None else both.unionByName(part)
    both = both.where(F.col("day").isNotNull())
    if not blank:
        both = both.where(not_blank(F.col("entity")))
    return both.groupBy("entity", "day").agg(F.count(F.lit(1)).alias("n"), *([F.coalesce(F.sum("value"), F.lit(0.0)).alias("value")] if valued else []))


def last_day(sources: list[tuple]) -> int | None:
    """The last day found in any source, whatever its entity; reads the time columns only."""
    both = None
    for df, _, when, *_ in sources:
        d = df.agg(F.max(F.unix_date(F.to_date(when))).alias("day"))
        both = d if both is None else both.unionByName(d)
    return both.agg(F.max("day")).first()[0]


def _levels(shard_days: int) -> int:
    return (shard_days - 1).bit_length()


def tree_nodes(daily: DataFrame, shard_days: int = SHARD_DAYS) -> DataFrame:
    """The trees as a table (entity, shard, level, node, n[, value]): what a store keeps between runs."""
    measures = [c for c in ("n", "value") if c in daily.columns]
    offset = F.pmod(F.col("day"), F.lit(shard_days))
    up = F.explode(F.transform(F.sequence(F.lit(0), F.lit(_levels(shard_days))), lambda k: F.struct(k.alias("level"), F.floor(offset / F.pow(F.lit(2), k)).cast("int").alias("node"))))
    return (
        daily.select("entity", F.floor(F.col("day") / shard_days).cast("int").alias("shard"), *measures, up.alias("u"))
        .groupBy("entity", "shard", F.col("u.level").alias("level"), F.col("u.node").alias("node"))
        .agg(*[F.sum(c).alias(c) for c in measures])
    )


def correct_nodes(nodes: DataFrame, late: DataFrame, shard_days: int = SHARD_DAYS, only_changed: bool = False) -> DataFrame:
    """``nodes`` after late (entity, day, n[, value]) corrections; only the ancestors of corrected leaves get new values.

    With ``only_changed`` just these come out, for a store that replaces rows by (entity, shard, level, node).
    """
    keys, measures = ["entity", "shard", "level", "node"], [c for c in ("n", "value") if c in nodes.columns]
    delta = tree_nodes(late, shard_days).withColumnsRenamed({c: f"_{c}" for c in measures})
    met = nodes.join(delta, keys, "right" if only_changed else "full")
    return met.select(*keys, *[(F.coalesce(F.col(c), F.lit(0)) + F.coalesce(F.col(f"_{c}"), F.lit(0))).alias(c) for c in measures])


Keep = Callable[[dict[int, np.ndarray]], np.ndarray]


def trailing_totals(daily: DataFrame, windows: tuple[int, ...] = (7, 30), keep: Keep | None = None, shard_days: int = SHARD_DAYS, entities_per_group: int = 2048, until: int | None = None) -> DataFrame:
    """(entity, day, total_w..., avg_w...[, value_w..., value_avg_w...]) for every day from an entity's first event to
    ``until``, else the last of ``daily``.

    ``daily`` has entity string, day int (days since 1970, may be negative), n and perhaps value; repeated (entity, day)
    rows add up. total_w counts events, value_w sums values over the last w days; averages are per day. Quiet days come
    out with zeros or what the windows still hold; days before the first event count as zero. ``keep`` takes {window:
    totals} and selects rows before they leave the kernel. An empty input gives an empty result. Entities are unevenly
    busy only in the source rows: here a busy entity has one row a day. Trees are built in the groups that ask them.
    """
    shard = F.floor(F.col("day") / shard_days).cast("int")
    measures = [c for c in ("n", "value") if c in daily.columns]
    leaves = daily.select("entity", shard.alias("shard"), F.lit(0).alias("level"), F.pmod(F.col("day"), F.lit(shard_days)).cast("int").alias("node"), *measures)
    return _ask(leaves, False, windows, keep, shard_days, entities_per_group, until)


def totals_of_nodes(nodes: DataFrame, windows: tuple[int, ...] = (7, 30), keep: Keep | None = None, shard_days: int = SHARD_DAYS, entities_per_group: int = 2048, until: int | None = None) -> DataFrame:
    """As ``trailing_totals``, answered from stored trees (of ``tree_nodes``, ``correct_nodes``) as they are: nothing is counted anew."""
    return _ask(nodes, True, windows, keep, shard_days, entities_per_group, until)


def _ask(nodes: DataFrame, whole: bool, windows: tuple[int, ...], keep: Keep | None, shard_days: int, entities_per_group: int, until: int | None) -> DataFrame:
    """Rows go to (bucket of entities, time shard) groups; a shard also gets the trees of those its windows reach back to.

    ``whole``: all levels are given; else leaves only, and the levels above are added up.
    """
    ship(nodes.sparkSession)
    measures = [c for c in ("n", "value") if c in nodes.columns]
    names = {"n": ("total_", "avg_"), "value": ("value_", "value_avg_")}
    schema = "entity string, day int, " + ", ".join(f"{names[m][0]}{w} {'bigint' if m == 'n' else 'double'}, {names[m][1]}{w} double" for m in measures for w in windows)
    reach, levels = max(windows) - 1, _levels(shard_days) + 1
    day = F.col("shard") * shard_days + F.col("node")
    leaf = nodes.where("level = 0 and n > 0")
    top = leaf.agg(F.max(day), F.approx_count_distinct("entity")).first()
    if top[0] is None:
        return nodes.sparkSession.createDataFrame([], schema)
    end = int(top[0]) if until is None else max(int(top[0]), until)
    buckets, last_shard, back = max(8, -(-int(top[1]) // entities_per_group)), end // shard_days, -(-reach // shard_days)

    # a tree serves its own shard and those whose windows reach the days under the node
    under_last = day if not whole else F.col("shard") * shard_days + F.least((F.col("node") + 1) * F.pow(F.lit(2), F.col("level")) - 1, F.lit(shard_days - 1)).cast("int")
    targets = F.filter(F.sequence(F.col("shard"), F.least(F.col("shard") + back, F.lit(last_shard))), lambda s: s * shard_days <= under_last + reach)
    sent = nodes.where(F.col("shard") <= last_shard).select("entity", F.explode(targets).alias("at"), "shard", "level", "node", *measures, F.lit(None).cast("int").alias("first_day"))
    firsts = leaf.groupBy("entity").agg(F.min(day).cast("int").alias("first_day"))
    marks = firsts.select("entity", F.explode(F.sequence(F.floor(F.col("first_day") / shard_days).cast("int"), F.lit(last_shard))).alias("at"), "first_day")
    rows = sent.unionByName(marks, allowMissingColumns=True).withColumn("bucket", F.pmod(F.xxhash64("entity"), F.lit(buckets)).cast("int"))

    def sums(t: pa.Table) -> pa.Table:
        s = t.column("at")[0].as_py()
        who = t.column("entity").combine_chunks().dictionary_encode()
        entity, n_entities = who.indices.to_numpy(), len(who.dictionary)
        first = t.column("first_day").to_numpy(zero_copy_only=False).astype(float)
        marked = ~np.isnan(first)
        begin = np.full(n_entities, np.iinfo(np.int64).max)
        begin[entity[marked]] = first[marked].astype(np.int64)
        real = t.filter(pa.array(~marked))
        entity = entity[~marked]
        ago, level, node = s - real.column("shard").to_numpy(), real.column("level").to_numpy(), real.column("node").to_numpy()
        days = np.arange(s * shard_days, min(end, (s + 1) * shard_days - 1) + 1)
        at = days - s * shard_days
        totals: dict[str, dict[int, np.ndarray]] = {m: {w: np.zeros((n_entities, days.size), np.int64 if m == "n" else float) for w in windows} for m in measures}
        for m in measures:
            values = real.column(m).to_numpy()
            for k in range(back + 1):
                own = ago == k
                if not own.any():
                    continue
                grid = [np.zeros((n_entities, max(1, -(-shard_days // 2**x))), values.dtype) for x in range(levels)]
                for x in range(levels if whole else 1):
                    here = own & (level == x)
                    np.add.at(grid[x], (entity[here], node[here]), values[here])
                forest = SegmentForest.of_levels(grid) if whole else SegmentForest(grid[0])
                for w in windows:  # the part of each window that lies in this shard
                    lo, hi = np.maximum(at - w + 1 + k * shard_days, 0), np.minimum(at + k * shard_days, shard_days - 1)
                    some = lo <= hi
                    totals[m][w][:, some] += forest.range_sums(lo[some], hi[some])
        mask = days[None, :] >= begin[:, None]
        if keep is not None:
            mask &= keep(totals["n"])
        e, d = np.nonzero(mask)
        cols = [who.dictionary.take(pa.array(e)), pa.array(days[d], pa.int32())]
        for m in measures:
            for w in windows:
                cols += [pa.array(totals[m][w][e, d]), pa.array(totals[m][w][e, d] / w)]
        return pa.Table.from_arrays(cols, names=[f.split()[0] for f in schema.split(", ")])

    return rows.groupBy("bucket", "at").applyInArrow(sums, schema)
