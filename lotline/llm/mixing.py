"""Mixing sources to target weights by Poisson replication.

Each document gets, for each mix, a number hashed from a seed, its id and the mix. The count of its copies is the Poisson
distribution with the source's mean repetition rate inverted at that number, cut at the largest number of repeats. The
rate that has the wanted size on average is known from the source's tokens alone; it is then moved a little so that what
is drawn, not only what is expected, has that size: rates around it are tried on all documents at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotline.session import cut, ship

#: Rates tried at a time for a row of the plan, fewer for long plans, and passes over the documents.
TRIES, TRIED_IN_ALL, PASSES = 48, 60_000, 2
PLAN = "mix_name string, source_key string, wanted double, cap bigint, size double, target double, least bigint, steps array<double>"


def source_key(c: Column) -> Column:
    """Names of sources without regard to case, white space around, and '-', ' ' or '_' between words."""
    return F.nullif(F.regexp_replace(F.lower(F.regexp_replace(c, r"^\s+|\s+$", "")), r"[-\s]+", "_"), F.lit(""))


def poisson_steps(rate: float, cap: int) -> tuple[int, np.ndarray]:
    """(least, steps): a number u in [0, 1) gives ``least`` copies and one more for each step <= u.

    The steps are P(X <= k) for those k below ``cap`` where it is neither 0 nor 1 to the precision of u, so there are
    about 20 times the root of the rate at most, however large ``cap`` is.
    """
    if rate <= 0 or cap <= 0:
        return 0, np.empty(0)
    wide = 10 * math.sqrt(rate) + 40
    lo = max(0, math.floor(rate - wide))
    if lo >= cap:
        return cap, np.empty(0)
    k = np.arange(lo, min(cap, math.ceil(rate + wide) + 1))
    log_p = k * math.log(rate) - rate - np.array([math.lgamma(x + 1) for x in k])
    return lo, np.minimum(np.cumsum(np.exp(log_p)), 1.0)


def mean_copies(rate: float, cap: int) -> float:
    """The mean of the Poisson distribution cut at ``cap``."""
    least, steps = poisson_steps(rate, cap)
    return least + float((1 - steps).sum())


def rate_for(mean: float, cap: int) -> float | None:
    """The rate with that mean number of copies; None if it takes all copies there may be."""
    if mean >= cap * (1 - 1e-12):
        return None
    lo, hi = 0.0, max(1.0, mean)
    while mean_copies(hi, cap) < mean:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        if mid in (lo, hi):
            break
        lo, hi = (mid, hi) if mean_copies(mid, cap) < mean else (lo, mid)
    return hi


def fill(weights: dict[str, float], room: dict[str, float], size: float) -> dict[str, float]:
    """Tokens for each source: by weight, but no source beyond its room; what it cannot give goes to the others by weight."""
    out = {s: 0.0 for s in weights}
    live = {s for s, w in weights.items() if w > 0 and room.get(s, 0) > 0}
    left = size
    while live and left > 1e-9:
        total = sum(weights[s] for s in live)
        full = {s for s in live if left * weights[s] / total >= room[s] - 1e-9}
        if not full:
            for s in live:
                out[s] = left * weights[s] / total
            break
        for s in full:
            out[s] = room[s]
            left -= room[s]
        live -= full
    return out


def _draw_sizes(placed: DataFrame, tries: dict[tuple[str, str], list[float]], caps: dict[tuple[str, str], int]) -> dict[tuple[str, str], np.ndarray]:
    """Tokens that each of the tried rates of a plan row draws, counted over all its documents in one pass."""
    tables = {k: [poisson_steps(r, caps[k]) for r in rates] for k, rates in tries.items()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, str], np.ndarray] = {}
        for b in batches:
            if not b.num_rows:
                continue
            mix, source = b.column("mix_name").dictionary_encode(), b.column("source_key").dictionary_encode()
            at = mix.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
            u, tokens = b.column("u").to_numpy(), b.column("n_tokens").to_numpy()
            for code in np.unique(at):
                key = (mix.dictionary[code // len(source.dictionary)].as_py(), source.dictionary[code % len(source.dictionary)].as_py())
                if key in tables:
                    own = at == code
                    got = [int(((least + np.searchsorted(steps, u[own], "right")) * tokens[own]).sum()) for least, steps in tables[key]]
                    sums[key] = sums.get(key, 0) + np.array(got, np.int64)
        rows = [(*key, k, int(v)) for key, values in sums.items() for k, v in enumerate(values)]
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["mix_name", "source_key", "k", "tokens"])

    if not tables:
        return {}
    ship(placed.sparkSession)
    found = placed.select("mix_name", "source_key", "u", "n_tokens").mapInArrow(count, "mix_name string, source_key string, k int, tokens bigint").groupBy("mix_name", "source_key", "k").agg(F.sum("tokens").alias("tokens"))
    out = {key: np.zeros(len(rates)) for key, rates in tries.items()}
    for r in found.collect():  # as many rows as rates are tried
        out[r.mix_name, r.source_key][r.k] = r.tokens
    return out


def fit_rates(placed: DataFrame, rates: dict[tuple[str, str], float], targets: dict[tuple[str, str], float], caps: dict[tuple[str, str], int], spread: dict[tuple[str, str], float]) -> dict[tuple[str, str], float]:
    """Rates near the given ones whose draw comes nearest to the targets.

    ``spread`` is how far, as a share of the rate, chance may have moved the size; rates are tried so far to both sides,
    then between the two that enclose the target.
    """
    n = max(4, min(TRIES, TRIED_IN_ALL // max(1, len(rates))))
    best = {k: (math.inf, r) for k, r in rates.items()}
    span = {k: (r / (1 + spread[k]), r * (1 + spread[k])) for k, r in rates.items()}
    for _ in range(PASSES):
        tries = {k: sorted({*np.geomspace(lo, hi, n).tolist(), rates[k]}) for k, (lo, hi) in span.items()}
        for k, sizes in _draw_sizes(placed, tries, caps).items():
            for r, size in zip(tries[k], sizes, strict=True):
                best[k] = min(best[k], (abs(size - targets[k]), r))
            above = int(np.searchsorted(sizes, targets[k]))
            ends = [tries[k][0] / 4, *tries[k], tries[k][-1] * 4]
            span[k] = (ends[above], ends[above + 1])
        span = {k: s for k, s in span.items() if best[k][0] > 0}
    return {k: r for k, (_, r) in best.items()}


def mix_sources(sized: DataFrame, plan: DataFrame, seed: int = 1, refill: bool = False) -> tuple[DataFrame, DataFrame]:
    """(draws, report) of the mixes of ``plan`` from ``sized`` (doc_id, source, n_tokens).

    ``plan`` has mix_name, source, weight, max_repeats, size_share; it is read to the driver, as orders are. Sources are
    compared by ``source_key``; NULL and blank sources and NULL names take no part. NULL or negative weights and caps count
    as 0; repeated plan rows of a source add their weights and take the larger cap. Documents without tokens are drawn like
    others but weigh nothing. The size of a mix is size_share times the tokens of all documents, and a source's target its
    share of that size, or all it has at the largest number of repeats; with ``refill`` what sources lack goes to the others.

    draws: mix_name, source_key, doc_id, copy, n_tokens, position_key, in random order over all mixes. report: mix_name,
    source_key, wanted_share, share_of_size (tokens by the size of the mix), actual_share (tokens by all that was drawn),
    documents, copies, most_copies, tokens, planned_tokens, mix_tokens (the size of the mix).
    Sources that don't exist get rows with zeros. An empty plan or corpus gives empty draws.
    """
    spark = sized.sparkSession
    docs = sized.select("doc_id", source_key(F.col("source")).alias("source_key"), F.coalesce("n_tokens", F.lit(0)).cast("bigint").alias("n_tokens"))
    wanted = planned_shares(plan).collect()
    names = spark.createDataFrame([(r.mix_name, r.source_key) for r in wanted], "mix_name string, source_key string")
    per_source = docs.groupBy("source_key").agg(F.sum("n_tokens").alias("tokens"), F.sum(F.col("n_tokens").cast("double") ** 2).alias("squares"))
    total = per_source.agg(F.sum("tokens")).first()[0] or 0
    have = {r.source_key: r for r in per_source.join(names.select("source_key").distinct(), "source_key", "left_semi").collect()}  # at most one row a planned source
    # the full number decides, not a bin of it, so that no rate is too small to be drawn
    number = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "mix_name", "doc_id"), 11) * F.lit(2.0**-53)
    placed = docs.join(names, "source_key").withColumn("u", number)

    made, rates, targets, caps, spread = [], {}, {}, {}, {}
    for mix in sorted({r.mix_name for r in wanted}):
        own = [r for r in wanted if r.mix_name == mix]
        weights = {r.source_key: r.weight for r in own}
        tokens = {r.source_key: float(have[r.source_key].tokens) if r.source_key in have else 0.0 for r in own}
        room = {r.source_key: r.cap * tokens[r.source_key] for r in own}
        size = max(r.size_share for r in own) * total
        all_w = sum(weights.values())
        target = fill(weights, room, size) if refill else {s: min(room[s], size * w / all_w if all_w else 0.0) for s, w in weights.items()}
        for r in own:
            key, t = (mix, r.source_key), target[r.source_key]
            made.append([mix, r.source_key, r.wanted_share, int(r.cap), float(size), float(t), 0, []])
            if t > 0 and tokens[r.source_key] > 0:
                mean = t / tokens[r.source_key]
                rate = rate_for(mean, r.cap)
                if rate is None:
                    made[-1][6] = int(r.cap)
                else:
                    rates[key], targets[key], caps[key] = rate, t, int(r.cap)
                    # eight standard deviations of the drawn size
                    spread[key] = max(1e-6, 8 * math.sqrt(have[r.source_key].squares * (mean + mean * mean if r.cap > 1 else mean)) / t)
    by_key = {(m[0], m[1]): m for m in made}
    for key, rate in fit_rates(placed, rates, targets, caps, spread).items():
        row = by_key[key]
        least, steps = poisson_steps(rate, caps[key])
        row[6], row[7] = least, steps.tolist()
    plan_rows = spark.createDataFrame([tuple(m) for m in made], PLAN)

    copies = F.col("least") + F.size(F.filter("steps", lambda s: s <= F.col("u")))
    counted = placed.join(plan_rows, ["mix_name", "source_key"]).withColumn("copies", copies).where("copies > 0")
    draws = (
        counted.select("mix_name", "source_key", "doc_id", "n_tokens", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy"))
        .withColumn("copy", F.col("copy").cast("int"))
        .withColumn("position_key", F.xxhash64(F.lit(seed + 1), "mix_name", "doc_id", "copy"))
        .orderBy("position_key")
        .select("mix_name", "source_key", "doc_id", "copy", "n_tokens", "position_key")
    )
    got = counted.groupBy("mix_name", "source_key").agg(F.count(F.lit(1)).alias("documents"), F.sum("copies").alias("copies"), F.max("copies").alias("most_copies"), F.sum(F.col("copies") * F.col("n_tokens")).alias("tokens"))
    shares = plan_rows.select("mix_name", "source_key", F.col("wanted").alias("wanted_share"), F.col("target").alias("planned_tokens"), F.col("size").alias("mix_tokens")).join(got, ["mix_name", "source_key"], "left").na.fill(0, ["documents", "copies", "most_copies", "tokens"])
    shares = shares.withColumn("_all", F.sum("tokens").over(Window.partitionBy("mix_name")))
    part = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    report = shares.select(
        "mix_name", "source_key", "wanted_share", part("tokens", "mix_tokens").alias("share_of_size"), part("tokens", "_all").alias("actual_share"), "documents", "copies", "most_copies", "tokens", "planned_tokens", "mix_tokens"
    )
    return draws, report


def planned_shares(plan: DataFrame) -> DataFrame:
    """(mix_name, source_key, weight, cap, size_share, wanted_share): the plan with each source once a mix."""
    rows = plan.select("mix_name", source_key(F.col("source")).alias("source_key"), F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)).alias("weight"), F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0)).alias("cap"), F.coalesce("size_share", F.lit(0.0)).alias("size_share"))
    rows = rows.where("mix_name is not null and source_key is not null").groupBy("mix_name", "source_key").agg(F.sum("weight").alias("weight"), F.max("cap").alias("cap"), F.max("size_share").alias("size_share"))
    all_w = F.sum("weight").over(Window.partitionBy("mix_name"))
    return rows.withColumn("wanted_share", F.when(all_w > 0, F.col("weight") / all_w).otherwise(0.0))


def sized_documents(counted: DataFrame) -> DataFrame:
    """Token counts made once and cut, since drawing reads them several times."""
    return cut(counted)
