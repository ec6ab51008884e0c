"""Matching entities across sources without keys: regularised Gaussian mixtures over similarity vectors.

Candidate pairs come from three blocks (alike address, same key, near points). Each pair has a vector of similarities:
address (probability of the address link, shared among the targets that bear it), key (1 for the one target that carries
the record's key, else the share of leading parts that agree) and place (falling with distance, halved for all but the
nearest). Two mixtures of Gaussians with ridged covariances, one of matches and one of the rest, are fitted without
labels; values that are missing are left out of a pair's density. Transitivity is enforced in every expectation step:
targets are different things, so a record that matched two of them would make them one; a record's posteriors therefore
compete and sum to at most one. The pair with the greatest posterior is a record's match, if it is above one half.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.session import cut, ship

#: Steps to which similarities are rounded, so that a record's pairs can be counted by vector; the last place of each is "unknown".
STEPS = (8, 5, 16)
SIZES = tuple(n + 2 for n in STEPS)
_GRID = np.array(list(itertools.product(*[[*(np.arange(n + 1) / n), np.nan] for n in STEPS])))
VECTORS, KNOWN = np.nan_to_num(_GRID), ~np.isnan(_GRID)
PATTERNS, PATTERN = np.unique(KNOWN, axis=0, return_inverse=True)
#: Distance at which the similarity of places has fallen to 1/e, and upper ends of the distance steps, in metres.
PLACE_M = 9.0
NEAR_STEPS = (0.5, 1.0, 1.5, 2.0, 3.0, 4.0, 5.0, 6.0, 8.0, 10.0, 12.5, 15.0, 20.0, 25.0)
#: Where the components start: matches that agree in all, in address, in key and place, in key and in place only; and the rest, of other blocks, of the same block, and near.
MATCHES = ((1.0, 1.0, 0.8), (1.0, 0.5, 0.1), (0.0, 1.0, 0.8), (0.0, 1.0, 0.1), (0.0, 0.2, 0.8))
REST = ((0.0, 0.2, 0.1), (0.0, 0.6, 0.1), (0.0, 0.4, 0.35))
LEAST_POSTERIOR = 0.5


def _density(mean: np.ndarray, cov: np.ndarray) -> np.ndarray:
    """The Gaussian's density at each vector of the grid, over the values that are known."""
    out = np.ones(len(VECTORS))
    for k, pattern in enumerate(PATTERNS):
        if pattern.any():
            own = PATTERN == k
            d = (VECTORS[own] - mean)[:, pattern]
            c = cov[np.ix_(pattern, pattern)]
            out[own] = np.exp(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d)) / np.sqrt(np.linalg.det(c) * (2 * np.pi) ** pattern.sum())
    return out


def _moments(weight: np.ndarray, ridge: float) -> tuple[np.ndarray, np.ndarray]:
    """Weighted mean and ridged covariance from the known values."""
    w = weight[:, None] * KNOWN
    mean = (w * VECTORS).sum(0) / np.maximum(w.sum(0), 1e-9)
    d = (VECTORS - mean) * KNOWN
    both = KNOWN.T.astype(float) @ (weight[:, None] * KNOWN)
    values, axes = np.linalg.eigh((d.T @ (weight[:, None] * d)) / np.maximum(both, 1e-9))
    return mean, (axes * np.maximum(values, 0)) @ axes.T + ridge * np.eye(len(mean))


class MatchMixture:
    """The two mixtures, and the odds of a match for each vector of the grid.

    Components are shared by all pairs; how often each occurs depends on which values are known, since a record without
    an address, say, is matched by its key more often than others are. Rare patterns lean on the rest by ``prior`` pairs.
    """

    def __init__(self, ridge: float = 0.01, prior: float = 5.0) -> None:
        self.ridge, self.prior = ridge, prior
        self.components = [(np.array(m), 0.02 * np.eye(len(STEPS))) for m in (*MATCHES, *REST)]
        start = [0.3 / len(MATCHES)] * len(MATCHES) + [0.7 / len(REST)] * len(REST)
        self.weights = np.repeat(np.array(start)[:, None], len(PATTERNS), axis=1)

    def _parts(self) -> np.ndarray:
        """Weighted density of each component at each vector, matches first."""
        return np.stack([_density(*c) for c in self.components]) * self.weights[:, PATTERN]

    def odds(self) -> np.ndarray:
        parts = self._parts()
        return np.clip(parts[: len(MATCHES)].sum(0) / np.maximum(parts[len(MATCHES) :].sum(0), 1e-12), 1e-9, 1e9)

    def maximise(self, matched: np.ndarray, seen: np.ndarray) -> None:
        """New parameters from how often each vector was seen and is expected to be a match."""
        parts, n = self._parts(), len(MATCHES)
        for own, weight in ((slice(0, n), matched), (slice(n, None), np.maximum(seen - matched, 0))):
            parts[own] = parts[own] / np.maximum(parts[own].sum(0), 1e-300) * weight
        # a component that nothing belongs to stays where it is
        self.components = [_moments(p, self.ridge) if p.sum() > 1e-3 else c for p, c in zip(parts, self.components, strict=True)]
        every = np.maximum(parts.sum(1), 1e-6 * max(seen.sum(), 1.0))
        by_pattern = np.stack([parts[:, PATTERN == k].sum(1) for k in range(len(PATTERNS))], axis=1) + self.prior * (every / every.sum())[:, None]
        self.weights = by_pattern / by_pattern.sum(0)


def _lookup(values: np.ndarray, at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(x)) for x in values]), at + 1)


def fit_mixture(records: DataFrame, rounds: int = 30, tolerance: float = 0.01) -> MatchMixture:
    """Fit on all pairs, given as one ``profile`` a record: its pairs counted by vector.

    Records with equal profiles are counted together; each round is one aggregation over the profiles that returns one
    row a vector. It ends when no posterior of a lone pair that was seen moves by more than ``tolerance``. No records
    leave the start values.
    """
    ship(records.sparkSession)
    profiles = cut(records.groupBy(F.transform("profile", lambda x: F.struct(x.vector.alias("vector"), x.n.alias("n"))).alias("profile")).agg(F.count(F.lit(1)).alias("records")))
    flat = profiles.select(F.col("profile.vector").alias("vectors"), F.col("profile.n").alias("counts"), "records")
    model, before = MatchMixture(), None
    for _ in range(rounds):
        odds = model.odds()
        rows = flat.mapInArrow(_expect(odds), "vector int, seen double, matched double").groupBy("vector").agg(F.sum("seen").alias("seen"), F.sum("matched").alias("matched")).collect()  # one row a vector
        if not rows:
            break
        seen, matched = np.zeros(len(VECTORS)), np.zeros(len(VECTORS))
        for r in rows:
            seen[r.vector], matched[r.vector] = r.seen, r.matched
        now = (odds / (1 + odds))[seen > 0]
        if before is not None and np.abs(now - before).max() <= tolerance:
            break
        before = now
        model.maximise(matched, seen)
    return model


def _expect(odds: np.ndarray):
    """The expectation step of a task: how often each vector is seen and expected to match, pairs of a record competing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, matched = np.zeros(len(odds)), np.zeros(len(odds))
        for b in batches:
            if not b.num_rows:
                continue
            vectors, counts = b.column("vectors"), b.column("counts")
            size = vectors.value_lengths().to_numpy()
            v, n = vectors.flatten().to_numpy(), counts.flatten().to_numpy().astype(float)
            at = np.repeat(np.arange(len(size)), size)
            n_all = n * b.column("records").to_numpy()[at]
            total = 1 + np.bincount(at, n * odds[v], len(size))
            seen += np.bincount(v, n_all, len(odds))
            matched += np.bincount(v, n_all * odds[v] / total[at], len(odds))
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(seen[some]), pa.array(matched[some])], names=["vector", "seen", "matched"])

    return run


def _total(odds: np.ndarray) -> Column:
    """1 for no match, plus the odds of each of a record's pairs."""
    return F.aggregate("profile", F.lit(1.0), lambda acc, x: acc + x.n * _lookup(odds, x.vector))


def _step(metres: Column) -> Column:
    """0 for not near, else the place of the distance in NEAR_STEPS, from 1."""
    c = F.when(metres <= NEAR_STEPS[0], 1)
    for k, limit in enumerate(NEAR_STEPS[1:], 2):
        c = c.when(metres <= limit, k)
    return c.otherwise(0)


def _round(value: Column, known: str, dim: int) -> Column:
    n = STEPS[dim]
    return F.when(F.col(known), F.round(F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0)) * n).cast("int")).otherwise(n + 1)


def _vector(code: Column, nearest: Column) -> Column:
    """Place on the grid of a pair's code, by what the record has."""
    step = code % 16
    middle = F.element_at(F.array(*[F.lit(0.0), *[F.lit(float(np.exp(-(a + b) / 2 / PLACE_M))) for a, b in zip((0.0, *NEAR_STEPS), NEAR_STEPS, strict=False)]]), step + 1)
    address = (F.floor(code / 256) % 16) / 15.0 / F.greatest(F.col("na"), F.lit(1))
    key = (F.floor(code / 16) % 16) / 15.0
    return (_round(address, "has_address", 0) * (SIZES[1] * SIZES[2]) + _round(key, "has_key", 1) * SIZES[2] + _round(middle * F.when(nearest, 1.0).otherwise(0.5), "has_point", 2)).cast("int")


def match_entities(by_address: DataFrame, by_key: DataFrame, by_place: DataFrame, records: DataFrame, within: float) -> DataFrame:
    """(record, target, method, confidence): the match of each record, or none.

    ``by_address`` (record, target, similarity), ``by_key`` (record, target; targets that alone carry the record's key)
    and ``by_place`` (record, target, metres, similarity of the keys) are the blocks; ``records`` (record, has_address,
    has_key, has_point) tells what a record has, for values that are missing. The posterior of the mixture chooses: a
    record's match is the pair that holds more than half of it. ``method`` is what the exact check that follows finds:
    ADDRESS for the one target of alike address; KEY, failing one such, for the one of equal key; PLACE, failing both, for
    the nearest within ``within`` metres if no other is as near; UNCONFIRMED if the match is none of these. NULL records
    and targets are ignored, repeated rows count once. A record's pairs are never gathered, only counted by vector.
    """
    fields = {"target": "string", "a": "double", "k": "double", "sole": "int", "metres": "double", "has_address": "boolean", "has_key": "boolean", "has_point": "boolean"}
    rows = lambda df, **have: df.select("record", *[have[c].cast(t).alias(c) if c in have else F.lit(None).cast(t).alias(c) for c, t in fields.items()])
    target = F.col("target")
    parts = rows(by_address.where("target is not null"), target=target, a=F.col("similarity"))
    parts = parts.unionByName(rows(by_key.where("target is not null"), target=target, k=F.lit(1.0), sole=F.lit(1)))
    parts = parts.unionByName(rows(by_place.where("target is not null"), target=target, metres=F.col("metres"), k=F.col("similarity")))
    parts = parts.unionByName(rows(records, **{c: F.col(c) for c in ("has_address", "has_key", "has_point")}))

    has = [F.max(c).alias(c) for c in ("has_address", "has_key", "has_point")]
    pairs = parts.where("record is not null").groupBy("record", "target").agg(*[F.max(c).alias(c) for c in ("a", "k", "sole")], F.min("metres").alias("metres"), *has)
    level = lambda c: F.ceil(F.coalesce(F.col(c), F.lit(0.0)) * 15).cast("int")
    coded = pairs.withColumn("code", F.when(target.isNotNull(), level("a") * 256 + level("k") * 16 + _step(F.col("metres"))))
    counted = coded.groupBy("record", "code").agg(
        F.count(F.lit(1)).alias("n"), F.min("target").alias("target"), *has,
        F.count_if(F.col("a") > 0).alias("na"), F.max(F.when(F.col("a") > 0, target)).alias("ta"),
        F.count_if(F.col("sole") == 1).alias("nk"), F.max(F.when(F.col("sole") == 1, target)).alias("tk"),
        F.min(F.when(F.col("metres").isNotNull(), F.struct("metres", "target", "code"))).alias("near"), F.max(F.struct((-F.col("metres")).alias("minus"), "target")).alias("last"),
    )
    one = counted.groupBy("record").agg(
        F.array_sort(F.collect_list(F.when(F.col("code").isNotNull(), F.struct("code", "n", "target")))).alias("codes"),
        *[F.coalesce(F.max(c), F.lit(False)).alias(c) for c in ("has_address", "has_key", "has_point")],
        F.sum("na").alias("na"), F.max("ta").alias("ta"), F.sum("nk").alias("nk"), F.max("tk").alias("tk"), F.min("near").alias("near"), F.max("last").alias("last"),
    )
    # of equally near targets the least and the greatest differ
    lone = F.col("near").isNotNull() & (F.col("near.target") == F.col("last.target"))
    first = F.when(lone, F.struct(F.col("near.code").alias("code"), F.lit(1).cast("bigint").alias("n"), F.col("near.target").alias("target"), F.lit(True).alias("nearest")))
    others = F.filter(F.transform("codes", lambda x: F.struct(x.code.alias("code"), (x.n - F.when(lone & (x.code == F.col("near.code")), 1).otherwise(0)).alias("n"), x.target.alias("target"), F.lit(False).alias("nearest"))), lambda x: x.n > 0)
    entries = F.concat(others, F.when(lone, F.array(first)).otherwise(F.array().cast("array<struct<code:int,n:bigint,target:string,nearest:boolean>>")))
    near = lone & (F.col("near.metres") <= within)
    rule = F.when(F.col("na") == 1, F.struct(F.col("ta").alias("target"), F.lit("ADDRESS").alias("method"))).when(F.col("nk") == 1, F.struct(F.col("tk").alias("target"), F.lit("KEY").alias("method"))).when(near, F.struct(F.col("near.target").alias("target"), F.lit("PLACE").alias("method")))
    ready = one.where(F.size("codes") > 0).select("record", "has_address", "has_key", "has_point", "na", rule.alias("rule"), entries.alias("entries"))
    judged = cut(ready.select("record", "rule", F.transform("entries", lambda x: F.struct(_vector(x.code, x.nearest).alias("vector"), x.n.alias("n"), x.target.alias("target"))).alias("profile")))
    odds = fit_mixture(judged).odds()
    best = F.array_max(F.transform("profile", lambda x: F.struct(_lookup(odds, x.vector).alias("odds"), x.n.alias("n"), x.target.alias("target"))))
    chosen = judged.select("record", "rule", best.alias("best"), _total(odds).alias("total")).select("record", "rule", "best", (F.col("best.odds") / F.col("total")).alias("confidence"))
    # two pairs alike have at most half of the posterior each
    chosen = chosen.where((F.col("confidence") > LEAST_POSTERIOR) & (F.col("best.n") == 1))
    method = F.when(F.col("rule.target") == F.col("best.target"), F.col("rule.method")).otherwise("UNCONFIRMED")
    return chosen.select("record", F.col("best.target").alias("target"), method.alias("method"), "confidence")
