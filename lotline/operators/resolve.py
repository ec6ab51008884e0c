"""Entity resolution: uniqueness guard, cascades of stages, proximity on a grid, candidate scoring."""

from __future__ import annotations

import difflib
import math
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from lotline.functions.numbers import haversine
from lotline.functions.text import allowed_edits, fuzzy_tokens_match, token_pieces, token_probes


def unique_target(df: DataFrame, keys: list[str], target: str) -> DataFrame:
    """(keys, target) for keys with exactly one distinct non-NULL target; NULL keys have none."""
    known = df.where(" and ".join(f"`{k}` is not null" for k in [*keys, target]))
    return known.groupBy(*keys).agg(F.min(target).alias(target), (F.min(target) != F.max(target)).alias("_many")).where(~F.col("_many")).drop("_many")


@dataclass(frozen=True)
class Stage:
    """One step of a cascade: ``match`` takes the rows left over and returns (key, target)."""

    method: str
    match: Callable[[DataFrame], DataFrame]
    confidence: str = "HIGH"


def run_cascade(df: DataFrame, key: str, stages: list[Stage], target: str = "target") -> DataFrame:
    """(key, target, method, confidence, status) for every row: each stage sees what the ones before left.

    Unmatched rows come out with NULL target and UNRESOLVED. ``key`` must be unique and not NULL. An empty input gives an
    empty result.
    """
    left, parts = df, []
    for s in stages:
        hit = s.match(left).select(key, target).withColumns({"method": F.lit(s.method), "confidence": F.lit(s.confidence), "status": F.lit("RESOLVED")})
        parts.append(hit)
        left = left.join(hit.select(key), key, "left_anti")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    kind = dict(out.dtypes)[target]
    rest = left.select(key, F.lit(None).cast(kind).alias(target), F.lit("UNRESOLVED").alias("method"), F.lit("NONE").alias("confidence"), F.lit("UNRESOLVED").alias("status"))
    return out.unionByName(rest)


def cascade_by_priority(df: DataFrame, key: str, stages: list[Stage], target: str = "target") -> DataFrame:
    """As ``run_cascade``, for stages that don't depend on what is left: all run once and the first hit of a key wins.

    One shuffle by key instead of an anti-join after each stage.
    """
    hits = None
    for rank, s in enumerate(stages):
        h = s.match(df).select(key, F.struct(F.lit(rank).alias("rank"), F.col(target).alias("target"), F.lit(s.method).alias("method"), F.lit(s.confidence).alias("confidence")).alias("h"))
        hits = h if hits is None else hits.unionByName(h)
    best = hits.groupBy(key).agg(F.min("h").alias("h"))
    return df.select(key).join(best, key, "left").select(
        key, F.col("h.target").alias(target), F.coalesce("h.method", F.lit("UNRESOLVED")).alias("method"), F.coalesce("h.confidence", F.lit("NONE")).alias("confidence"), F.when(F.col("h").isNotNull(), "RESOLVED").otherwise("UNRESOLVED").alias("status")
    )


def lookup_join(df: DataFrame, key: str, cols: list[str], lookup: DataFrame, values: dict[str, str]) -> DataFrame:
    """``df`` with ``values`` (column of ``lookup``: new name) of the lookup row that equals it in ``cols``, else NULL.

    Rows with a NULL in ``cols`` match nothing; they get a value of their own, so that missing keys spread evenly instead
    of meeting in one task. ``lookup`` has one row for each value of ``cols``; small ones are broadcast if their measured
    size allows.
    """
    keys = [f"_k{j}" for j in range(len(cols))]
    none = F.concat(F.lit("\u0000"), F.xxhash64(key).cast("string"))
    missing = F.lit(False)
    for c in cols:
        missing = missing | F.col(c).isNull()
    own = {k: F.when(missing, none).otherwise(F.col(c).cast("string")) if j == 0 else F.coalesce(F.col(c).cast("string"), F.lit("")) for j, (k, c) in enumerate(zip(keys, cols, strict=True))}
    right = lookup.select(*[F.col(c).cast("string").alias(k) for c, k in zip(cols, keys, strict=True)], *[F.col(c).alias(n) for c, n in values.items()])
    return df.withColumns(own).join(right, keys, "left").drop(*keys)


def lookup_cascade(df: DataFrame, key: str, lookups: list[tuple[str, list[str], DataFrame]], target: str = "target", confidence: str = "HIGH") -> DataFrame:
    """As ``run_cascade``, where each stage is a lookup (method, columns, frame with the columns and a unique target).

    One left join a stage, no anti-joins, unions or joining back.
    """
    names = [f"_t{i}" for i in range(len(lookups))]
    for n, (_, cols, lookup) in zip(names, lookups, strict=True):
        df = lookup_join(df, key, cols, lookup, {target: n})
    method = F.lit("UNRESOLVED")
    for n, (label, _, _) in reversed(list(zip(names, lookups, strict=True))):
        method = F.when(F.col(n).isNotNull(), label).otherwise(method)
    hit = F.coalesce(*names)
    return df.select(key, hit.alias(target), method.alias("method"), F.when(hit.isNotNull(), confidence).otherwise("NONE").alias("confidence"), F.when(hit.isNotNull(), "RESOLVED").otherwise("UNRESOLVED").alias("status"))


def pick_by_priority(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def _grid(metres: float, lat: Column, lon: Column, row: Column | None = None) -> tuple[Column, Column, Column]:
    """(row, column, columns of the row) on a grid whose columns are as wide as ``metres`` at the row's far edge asks for.

    Points within ``metres`` are at most one row apart and, by the columns of either row, one column, counted round the globe.
    """
    cell = math.degrees(metres / 6_371_000.0) * 1.0001
    row = F.floor((lat + 90) / cell) if row is None else row
    edge = F.greatest(F.abs(row * cell - 90), F.abs((row + 1) * cell - 90)) + cell
    least, half = F.cos(F.radians(F.least(edge, F.lit(90.0)))), math.sin(min(metres / 2 / 6_371_000.0, math.pi / 2))
    columns = F.when(least <= half * 1.0001, 1).otherwise(F.greatest(F.floor(360 / F.degrees(2 * F.asin(half / least)) * 0.9999), F.lit(1))).cast("bigint")
    around = F.pmod(lon + 180, F.lit(360.0))
    return row, F.least(F.floor(around / 360 * columns), columns - 1), columns


def grid_pairs(left: DataFrame, right: DataFrame, metres: float, lat: tuple[str, str], lon: tuple[str, str], on: list[str] | None = None) -> DataFrame:
    """Pairs within ``metres`` by an equi-join on grid cells, with distance_m; none is lost at any latitude or at the 180th meridian.

    Each row of the grid has columns of its own width, so a point looks at nine cells however narrow the parallels are.
    ``on`` lists further columns that must be equal. NULL and NaN coordinates have no partner.
    """
    there = lambda df, k: df.where(F.col(lat[k]).isNotNull() & F.col(lon[k]).isNotNull() & ~F.isnan(lat[k]) & ~F.isnan(lon[k]))
    gy, gx, _ = _grid(metres, F.col(lat[0]), F.col(lon[0]))
    a = there(left, 0).withColumns({"_gy": gy, "_gx": gx})
    own = _grid(metres, F.col(lat[1]), F.col(lon[1]))[0]
    b = there(right, 1).withColumn("_gy", F.explode(F.array(*[own + i for i in (-1, 0, 1)])))
    _, at, n = _grid(metres, F.col(lat[1]), F.col(lon[1]), F.col("_gy"))
    b = b.withColumn("_gx", F.explode(F.array_distinct(F.array(*[F.pmod(at + j, n) for j in (-1, 0, 1)]))))
    d = haversine(F.col(lat[0]), F.col(lon[0]), F.col(lat[1]), F.col(lon[1]))
    return a.join(b, ["_gy", "_gx", *(on or [])]).withColumn("distance_m", d).where(F.col("distance_m") <= metres).drop("_gy", "_gx")


def geo_profile(pairs: DataFrame, key: str | list[str], candidate: str) -> DataFrame:
    """(key, candidates, nearest, nearest_m, second_m): how near and how lonely the nearest candidate is.

    The two nearest are ranked with a limit of two a task before anything moves; ties go to the least candidate.
    """
    keys = [key] if isinstance(key, str) else key
    per = pairs.groupBy(*keys, candidate).agg(F.min("distance_m").alias("d"))
    w = Window.partitionBy(*keys).orderBy("d", candidate)
    first = lambda k, c: F.max(F.when(F.col("_rn") == k, F.col(c)))
    two = per.withColumn("_rn", F.row_number().over(w)).where("_rn <= 2").groupBy(*keys).agg(first(1, candidate).alias("nearest"), first(1, "d").alias("nearest_m"), first(2, "d").alias("second_m"))
    n = per.groupBy(*keys).agg(F.count(F.lit(1)).cast("int").alias("candidates"))
    return n.join(two, keys).select(*keys, "candidates", "nearest", "nearest_m", "second_m")


def geo_method(candidates: Column, nearest: Column, second: Column, unique_m: float = 25.0, dominant_m: float = 10.0, gap_m: float = 20.0) -> Column:
    """GEO_UNIQUE_25M for one near candidate, GEO_DOMINANT_10M for one much nearer than the next, else NULL."""
    return F.when((candidates == 1) & (nearest <= unique_m), "GEO_UNIQUE_25M").when((nearest <= dominant_m) & (second - nearest >= gap_m), "GEO_DOMINANT_10M")


def fuzzy_pairs(queries: DataFrame, docs: DataFrame, on: str) -> DataFrame:
    """(query, street, on) for texts (query, on) and (street, on), both distinct, with ``fuzzy_tokens_match`` and equal ``on``.

    Distinct tokens are compared by keys that lose no pair; each query then meets the streets near the one of its tokens
    that has the fewest, and is checked whole. NULLs have no partner.
    """
    words = docs.select(on, "street", F.explode(F.array_distinct(F.split("street", " "))).alias("word"))
    tokens = queries.select(on, "query", F.explode(F.array_distinct(F.split("query", " "))).alias("token"))
    have = words.groupBy(on, "word").agg(F.count(F.lit(1)).alias("streets")).select(on, "word", "streets", F.explode(F.array_distinct(token_pieces(F.col("word")))).alias("key"))
    ask = tokens.select(on, "token").distinct().select(on, "token", F.explode(token_probes(F.col("token"))).alias("key"))
    near = ask.join(have, [on, "key"]).where(F.levenshtein("token", "word") <= allowed_edits(F.col("token"))).select(on, "token", "word", "streets").distinct()
    reach = near.groupBy(on, "token").agg(F.sum("streets").alias("reach"), F.collect_list("word").alias("words"))
    # a token near no word leaves its query without a partner whichever token is taken
    rarest = tokens.join(reach, [on, "token"]).groupBy(on, "query").agg(F.min_by("words", F.struct("reach", "token")).alias("words"))
    met = rarest.select(on, "query", F.explode("words").alias("word")).join(words, [on, "word"]).select("query", "street", on).distinct()
    return met.where(fuzzy_tokens_match(F.col("query"), F.col("street")))


@F.pandas_udf(DoubleType())
def street_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-blocks ratio of two texts, in Arrow batches; NULL if either is."""
    ratio = lambda x, y: None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio()
    return pd.Series([ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


# Points for equal parts and for nearness.
def candidate_score(house: Column, street: Column, similarity: Column, same_borough: Column, distance: Column) -> Column:
    """Points for equal house number, equal or similar street, equal borough and nearness."""
    near = F.when(distance <= 25, 10).when(distance <= 50, 8).when(distance <= 100, 5).when(distance <= 200, 2).otherwise(0)
    return F.when(house, 40).otherwise(0) + F.when(street, 40).otherwise(30 * similarity) + F.when(same_borough, 10).otherwise(0) + near


def nearest_candidates(pairs: DataFrame, key: str, order: list[Column], most: int = 25) -> DataFrame:
    """The first ``most`` candidates of each key, as a search that returns one page of hits would give them."""
    w = Window.partitionBy(key).orderBy(*order)
    return pairs.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= most).drop("_rn")


def classify_candidates(scored: DataFrame, key: str, candidate: str, asked: DataFrame | None = None) -> DataFrame:
    """(key, candidate, score, status, confidence) from scored candidates.

    ``scored`` has key, candidate, score, distance, house, street, same_borough (booleans), similarity. One candidate equal
    in all parts resolves, several are ambiguous, else the best one goes to review. With ``asked`` (key, has_input) every
    key asked for has a row: NO_INPUT for one without address and point, NO_CANDIDATE for one that nothing fits.
    """
    exact = F.col("house") & F.col("street") & F.col("same_borough") & (F.col("distance").isNull() | (F.col("distance") <= 100))
    medium = F.col("house") & (F.col("similarity") >= 0.9) & F.col("same_borough") & (F.col("distance") <= 50)
    # the first by score, then distance (missing last), then candidate
    order = F.struct((-F.col("score")).alias("s"), F.coalesce("distance", F.lit(float("inf"))).alias("d"), F.col(candidate).alias("c"), exact.alias("exact"), F.coalesce(medium, F.lit(False)).alias("medium"))
    g = scored.groupBy(key).agg(F.min(order).alias("top"), F.min(F.when(exact, order)).alias("top_exact"), F.count_if(exact).alias("n"))
    if asked is not None:
        g = asked.select(key, "has_input").join(g, key, "left")
    pick = F.when(F.col("n") == 1, F.col("top_exact")).otherwise(F.col("top"))
    status = F.when(F.col("n") == 1, "AUTO_RESOLVED").when(F.col("n") > 1, "AMBIGUOUS").when(F.col("n").isNotNull(), "REVIEW_REQUIRED")
    confidence = F.when(F.col("n") == 1, "HIGH").when(F.col("n") > 1, "REVIEW").when(F.col("top.medium"), "MEDIUM").when(F.col("n").isNotNull(), "LOW")
    if asked is not None:
        status, confidence = status.otherwise(F.when(F.col("has_input"), "NO_CANDIDATE").otherwise("NO_INPUT")), confidence.otherwise("NONE")
    return g.select(key, pick["c"].alias(candidate), (-pick["s"]).alias("score"), status.alias("status"), confidence.alias("confidence"))
