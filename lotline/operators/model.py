"""Canonical entities, star schema, event features and capped, weighted scores; all parameters are data."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotline.functions.keys import not_blank
from lotline.functions.numbers import linear_score, log_score, round_half_up
from lotline.operators.resolve import lookup_join
from lotline.session import cut


def canonicalize(obs: DataFrame, key: str, values: list[str], when: str, source: str, aliases: dict[str, tuple[str, str]], settled: str = "STABLE") -> DataFrame:
    """One row a key: the latest observation, sorted alias sets, their sizes and a status.

    Observations that differ only in time are collapsed first. Latest is by time (NULL last), then source, then the values
    (NULL last). ``aliases`` maps a value to its alias column and the status of keys with more than one of it; the first
    that holds counts, else ``settled``. Sets leave NULLs out. Rows with NULL or blank keys are left out.
    """
    cols = [key, *values, source]
    seen = obs.where(not_blank(F.col(key))).groupBy(*cols).agg(F.max(when).alias(when))
    w = Window.partitionBy(key).orderBy(F.col(when).desc_nulls_last(), F.col(source).asc_nulls_last(), *[F.col(v).asc_nulls_last() for v in values])
    latest = seen.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    aggs = [F.array_sort(F.collect_set(c)).alias(name) for c, (name, _) in aliases.items()]
    history = seen.groupBy(key).agg(*aggs, F.array_sort(F.collect_set(source)).alias("sources"))
    status = F.lit(settled)
    for name, label in reversed(list(aliases.values())):
        status = F.when(F.size(name) > 1, label).otherwise(status)
    counts = {f"{c}_count": F.size(name).cast("bigint") for c, (name, _) in aliases.items()}
    return latest.join(history, key).withColumns({**counts, "identity_status": status})


def build_dim(df: DataFrame, prefix: str, key: str, columns: list[str], id_name: str) -> DataFrame:
    """Dimension rows: a prefixed id and the given columns, one for each non-blank key (the greatest row of repeated ones)."""
    rest = [c for c in columns if c != key]
    g = df.where(not_blank(F.col(key))).groupBy(key).agg(F.max(F.struct(*rest)).alias("_r")) if rest else df.where(not_blank(F.col(key))).select(key).distinct()
    return g.select(F.concat(F.lit(f"{prefix}:"), F.col(key)).alias(id_name), key, *([f"_r.{c}" for c in rest]))


def arbitrate(entity_parent: Column, source_parent: Column, entity: Column) -> tuple[Column, Column, Column]:
    """(parent, method, conflict flag): the entity's parent wins; the event's own counts only if no entity was found."""
    parent = F.when(entity_parent.isNotNull(), entity_parent).when(entity.isNull(), source_parent)
    method = F.when(entity_parent.isNotNull(), "BUILDING_CANONICAL").when(entity.isNull() & source_parent.isNotNull(), "SOURCE_BBL").otherwise("UNRESOLVED")
    conflict = F.when(entity_parent.isNotNull() & source_parent.isNotNull() & (entity_parent != source_parent), 1).otherwise(0)
    return parent, method, conflict


def build_fact(events: DataFrame, event_id: str, prefix: str, key: str, building: str, lot: str, buildings: DataFrame, properties: DataFrame) -> DataFrame:
    """Fact rows: a prefixed id, the building and lot of each event, and which of both decided.

    ``events`` has ``key`` (unique), ``building`` (a bin) and ``lot`` (a lot number); ``buildings`` has bin, building_id,
    property_id, ``properties`` bbl and property_id, one row a key. Every event keeps its row; NULL keys of buildings and
    lots match nothing. Columns of ``events`` stay as they are.
    """
    x = lookup_join(events.withColumn("_bin", F.trim(building)), key, ["_bin"], buildings.withColumn("_bin", F.trim("bin")), {"building_id": "building_id", "property_id": "building_property_id"}).drop("_bin")
    x = lookup_join(x, key, [lot], properties.withColumn(lot, F.col("bbl")), {"property_id": "source_property_id"})
    parent, method, conflict = arbitrate(F.col("building_property_id"), F.col("source_property_id"), F.col("building_id"))
    return x.withColumns(
        {
            event_id: F.concat(F.lit(f"{prefix}:"), F.col(key)),
            "property_id": parent,
            "property_resolution_method": method,
            "property_conflict_flag": conflict,
            "building_resolution_status": F.when(F.col("building_id").isNotNull(), "RESOLVED").otherwise("UNRESOLVED"),
        }
    )


def as_of_date(sources: list[tuple[DataFrame, str]]) -> DataFrame:
    """One row: the least of the sources' latest dates (the last day every source covers)."""
    latest = None
    for df, c in sources:
        one = df.agg(F.max(F.to_date(c)).alias("d"))
        latest = one if latest is None else latest.unionByName(one)
    return latest.agg(F.min("d").alias("as_of"))


@dataclass(frozen=True)
class Buckets:
    """Disjoint ages in days, both ends included."""

    edges: tuple[tuple[str, int, int], ...] = (("d0_30", 0, 30), ("d31_90", 31, 90), ("d91_365", 91, 365))


def event_features(df: DataFrame, entity: str, when: str, as_of: DataFrame, buckets: Buckets = Buckets(), flags: dict[str, Column] | None = None) -> DataFrame:
    """Per entity: events in each bucket of age at the as-of date and, without limit of age, events with each flag.

    ``as_of`` is one row; it becomes a scalar subquery. Events after the as-of date, with NULL entity or NULL time are left
    out. One pass with map-side counts; a busy entity is one row a partition in the shuffle.
    """
    base = df.withColumn("_age", F.datediff(as_of.select("as_of").scalar(), F.to_date(when)))
    base = base.where((F.col("_age") >= 0) & F.col(entity).isNotNull())
    aggs = [F.count_if(F.col("_age").between(lo, hi)).alias(name) for name, lo, hi in buckets.edges]
    aggs += [F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in (flags or {}).items()]
    return base.groupBy(entity).agg(*aggs)


@dataclass(frozen=True)
class Component:
    """A raw signal (weighted sum of feature columns) scored up to a cap."""

    name: str
    raw: dict[str, float]
    cap: float
    weight: float
    scale: str = "log"
    missing: float | None = None

    def signal(self) -> Column:
        return sum((F.col(c) * w for c, w in self.raw.items()), F.lit(0.0))

    def score(self) -> Column:
        s = log_score(self.signal(), self.cap) if self.scale == "log" else linear_score(self.signal(), self.cap)
        return s if self.missing is None else F.coalesce(s, F.lit(float(self.missing)))


@dataclass(frozen=True)
class ScoreModel:
    """Caps, weights and levels as data."""

    components: tuple[Component, ...]
    levels: tuple[tuple[str, float], ...] = field(default=())
    lowest: str = "LOW"

    def apply(self, features: DataFrame) -> DataFrame:
        """``features`` plus score_<name> for each component, score and level."""
        with_parts = features.withColumns({f"score_{c.name}": c.score() for c in self.components})
        total = sum((F.col(f"score_{c.name}") * c.weight for c in self.components), F.lit(0.0))
        scored = with_parts.withColumn("score", round_half_up(total))
        return scored.withColumn("level", self.level(F.col("score")))

    def level(self, score: Column) -> Column:
        """The first level whose threshold the score reaches; NO_DATA for NULL."""
        out = F.when(score.isNull(), "NO_DATA")
        for name, least in self.levels:
            out = out.when(score >= least, name)
        return out.otherwise(self.lowest)


def rollup(df: DataFrame, parent: str, score: str) -> DataFrame:
    """Children per parent: how many, greatest and mean score."""
    return df.where(F.col(parent).isNotNull()).groupBy(parent).agg(F.count(F.lit(1)).alias("children"), F.max(score).alias("max_score"), round_half_up(F.avg(score), 4).alias("avg_score"))


def calibrate(df: DataFrame, column: str, probs: list[float], error: float | None = None) -> DataFrame:
    """(p, value): quantiles of the positive values; none positive gives NULLs.

    Exact ones are the least value that at least the share p does not exceed: values are counted, sorted by range over all
    tasks, and ranks come from counts before each range, so no task holds all values. With ``error`` they are approximate
    to that share of the rows, in one pass.
    """
    x = df.where(F.col(column) > 0).select(F.col(column).alias("v"))
    pairs = lambda row: row.select(F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.col(f"q{i}").alias("value")) for i, p in enumerate(probs)])).alias("x")).select("x.*")
    if error:
        return pairs(x.agg(*[F.percentile_approx("v", p, round(1 / error)).alias(f"q{i}") for i, p in enumerate(probs)]))
    ranged = cut(x.groupBy("v").agg(F.count(F.lit(1)).alias("n")).repartitionByRange("v").withColumn("part", F.spark_partition_id()))
    ahead = ranged.groupBy("part").agg(F.sum("n").alias("total")).withColumn("before", F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = F.sum("n").over(Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = ranged.withColumn("upto", inside).join(ahead.select("part", "before"), "part").withColumn("rank", F.col("before") + F.col("upto"))
    total = ranged.agg(F.sum("n")).scalar()
    return pairs(ranked.agg(*[F.min(F.when(F.col("rank") >= F.ceil(total * p), F.col("v"))).alias(f"q{i}") for i, p in enumerate(probs)]))
