"""Quality gates: many expectations, one aggregate; and profiles of sources and keys."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.functions.keys import not_blank


@dataclass(frozen=True)
class Expectation:
    """``measure`` is an aggregate that must lie in [least, most]; a warning is reported, an error blocks."""

    name: str
    measure: Column
    least: float = 0.0
    most: float = 0.0
    blocking: bool = True


class GateError(RuntimeError):
    pass


def missing(c: str) -> Expectation:
    return Expectation(f"missing_{c}", F.count_if(~F.coalesce(not_blank(F.col(c).cast("string")), F.lit(False))))


def duplicates(c: str) -> Expectation:
    return Expectation(f"duplicate_{c}", F.count(F.col(c)) - F.count_distinct(F.col(c)))


def not_empty() -> Expectation:
    return Expectation("rows", F.count(F.lit(1)), 1, float("inf"))


def not_in(c: str, values: list[str]) -> Expectation:
    """Values outside the list; NULL counts as outside."""
    return Expectation(f"invalid_{c}", F.count_if(~F.coalesce(F.col(c).isin(values), F.lit(False))))


def outside(c: str, low: float, high: float) -> Expectation:
    return Expectation(f"outside_{c}", F.count_if(~F.coalesce(F.col(c).between(low, high), F.lit(False))))


def evaluate(df: DataFrame, expectations: list[Expectation]) -> DataFrame:
    """(name, value, ok, blocking), one row an expectation, from one pass over ``df``."""
    row = df.agg(*[e.measure.cast("double").alias(f"m{i}") for i, e in enumerate(expectations)])
    out = F.array(*[F.struct(F.lit(e.name).alias("name"), F.col(f"m{i}").alias("value"), F.col(f"m{i}").between(e.least, e.most).alias("ok"), F.lit(e.blocking).alias("blocking")) for i, e in enumerate(expectations)])
    return row.select(F.explode(out).alias("x")).select("x.*")


def check(df: DataFrame, expectations: list[Expectation], what: str = "table") -> DataFrame:
    """Raise on any blocking expectation that fails; else return ``df`` itself."""
    pass_gate(evaluate(df, expectations), what)
    return df


@dataclass(frozen=True)
class Measure:
    """A named number (a scalar of one frame) with the bounds it must keep; bounds may be scalars of other frames."""

    name: str
    value: Column
    least: Column | float = 0.0
    most: Column | float = 0.0
    blocking: bool = True


def gate(spark: SparkSession, measures: list[Measure]) -> DataFrame:
    """(name, value, ok, blocking), one row a measure, over any number of frames in one query; NULL is not ok."""
    as_double = lambda x: F.lit(float(x)) if isinstance(x, (int, float)) else x.cast("double")
    row = spark.range(1).select(*[c.alias(n) for i, m in enumerate(measures) for n, c in ((f"v{i}", as_double(m.value)), (f"l{i}", as_double(m.least)), (f"m{i}", as_double(m.most)))])
    out = F.array(*[F.struct(F.lit(m.name).alias("name"), F.col(f"v{i}").alias("value"), F.coalesce(F.col(f"v{i}").between(F.col(f"l{i}"), F.col(f"m{i}")), F.lit(False)).alias("ok"), F.lit(m.blocking).alias("blocking")) for i, m in enumerate(measures)])
    return row.select(F.explode(out).alias("x")).select("x.*")


def pass_gate(result: DataFrame, what: str = "gate") -> None:
    """Raise if a blocking measure of ``gate`` or expectation of ``evaluate`` failed."""
    bad = result.where("blocking and not ok").collect()
    if bad:
        raise GateError(f"{what}: " + ", ".join(f"{r.name}={r.value:g}" if r.value is not None else f"{r.name} unknown" for r in bad))


def rows_of(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


def stat(df: DataFrame, measure: Column) -> Column:
    """One aggregate of ``df`` as a scalar."""
    return df.agg(measure).scalar()


def orphan_keys(df: DataFrame, key: str, dim: DataFrame) -> Column:
    """Distinct non-NULL keys that ``dim`` lacks; made distinct before they meet, so a hot key is one row a task."""
    return rows_of(df.where(F.col(key).isNotNull()).select(key).distinct().join(dim.select(key).distinct(), key, "left_anti"))


def key_measures(df: DataFrame, key: str, what: str) -> list[Measure]:
    """No NULL and no repeated key."""
    return [Measure(f"{what}_null_{key}", stat(df, F.count_if(F.col(key).isNull()))), Measure(f"{what}_repeated_{key}", stat(df, F.count(key) - F.count_distinct(key)))]


def snapshot_gate(snapshot: DataFrame, key: str) -> DataFrame:
    """A snapshot has rows, no missing keys and no repeated ones (they are never dropped in silence)."""
    return evaluate(snapshot, [not_empty(), missing(key), duplicates(key)])


def star_gate(properties: DataFrame, buildings: DataFrame, bridge: DataFrame, identity: DataFrame) -> DataFrame:
    """The ten rules of a star schema: keys unique, counts that agree, one relation a building, no references to nothing."""
    rows = rows_of(bridge)
    with_parent = stat(buildings, F.count("property_id"))
    spark = bridge.sparkSession
    return gate(
        spark,
        [
            Measure("property_repeated_id", stat(properties, F.count(F.lit(1)) - F.count_distinct("property_id"))),
            Measure("property_repeated_bbl", stat(properties, F.count(F.lit(1)) - F.count_distinct("bbl"))),
            Measure("building_repeated_id", stat(buildings, F.count(F.lit(1)) - F.count_distinct("building_id"))),
            Measure("building_rows", rows_of(buildings), rows_of(identity), rows_of(identity)),
            Measure("bridge_repeated_pairs", rows - rows_of(bridge.select("property_id", "building_id").distinct())),
            Measure("bridge_rows", rows, with_parent, with_parent),
            Measure("bridge_buildings", stat(bridge, F.count_distinct("building_id")), rows, rows),
            Measure("building_property_orphans", orphan_keys(buildings, "property_id", properties)),
            Measure("bridge_property_orphans", orphan_keys(bridge, "property_id", properties)),
            Measure("bridge_building_orphans", orphan_keys(bridge, "building_id", buildings)),
        ],
    )


def fact_gate(source: DataFrame, source_key: str, fact: DataFrame, fact_key: str, properties: DataFrame, buildings: DataFrame, resolved: str | None = None) -> DataFrame:
    """A fact has its source's rows, unique keys on both sides and no references to nothing.

    With ``resolved`` every row that names a building there must have one.
    """
    n = rows_of(source)
    found = [Measure("resolved_without_building", stat(fact, F.count_if(F.col(resolved).isNotNull() & F.col("building_id").isNull())))] if resolved else []
    return gate(
        fact.sparkSession,
        [
            Measure("source_rows", n, 1, float("inf")),
            *key_measures(source, source_key, "source"),
            Measure("fact_rows", rows_of(fact), n, n),
            *key_measures(fact, fact_key, "fact"),
            Measure("building_orphans", orphan_keys(fact, "building_id", buildings)),
            Measure("property_orphans", orphan_keys(fact, "property_id", properties)),
            *found,
        ],
    )


def entity_gate(dim: DataFrame, out: DataFrame, key: str, expectations: list[Expectation]) -> DataFrame:
    """One row of ``out`` for each row of ``dim``, and what ``expectations`` ask of ``out``."""
    n = rows_of(dim)
    counted = gate(out.sparkSession, [Measure("dim_rows", n, 1, float("inf")), *key_measures(dim, key, "dim"), Measure("rows", rows_of(out), n, n), *key_measures(out, key, "out")])
    return counted.unionByName(evaluate(out, expectations)) if expectations else counted


def when_wrong(name: str, condition: Column) -> Expectation:
    """No row may meet the condition; a condition that is NULL counts as met."""
    return Expectation(name, F.count_if(F.coalesce(condition, F.lit(True))))


def any_of(conditions: list[Column]) -> Column:
    return reduce(or_, conditions)


def single_value(df: DataFrame, column: str) -> DataFrame:
    """A table has exactly one non-NULL value of the column and no NULL."""
    return evaluate(df, [Expectation(f"values_of_{column}", F.count_distinct(column), 1, 1), Expectation(f"null_{column}", F.count_if(F.col(column).isNull()))])


def reconcile(spark: SparkSession, processed: Column | int, expected: Column | int, there: Column | int) -> DataFrame:
    """Documents sent, rows there were and what the sink counts must be one number."""
    as_column = lambda x: F.lit(x) if isinstance(x, int) else x
    return gate(spark, [Measure("processed", as_column(processed), as_column(expected), as_column(expected)), Measure("in_sink", as_column(there), as_column(expected), as_column(expected))])


def key_agreement(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: how often two keys of a row are both there, agree, differ, or only one is there."""
    x, y = F.col(a), F.col(b)
    return df.agg(
        F.count_if(x.isNotNull() & y.isNotNull()).alias("both"),
        F.count_if(x == y).alias("same"),
        F.count_if(x != y).alias("different"),
        F.count_if(x.isNotNull() & y.isNull()).alias("only_first"),
        F.count_if(x.isNull() & y.isNotNull()).alias("only_second"),
        F.count_if(x.isNull() & y.isNull()).alias("neither"),
    )


def source_profile(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """One row: rows, missing or blank, malformed, with a decimal tail, repeated."""
    c = F.col(column)
    t = F.trim(c)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(c.isNull() | (t == "")).alias("missing"),
        F.count_if((t != "") & ~t.rlike(pattern)).alias("malformed"),
        F.count_if(t.rlike(r"\.0+$")).alias("decimal_tail"),
        (F.count(c) - F.count_distinct(c)).alias("repeated"),
    )
