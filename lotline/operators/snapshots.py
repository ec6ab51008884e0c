"""What changed between full snapshots, by signed cells."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def versions_in_order(df: DataFrame, version: str) -> list[str]:
    """The names of all snapshots in the data, numbers in them compared as numbers; one name a delivered snapshot."""
    names = [r[0] for r in df.where(F.col(version).isNotNull()).select(version).distinct().collect()]
    parts = lambda v: [(int(x), "") if x.isdigit() else (-1, x) for x in re.findall(r"[0-9]+|[^0-9]+", v)]
    return sorted(names, key=lambda v: (parts(v), v))


def snapshot_changes(df: DataFrame, key: Column, version: Column, order: list[str], fields: dict[str, Column]) -> DataFrame:
    """(key, version_from, version_to, change_kind, changed_fields) between consecutive versions.

    Each snapshot row becomes one cell for each field, plus a key-presence cell. A cell counts +1 for the step that
    ends in its version and -1 for the step that starts there; cells whose sum is zero vanish. A nonzero presence
    cell means added or removed, any other nonzero cell changed. Cells are first made distinct within a version, so
    rows repeated within a snapshot do no harm; rows of one key that differ form a set of values.
    NULL field values are values of their own; rows with NULL key or a version outside ``order`` are left out.
    A key that vanishes and comes back is removed, then added. Extra columns are ignored.
    """
    if len(order) < 2:
        order = [*order, *order][:2] if order else ["", ""]
    pos = F.array_position(F.array(*map(F.lit, order)), version)
    named = F.array(
        F.struct(F.lit("").alias("field"), F.lit("").alias("value")),
        *[F.struct(F.lit(f).alias("field"), F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("~")).alias("value")) for f, c in fields.items()],
    )
    cells = df.select(key.alias("key"), pos.cast("int").alias("pos"), F.explode(named).alias("c")).where("key is not null and pos > 0").select("key", "pos", "c.field", "c.value").distinct()
    last = len(order)
    steps = F.filter(
        F.array(F.struct((F.col("pos") - 1).alias("step"), F.lit(1).alias("sign")), F.struct(F.col("pos").alias("step"), F.lit(-1).alias("sign"))),
        lambda s: (s.step >= 1) & (s.step < last),
    )
    left = (
        cells.select("key", "field", "value", F.explode(steps).alias("s"))
        .groupBy("key", F.col("s.step").alias("step"), "field", "value")
        .agg(F.sum("s.sign").alias("n"))
        .where("n <> 0")
    )
    presence = F.max(F.when(F.col("field") == "", F.col("n")))
    names = F.array(*map(F.lit, order))
    return (
        left.groupBy("key", "step")
        .agg(presence.alias("there"), F.array_sort(F.collect_set(F.when(F.col("field") != "", F.col("field")))).alias("changed"))
        .select(
            "key",
            F.element_at(names, F.col("step")).alias("version_from"),
            F.element_at(names, F.col("step") + 1).alias("version_to"),
            F.when(F.col("there") > 0, "added").when(F.col("there") < 0, "removed").otherwise("changed").alias("change_kind"),
            F.when(F.col("there").isNull(), F.array_join("changed", ",")).otherwise("").alias("changed_fields"),
        )
    )
