"""References to records that do not exist.

Parents and distinct references are range-partitioned together on (kind, key); in each range the parents form one
sorted array and the references are probed in batches by binary search. Only misses leave the probe.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.functions.keys import not_blank
from lotline.session import cut, ship


def sortable(keys: pa.Array) -> np.ndarray:
    """Keys as an array that is searched without making Python objects: fixed-width bytes for short ASCII keys, else texts.

    Both sort as the engine sorts, by code point.
    """
    width = pc.max(pc.binary_length(keys)).as_py() or 1
    if width > 64 or not pc.all(pc.string_is_ascii(keys)).as_py() or pc.any(pc.match_substring(keys, "\0")).as_py():
        return keys.to_numpy(zero_copy_only=False)
    padded = pc.ascii_rpad(keys, width, "\0")
    padded = pa.concat_arrays([padded])  # offsets from 0
    return np.frombuffer(padded.buffers()[2], f"S{width}", len(keys)) if len(keys) else np.empty(0, f"S{width}")


def _find(have: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key is in the sorted array."""
    if have.dtype.kind != keys.dtype.kind:
        text = lambda x: x if x.dtype.kind == "O" else np.char.decode(x, "ascii").astype(object)
        have, keys = text(have), text(keys)
    at = np.searchsorted(have, keys)
    found = np.zeros(keys.size, bool)
    inside = at < have.size
    found[inside] = have[at[inside]] == keys[inside]
    return found


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range, parents first: keep the references that the sorted parents lack."""
    parents: dict[str, list[pa.Array]] = {}
    arrays: dict[str, np.ndarray] = {}
    for b in batches:
        names = b.column("kind").dictionary_encode()
        kinds, keys = names.indices.to_numpy(), b.column("key")
        is_ref = b.column("is_ref").to_numpy(zero_copy_only=False).astype(bool)
        miss = np.zeros(len(keys), bool)
        for code, kind in enumerate(names.dictionary.to_pylist()):
            own = kinds == code
            if (p := own & ~is_ref).any():
                parents.setdefault(kind, []).append(keys.filter(pa.array(p)))
                arrays.pop(kind, None)
            if (r := np.flatnonzero(own & is_ref)).size:
                if kind not in arrays:
                    arrays[kind] = sortable(pa.concat_arrays(parents.get(kind) or [pa.array([], pa.string())]))
                miss[r] = ~_find(arrays[kind], sortable(keys.take(pa.array(r))))
        if miss.any():
            yield b.select(["kind", "key"]).filter(pa.array(miss))


def missing_keys(refs: DataFrame, parents: DataFrame) -> DataFrame:
    """Distinct (kind, key) of ``refs`` that ``parents`` does not hold.

    Both have string columns kind and key. NULL in either column: the row is ignored on both sides. Repeated rows
    count once. An empty ``parents`` makes every reference a miss; empty ``refs`` give an empty result.
    """
    side = lambda df, flag: df.select("kind", "key").where("kind is not null and key is not null").distinct().withColumn("is_ref", F.lit(flag))
    ship(refs.sparkSession)
    both = cut(side(parents, 0).unionByName(side(refs, 1)))  # ranges are drawn from it before it is sent
    ranged = both.repartitionByRange("kind", "key").sortWithinPartitions("is_ref", "kind", "key")
    return ranged.mapInArrow(_probe, "kind string, key string")


def orphan_references(facts: dict[str, tuple[DataFrame, str, Column]], fields: dict[str, str], parents: DataFrame) -> DataFrame:
    """Rows (fact_table, event_id, field_name, ref_id, month) whose reference has no parent.

    ``facts`` maps a table name to (frame, event-id column, time column); ``fields`` maps a reference column to the
    kind it refers to in ``parents`` (kind, key). NULL and blank references are no references. Values are compared
    exactly. Misses are found on distinct references and joined back, so a hot reference is probed once; the engine
    broadcasts the misses only when their measured size allows and otherwise splits skewed partitions.
    Extra columns of the facts are ignored; repeated fact rows give one case.
    """
    long = None
    for name, (df, event_id, when) in facts.items():
        ref = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.lit(k).alias("kind"), F.col(f).alias("key")) for f, k in fields.items()]))
        part = df.select(F.lit(name).alias("fact_table"), F.col(event_id).alias("event_id"), F.date_format(when, "yyyy-MM").alias("month"), ref.alias("r")).select("fact_table", "event_id", "month", "r.*").where(not_blank(F.col("key")))
        long = part if long is None else long.unionByName(part)
    miss = missing_keys(long.select("kind", "key"), parents)
    return long.join(miss, ["kind", "key"]).select("fact_table", "event_id", "field_name", F.col("key").alias("ref_id"), "month").distinct()


def orphan_report(orphans: DataFrame, known: DataFrame, current: str) -> DataFrame:
    """Orphans counted by table, field, month and what the register knows of the key.

    ``known`` has key and version, one row for each version that lists the key; ``current`` is the version behind the
    parents. lot_status: known_before, known_later, known_before_and_later, known_now, never_known.
    """
    k = known.groupBy("key").agg(
        F.max((F.col("version") < current).cast("int")).alias("before"),
        F.max((F.col("version") > current).cast("int")).alias("later"),
        F.max((F.col("version") == current).cast("int")).alias("now"),
    )
    status = (
        F.when(F.col("now") == 1, "known_now")
        .when((F.col("before") == 1) & (F.col("later") == 1), "known_before_and_later")
        .when(F.col("before") == 1, "known_before")
        .when(F.col("later") == 1, "known_later")
        .otherwise("never_known")
    )
    counted = orphans.groupBy("fact_table", "field_name", "month", F.col("ref_id").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return counted.join(k, "key", "left").groupBy("fact_table", "field_name", "month", status.alias("lot_status")).agg(F.sum("n").alias("orphans"), F.count(F.lit(1)).alias("distinct_ids"))
