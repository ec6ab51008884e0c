"""Serving documents, bridges, lookups and coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DateType, DecimalType, DoubleType, FloatType, MapType, StructType, TimestampNTZType, TimestampType

from lotline.functions.text import blank_to_null


def build_bridge(resolved: DataFrame, child: str = "bin", parent: str = "bbl") -> DataFrame:
    """One row for each resolved child: ids with prefixes, raw keys and the kind of relation."""
    return resolved.where(F.col(parent).isNotNull()).select(F.concat(F.lit("PROP:"), F.col(parent)).alias("property_id"), F.concat(F.lit("BLD:"), F.col(child)).alias("building_id"), parent, child, F.lit("CANONICAL").alias("relationship_type"))


def serving(df: DataFrame, entity_type: str, address: str, lat: str = "latitude", lon: str = "longitude", stamp: bool = False) -> DataFrame:
    """``df`` as documents: entity type, search address (trimmed, upper case; blank is NULL) and location
    (NULL unless both coordinates are known); with ``stamp`` also the time of processing."""
    both = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    out = df.withColumns({"entity_type": F.lit(entity_type), "search_address": F.upper(F.trim(blank_to_null(F.col(address)))), "location": F.when(both, F.struct(F.col(lat).alias("lat"), F.col(lon).alias("lon")))})
    return out.withColumn("serving_calculated_at", F.current_timestamp()) if stamp else out


def lookup_key(c: Column) -> Column:
    return F.upper(F.trim(F.regexp_replace(c, r"\s+", " ")))


def lookup(queries: DataFrame, buildings: DataFrame, properties: DataFrame) -> DataFrame:
    """(query, id, entity_type) for distinct queries that equal an address: buildings (id, address) first, then properties.

    Compared in upper case with single spaces; of several ids the least. NULL queries and addresses match nothing.
    """
    side = lambda df, k: df.where("address is not null").select(lookup_key(F.col("address")).alias("k"), F.struct(F.lit(k).alias("rank"), F.col("id")).alias("hit"))
    best = side(buildings, 1).unionByName(side(properties, 2)).groupBy("k").agg(F.min("hit").alias("hit"))
    q = queries.where("query is not null").select("query").distinct().withColumn("k", lookup_key(F.col("query")))
    return q.join(best, "k").select("query", F.col("hit.id").alias("id"), F.when(F.col("hit.rank") == 1, "BUILDING").otherwise("PROPERTY").alias("entity_type"))


def coverage(df: DataFrame, key: str, known: DataFrame, known_key: str, label: str) -> DataFrame:
    """One row: how many rows there are and how many have a known key; counted by key before the join."""
    per = df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    flags = known.select(F.col(known_key).alias("k"), F.lit(1).alias("there")).distinct()
    return per.join(flags, "k", "left").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.when(F.col("there") == 1, F.col("n"))), F.lit(0)).alias("covered")).select(F.lit(label).alias("source"), "n", "covered")


def json_safe(c: Column, kind: DataType) -> Column:
    """``c`` as JSON can hold it, at any depth: NaN and infinite numbers NULL, decimals doubles, dates and times ISO texts."""
    if isinstance(kind, (DoubleType, FloatType)):
        return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)
    if isinstance(kind, DecimalType):
        return c.cast("double")
    if isinstance(kind, DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS")
    if isinstance(kind, ArrayType):
        return F.transform(c, lambda x: json_safe(x, kind.elementType))
    if isinstance(kind, MapType):
        return F.transform_values(c, lambda _, v: json_safe(v, kind.valueType))
    if isinstance(kind, StructType):
        return F.when(c.isNotNull(), F.struct(*[json_safe(c.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]))
    return c


def documents_json(df: DataFrame) -> DataFrame:
    """One JSON text a row, NULL fields kept, values made safe by ``json_safe``."""
    clean = [json_safe(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields]
    return df.select(F.to_json(F.struct(*clean), {"ignoreNullFields": "false"}).alias("document"))
