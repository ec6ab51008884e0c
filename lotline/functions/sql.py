"""The normalisers as SQL functions and the tables as views, for sessions that speak SQL."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

from lotline.functions.text import ADDRESS_WORDS, BOROUGH_ABBREVIATIONS, BOROUGH_NAMES
from lotline.session import table

_WHENS = " ".join(f"WHEN upper(trim(x)) IN ('{k}', '{BOROUGH_ABBREVIATIONS[k]}') THEN '{v}'" for k, v in BOROUGH_NAMES.items())
_LIGHT = r"trim(regexp_replace(regexp_replace(upper(x), '[^A-Z0-9 ]', ' '), '\\s+', ' '))"
_FULL = _LIGHT
for _a, _b in ADDRESS_WORDS.items():
    _FULL = rf"regexp_replace({_FULL}, '\\b{_a}\\b', '{_b}')"
_NUMBER = r"regexp_replace(btrim(x, ' \t\n\r'), '\\.0*$', '')"

FUNCTIONS = {
    "message_key(x STRING) RETURNS STRING": rf"CASE WHEN {_NUMBER} RLIKE '^[0-9]+$' THEN coalesce(nullif(ltrim('0', {_NUMBER}), ''), '0') ELSE nullif(btrim(x, ' \t\n\r'), '') END",
    "borough_name(x STRING) RETURNS STRING": f"CASE {_WHENS} ELSE upper(trim(x)) END",
    "address_light(x STRING) RETURNS STRING": _LIGHT,
    "address_full(x STRING) RETURNS STRING": _FULL,
    "haversine_m(a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE) RETURNS DOUBLE": "CASE WHEN a + b + c + d IS NOT NULL THEN 2 * 6371000D * asin(sqrt(least(1D, pow(sin(radians(c - a) / 2), 2) + cos(radians(a)) * cos(radians(c)) * pow(sin(radians(d - b) / 2), 2)))) END",
    "log_score(x DOUBLE, cap DOUBLE) RETURNS DOUBLE": "CASE WHEN x IS NOT NULL THEN log1p(least(x, cap)) / log1p(cap) * 100 END",
}


def register_functions(spark: SparkSession) -> list[str]:
    """Make the functions known to the session; returns their names."""
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [h.split("(")[0] for h in FUNCTIONS]


def register_views(spark: SparkSession, folder: str) -> list[str]:
    """A temporary view for every parquet table of a local folder; returns their names."""
    names = sorted(p.stem for p in Path(folder).glob("*.parquet"))
    for n in names:
        table(spark, folder, n).createOrReplaceTempView(n)
    return names
