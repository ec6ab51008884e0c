"""The queries of this subpackage over the project's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.functions.keys import lot_number, message_key
from lotline.llm.address import borough_code, read_addresses
from lotline.llm.entities import match_entities
from lotline.llm.linkage import link_addresses, zip_boroughs
from lotline.llm.mixing import mix_sources, planned_shares, sized_documents
from lotline.llm.quality import common_words, judge, text_statistics
from lotline.llm.tokens import count_tokens, decode_ids, encode_documents, vocabulary
from lotline.operators.spatial import near_points
from lotline.session import cut, table

#: Complaints and buildings count as near for the mixture, and as the same for want of anything better, within so many metres.
NEAR_M, SAME_M = 25.0, 6.0
IN_CITY = "latitude between 40 and 41 and longitude between -75 and -73"


def _with_borough(df: DataFrame, zips: DataFrame, named: Column, zipcode: str, line: str, ident: Column, side: str) -> DataFrame:
    """Address rows for the linker; the postcode tells the borough where it is missing."""
    z = F.regexp_extract(zipcode, "^\\s*([0-9]{5})", 1)
    rows = df.select(F.lit(side).alias("side"), ident.alias("id"), named.alias("b"), z.alias("zip"), F.col(line).alias("line")).where("id is not null and line is not null")
    return rows.join(F.broadcast(zips), "zip", "left").select("side", "id", F.coalesce("b", "zip_borough").alias("borough"), "line")


def _line(house: str, street: str) -> Column:
    h = F.trim(F.regexp_replace(house, r"\s+", " "))
    return F.concat_ws(" ", F.when(~F.upper(h).isin("N/A", "NA", "NONE", "UNKNOWN", ""), h), street)


def lot_lines(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(address rows of the lots in any snapshot, boroughs of the postcodes)."""
    lots = table(spark, d, "pluto").select(lot_number(F.col("bbl")).alias("lot"), "borocode", "borough", "zipcode", "address")
    named = F.coalesce(borough_code(F.col("borocode"), F.col("borough")), F.substring("lot", 1, 1))
    zips = cut(zip_boroughs(lots, F.col("zipcode"), named))
    return _with_borough(lots, zips, named, "zipcode", "address", F.col("lot"), "target"), zips


def complaint_lines(spark: SparkSession, d: str, zips: DataFrame, side: str = "record") -> DataFrame:
    return _with_borough(table(spark, d, "nyc_311"), zips, borough_code(F.col("borough")), "incident_zip", "incident_address", F.concat(F.lit("311:"), message_key(F.col("unique_key"))), side)


def violation_lines(spark: SparkSession, d: str, zips: DataFrame) -> DataFrame:
    hpd = table(spark, d, "hpd").withColumn("line", _line("housenumber", "streetname"))
    return _with_borough(hpd, zips, borough_code(F.col("boro"), F.col("boroid")), "zip", "line", F.concat(F.lit("HPD:"), message_key(F.col("violationid"))), "record")


def building_lines(spark: SparkSession, d: str, zips: DataFrame) -> DataFrame:
    """Current and former addresses of the buildings."""
    b = table(spark, d, "building_identity")
    every = F.explode(F.array_distinct(F.concat(F.array("current_address"), F.coalesce("address_aliases", F.array().cast("array<string>")))))
    rows = b.select("bin", "borough", F.lit(None).cast("string").alias("zip"), every.alias("address"))
    return _with_borough(rows, zips, borough_code(F.col("borough")), "zip", "address", F.col("bin"), "target")


def read_all(rows: DataFrame) -> DataFrame:
    return read_addresses(rows, "line", ["side", "id", "borough"]).withColumn("borough", F.coalesce("borough", "named")).drop("named")


def p4_links(spark: SparkSession, d: str) -> DataFrame:
    lots, zips = lot_lines(spark, d)
    rows = lots.unionByName(complaint_lines(spark, d, zips)).unionByName(violation_lines(spark, d, zips))
    return link_addresses(read_all(rows)).select("record_id", F.col("target_id").alias("bbl"), "probability")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_links(spark, d).select("record_id", "bbl")


def p2_matches(spark: SparkSession, d: str) -> DataFrame:
    lots, zips = lot_lines(spark, d)
    # one narrow copy of the complaints, distinct over deliveries, serves all blocks
    calls = cut(
        table(spark, d, "nyc_311")
        .select(
            message_key(F.col("unique_key")).alias("record"), lot_number(F.col("bbl")).alias("lot"), "incident_address", borough_code(F.col("borough")).alias("b"), "incident_zip",
            F.when(F.expr(IN_CITY), F.col("longitude")).alias("x"), F.when(F.expr(IN_CITY), F.col("latitude")).alias("y"),
        )
        .where("record is not null")
        .distinct()
    )
    rows = lots.withColumn("side", F.lit("street")).unionByName(building_lines(spark, d, zips)).unionByName(_with_borough(calls, zips, F.col("b"), "incident_zip", "incident_address", F.col("record"), "record"))
    by_address = link_addresses(read_all(rows)).select(F.col("record_id").alias("record"), F.col("target_id").alias("target"), F.col("probability").alias("similarity"))

    b = table(spark, d, "building_identity")
    lots_of = F.explode(F.array_distinct(F.concat(F.array("current_bbl"), F.coalesce("bbl_aliases", F.array().cast("array<string>")))))
    owned = b.select("bin", lots_of.alias("bbl")).select("bin", lot_number(F.col("bbl")).alias("lot")).where("lot is not null and bin is not null").distinct()
    carried = owned.groupBy("lot").agg(F.min("bin").alias("target"), F.max("bin").alias("other")).where("target = other").select("lot", "target")
    by_key = calls.select("record", "lot").where("lot is not null").join(carried, "lot").select("record", "target")

    points = calls.select("record", "lot", "x", "y").where("x is not null and y is not null").distinct()
    places = b.where(IN_CITY).select(F.col("bin").alias("place"), F.col("longitude").alias("x"), F.col("latitude").alias("y"))
    near = near_points(points, places, NEAR_M).join(b.select(F.col("bin").alias("place"), F.coalesce(lot_number(F.col("current_bbl")), F.lit("")).alias("own")), "place")
    by_place = points.join(near, ["x", "y"]).select("record", F.col("place").alias("target"), "metres", _lot_similarity(F.col("lot"), F.col("own")).alias("similarity"))

    has = calls.select("record", F.coalesce(F.col("incident_address").rlike("[0-9]"), F.lit(False)).alias("has_address"), F.col("lot").isNotNull().alias("has_key"), F.col("x").isNotNull().alias("has_point"))
    return match_entities(by_address, by_key, by_place, has, SAME_M).select(F.col("record").alias("unique_key"), F.col("target").alias("bin"), "method", "confidence")


def _lot_similarity(a: Column, b: Column) -> Column:
    """Lot numbers by their parts: 0.8 for the same lot (others may carry it too), 0.5 for the same block, 0.2 for the same borough."""
    same = lambda n: F.substring(a, 1, n) == F.substring(b, 1, n)
    return F.when(same(10), 0.8).when(same(6), 0.5).when(same(1), 0.2).otherwise(0.0)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return p2_matches(spark, d).where("method <> 'UNCONFIRMED'").select("unique_key", "bin")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode_documents(table(spark, d, "documents"), "doc_id", "text", vocabulary())


def p8_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Every text encoded and decoded again; NULL comes back as the empty text that its ids stand for."""
    return decode_ids(p8_ids(spark, d), "doc_id", "ids", vocabulary())


def _mixed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, d, "documents").select("doc_id", "source", "text")
    return mix_sources(sized_documents(count_tokens(docs, "text", vocabulary())), table(spark, d, "mix_plan"))


def p9_draws(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d)[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d)[1]


def p9_plan(spark: SparkSession, d: str) -> DataFrame:
    """What is wanted of each source, before anything is drawn."""
    return planned_shares(table(spark, d, "mix_plan")).select("mix_name", "source_key", "cap", "size_share", "wanted_share")


def _judged(spark: SparkSession, d: str) -> DataFrame:
    words, han = common_words(table(spark, d, "common_word"))
    return judge(text_statistics(table(spark, d, "documents").select("doc_id", "text"), "text", words, han))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return _judged(spark, d).where(F.col("kind").isin("list", "table", "junk")).select("doc_id")


def p10_statistics(spark: SparkSession, d: str) -> DataFrame:
    return _judged(spark, d).select(
        "doc_id", "kind", F.array_join("reasons", ",").alias("reasons"), F.array_join("published_failures", ",").alias("published_failures"), "n_words", "n_lines", "mean_word_length", "symbol_share", "ended_line_share", "bullet_line_share", "common_share"
    )


def p10_counts(spark: SparkSession, d: str) -> DataFrame:
    """The plain counts of each text, for comparison with SQL."""
    words, han = common_words(table(spark, d, "common_word"))
    return text_statistics(table(spark, d, "documents").select("doc_id", "text"), "text", words, han).select("doc_id", "n_lines", "n_tokens_ws", "longest_token", "hans")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p2_found, p2_matches, p4_found, p4_links, p8_ids, p8_roundtrip, p9_draws, p9_shares, p9_plan, p10_found, p10_statistics, p10_counts)}


_WS = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_KEY = r"nullif(regexp_replace(lower(regexp_replace(source, '^\s+|\s+$', '', 'g')), '[-\s]+', '_', 'g'), '')"


def oracle_sql() -> dict[str, str]:
    """What SQL can say of these: the plan of a mix, the round trip of the encoding, the plain counts of texts."""
    return {
        "p8_roundtrip": "select doc_id, coalesce(text, '') as text from documents",
        "p9_plan": rf"""with p as (select mix_name, {_KEY} as source_key, sum(greatest(coalesce(weight, 0), 0)) as w, max(greatest(coalesce(max_repeats, 0), 0)) as cap, max(coalesce(size_share, 0)) as size_share from mix_plan where mix_name is not null group by 1, 2)
          select mix_name, source_key, cap, size_share, case when sum(w) over (partition by mix_name) > 0 then w / sum(w) over (partition by mix_name) else 0 end as wanted_share from p where source_key is not null""",
        "p10_counts": rf"""with t as (select doc_id, regexp_replace(regexp_replace(coalesce(text, ''), '\r\n', chr(10), 'g'), '[\r\x{{2028}}]', chr(10), 'g') as t from documents),
          w as (select doc_id, t, regexp_extract_all(t, '[^{_WS}]+') as w from t)
          select doc_id, len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{_WS}]'))) as n_lines, len(w) as n_tokens_ws, coalesce(list_max(list_transform(w, lambda x: length(x))), 0) as longest_token, length(regexp_replace(t, '[^\x{{3400}}-\x{{9fff}}]', '', 'g')) as hans from w""",
    }
