"""The queries of the general data-processing operators over the project's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.functions.keys import lot_number, message_key, not_blank
from lotline.operators.once import deliver_once, repeated_messages
from lotline.operators.orphans import orphan_references, orphan_report
from lotline.operators.snapshots import snapshot_changes, versions_in_order
from lotline.operators.spatial import containing_regions, near_points
from lotline.operators.trailing import correct_nodes, daily_counts, totals_of_nodes, trailing_totals, tree_nodes
from lotline.session import cut, table

NEAR_M = 25.0
LAT, LON = (40.0, 41.0), (-75.0, -73.0)


def in_city(df: DataFrame) -> DataFrame:
    return df.where(F.col("latitude").between(*LAT) & F.col("longitude").between(*LON))


def _near(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    calls = in_city(table(spark, d, "nyc_311")).select(message_key(F.col("unique_key")).alias("unique_key"), F.col("longitude").alias("x"), F.col("latitude").alias("y")).where("unique_key is not null").distinct()
    places = in_city(table(spark, d, "building_identity")).select(F.col("bin").alias("place"), F.col("longitude").alias("x"), F.col("latitude").alias("y"))
    return calls, near_points(calls, places, NEAR_M)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    calls, near = _near(spark, d)
    return calls.join(near, ["x", "y"]).select("unique_key", F.col("place").alias("bin")).distinct()


def p1_near_counts(spark: SparkSession, d: str) -> DataFrame:
    """Complaint points near each building, by distance band."""
    calls, near = _near(spark, d)
    weight = calls.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
    band = F.when(F.col("metres") <= 5, "0-5").when(F.col("metres") <= 10, "5-10").otherwise("10-25")
    return near.join(weight, ["x", "y"]).groupBy(F.col("place").alias("bin"), band.alias("band")).agg(F.sum("n").alias("complaints"))


def blocks_of_lots(lots: DataFrame) -> DataFrame:
    """(region, ring, holes): the frame of each block of lots, an L-shaped ring around its points with the yard cut out.

    The ring leaves the north-eastern quarter of the block's box to the neighbours; the hole lies in the south-western one.
    """
    at = lambda x, y: F.struct(F.expr(x).alias("x"), F.expr(y).alias("y"))
    key = lot_number(F.col("bbl"))
    box = in_city(lots).select(F.substring(key, 1, 6).alias("region"), F.col("longitude").alias("x"), F.col("latitude").alias("y")).where("region is not null")
    box = box.groupBy("region").agg(F.min("x").alias("x0"), F.max("x").alias("x4"), F.min("y").alias("y0"), F.max("y").alias("y4")).where("x0 < x4 and y0 < y4")
    box = box.selectExpr("*", "(x0 + x4) / 2 as x2", "(y0 + y4) / 2 as y2").selectExpr("*", "x0 + (x2 - x0) * 0.25 as x1", "x0 + (x2 - x0) * 0.75 as x3", "y0 + (y2 - y0) * 0.25 as y1", "y0 + (y2 - y0) * 0.75 as y3")
    ring = F.array(at("x0", "y0"), at("x4", "y0"), at("x4", "y2"), at("x2", "y2"), at("x2", "y4"), at("x0", "y4"))
    hole = F.array(at("x1", "y1"), at("x1", "y3"), at("x3", "y3"), at("x3", "y1"))
    return box.select("region", ring.alias("ring"), F.array(hole).alias("holes"))


def p1_regions(spark: SparkSession, d: str) -> DataFrame:
    """The block of lots whose frame contains each complaint's point; of several the first."""
    calls = in_city(table(spark, d, "nyc_311")).select(message_key(F.col("unique_key")).alias("unique_key"), F.col("longitude").alias("x"), F.col("latitude").alias("y")).where("unique_key is not null").distinct()
    inside = containing_regions(calls, blocks_of_lots(table(spark, d, "pluto")))
    return calls.join(inside, ["x", "y"]).select("unique_key", "region").distinct()


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    props = table(spark, d, "dim_property").select(F.lit("property").alias("kind"), F.col("property_id").alias("key"))
    blds = table(spark, d, "building_identity").select(F.lit("building").alias("kind"), F.concat(F.lit("BLD:"), F.col("bin")).alias("key"))
    facts = {
        "fact_311_event": (table(spark, d, "fact_311_event"), "event_id", F.col("created_date")),
        "fact_hpd_violation": (table(spark, d, "fact_hpd_violation"), "hpd_event_id", F.col("inspectiondate")),
    }
    return orphan_references(facts, {"property_id": "property", "building_id": "building"}, props.unionByName(blds))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select("fact_table", "event_id", "field_name")


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "pluto").select(F.concat(F.lit("PROP:"), lot_number(F.col("bbl"))).alias("key"), "version").distinct()
    current = table(spark, d, "dim_property").agg(F.max("snapshot_version")).first()[0]
    return orphan_report(_orphans(spark, d), known, current)


FACTS = {"fact_311_event": "created_date", "fact_hpd_violation": "inspectiondate", "fact_dob_violation": "violation_issue_date"}


def p5_corrected(spark: SparkSession, d: str) -> DataFrame:
    """As p5_trailing, but from stored trees: those of the complaints, corrected by the violations as by late events."""
    daily = {f: cut(daily_counts([(table(spark, d, f), "building_id", F.col(c))], blank=True)) for f, c in FACTS.items()}
    until = max((x for df in daily.values() if (x := df.agg(F.max("day")).first()[0]) is not None), default=None)
    known = {f: df.where(not_blank(F.col("entity"))) for f, df in daily.items()}
    nodes = cut(correct_nodes(tree_nodes(known["fact_311_event"]), known["fact_hpd_violation"].unionByName(known["fact_dob_violation"])))
    return totals_of_nodes(nodes, (7, 30), until=until).select(F.col("entity").alias("building_id"), _day().alias("on_day"), "total_7", "total_30", "avg_7", "avg_30")


def _trailing(spark: SparkSession, d: str, keep=None) -> DataFrame:
    events = [(table(spark, d, f), "building_id", F.col(c)) for f, c in FACTS.items()]
    every = cut(daily_counts(events, blank=True))  # the facts are read once; the last day may be that of an event without a building
    until = every.agg(F.max("day")).first()[0]
    return trailing_totals(every.where(not_blank(F.col("entity"))), (7, 30), keep, until=until)


def _day(c: str = "day"):
    return F.date_format(F.date_from_unix_date(F.col(c)), "yyyy-MM-dd")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    burst = lambda t: (t[7] >= 4) & (t[30] <= 20) & (15 * t[7] >= 7 * t[30])  # noqa: E731  7-day mean at least twice the 30-day mean
    return _trailing(spark, d, burst).select(F.col("entity").alias("building_id"), _day().alias("on_day"))


def p5_trailing(spark: SparkSession, d: str) -> DataFrame:
    return _trailing(spark, d).select(F.col("entity").alias("building_id"), _day().alias("on_day"), "total_7", "total_30", "avg_7", "avg_30")


def _messages(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "nyc_311").select(F.lit("nyc_311").alias("producer"), message_key(F.col("unique_key")).alias("key"))
    return a.unionByName(table(spark, d, "hpd").select(F.lit("hpd").alias("producer"), message_key(F.col("violationid")).alias("key")))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return repeated_messages(_messages(spark, d)).select(F.col("producer").alias("source_table"), F.col("key").alias("message_id"))


def p6_once(spark: SparkSession, d: str) -> DataFrame:
    """One row for each message: its latest delivery."""
    out = []
    for name, key in (("nyc_311", "unique_key"), ("hpd", "violationid")):
        df = table(spark, d, name).select(message_key(F.col(key)).alias("message_id"), "run_id", F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss").alias("ingested_at"))
        out.append(deliver_once(df, F.lit(name), F.col("message_id"), [F.col("ingested_at"), F.col("run_id")]).select(F.lit(name).alias("source_table"), "message_id", "run_id", "ingested_at"))
    return out[0].unionByName(out[1])


def _changes(spark: SparkSession, d: str) -> DataFrame:
    address = F.nullif(F.upper(F.trim(F.regexp_replace("address", r"\s+", " "))), F.lit(""))
    pluto = table(spark, d, "pluto")
    return snapshot_changes(pluto, lot_number(F.col("bbl")), F.col("version"), versions_in_order(pluto, "version"), {"address": address, "yearbuilt": F.nullif(F.col("yearbuilt"), F.lit(0))})


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _changes(spark, d).select(F.col("key").alias("bbl"), "version_from", "version_to", "change_kind")


def p7_fields(spark: SparkSession, d: str) -> DataFrame:
    """Changes counted by step, kind and fields."""
    return _changes(spark, d).groupBy("version_from", "version_to", "change_kind", "changed_fields").agg(F.count(F.lit(1)).alias("lots"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_near_counts, p1_regions, p3_found, p3_report, p5_found, p5_trailing, p5_corrected, p6_found, p6_once, p7_found, p7_fields)}


_MK = r"case when regexp_full_match(regexp_replace({c}, '^\s+|\s+$', '', 'g'), '[0-9]+(\.0*)?') then coalesce(nullif(ltrim(regexp_replace(regexp_replace({c}, '^\s+|\s+$', '', 'g'), '\.0*$', ''), '0'), ''), '0') else nullif(regexp_replace({c}, '^\s+|\s+$', '', 'g'), '') end"
_T = r"regexp_replace(regexp_replace({c}, '^\s+|\s+$', '', 'g'), '\.0*$', '')"
_LOT = rf"case when regexp_full_match({_T}, '[1-5][0-9]{{{{9}}}}') then {_T} when regexp_full_match({_T}, '[1-5][-/ ]+[0-9]{{{{1,5}}}}[-/ ]+[0-9]{{{{1,4}}}}') then regexp_extract({_T}, '^([1-5])', 1) || lpad(regexp_extract({_T}, '^[1-5][-/ ]+([0-9]+)', 1), 5, '0') || lpad(regexp_extract({_T}, '([0-9]+)$', 1), 4, '0') end"


def sql_message_key(c: str) -> str:
    return _MK.format(c=c)


def sql_lot_number(c: str) -> str:
    return _LOT.format(c=c)


def oracle_sql() -> dict[str, str]:
    near = f"""
      with c as (select distinct {sql_message_key('unique_key')} as unique_key, latitude lat, longitude lon from nyc_311 where latitude between 40 and 41 and longitude between -75 and -73),
      b as (select bin, latitude lat, longitude lon from building_identity where latitude between 40 and 41 and longitude between -75 and -73 and bin is not null),
      g as (select *, cast(floor(lat*1000) as bigint)+dy as gy, cast(floor(lon*1000) as bigint)+dx as gx from b, (select unnest([-1,0,1]) as dy) a1, (select unnest([-1,0,1]) as dx) a2),
      m as (select c.unique_key, c.lat, c.lon, g.bin, 2*6371000*asin(sqrt(pow(sin(radians(g.lat-c.lat)/2),2)+cos(radians(c.lat))*cos(radians(g.lat))*pow(sin(radians(g.lon-c.lon)/2),2))) as metres
            from c join g on g.gy = cast(floor(c.lat*1000) as bigint) and g.gx = cast(floor(c.lon*1000) as bigint) where c.unique_key is not null)"""
    orphans = """
      with r as (select 'fact_311_event' as fact_table, event_id, strftime(created_date, '%Y-%m') as "month", property_id, building_id from fact_311_event
        union all select 'fact_hpd_violation', hpd_event_id, strftime(inspectiondate, '%Y-%m'), property_id, building_id from fact_hpd_violation),
      o as (select distinct fact_table, event_id, 'property_id' as field_name, property_id as ref_id, "month" from r where regexp_matches(property_id, '\\S') and property_id not in (select property_id from dim_property where property_id is not null)
        union select distinct fact_table, event_id, 'building_id', building_id, "month" from r where regexp_matches(building_id, '\\S') and building_id not in (select 'BLD:' || bin from building_identity where bin is not null))"""
    daily = """
      with e as (select building_id, cast(created_date as date) as dd from fact_311_event union all select building_id, cast(inspectiondate as date) from fact_hpd_violation union all select building_id, cast(violation_issue_date as date) from fact_dob_violation),
      dc as (select building_id, dd, count(*) as n from e where regexp_matches(building_id, '\\S') and dd is not null group by 1, 2),
      f as (select building_id, min(dd) as first_day from dc group by 1),
      s as (select building_id, cast(unnest(generate_series(first_day::timestamp, (select max(dd) from e)::timestamp, interval 1 day)) as date) as dd from f),
      w as (select s.building_id, s.dd, cast(sum(coalesce(n, 0)) over (partition by s.building_id order by s.dd rows 6 preceding) as bigint) as total_7, cast(sum(coalesce(n, 0)) over (partition by s.building_id order by s.dd rows 29 preceding) as bigint) as total_30 from s left join dc on dc.building_id = s.building_id and dc.dd = s.dd)"""
    msgs = f"with m as (select 'nyc_311' as source_table, {sql_message_key('unique_key')} as message_id, run_id, strftime(ingested_at, '%Y-%m-%d %H:%M:%S') as ingested_at from nyc_311 union all select 'hpd', {sql_message_key('violationid')}, run_id, strftime(ingested_at, '%Y-%m-%d %H:%M:%S') from hpd)"
    changes = f"""
      with vs as (select list(version order by try_cast(regexp_extract(version, '^([0-9]+)', 1) as int), try_cast(regexp_extract(version, '([0-9]+)$', 1) as int), version) as vs from (select distinct version from pluto where version is not null)),
      p as (select distinct {sql_lot_number('bbl')} as bbl, list_position((select vs from vs), version) as v, coalesce(nullif(upper(trim(regexp_replace(address, '\\s+', ' ', 'g'))), ''), '~') as a, coalesce(nullif(yearbuilt, 0), 0) as y from pluto),
      q as (select bbl, v, list_sort(list_distinct(list(a))) as a, list_sort(list_distinct(list(y))) as y from p where bbl is not null and v > 0 group by 1, 2),
      j as (select coalesce(x.bbl, z.bbl) as bbl, coalesce(x.v, z.v - 1) as v, x.a as a1, z.a as a2, x.y as y1, z.y as y2 from (select * from q where v < (select len(vs) from vs)) x full join (select * from q where v > 1) z on x.bbl = z.bbl and z.v = x.v + 1),
      ch as (select bbl, (select vs from vs)[v] as version_from, (select vs from vs)[v + 1] as version_to, case when a1 is null then 'added' when a2 is null then 'removed' else 'changed' end as change_kind,
        case when a1 is null or a2 is null then '' when a1 <> a2 and y1 <> y2 then 'address,yearbuilt' when a1 <> a2 then 'address' else 'yearbuilt' end as changed_fields from j where a1 is null or a2 is null or a1 <> a2 or y1 <> y2)"""
    lot = sql_lot_number("bbl")
    inside = f"""
      with c as (select distinct {sql_message_key('unique_key')} as unique_key, latitude y, longitude x from nyc_311 where latitude between 40 and 41 and longitude between -75 and -73),
      p as (select substr({lot}, 1, 6) as region, min(longitude) x0, max(longitude) x4, min(latitude) y0, max(latitude) y4 from pluto where latitude between 40 and 41 and longitude between -75 and -73 and {lot} is not null group by 1),
      r as (select *, (x0 + x4) / 2 as x2, (y0 + y4) / 2 as y2 from p where x0 < x4 and y0 < y4),
      k as (select *, x0 + (x2 - x0) * 0.25 as x1, x0 + (x2 - x0) * 0.75 as x3, y0 + (y2 - y0) * 0.25 as y1, y0 + (y2 - y0) * 0.75 as y3 from r)
      select unique_key, min(region) as region from (select distinct unique_key, x, y, region from c join k on x between x0 and x4 and y between y0 and y4 and not (x > x2 and y > y2) and not (x > x1 and x < x3 and y > y1 and y < y3) where unique_key is not null) group by unique_key, x, y"""
    return {
        "p1_regions": f"select distinct unique_key, region from ({inside})",
        "p1_found": near + " select distinct unique_key, bin from m where metres <= 25",
        "p1_near_counts": near + " select bin, case when metres <= 5 then '0-5' when metres <= 10 then '5-10' else '10-25' end as band, count(*) as complaints from m where metres <= 25 group by 1, 2",
        "p3_found": orphans + " select fact_table, event_id, field_name from o",
        "p3_report": orphans + f""", k as (select 'PROP:' || {lot} as key, max(cast(version < (select max(snapshot_version) from dim_property) as int)) as b, max(cast(version > (select max(snapshot_version) from dim_property) as int)) as l, max(cast(version = (select max(snapshot_version) from dim_property) as int)) as n from pluto group by 1)
          select fact_table, field_name, "month", case when n = 1 then 'known_now' when b = 1 and l = 1 then 'known_before_and_later' when b = 1 then 'known_before' when l = 1 then 'known_later' else 'never_known' end as lot_status,
          count(*) as orphans, count(distinct ref_id) as distinct_ids from o left join k on k.key = o.ref_id group by 1, 2, 3, 4""",
        "p5_found": daily + " select building_id, strftime(dd, '%Y-%m-%d') as on_day from w where total_7 >= 4 and total_30 <= 20 and 15 * total_7 >= 7 * total_30",
        "p5_trailing": daily + " select building_id, strftime(dd, '%Y-%m-%d') as on_day, total_7, total_30, total_7 / 7.0 as avg_7, total_30 / 30.0 as avg_30 from w",
        "p5_corrected": daily + " select building_id, strftime(dd, '%Y-%m-%d') as on_day, total_7, total_30, total_7 / 7.0 as avg_7, total_30 / 30.0 as avg_30 from w",
        "p6_found": msgs + " select source_table, message_id from m where message_id is not null group by 1, 2 having count(*) > 1",
        "p6_once": msgs + " select source_table, message_id, run_id, ingested_at from m where message_id is not null qualify row_number() over (partition by source_table, message_id order by ingested_at desc nulls last, run_id desc nulls last) = 1",
        "p7_found": changes + " select bbl, version_from, version_to, change_kind from ch",
        "p7_fields": changes + " select version_from, version_to, change_kind, changed_fields, count(*) as lots from ch group by all",
    }
