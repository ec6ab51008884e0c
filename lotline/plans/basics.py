"""Catalogue: scalar functions, dates, numbers, arrays, dedup, joins, sets and counts (q01 to q29)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotline.functions import numbers as N
from lotline.functions import text as T
from lotline.functions.keys import lot_with_source, strip_zero_decimals
from lotline.operators.model import as_of_date
from lotline.operators.once import keep_one
from lotline.operators.resolve import pick_by_priority, unique_target
from lotline.plans.registry import Catalog, Tables

C = Catalog()

SQL_LIGHT = "trim(regexp_replace(regexp_replace(upper({c}), '[^A-Z0-9 ]', ' ', 'g'), '\\s+', ' ', 'g'))"


def sql_light(c: str) -> str:
    return SQL_LIGHT.format(c=c)


def sql_full(c: str) -> str:
    out = sql_light(c)
    for a, b in T.ADDRESS_WORDS.items():
        out = f"regexp_replace({out}, '\\b{a}\\b', '{b}', 'g')"
    return out


def sql_borough(c: str) -> str:
    u = f"upper(trim({c}))"
    whens = " ".join(f"when {u} in ('{k}', '{T.BOROUGH_ABBREVIATIONS[k]}') then '{v}'" for k, v in T.BOROUGH_NAMES.items())
    return f"case {whens} else {u} end"


def sql_round(c: str, digits: int = 2) -> str:
    k = 10.0**digits
    return f"floor(({c}) * {k} + 0.5) / {k}"


@C.add("select unique_key, upper(trim(agency)) as agency, regexp_replace(upper(trim(complaint_type)), '\\s+', ' ', 'g') as complaint_type, upper(trim(city)) as city from nyc_311")
def q01_text_standardize(t: Tables) -> DataFrame:
    return t.nyc_311.select("unique_key", T.standardize(F.col("agency")).alias("agency"), T.collapse(T.standardize(F.col("complaint_type"))).alias("complaint_type"), T.standardize(F.col("city")).alias("city"))


@C.add(f"select violationid, {sql_light('streetname')} as street from hpd")
def q02_address_normalize_light(t: Tables) -> DataFrame:
    return t.hpd.select("violationid", T.address_light(F.col("streetname")).alias("street"))


@C.add(f"select unique_key, {sql_full('incident_address')} as address from nyc_311")
def q03_address_normalize_full(t: Tables) -> DataFrame:
    return t.nyc_311.select("unique_key", T.address_full(F.col("incident_address")).alias("address"))


@C.add(
    "select bbl, version, nullif(regexp_extract(upper(trim(address)), '^([0-9]+(?:-[0-9]+)?[A-Z]?)\\s+', 1), '') as house, trim(regexp_replace(upper(trim(address)), '^[0-9]+(?:-[0-9]+)?[A-Z]?\\s+', '')) as street from pluto"
)
def q04_house_street_split(t: Tables) -> DataFrame:
    return t.pluto.select("bbl", "version", T.house_number(F.col("address")).alias("house"), T.street_part(F.col("address")).alias("street"))


@C.add(
    f"select {sql_borough('borough')} as borough, 'pluto' as source, count(*) as n from pluto group by 1 union all select {sql_borough('boro')}, 'hpd', count(*) from hpd group by 1 union all select {sql_borough('borough')}, 'nyc_311', count(*) from nyc_311 group by 1"
)
def q05_borough_canonical(t: Tables) -> DataFrame:
    part = lambda df, c, s: df.groupBy(T.borough(F.col(c)).alias("borough"), F.lit(s).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    return part(t.pluto, "borough", "pluto").unionByName(part(t.hpd, "boro", "hpd")).unionByName(part(t.nyc_311, "borough", "nyc_311"))


SQL_SRC_LOT = "case when regexp_full_match(trim(bbl), '[0-9]{10}') then trim(bbl) end"
SQL_MADE_LOT = "case when regexp_full_match(trim(boroid), '[1-5]') and regexp_full_match(trim(block), '[0-9]{1,5}') and regexp_full_match(trim(lot), '[0-9]{1,4}') then trim(boroid) || lpad(trim(block), 5, '0') || lpad(trim(lot), 4, '0') end"


@C.add(f"select violationid, coalesce({SQL_SRC_LOT}, {SQL_MADE_LOT}) as lot_key, case when {SQL_SRC_LOT} is not null then 'SOURCE' when {SQL_MADE_LOT} is not null then 'CONSTRUCTED' else 'MISSING' end as lot_source from hpd")
def q06_composite_key_build(t: Tables) -> DataFrame:
    key, label = lot_with_source(*map(F.col, ("bbl", "boroid", "block", "lot")))
    return t.hpd.select("violationid", key.alias("lot_key"), label.alias("lot_source"))


@C.add("select version, regexp_replace(trim(bbl), '\\.0*$', '') as bbl, count(*) as n from pluto group by 1, 2")
def q07_numeric_suffix_strip(t: Tables) -> DataFrame:
    return t.pluto.groupBy("version", strip_zero_decimals(F.trim("bbl")).alias("bbl")).agg(F.count(F.lit(1)).alias("n"))


@C.add(
    "select doc_id, trunc(try_cast(x as double)) as as_int, try_cast(x as double) as as_double, case when trunc(try_cast(x as double)) > 0 then trunc(try_cast(x as double)) end as positive from (select doc_id, case when doc_id % 5 = 0 then 'abc' when doc_id % 5 = 1 then '0' when doc_id % 5 = 2 then doc_id || '.00000000' when doc_id % 5 = 3 then '' else cast(doc_id as varchar) end as x from documents)"
)
def q08_safe_casts(t: Tables) -> DataFrame:
    k, x = F.col("doc_id") % 5, F.col("doc_id").cast("string")
    dirty = F.when(k == 0, "abc").when(k == 1, "0").when(k == 2, F.concat(x, F.lit(".00000000"))).when(k == 3, "").otherwise(x)
    df = t.documents.select("doc_id", dirty.alias("x"))
    return df.select("doc_id", N.safe_int(F.col("x")).cast("double").alias("as_int"), F.col("x").try_cast("double").alias("as_double"), N.positive(N.safe_int(F.col("x"))).cast("double").alias("positive"))


@C.add(
    "select o_orderkey, cast(year(x) as double) as y, cast(month(x) as double) as m, cast(day(x) as double) as d from (select o_orderkey, case when o_orderkey % 7 = 0 then null else o_orderdate end as x from orders)"
)
def q09_timestamp_parse_parts(t: Tables) -> DataFrame:
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    x = N.parse_millis(F.when(F.col("o_orderkey") % 7 == 0, "not a time").otherwise(iso))
    return t.orders.select("o_orderkey", x.alias("x")).select("o_orderkey", *[f("x").cast("double").alias(n) for n, f in (("y", F.year), ("m", F.month), ("d", F.dayofmonth))])


@C.add(
    """with a as (select max(cast(created_date as date)) as as_of from fact_311_event),
    x as (select property_id, datediff('day', cast(created_date as date), as_of) as age from fact_311_event, a)
    select property_id, count(*) filter (age between 0 and 30) as d0_30, count(*) filter (age between 31 and 90) as d31_90, count(*) filter (age between 91 and 365) as d91_365 from x where age >= 0 and property_id is not null group by 1"""
)
def q10_age_days_buckets(t: Tables) -> DataFrame:
    from lotline.operators.model import event_features

    return event_features(t.fact_311_event, "property_id", "created_date", as_of_date([(t.fact_311_event, "created_date")]))


@C.add(
    """with a as (select max(cast(l_shipdate as date)) as d from lineitem)
    select l_suppkey, count(*) filter (cast(l_shipdate as date) >= d - 30) as last_30, count(*) filter (cast(l_shipdate as date) >= d - 90) as last_90, count(*) filter (cast(l_shipdate as date) >= d - 365) as last_365 from lineitem, a group by 1"""
)
def q11_rolling_last_30_90_365(t: Tables) -> DataFrame:
    d = t.lineitem.agg(F.max(F.to_date("l_shipdate"))).scalar()
    x = t.lineitem.select("l_suppkey", F.to_date("l_shipdate").alias("s"), d.alias("d"))
    return x.groupBy("l_suppkey").agg(*[F.count_if(F.col("s") >= F.date_sub("d", n)).alias(f"last_{n}") for n in (30, 90, 365)])


@C.add(
    "select strftime(least((select max(cast(created_date as date)) from fact_311_event), (select max(cast(inspectiondate as date)) from fact_hpd_violation), (select max(cast(violation_issue_date as date)) from fact_dob_violation)), '%Y-%m-%d') as as_of"
)
def q12_as_of_common_date(t: Tables) -> DataFrame:
    return as_of_date([(t.fact_311_event, "created_date"), (t.fact_hpd_violation, "inspectiondate"), (t.fact_dob_violation, "violation_issue_date")]).select(F.date_format("as_of", "yyyy-MM-dd").alias("as_of"))


@C.add(
    f"select p_partkey, {sql_round('ln(1 + least(cast(p_size as double), 40.0)) / ln(41.0) * 100', 4)} as log_score, {sql_round('least(p_retailprice, 1500.0) / 1500.0 * 100', 4)} as linear_score, greatest(p_size, 10) as g from part"
)
def q13_log_and_linear_normalize(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", N.round_half_up(N.log_score(F.col("p_size"), 40), 4).alias("log_score"), N.round_half_up(N.linear_score(F.col("p_retailprice"), 1500), 4).alias("linear_score"), F.greatest("p_size", F.lit(10)).alias("g"))


SQL_DIST = "case when {a}.latitude + {a}.longitude + {b}.latitude + {b}.longitude is not null then 2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin(radians({b}.latitude - {a}.latitude) / 2), 2) + cos(radians({a}.latitude)) * cos(radians({b}.latitude)) * pow(sin(radians({b}.longitude - {a}.longitude) / 2), 2)))) end"


@C.add(f"select b.bin, {sql_round(SQL_DIST.format(a='b', b='p'), 3)} as metres from building_identity b join dim_property p on b.current_bbl = p.bbl")
def q14_haversine_pairs(t: Tables) -> DataFrame:
    b = t.building_identity.select("bin", "current_bbl", F.col("latitude").alias("la"), F.col("longitude").alias("lo"))
    j = b.join(t.dim_property.select("bbl", "latitude", "longitude"), F.col("current_bbl") == F.col("bbl"))
    return j.select("bin", N.round_half_up(N.haversine(F.col("la"), F.col("lo"), F.col("latitude"), F.col("longitude")), 3).alias("metres"))


@C.add("select event_type, cast(json_extract_string(props, '$.k') as int) as k, count(*) as n from events group by 1, 2")
def q15_json_props_extract(t: Tables) -> DataFrame:
    k = F.from_json("props", "k int")["k"]
    return t.events.groupBy("event_type", k.alias("k")).agg(F.count(F.lit(1)).alias("n"))


@C.add(
    "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc, l_orderkey desc, l_partkey desc, l_suppkey desc, l_linenumber desc, l_quantity desc, l_extendedprice desc, l_discount desc, l_tax desc, l_returnflag desc, l_linestatus desc) = 1"
)
def q16_dedup_latest_wins(t: Tables) -> DataFrame:
    return keep_one(t.lineitem, F.struct("l_orderkey", "l_linenumber"), [F.col("l_shipdate")]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@C.add("select distinct bbl, source from (select bbl, 'lot' as source from dim_property union all select current_bbl, 'building' from building_identity union all select source_bbl, 'event' from fact_311_event)")
def q17_distinct_union_by_name(t: Tables) -> DataFrame:
    a = t.dim_property.select("bbl", F.lit("lot").alias("source"))
    b = t.building_identity.select(F.lit("building").alias("source"), F.col("current_bbl").alias("bbl"))
    return a.unionByName(b).unionByName(t.fact_311_event.select(F.col("source_bbl").alias("bbl"), F.lit("event").alias("source"))).distinct()


@C.add("select distinct bin, v from (select bin, unnest(list_concat([current_bbl, resolved_bbl], coalesce(bbl_aliases, []))) as v from building_identity) where v is not null")
def q19_array_concat_distinct_explode(t: Tables) -> DataFrame:
    every = F.array_distinct(F.concat(F.array("current_bbl", "resolved_bbl"), F.coalesce("bbl_aliases", F.array().cast("array<string>"))))
    return t.building_identity.select("bin", F.explode(every).alias("v")).where("v is not null").distinct()


@C.add("select bbl, min(bin) as bin from hpd where bbl is not null and bin is not null group by 1 having count(distinct bin) = 1")
def q20_uniqueness_guard(t: Tables) -> DataFrame:
    return unique_target(t.hpd, ["bbl"], "bin")


@C.add(
    "select a.building_id, count(*) as pairs from fact_311_event a join fact_hpd_violation b on a.building_id = b.building_id and a.created_year = b.inspection_year and a.created_month = b.inspection_month and a.created_day = b.inspection_day group by 1"
)
def q21_join_inner_composite(t: Tables) -> DataFrame:
    """Pairs of complaints and violations of a building and day, counted before joining so that no pairs are made."""
    a = t.fact_311_event.groupBy("building_id", F.col("created_year").alias("y"), F.col("created_month").alias("m"), F.col("created_day").alias("d")).agg(F.count(F.lit(1)).alias("na"))
    b = t.fact_hpd_violation.groupBy("building_id", F.col("inspection_year").alias("y"), F.col("inspection_month").alias("m"), F.col("inspection_day").alias("d")).agg(F.count(F.lit(1)).alias("nb"))
    return a.join(b, ["building_id", "y", "m", "d"]).groupBy("building_id").agg(F.sum(F.col("na") * F.col("nb")).alias("pairs"))


@C.add("select b.bin, b.current_bbl, p.property_id, cast(p.yearbuilt as double) as yearbuilt, p.landuse from building_identity b left join dim_property p on b.current_bbl = p.bbl")
def q22_join_left_enrich(t: Tables) -> DataFrame:
    p = t.dim_property.select(F.col("bbl").alias("current_bbl"), "property_id", "yearbuilt", "landuse")
    return t.building_identity.join(p, "current_bbl", "left").select("bin", "current_bbl", "property_id", F.col("yearbuilt").cast("double").alias("yearbuilt"), "landuse")


@C.add("select bin, current_bbl from building_identity b where not exists (select 1 from dim_property p where p.bbl = b.current_bbl)")
def q23_join_anti_residual(t: Tables) -> DataFrame:
    return t.building_identity.join(t.dim_property.select(F.col("bbl").alias("current_bbl")), "current_bbl", "left_anti").select("bin", "current_bbl")


@C.add("select borough, count(*) as covered from building_identity b where exists (select 1 from fact_dob_violation f where f.building_id = 'BLD:' || b.bin) group by 1")
def q24_join_semi_coverage(t: Tables) -> DataFrame:
    ids = t.fact_dob_violation.select(F.substring("building_id", 5, 100).alias("bin")).where(F.col("building_id").startswith("BLD:"))
    return t.building_identity.join(ids, "bin", "left_semi").groupBy("borough").agg(F.count(F.lit(1)).alias("covered"))


@C.add(
    "select gy, gx, count(*) as n from (select cast(floor(latitude * 1000) as bigint) + dy as gy, cast(floor(longitude * 1000) as bigint) + dx as gx from building_identity, (select unnest([-1, 0, 1]) as dy) a, (select unnest([-1, 0, 1]) as dx) b where latitude is not null and longitude is not null) group by 1, 2"
)
def q25_neighbour_cells(t: Tables) -> DataFrame:
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    x = t.building_identity.where("latitude is not null and longitude is not null").select("latitude", "longitude", steps.alias("s"))
    return x.groupBy((F.floor(F.col("latitude") * 1000) + F.col("s.i")).alias("gy"), (F.floor(F.col("longitude") * 1000) + F.col("s.j")).alias("gx")).agg(F.count(F.lit(1)).alias("n"))


@C.add(f"select r_name, n_name, {sql_round('sum(l_quantity)')} as quantity, count(*) as n from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1, 2")
def q26_join_lookup(t: Tables) -> DataFrame:
    """Aggregated to the supplier before the small tables are looked up."""
    per = t.lineitem.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("q"), F.count(F.lit(1)).alias("n"))
    j = per.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("r_name", "n_name").agg(N.round_half_up(F.sum("q")).alias("quantity"), F.sum("n").alias("n"))


@C.add(
    """with u as (select building_id as id, 1 as a, 0 as b, 0 as c from fact_311_event union all select building_id, 0, 1, 0 from fact_hpd_violation union all select building_id, 0, 0, 1 from fact_dob_violation),
    g as (select id, max(a) as a, max(b) as b, max(c) as c from u where id is not null group by 1) select a as in_311, b as in_hpd, c as in_dob, count(*) as ids from g group by 1, 2, 3"""
)
def q27_set_overlap_three_way(t: Tables) -> DataFrame:
    """One pass: presence flags per id instead of three joins."""
    part = lambda df, k: df.select(F.col("building_id").alias("id"), *[F.lit(int(i == k)).alias(n) for i, n in enumerate(("in_311", "in_hpd", "in_dob"))])
    u = part(t.fact_311_event, 0).unionByName(part(t.fact_hpd_violation, 1)).unionByName(part(t.fact_dob_violation, 2)).where("id is not null")
    g = u.groupBy("id").agg(*[F.max(n).alias(n) for n in ("in_311", "in_hpd", "in_dob")])
    return g.groupBy("in_311", "in_hpd", "in_dob").agg(F.count(F.lit(1)).alias("ids"))


@C.add(
    "select o_custkey, o_orderkey, o_orderpriority from orders qualify row_number() over (partition by o_custkey order by case o_orderstatus when 'F' then 1 when 'O' then 2 else 3 end, o_orderpriority, o_orderkey) = 1"
)
def q28_priority_pick(t: Tables) -> DataFrame:
    rank = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3)
    return pick_by_priority(t.orders, "o_custkey", [rank, F.col("o_orderpriority"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderpriority")


@C.add(f"select complaint_type, count(*) as n, {sql_round('count(*) * 100.0 / sum(count(*)) over ()')} as percent from fact_311_event group by 1")
def q29_frequency_percent(t: Tables) -> DataFrame:
    g = t.fact_311_event.groupBy("complaint_type").agg(F.count(F.lit(1)).alias("n"))
    total = t.fact_311_event.agg(F.count(F.lit(1))).scalar()
    return g.select("complaint_type", "n", N.round_half_up(F.col("n") * 100.0 / total).alias("percent"))


@C.add("select p_partkey, p_retailprice from part order by p_retailprice desc, p_partkey limit 20")
def q29_top_n(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", "p_retailprice").orderBy(F.desc("p_retailprice"), "p_partkey").limit(20)


@C.add("select cast(year(created_date) as int) as y, cast(month(created_date) as int) as m, count(*) as n from nyc_311 group by 1, 2")
def q29_month_histogram(t: Tables) -> DataFrame:
    return t.nyc_311.groupBy(F.year("created_date").alias("y"), F.month("created_date").alias("m")).agg(F.count(F.lit(1)).alias("n"))


@C.add("select source_table, bucket, count(*) as n from (select 'nyc_311' as source_table, case when latitude is null or longitude is null then 'missing' when latitude = 0 then 'zero' else 'there' end as bucket from nyc_311 union all select 'hpd', case when latitude is null or longitude is null then 'missing' when latitude = 0 then 'zero' else 'there' end from hpd) group by 1, 2")
def q29_point_buckets(t: Tables) -> DataFrame:
    b = F.when(F.col("latitude").isNull() | F.col("longitude").isNull(), "missing").when(F.col("latitude") == 0, "zero").otherwise("there")
    part = lambda df, s: df.groupBy(F.lit(s).alias("source_table"), b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return part(t.nyc_311, "nyc_311").unionByName(part(t.hpd, "hpd"))


@C.add("select o_custkey, o_orderkey, cast(row_number() over w as int) as nth, cast(lag(o_orderkey) over w as double) as before from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)")
def q29_window_numbering(t: Tables) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return t.orders.select("o_custkey", "o_orderkey", F.row_number().over(w).alias("nth"), F.lag("o_orderkey").over(w).cast("double").alias("before"))
