"""Catalogue: cleaned feeds, identities, cascades, proximity, candidates, star schema and its gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.functions import numbers as N
from lotline.functions import text as T
from lotline.functions.keys import message_key
from lotline.operators import model as M
from lotline.operators import quality as Q
from lotline.operators import resolve as R
from lotline.operators import serving as S
from lotline.plans.basics import SQL_DIST, SQL_MADE_LOT, SQL_SRC_LOT, sql_borough, sql_full, sql_light, sql_round
from lotline.plans.problems import sql_message_key
from lotline.plans.registry import Catalog, Tables
from lotline.session import cut
from lotline.sources.spec import SPECS, clean, latest

C = Catalog()

CALLS = ["unique_key", "created_date", "closed_date", "agency", "complaint_type", "status", "incident_address", "borough", "city", "bbl", "latitude", "longitude"]
HOUSING = ["violationid", "inspectiondate", "bin", "bbl", "bbl_source", "source_bbl", "boro", "housenumber", "streetname", "class", "violationstatus", "latitude", "longitude"]


def complaints(t: Tables) -> DataFrame:
    """The newest delivery of each complaint, cleaned."""
    df = clean(t.nyc_311, SPECS["complaints"]).withColumn("unique_key", message_key(F.col("unique_key")))
    return latest(df.select(*CALLS, "run_id", "ingested_at"), SPECS["complaints"], ["ingested_at", "run_id"]).drop("run_id", "ingested_at")


def housing(t: Tables) -> DataFrame:
    """The newest delivery of each housing violation, cleaned."""
    df = clean(t.hpd, SPECS["housing"]).withColumn("violationid", message_key(F.col("violationid")))
    return latest(df.select(*HOUSING, "run_id", "ingested_at"), SPECS["housing"], ["ingested_at", "run_id"]).drop("run_id", "ingested_at")


def safety(t: Tables) -> DataFrame:
    """Safety violations, cleaned; they come one row each."""
    raw = t.fact_dob_violation.withColumnsRenamed({"source_bbl": "bbl", "source_bin": "bin"})
    return clean(raw, SPECS["safety"])


def current_version(t: Tables) -> Column:
    """The snapshot behind dim_property, as a scalar."""
    return t.dim_property.agg(F.max("snapshot_version")).scalar()


def lots(t: Tables) -> DataFrame:
    """The current snapshot of the lots, cleaned."""
    return clean(t.pluto.where(F.col("version") == current_version(t)), SPECS["lots"])


def _newest(cols: list[str]) -> str:
    return ", ".join(f"{c} desc nulls last" for c in ["ingested_at", "run_id", *cols])


SQL_CALLS = rf"""
  c0 as (select {sql_message_key('unique_key')} as unique_key, created_date, closed_date, upper(trim(agency)) as agency, regexp_replace(upper(trim(complaint_type)), '\s+', ' ', 'g') as complaint_type, upper(trim(status)) as status, upper(trim(incident_address)) as incident_address,
    upper(trim(borough)) as borough, trim(city) as city, {SQL_SRC_LOT} as bbl, latitude, longitude, run_id, ingested_at from nyc_311),
  calls as (select * exclude (run_id, ingested_at) from c0 where unique_key is not null qualify row_number() over (partition by unique_key order by {_newest(CALLS)}) = 1)"""
SQL_HOUSING = f"""
  h0 as (select {sql_message_key('violationid')} as violationid, inspectiondate, trim(bin) as bin, coalesce({SQL_SRC_LOT}, {SQL_MADE_LOT}) as bbl, case when {SQL_SRC_LOT} is not null then 'SOURCE' when {SQL_MADE_LOT} is not null then 'CONSTRUCTED' else 'MISSING' end as bbl_source, trim(bbl) as source_bbl,
    upper(trim(boro)) as boro, trim(housenumber) as housenumber, upper(trim(streetname)) as streetname, upper(trim(class)) as "class", upper(trim(violationstatus)) as violationstatus, latitude, longitude, run_id, ingested_at from hpd),
  housing as (select * exclude (run_id, ingested_at) from h0 where violationid is not null qualify row_number() over (partition by violationid order by {_newest(HOUSING)}) = 1)"""
_CODE = "case upper(trim(borough)) when 'MANHATTAN' then '1' when 'BRONX' then '2' when 'BROOKLYN' then '3' when 'QUEENS' then '4' when 'STATEN ISLAND' then '5' end"
_MADE = f"case when {_CODE} is not null and regexp_full_match(trim(block), '[0-9]{{1,5}}') and regexp_full_match(trim(lot), '[0-9]{{1,4}}') then {_CODE} || lpad(trim(block), 5, '0') || lpad(trim(lot), 4, '0') end"
_OWN = "case when regexp_full_match(trim(source_bbl), '[0-9]{10}') then trim(source_bbl) end"
SQL_SAFETY = f"""
  safety as (select trim(violation_number) as violation_number, violation_issue_date, trim(source_bin) as bin, coalesce({_OWN}, {_MADE}) as bbl, case when {_OWN} is not null then 'SOURCE' when {_MADE} is not null then 'CONSTRUCTED' else 'MISSING' end as bbl_source,
    upper(trim(borough)) as borough, trim(house_number) as house_number, upper(trim(street)) as street, upper(trim(violation_status)) as violation_status, latitude, longitude from fact_dob_violation)"""
_DATE = "strftime({c}, '%Y-%m-%d')"


def day(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


@C.add(f"with {SQL_CALLS} select * exclude (created_date, closed_date), strftime(created_date, '%Y-%m-%d %H:%M:%S') as created_at, strftime(closed_date, '%Y-%m-%d') as closed_on from calls")
def q63_clean_complaints(t: Tables) -> DataFrame:
    return complaints(t).select("*", F.date_format("created_date", "yyyy-MM-dd HH:mm:ss").alias("created_at"), day("closed_date").alias("closed_on")).drop("created_date", "closed_date")


@C.add(f"with {SQL_HOUSING} select * exclude (inspectiondate), {_DATE.format(c='inspectiondate')} as inspected_on from housing")
def q64_clean_housing(t: Tables) -> DataFrame:
    return housing(t).select("*", day("inspectiondate").alias("inspected_on")).drop("inspectiondate")


@C.add(f"with {SQL_SAFETY} select * exclude (violation_issue_date), {_DATE.format(c='violation_issue_date')} as issued_on from safety")
def q65_clean_safety(t: Tables) -> DataFrame:
    return safety(t).select("violation_number", "bin", "bbl", "bbl_source", "borough", "house_number", "street", "violation_status", "latitude", "longitude", day("violation_issue_date").alias("issued_on"))


_NUMBER = "regexp_replace(trim(bbl), '\\.0*$', '')"
_PARTS = "case when regexp_full_match(trim(borocode), '[1-5]') and regexp_full_match(trim(block), '[0-9]{1,5}') and regexp_full_match(trim(lot), '[0-9]{1,4}') then trim(borocode) || lpad(trim(block), 5, '0') || lpad(trim(lot), 4, '0') end"
_VALID = f"case when regexp_full_match({_NUMBER}, '[0-9]{{10}}') then {_NUMBER} end"
SQL_LOTS = f"""
  lots as (select coalesce({_VALID}, {_PARTS}) as bbl, trim(bbl) as source_bbl, case when {_VALID} is not null then 'SOURCE_NORMALIZED' when {_PARTS} is not null then 'CONSTRUCTED' else 'MISSING' end as bbl_source,
    case trim(borocode) when '1' then 'MANHATTAN' when '2' then 'BRONX' when '3' then 'BROOKLYN' when '4' then 'QUEENS' when '5' then 'STATEN ISLAND' else upper(trim(borough)) end as borough, upper(trim(address)) as address, trim(landuse) as landuse, upper(trim(bldgclass)) as bldgclass,
    case when yearbuilt > 0 then yearbuilt end as yearbuilt, unitsres, numfloors, lotarea, upper(trim(ownername)) as ownername, trim(zipcode) as zipcode, version as snapshot_version from pluto where version = (select max(snapshot_version) from dim_property))"""
LOT_COLUMNS = ["bbl", "source_bbl", "bbl_source", "borough", "address", "landuse", "bldgclass", "unitsres", "numfloors", "lotarea", "ownername", "zipcode", "snapshot_version"]


@C.add(f"with {SQL_LOTS} select * replace (cast(yearbuilt as double) as yearbuilt, cast(unitsres as double) as unitsres) from lots")
def q66_clean_lots(t: Tables) -> DataFrame:
    return lots(t).select(*LOT_COLUMNS, "yearbuilt").withColumns({c: F.col(c).cast("double") for c in ("yearbuilt", "unitsres")})


def observations(t: Tables) -> DataFrame:
    """What the violations tell of buildings: lot, address, borough and point, each with its latest date and source."""
    a = housing(t).select("bin", "bbl", F.trim(F.concat_ws(" ", "housenumber", "streetname")).alias("address"), T.borough(F.col("boro")).alias("borough"), "latitude", "longitude", F.col("inspectiondate").alias("event_date"), F.lit("HPD").alias("source"))
    b = safety(t).select("bin", "bbl", F.trim(F.concat_ws(" ", "house_number", "street")).alias("address"), T.borough(F.col("borough")).alias("borough"), "latitude", "longitude", F.col("violation_issue_date").alias("event_date"), F.lit("DOB").alias("source"))
    return a.unionByName(b)


_OBS = f"""{SQL_HOUSING}, {SQL_SAFETY},
  o as (select bin, bbl, address, borough, latitude, longitude, source, max(event_date) as event_date from (
    select bin, bbl, trim(concat_ws(' ', housenumber, streetname)) as address, {sql_borough('boro')} as borough, latitude, longitude, inspectiondate as event_date, 'HPD' as source from housing
    union all select bin, bbl, trim(concat_ws(' ', house_number, street)), {sql_borough('borough')}, latitude, longitude, violation_issue_date, 'DOB' from safety) where regexp_matches(bin, '\\S') group by all),
  l as (select * from o qualify row_number() over (partition by bin order by event_date desc nulls last, source, bbl nulls last, address nulls last, borough nulls last, latitude nulls last, longitude nulls last) = 1),
  hs as (select bin, list_sort(list_distinct(list(bbl))) as bbls, list_sort(list_distinct(list(address))) as addresses, list_sort(list_distinct(list(source))) as sources from o group by 1)"""


@C.add(
    f"with {_OBS} select l.bin, 'BIN:' || l.bin as building_key, bbl as current_bbl, address as current_address, borough, strftime(event_date, '%Y-%m-%d') as latest_event_date, source as latest_source, array_to_string(bbls, '|') as bbl_aliases, array_to_string(addresses, '|') as address_aliases, array_to_string(sources, '|') as sources, len(bbls) as bbl_count, len(addresses) as address_count, case when len(bbls) > 1 then 'BBL_HISTORY' when len(addresses) > 1 then 'ADDRESS_ALIAS' else 'STABLE' end as identity_status from l join hs using (bin)"
)
def q18_alias_history(t: Tables) -> DataFrame:
    out = M.canonicalize(observations(t), "bin", ["bbl", "address", "borough", "latitude", "longitude"], "event_date", "source", {"bbl": ("bbl_aliases", "BBL_HISTORY"), "address": ("address_aliases", "ADDRESS_ALIAS")})
    text = lambda c: F.array_join(c, "|").alias(c)
    return out.select(
        "bin", F.concat(F.lit("BIN:"), F.col("bin")).alias("building_key"), F.col("bbl").alias("current_bbl"), F.col("address").alias("current_address"), "borough", day("event_date").alias("latest_event_date"), F.col("source").alias("latest_source"),
        text("bbl_aliases"), text("address_aliases"), text("sources"), "bbl_count", "address_count", "identity_status",
    )


# --- events to buildings ---------------------------------------------------------------------------------------------


def _every(b: DataFrame, first: list[str], more: str) -> Column:
    return F.explode(F.array_distinct(F.concat(F.array(*first), F.coalesce(more, F.array().cast("array<string>")))))


def _known(c: str) -> Column:
    return F.when(F.length(F.trim(c)) > 0, F.col(c))


def references(t: Tables) -> tuple[DataFrame, DataFrame]:
    """(bin, bbl) of every lot and (bin, boro, address) of every address a building has or had."""
    b = t.building_identity
    by_lot = b.select("bin", _every(b, ["current_bbl", "resolved_bbl"], "bbl_aliases").alias("bbl")).withColumn("bbl", _known("bbl")).where("bbl is not null")
    by_address = b.select("bin", T.borough(F.col("borough")).alias("boro"), _every(b, ["current_address"], "address_aliases").alias("a")).select("bin", "boro", T.address_full(F.col("a")).alias("address"))
    return by_lot, by_address.withColumn("address", _known("address")).where("address is not null")


def event_resolution(t: Tables) -> DataFrame:
    """(unique_key, bbl_resolution_reason, resolved_bin, match_method, match_confidence, resolution_status) of every complaint.

    Stages: the lot is one building's; lot, address and borough are; address and borough are; the point is near one
    building or much nearer than the next. Points are looked up once each, and only those of complaints the earlier
    stages left.
    """
    by_lot, by_address = references(t)
    lot = by_lot.groupBy("bbl").agg(F.count_distinct("bin").alias("n"), F.min("bin").alias("bin"))
    both = R.unique_target(by_lot.join(by_address, "bin"), ["bbl", "address", "boro"], "bin")
    alone = R.unique_target(by_address, ["address", "boro"], "bin")
    x = complaints(t).select("unique_key", "bbl", T.borough(F.col("borough")).alias("boro"), T.address_full(F.col("incident_address")).alias("address"), "latitude", "longitude").withColumn("address", _known("address"))
    x = R.lookup_join(x, "unique_key", ["bbl"], lot, {"n": "lot_n", "bin": "lot_bin"})
    x = R.lookup_join(x, "unique_key", ["bbl", "address", "boro"], both, {"bin": "both_bin"})
    x = R.lookup_join(x, "unique_key", ["address", "boro"], alone, {"bin": "address_bin"})
    reason = F.when(F.col("bbl").isNull(), "MISSING_BBL").when(F.col("lot_n") == 1, "UNIQUE_BBL").when(F.col("lot_n") > 1, "MULTI_BIN_BBL").otherwise("BBL_NOT_FOUND")
    early = F.when(F.col("lot_n") == 1, F.struct(F.col("lot_bin").alias("bin"), F.lit("UNIQUE_BBL").alias("method")))
    early = early.when((F.col("lot_n") > 1) & F.col("both_bin").isNotNull(), F.struct(F.col("both_bin").alias("bin"), F.lit("BBL_EXACT_ADDRESS").alias("method")))
    early = early.when(F.col("address_bin").isNotNull(), F.struct(F.col("address_bin").alias("bin"), F.lit("EXACT_ADDRESS_BOROUGH").alias("method")))
    x = x.select("unique_key", "boro", "latitude", "longitude", reason.alias("bbl_resolution_reason"), early.alias("early"))
    spots = x.where("early is null and boro is not null and latitude is not null and longitude is not null").select("latitude", "longitude", "boro").distinct()
    profile = R.geo_profile(building_pairs(t, spots), ["latitude", "longitude", "boro"], "bin")
    geo = profile.select("latitude", "longitude", "boro", F.col("nearest").alias("bin"), R.geo_method(F.col("candidates"), F.col("nearest_m"), F.col("second_m")).alias("method")).where("method is not null")
    x = R.lookup_join(x, "unique_key", ["latitude", "longitude", "boro"], geo, {"bin": "geo_bin", "method": "geo_method"})
    none = F.col("early").isNull()
    found = F.coalesce("early.bin", F.when(none, F.col("geo_bin")))
    status = F.when(~none, "RESOLVED").when(F.col("geo_bin").isNotNull(), "AUTO_RESOLVED")
    return x.select("unique_key", "bbl_resolution_reason", found.alias("resolved_bin"), F.coalesce("early.method", F.when(none, F.col("geo_method"))).alias("match_method"), F.when(found.isNotNull(), "HIGH").alias("match_confidence"), status.alias("resolution_status"))


def building_pairs(t: Tables, spots: DataFrame, metres: float = 100.0) -> DataFrame:
    """(latitude, longitude, boro, bin, distance_m) of buildings of the same borough near the points."""
    b = t.building_identity.where("latitude is not null and longitude is not null").select("bin", F.col("latitude").alias("lb"), F.col("longitude").alias("lob"), T.borough(F.col("borough")).alias("boro"))
    return R.grid_pairs(spots, b, metres, ("latitude", "lb"), ("longitude", "lob"), ["boro"])


SQL_REFS = f"""
  b0 as (select *, {sql_borough('borough')} as boro from building_identity),
  rl as (select distinct bin, lot from (select bin, unnest(list_concat([current_bbl, resolved_bbl], coalesce(bbl_aliases, []))) as lot from b0) where trim(lot) <> ''),
  ra as (select distinct bin, boro, address from (select bin, boro, {sql_full('a')} as address from (select bin, boro, unnest(list_concat([current_address], coalesce(address_aliases, []))) as a from b0)) where address <> ''),
  s1 as (select lot, count(distinct bin) as n, min(bin) as bin from rl group by 1),
  s2 as (select lot, address, boro, min(bin) as bin from rl join ra using (bin) where boro is not null group by 1, 2, 3 having count(distinct bin) = 1),
  s3 as (select address, boro, min(bin) as bin from ra where boro is not null group by 1, 2 having count(distinct bin) = 1)"""
SQL_EVENTS = f"""{SQL_CALLS}, {SQL_REFS},
  ev as (select *, {sql_borough('borough')} as boro, nullif({sql_full('incident_address')}, '') as address from calls),
  e3 as (select ev.*, case when ev.bbl is null then 'MISSING_BBL' when s1.n = 1 then 'UNIQUE_BBL' when s1.n > 1 then 'MULTI_BIN_BBL' else 'BBL_NOT_FOUND' end as reason,
      case when s1.n = 1 then s1.bin when s1.n > 1 and s2.bin is not null then s2.bin else s3.bin end as early, case when s1.n = 1 then 'UNIQUE_BBL' when s1.n > 1 and s2.bin is not null then 'BBL_EXACT_ADDRESS' when s3.bin is not null then 'EXACT_ADDRESS_BOROUGH' end as early_method
    from ev left join s1 on ev.bbl = s1.lot left join s2 on ev.bbl = s2.lot and ev.address = s2.address and ev.boro = s2.boro left join s3 on ev.address = s3.address and ev.boro = s3.boro),
  gp as (select e.unique_key, b.bin, min({SQL_DIST.format(a='e', b='b')}) as d from e3 e join b0 b on e.boro = b.boro and abs(e.latitude - b.latitude) < 0.002 and abs(e.longitude - b.longitude) < 0.003 where e.early is null and {SQL_DIST.format(a='e', b='b')} <= 100 group by 1, 2),
  pr as (select unique_key, cast(count(*) as int) as candidates, min(d) as nearest_m, (list(d order by d))[2] as second_m, arg_min(bin, (d, bin)) as nearest from gp group by 1),
  gm as (select *, case when candidates = 1 and nearest_m <= 25 then 'GEO_UNIQUE_25M' when nearest_m <= 10 and second_m - nearest_m >= 20 then 'GEO_DOMINANT_10M' end as method from pr),
  rs as (select e3.unique_key, reason as bbl_resolution_reason, coalesce(early, case when method is not null then nearest end) as resolved_bin, coalesce(early_method, method) as match_method, case when early is not null or method is not null then 'HIGH' end as match_confidence,
    case when early is not null then 'RESOLVED' when method is not null then 'AUTO_RESOLVED' end as resolution_status from e3 left join gm using (unique_key))"""


@C.add(f"with {SQL_EVENTS} select * from rs")
def q38_event_resolution_cascade(t: Tables) -> DataFrame:
    return event_resolution(t)


@C.add(f"with {SQL_EVENTS} select coalesce(match_method, 'UNRESOLVED') as method, count(*) as n, (select count(*) from calls) - (select count(*) from rs) as lost from rs group by 1")
def q39_cascade_reconciliation(t: Tables) -> DataFrame:
    c = event_resolution(t).groupBy(F.coalesce("match_method", F.lit("UNRESOLVED")).alias("method")).agg(F.count(F.lit(1)).alias("n"))
    calls, counted = t.nyc_311.select(message_key(F.col("unique_key")).alias("k")).agg(F.count_distinct("k")).scalar(), c.agg(F.sum("n")).scalar()
    return c.select("method", "n", (calls - counted).alias("lost"))


def lonely(t: Tables) -> DataFrame:
    """Complaints whose lot is no single building's: the geo stage alone, on more rows than the cascade leaves it."""
    return t.fact_311_event.where("building_id is null and latitude is not null and longitude is not null").select("event_id", "latitude", "longitude", T.borough(F.col("borough")).alias("boro"))


def lonely_pairs(t: Tables) -> DataFrame:
    e = lonely(t)
    return e.join(building_pairs(t, e.select("latitude", "longitude", "boro").distinct()), ["latitude", "longitude", "boro"])


_GP = f"""gp as (select e.event_id, b.bin, {SQL_DIST.format(a='e', b='b')} as distance_m from (select *, {sql_borough('borough')} as boro from fact_311_event where building_id is null) e join (select *, {sql_borough('borough')} as boro from building_identity) b on e.boro = b.boro and abs(e.latitude - b.latitude) < 0.002 and abs(e.longitude - b.longitude) < 0.003 where {SQL_DIST.format(a='e', b='b')} <= 100),
    pr as (select event_id, cast(count(*) as int) as candidates, min(d) as nearest_m, (list(d order by d))[2] as second_m, arg_min(bin, (d, bin)) as nearest from (select event_id, bin, min(distance_m) as d from gp group by 1, 2) group by 1)"""


@C.add(f"with {_GP} select event_id, bin, {sql_round('distance_m', 3)} as metres from gp")
def q35_geo_grid_candidates(t: Tables) -> DataFrame:
    return lonely_pairs(t).select("event_id", "bin", N.round_half_up(F.col("distance_m"), 3).alias("metres"))


@C.add(f"with {_GP} select event_id, candidates, nearest, {sql_round('nearest_m', 3)} as nearest_m, {sql_round('second_m', 3)} as second_m from pr")
def q36_geo_profile_nearest_two(t: Tables) -> DataFrame:
    r = lambda c: N.round_half_up(F.col(c), 3).alias(c)
    e = lonely(t)
    spot = R.geo_profile(building_pairs(t, e.select("latitude", "longitude", "boro").distinct()), ["latitude", "longitude", "boro"], "bin")
    return e.join(spot, ["latitude", "longitude", "boro"]).select("event_id", "candidates", "nearest", r("nearest_m"), r("second_m"))


_GM = "case when candidates = 1 and nearest_m <= 25 then 'GEO_UNIQUE_25M' when nearest_m <= 10 and second_m - nearest_m >= 20 then 'GEO_DOMINANT_10M' end"


@C.add(f"with {_GP} select event_id, nearest as bin, {_GM} as method from pr where {_GM} is not null")
def q37_geo_auto_resolve(t: Tables) -> DataFrame:
    e = lonely(t)
    p = R.geo_profile(building_pairs(t, e.select("latitude", "longitude", "boro").distinct()), ["latitude", "longitude", "boro"], "bin")
    p = p.select("latitude", "longitude", "boro", F.col("nearest").alias("bin"), R.geo_method(F.col("candidates"), F.col("nearest_m"), F.col("second_m")).alias("method")).where("method is not null")
    return e.join(p, ["latitude", "longitude", "boro"]).select("event_id", "bin", "method")


# --- buildings to lots -----------------------------------------------------------------------------------------------


def _street(c: str) -> Column:
    return T.address_full(T.street_part(F.col(c)))


def candidates(t: Tables, buildings: DataFrame, with_similarity: bool) -> DataFrame:
    """Lots that buildings may stand on, scored part by part.

    A building with a point gets the 25 nearest lots within 200 m of its borough (any, if it has none); one without gets
    25 of the lots whose street holds every token of its street up to slips, with its house number if it has one.
    """
    u = buildings.select("bin", F.col("latitude").alias("la"), F.col("longitude").alias("lo"), F.nullif(T.borough(F.col("borough")), F.lit("")).alias("bb"), T.house_number(F.col("current_address")).alias("bh"), F.nullif(_street("current_address"), F.lit("")).alias("bs"))
    p = t.dim_property.select("bbl", F.col("latitude").alias("lb"), F.col("longitude").alias("lob"), T.borough(F.col("borough")).alias("pb"), T.house_number(F.col("property_address")).alias("ph"), F.nullif(_street("property_address"), F.lit("")).alias("ps"))
    near = R.grid_pairs(u, p, 200, ("la", "lb"), ("lo", "lob")).where("bb is null or bb = pb").withColumnRenamed("distance_m", "distance")
    named = u.where("(la is null or lo is null) and bs is not null").withColumn("boro", F.explode(F.when(F.col("bb").isNotNull(), F.array("bb")).otherwise(F.array(*map(F.lit, T.BOROUGH_NAMES.values())))))
    streets = p.where("ps is not null").select(F.col("ps").alias("street"), F.col("pb").alias("boro")).distinct()
    fits = R.fuzzy_pairs(named.select(F.col("bs").alias("query"), "boro").distinct(), streets, "boro")
    like = named.join(fits.withColumnRenamed("query", "bs"), ["bs", "boro"]).join(p.withColumns({"street": F.col("ps"), "boro": F.col("pb")}), ["street", "boro"]).where("bh is null or bh = ph").withColumn("distance", F.lit(None).cast("double"))
    eq = lambda a, b: F.coalesce(F.col(a) == F.col(b), F.lit(False))
    sim = F.coalesce(R.street_similarity(F.col("bs"), F.col("ps")), F.lit(0.0)) if with_similarity else F.lit(0.0)
    cols = ["bin", "bbl", "distance", "bh", "ph", "bs", "ps", "bb", "pb"]
    both = near.select(*cols).unionByName(like.select(*cols))  # a building is on one side only
    g = R.nearest_candidates(both, "bin", [F.col("distance"), F.when(F.col("distance").isNull(), (F.col("bs") != F.col("ps")).cast("int")), F.col("bbl")])
    g = g.select("bin", "bbl", "distance", eq("bh", "ph").alias("house"), eq("bs", "ps").alias("street"), eq("bb", "pb").alias("same_borough"), sim.alias("similarity"))
    return g.withColumn("score", R.candidate_score(F.col("house"), F.col("street"), F.col("similarity"), F.col("same_borough"), F.col("distance")))


def resolver(t: Tables, buildings: DataFrame, with_similarity: bool = False) -> DataFrame:
    """(bin, bbl, score, status, confidence) for every building asked for."""
    asked = buildings.select("bin", (F.coalesce(F.col("current_address") != "", F.lit(False)) | F.col("latitude").isNotNull() | F.col("longitude").isNotNull()).alias("has_input"))
    return R.classify_candidates(candidates(t, buildings, with_similarity), "bin", "bbl", asked)


def unlisted(t: Tables) -> DataFrame:
    """Buildings whose own lot is not in the current snapshot."""
    return t.building_identity.join(t.dim_property.select(F.col("bbl").alias("current_bbl")), "current_bbl", "left_anti")


_HOUSE = "nullif(regexp_extract(upper(trim({c})), '^([0-9]+(?:-[0-9]+)?[A-Z]?)\\s+', 1), '')"
_STREET = "trim(regexp_replace(upper(trim({c})), '^[0-9]+(?:-[0-9]+)?[A-Z]?\\s+', ''))"


def _sql_resolver(buildings: str) -> str:
    far = SQL_DIST.format(a="u", b="p")
    return f"""
  cu as (select bin, latitude, longitude, nullif({sql_borough('borough')}, '') as bb, {_HOUSE.format(c='current_address')} as bh, nullif({sql_full(_STREET.format(c='current_address'))}, '') as bs, coalesce(current_address <> '', false) or latitude is not null or longitude is not null as has_input from ({buildings})),
  cp as (select bbl, latitude, longitude, {sql_borough('borough')} as pb, {_HOUSE.format(c='property_address')} as ph, nullif({sql_full(_STREET.format(c='property_address'))}, '') as ps from dim_property),
  cn as (select bin, bbl, {far} as distance, bh, ph, bs, ps, bb, pb from cu u join cp p on abs(u.latitude - p.latitude) < 0.0025 and abs(u.longitude - p.longitude) < 0.005 where (bb is null or bb = pb) and {far} <= 200 qualify row_number() over (partition by bin order by distance, bbl) <= 25),
  ca as (select bin, bbl, cast(null as double) as distance, bh, ph, bs, ps, bb, pb from cu u join cp p on (bb is null and pb in ('MANHATTAN', 'BRONX', 'BROOKLYN', 'QUEENS', 'STATEN ISLAND') or bb = pb) and (bh is null or bh = ph) where (u.latitude is null or u.longitude is null)
      and len(list_filter(string_split(bs, ' '), lambda q: len(list_filter(string_split(ps, ' '), lambda d: levenshtein(q, d) <= case when len(q) <= 2 then 0 when len(q) <= 5 then 1 else 2 end)) = 0)) = 0 qualify row_number() over (partition by bin order by cast(bs <> ps as int), bbl) <= 25),
  cj as (select bin, bbl, distance, coalesce(bh = ph, false) as house, coalesce(bs = ps, false) as street, coalesce(bb = pb, false) as sb from (select * from cn union all select * from ca)),
  ck as (select *, case when house then 40 else 0 end + case when street then 40 else 0 end + case when sb then 10 else 0 end + case when distance <= 25 then 10 when distance <= 50 then 8 when distance <= 100 then 5 when distance <= 200 then 2 else 0 end as score, house and street and sb and coalesce(distance <= 100, true) as ex from cj),
  cl as (select bin, count(*) filter (ex) as n, arg_min(bbl, (-score, coalesce(distance, 1e9), bbl)) as top, max(score) as best, arg_min(bbl, (-score, coalesce(distance, 1e9), bbl)) filter (ex) as tex, max(score) filter (ex) as bex from ck group by 1),
  cr as (select cu.bin, case when n = 1 then tex else top end as bbl, cast(case when n = 1 then bex else best end as double) as score, case when n = 1 then 'AUTO_RESOLVED' when n > 1 then 'AMBIGUOUS' when n is not null then 'REVIEW_REQUIRED' when has_input then 'NO_CANDIDATE' else 'NO_INPUT' end as status from cu left join cl using (bin))"""


@C.add(f"with {_sql_resolver('select * from building_identity where current_bbl is null or current_bbl not in (select bbl from dim_property)')} select * from cr")
def q41_candidate_score_classify(t: Tables) -> DataFrame:
    return resolver(t, unlisted(t)).select("bin", "bbl", F.col("score").cast("double").alias("score"), "status")


@C.add()
def q41b_candidate_similarity(t: Tables) -> DataFrame:
    return resolver(t, unlisted(t), True)


def identity_cascade(t: Tables) -> DataFrame:
    """(bin, bbl, method, confidence, status): the lot of each building by four stages; the last asks the candidate resolver.

    What the first three leave is made once before the resolver reads it several times."""
    known = t.dim_property.select("bbl", T.borough(F.col("borough")).alias("boro"), T.address_light(F.col("property_address")).alias("address"))
    by_address = known.where("address <> ''").select("boro", "address", F.col("bbl").alias("lot"))
    b = t.building_identity.select("bin", "current_bbl", "bbl_aliases", "current_address", "address_aliases", "borough", "latitude", "longitude")
    every = F.explode(F.array_compact(F.array_distinct(F.concat(F.array("current_address"), F.coalesce("address_aliases", F.array().cast("array<string>"))))))
    read = lambda df: df.select("bin", T.borough(F.col("borough")).alias("boro"), every.alias("a")).select("bin", "boro", T.address_light(F.col("a")).alias("address"))
    stages = [
        R.Stage("DIRECT_BBL", lambda df: df.join(known.select("bbl"), F.col("current_bbl") == F.col("bbl")).select("bin", "bbl")),
        R.Stage("BBL_HISTORY", lambda df: R.unique_target(df.select("bin", F.explode("bbl_aliases").alias("bbl")).join(known.select("bbl"), "bbl"), ["bin"], "bbl")),
        R.Stage("EXACT_ADDRESS", lambda df: R.unique_target(read(df).join(by_address, ["boro", "address"]), ["bin"], "lot").withColumnRenamed("lot", "bbl")),
        R.Stage("ELASTICSEARCH", lambda df: R.unique_target(resolver(t, cut(df)).where("status = 'AUTO_RESOLVED'").join(known.select("bbl"), "bbl"), ["bin"], "bbl")),
    ]
    return R.run_cascade(b, "bin", stages, "bbl")


SQL_IDENTITY = f"""
  lo as (select bbl, {sql_borough('borough')} as boro, {sql_light('property_address')} as address from dim_property),
  hi as (select bin, min(l.bbl) as bbl from (select bin, unnest(bbl_aliases) as bbl from building_identity) x join lo l on x.bbl = l.bbl group by 1 having count(distinct l.bbl) = 1),
  aa as (select bin, min(lo.bbl) as bbl from (select bin, {sql_borough('borough')} as boro, {sql_light('a')} as address from (select bin, borough, unnest(list_concat([current_address], coalesce(address_aliases, []))) as a from building_identity)) x join lo on x.boro = lo.boro and x.address = lo.address and lo.address <> '' group by 1 having count(distinct lo.bbl) = 1),
  i3 as (select b.*, coalesce(d.bbl, hi.bbl, aa.bbl) as found, case when d.bbl is not null then 'DIRECT_BBL' when hi.bbl is not null then 'BBL_HISTORY' when aa.bbl is not null then 'EXACT_ADDRESS' end as found_by from building_identity b left join lo d on b.current_bbl = d.bbl left join hi on hi.bin = b.bin left join aa on aa.bin = b.bin),
  {_sql_resolver('select * from i3 where found is null')},
  ic as (select i3.bin, coalesce(found, case when status = 'AUTO_RESOLVED' then cr.bbl end) as bbl, coalesce(found_by, case when status = 'AUTO_RESOLVED' then 'ELASTICSEARCH' else 'UNRESOLVED' end) as method from i3 left join cr on cr.bin = i3.bin)"""


@C.add(f"with {SQL_IDENTITY} select bin, bbl, method, case when bbl is null then 'NONE' else 'HIGH' end as confidence, case when bbl is null then 'UNRESOLVED' else 'RESOLVED' end as status from ic")
def q40_identity_cascade(t: Tables) -> DataFrame:
    return identity_cascade(t)


def _street_texts(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Distinct (query, boro) of the buildings and (street, boro) of the lots."""
    st = t.dim_property.where("property_address is not null").select(_street("property_address").alias("street"), T.borough(F.col("borough")).alias("boro")).distinct()
    qs = t.building_identity.where("current_address is not null").select(_street("current_address").alias("query"), T.borough(F.col("borough")).alias("boro")).distinct()
    return qs, st


@C.add(
    f"""with st as (select distinct {sql_full(_STREET.format(c='property_address'))} as street, {sql_borough('borough')} as boro from dim_property where property_address is not null),
    bs as (select distinct {sql_full(_STREET.format(c='current_address'))} as query, {sql_borough('borough')} as boro from building_identity where current_address is not null)
    select query, street, bs.boro from bs join st on bs.boro = st.boro where len(list_filter(string_split(query, ' '), lambda q: len(list_filter(string_split(street, ' '), lambda d: levenshtein(q, d) <= case when len(q) <= 2 then 0 when len(q) <= 5 then 1 else 2 end)) = 0)) = 0"""
)
def q42_fuzzy_token_match(t: Tables) -> DataFrame:
    """Street texts whose every token is near some token of a lot's street in the borough, in whatever order."""
    return R.fuzzy_pairs(*_street_texts(t), "boro")


# --- star schema -----------------------------------------------------------------------------------------------------

DIM_LOT = ["address", "borough", "zipcode", "landuse", "bldgclass", "yearbuilt", "unitsres", "numfloors", "lotarea", "ownername", "snapshot_version"]


def dim_property(t: Tables) -> DataFrame:
    return M.build_dim(lots(t), "PROP", "bbl", ["bbl", *DIM_LOT], "property_id").withColumnRenamed("address", "property_address")


_DIM_ROW = ", ".join(f"{c} desc nulls last" for c in DIM_LOT)


@C.add(f"with {SQL_LOTS} select 'PROP:' || bbl as property_id, bbl, address as property_address, borough, zipcode, landuse, bldgclass, cast(yearbuilt as double) as yearbuilt, cast(unitsres as double) as unitsres, numfloors, lotarea, ownername, snapshot_version from lots where bbl is not null qualify row_number() over (partition by bbl order by {_DIM_ROW}) = 1")
def q43_dim_property(t: Tables) -> DataFrame:
    return dim_property(t).withColumns({c: F.col(c).cast("double") for c in ("yearbuilt", "unitsres")})


DIM_BUILDING = ["property_id", "resolved_bbl", "current_bbl", "current_address", "borough", "latitude", "longitude", "bbl_aliases", "address_aliases", "identity_status", "match_method", "match_confidence", "resolution_status"]


def dim_building(t: Tables) -> DataFrame:
    return M.build_dim(t.building_identity.withColumn("property_id", F.concat(F.lit("PROP:"), F.col("resolved_bbl"))), "BLD", "bin", ["bin", *DIM_BUILDING], "building_id")


SQL_BUILDING = "db as (select 'BLD:' || bin as building_id, *, 'PROP:' || resolved_bbl as property_id from building_identity where regexp_matches(bin, '\\S'))"


@C.add(f"with {SQL_BUILDING} select building_id, bin, {', '.join(DIM_BUILDING)} from (select * replace (array_to_string(bbl_aliases, '|') as bbl_aliases, array_to_string(address_aliases, '|') as address_aliases) from db)")
def q44_dim_building(t: Tables) -> DataFrame:
    return dim_building(t).withColumns({c: F.array_join(c, "|") for c in ("bbl_aliases", "address_aliases")})


def bridge(t: Tables) -> DataFrame:
    return S.build_bridge(t.building_identity.select("bin", F.col("resolved_bbl").alias("bbl"))).dropDuplicates(["property_id", "building_id"])


@C.add(f"with {SQL_BUILDING} select distinct property_id, building_id, resolved_bbl as bbl, bin, 'CANONICAL' as relationship_type from db where property_id is not null")
def q45_bridge(t: Tables) -> DataFrame:
    return bridge(t)


def keys(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Narrow keys of both dimensions."""
    return dim_building(t).select("bin", "building_id", "property_id"), t.dim_property.select("bbl", "property_id")


ARBITRATED = ["property_id", "building_id", "source_property_id", "building_property_id", "property_resolution_method", "property_conflict_flag", "building_resolution_status"]


def fact_complaints(t: Tables) -> DataFrame:
    x = complaints(t).withColumnRenamed("bbl", "source_bbl").join(event_resolution(t).drop("bbl_resolution_reason"), "unique_key", "left")
    x = x.withColumns({"created_day": F.dayofmonth("created_date"), "created_year": F.year("created_date"), "created_month": F.month("created_date")})
    return M.build_fact(x, "event_id", "311", "unique_key", "resolved_bin", "source_bbl", *keys(t))


def fact_housing(t: Tables) -> DataFrame:
    x = housing(t).drop("source_bbl").withColumnsRenamed({"bin": "source_bin", "bbl": "source_bbl_original"})
    x = x.withColumns({"inspection_day": F.dayofmonth("inspectiondate"), "inspection_year": F.year("inspectiondate"), "inspection_month": F.month("inspectiondate")})
    return M.build_fact(x, "hpd_event_id", "HPD", "violationid", "source_bin", "source_bbl_original", *keys(t))


def fact_safety(t: Tables) -> DataFrame:
    x = safety(t).drop("source_bbl").withColumnsRenamed({"bin": "source_bin", "bbl": "source_bbl_original", "event_day": "violation_day", "event_year": "violation_year", "event_month": "violation_month"})
    return M.build_fact(x, "dob_event_id", "DOB", "violation_number", "source_bin", "source_bbl_original", *keys(t))


def _sql_fact(name: str, source: str, prefix: str, key: str, event_id: str, building: str, lot: str) -> str:
    return f"""{name} as (select '{prefix}:' || {key} as {event_id}, x.*, d.building_id, d.property_id as building_property_id, p.property_id as source_property_id,
    case when d.property_id is not null then d.property_id when d.building_id is null then p.property_id end as property_id,
    case when d.property_id is not null then 'BUILDING_CANONICAL' when d.building_id is null and p.property_id is not null then 'SOURCE_BBL' else 'UNRESOLVED' end as property_resolution_method,
    case when d.property_id <> p.property_id then 1 else 0 end as property_conflict_flag, case when d.building_id is not null then 'RESOLVED' else 'UNRESOLVED' end as building_resolution_status
    from ({source}) x left join (select trim(bin) as k, building_id, property_id from db) d on trim(x.{building}) = d.k left join dim_property p on x.{lot} = p.bbl)"""


SQL_FACT_COMPLAINTS = f"{SQL_EVENTS}, {SQL_BUILDING}, {_sql_fact('fc', 'select calls.* exclude (bbl), calls.bbl as source_bbl, rs.* exclude (unique_key, bbl_resolution_reason) from calls join rs using (unique_key)', '311', 'unique_key', 'event_id', 'resolved_bin', 'source_bbl')}"
SQL_FACT_HOUSING = f"{SQL_HOUSING}, {SQL_BUILDING}, {_sql_fact('fh', 'select * exclude (bin, bbl, source_bbl), bin as source_bin, bbl as source_bbl_original from housing', 'HPD', 'violationid', 'hpd_event_id', 'source_bin', 'source_bbl_original')}"
SQL_FACT_SAFETY = f"{SQL_SAFETY}, {SQL_BUILDING}, {_sql_fact('fs', 'select * exclude (bin, bbl), bin as source_bin, bbl as source_bbl_original from safety', 'DOB', 'violation_number', 'dob_event_id', 'source_bin', 'source_bbl_original')}"
_ARB = ", ".join(ARBITRATED)
_CALL_OUT = ["event_id", "unique_key", "resolved_bin", "source_bbl", "match_method", "match_confidence", "resolution_status", "agency", "complaint_type", "status", "incident_address", "borough"]
_HOUSING_OUT = ["hpd_event_id", "violationid", "source_bin", "source_bbl_original", "bbl_source", "class", "violationstatus", "boro", "housenumber", "streetname"]
_SAFETY_OUT = ["dob_event_id", "violation_number", "source_bin", "source_bbl_original", "bbl_source", "violation_status", "borough", "house_number", "street"]


def _sql_day(c: str, p: str) -> str:
    return f"cast(day({c}) as int) as {p}_day, cast(year({c}) as int) as {p}_year, cast(month({c}) as int) as {p}_month"


@C.add(f"with {SQL_FACT_COMPLAINTS} select {', '.join(_CALL_OUT)}, {_ARB}, {_sql_day('created_date', 'created')} from fc")
def q46_fact_with_property_arbitration(t: Tables) -> DataFrame:
    return fact_complaints(t).select(*_CALL_OUT, *ARBITRATED, "created_day", "created_year", "created_month")


@C.add(f"with {SQL_FACT_HOUSING} select {', '.join(_HOUSING_OUT)}, {_ARB}, {_sql_day('inspectiondate', 'inspection')} from fh")
def q46b_fact_housing(t: Tables) -> DataFrame:
    return fact_housing(t).select(*_HOUSING_OUT, *ARBITRATED, "inspection_day", "inspection_year", "inspection_month")


@C.add(f"with {SQL_FACT_SAFETY} select {', '.join(_SAFETY_OUT)}, {_ARB}, {_sql_day('violation_issue_date', 'violation')} from fs")
def q46c_fact_safety(t: Tables) -> DataFrame:
    return fact_safety(t).select(*_SAFETY_OUT, *ARBITRATED, "violation_day", "violation_year", "violation_month")


# --- gates -----------------------------------------------------------------------------------------------------------

FACTS = {"fact_311_event": "event_id", "fact_hpd_violation": "hpd_event_id", "fact_dob_violation": "dob_event_id"}
_ORPHAN = "(select count(distinct {k}) from {f} where {k} is not null and {k} not in (select {k} from {d}))"


@C.add(f"with {SQL_BUILDING} " + " union all ".join(f"select '{f}' as fact_table, {_ORPHAN.format(k='property_id', f=f, d='dim_property')} as property_orphans, {_ORPHAN.format(k='building_id', f=f, d='db')} as building_orphans" for f in FACTS))
def q47_fk_orphans(t: Tables) -> DataFrame:
    """Distinct references to nothing in each stored fact."""
    spark, b = t.dim_property.sparkSession, dim_building(t).select("building_id")
    rows = [spark.range(1).select(F.lit(f).alias("fact_table"), Q.orphan_keys(getattr(t, f), "property_id", t.dim_property).alias("property_orphans"), Q.orphan_keys(getattr(t, f), "building_id", b).alias("building_orphans")) for f in FACTS]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def shown(g: DataFrame) -> DataFrame:
    return g.select("name", "value", "ok")


def sql_gate(*rows: tuple[str, str, str]) -> str:
    """name, value and the test of the value ``v``."""
    return " union all ".join(f"select '{n}' as name, cast(v as double) as value, coalesce({ok}, false) as ok from (select {v} as v)" for n, v, ok in rows)


@C.add(f"with {SQL_LOTS} " + sql_gate(("rows", "(select count(*) from lots)", "v >= 1"), ("missing_bbl", "(select count(*) from lots where coalesce(not regexp_matches(bbl, '\\S'), true))", "v = 0"), ("duplicate_bbl", "(select count(bbl) - count(distinct bbl) from lots)", "v = 0")))
def q67_snapshot_gate(t: Tables) -> DataFrame:
    """Missing and repeated keys of the current snapshot; repeated lots are a failure here, not dropped."""
    return shown(Q.snapshot_gate(lots(t), "bbl"))


@C.add(f"with {SQL_HOUSING} " + sql_gate(*[(f"missing_{c}", f"(select count(*) from housing where coalesce(not regexp_matches(cast({c} as varchar), '\\S'), true))", "v = 0") for c in ("bin", "latitude", "longitude", "bbl", "inspectiondate")]))
def q68_source_report(t: Tables) -> DataFrame:
    """What housing violations lack; reported, only a missing date would block."""
    e = [Q.missing(c) for c in ("bin", "latitude", "longitude", "bbl")]
    return shown(Q.evaluate(housing(t), [*[Q.Expectation(x.name, x.measure, blocking=False) for x in e], Q.missing("inspectiondate")]))


@C.add(sql_gate(("rows", "(select count(*) from building_identity)", "v >= 1"), ("duplicate_bin", "(select count(bin) - count(distinct bin) from building_identity)", "v = 0"), ("coverage", "(select floor(count(*) filter (resolution_status = 'RESOLVED') * 100.0 / count(*) * 100 + 0.5) / 100 from building_identity)", "v between 95 and 100")))
def q69_identity_gate(t: Tables) -> DataFrame:
    """One row a building and at least 95 % of them with a lot."""
    share = N.round_half_up(F.try_divide(F.count_if(F.col("resolution_status") == "RESOLVED") * 100.0, F.count(F.lit(1))))
    return shown(Q.evaluate(t.building_identity, [Q.not_empty(), Q.duplicates("bin"), Q.Expectation("coverage", share, 95, 100)]))


@C.add(
    f"with {SQL_BUILDING}, br as (select distinct property_id, building_id from db where property_id is not null) "
    + sql_gate(
        ("property_repeated_id", "(select count(*) - count(distinct property_id) from dim_property)", "v = 0"),
        ("property_repeated_bbl", "(select count(*) - count(distinct bbl) from dim_property)", "v = 0"),
        ("building_repeated_id", "(select count(*) - count(distinct building_id) from db)", "v = 0"),
        ("building_rows", "(select count(*) from db)", "v = (select count(*) from building_identity)"),
        ("bridge_repeated_pairs", "(select count(*) from br) - (select count(*) from (select distinct * from br))", "v = 0"),
        ("bridge_rows", "(select count(*) from br)", "v = (select count(property_id) from db)"),
        ("bridge_buildings", "(select count(distinct building_id) from br)", "v = (select count(*) from br)"),
        ("building_property_orphans", _ORPHAN.format(k="property_id", f="db", d="dim_property"), "v = 0"),
        ("bridge_property_orphans", _ORPHAN.format(k="property_id", f="br", d="dim_property"), "v = 0"),
        ("bridge_building_orphans", _ORPHAN.format(k="building_id", f="br", d="db"), "v = 0"),
    )
)
def q70_star_gate(t: Tables) -> DataFrame:
    return shown(Q.star_gate(t.dim_property, dim_building(t), bridge(t), t.building_identity))


def _sql_fact_gate(source: str, key: str, fact: str, fact_key: str, resolved: bool = False) -> str:
    rows = [
        ("source_rows", f"(select count(*) from {source})", "v >= 1"),
        (f"source_null_{key}", f"(select count(*) from {source} where {key} is null)", "v = 0"),
        (f"source_repeated_{key}", f"(select count({key}) - count(distinct {key}) from {source})", "v = 0"),
        ("fact_rows", f"(select count(*) from {fact})", f"v = (select count(*) from {source})"),
        (f"fact_null_{fact_key}", f"(select count(*) from {fact} where {fact_key} is null)", "v = 0"),
        (f"fact_repeated_{fact_key}", f"(select count({fact_key}) - count(distinct {fact_key}) from {fact})", "v = 0"),
        ("building_orphans", _ORPHAN.format(k="building_id", f=fact, d="db"), "v = 0"),
        ("property_orphans", _ORPHAN.format(k="property_id", f=fact, d="dim_property"), "v = 0"),
    ]
    if resolved:
        rows.append(("resolved_without_building", f"(select count(*) from {fact} where resolved_bin is not null and building_id is null)", "v = 0"))
    return sql_gate(*rows)


@C.add(f"with {SQL_FACT_COMPLAINTS} {_sql_fact_gate('calls', 'unique_key', 'fc', 'event_id', True)}")
def q71_fact_gate_complaints(t: Tables) -> DataFrame:
    fact = cut_fact(fact_complaints(t), "event_id", "resolved_bin")
    return shown(Q.fact_gate(complaints(t).select("unique_key"), "unique_key", fact, "event_id", t.dim_property, dim_building(t), "resolved_bin"))


@C.add(f"with {SQL_FACT_HOUSING} {_sql_fact_gate('housing', 'violationid', 'fh', 'hpd_event_id')}")
def q72_fact_gate_housing(t: Tables) -> DataFrame:
    return shown(Q.fact_gate(housing(t).select("violationid"), "violationid", cut_fact(fact_housing(t), "hpd_event_id"), "hpd_event_id", t.dim_property, dim_building(t)))


@C.add(f"with {SQL_FACT_SAFETY} {_sql_fact_gate('safety', 'violation_number', 'fs', 'dob_event_id')}")
def q73_fact_gate_safety(t: Tables) -> DataFrame:
    return shown(Q.fact_gate(safety(t).select("violation_number"), "violation_number", cut_fact(fact_safety(t), "dob_event_id"), "dob_event_id", t.dim_property, dim_building(t)))


def cut_fact(fact: DataFrame, key: str, *more: str) -> DataFrame:
    """The columns a gate reads, made once: gates read what was written, not the plan again."""
    return cut(fact.select(key, "building_id", "property_id", *more))
