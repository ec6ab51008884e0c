"""Catalogue: event features, scores of buildings and lots, serving, dashboards, calibration and the gates of all these."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.functions import numbers as N
from lotline.functions.text import blank_to_null, borough
from lotline.operators import model as M
from lotline.operators import quality as Q
from lotline.operators import resolve as R
from lotline.operators import serving as S
from lotline.plans.basics import SQL_DIST, sql_borough, sql_round
from lotline.plans.registry import Catalog, Tables
from lotline.plans.star import SQL_BUILDING, day, dim_building, shown, sql_gate

C = Catalog()

# Caps, weights, levels, labels and versions of the two models.
BUILDING_MODEL = M.ScoreModel(
    components=(
        M.Component("311", {"complaints_0_30": 3, "complaints_31_90": 2, "complaints_91_365": 1}, 96, 0.25),
        M.Component("hpd_severity", {"hpd_open_class_a": 1, "hpd_open_class_b": 2, "hpd_open_class_c": 4}, 102, 0.28),
        M.Component("hpd_recency", {"hpd_0_30": 3, "hpd_31_90": 2, "hpd_91_365": 1}, 104, 0.12),
        M.Component("dob_active", {"dob_active_violations": 1}, 4, 0.15),
        M.Component("dob_recency", {"dob_0_30": 3, "dob_31_90": 2, "dob_91_365": 1}, 6, 0.10),
        M.Component("building_age_final", {"building_age": 1}, 160, 0.10, scale="linear", missing=60),
    ),
    levels=(("CRITICAL", 74.81), ("HIGH", 54.52), ("MEDIUM", 22.98)),
)
PROPERTY_CAPS = {"311": 24, "hpd_severity": 170, "hpd_recency": 110}
PROPERTY_WEIGHTS = {"311": 25.0, "hpd_severity": 28.0, "hpd_recency": 12.0}
PROPERTY_LEVELS = M.ScoreModel((), (("CRITICAL", 79.63), ("HIGH", 59.87), ("MEDIUM", 24.80)))
UPLIFT_FACTOR = 0.5
UPLIFT_LEVELS = M.ScoreModel((), (("CRITICAL", 78.96), ("HIGH", 59.67), ("MEDIUM", 24.82)))
LEVELS = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
SOURCES = ["BUILDING_PLUS_PROPERTY_EVENTS", "BUILDING_ONLY", "PROPERTY_EVENTS_ONLY", "NO_RISK_DATA"]
MODEL_VERSION = "building_risk_v1"

AGES = (("0_30", 0, 30), ("31_90", 31, 90), ("91_365", 91, 365), ("365", 0, 365))
COUNTS = [*[f"complaints_{n}" for n, *_ in AGES], *[f"hpd_open_class_{k}" for k in "abci"], "hpd_active_violations", *[f"hpd_{n}" for n, *_ in AGES], "dob_active_violations", *[f"dob_{n}" for n, *_ in AGES]]
HISTORY = ["has_311_history", "has_hpd_history", "has_dob_history"]
CONTEXT = ["yearbuilt", "yearalter1", "yearalter2", "numbldgs", "numfloors", "unitsres", "unitstotal", "lotarea", "bldgarea", "resarea", "comarea", "landuse", "bldgclass"]


def as_of(t: Tables) -> DataFrame:
    return M.as_of_date([(t.fact_311_event, "created_date"), (t.fact_hpd_violation, "inspectiondate"), (t.fact_dob_violation, "violation_issue_date")])


def _ages(p: str, ages=AGES) -> M.Buckets:
    return M.Buckets(tuple((f"{p}_{n}", lo, hi) for n, lo, hi in ages))


def _open(*classes: str) -> dict[str, Column]:
    return {k: (F.col("violationstatus") == "OPEN") & (F.col("class") == k.upper()) for k in classes}


def building_features(t: Tables) -> DataFrame:
    """One row a building of the dimension; events are counted per fact before they are joined."""
    when = as_of(t)
    one = lambda df, n: df.withColumn(n, F.lit(1))
    a = M.event_features(t.fact_311_event, "building_id", "created_date", when, _ages("complaints"))
    b = M.event_features(t.fact_hpd_violation, "building_id", "inspectiondate", when, _ages("hpd"), {**{f"hpd_open_class_{k}": c for k, c in _open(*"abci").items()}, "hpd_active_violations": F.col("violationstatus") == "OPEN"})
    c = M.event_features(t.fact_dob_violation, "building_id", "violation_issue_date", when, _ages("dob"), {"dob_active_violations": F.col("violation_status") == "ACTIVE"})
    context = t.dim_property.select("property_id", *[F.col(x).alias(f"property_{x}") for x in CONTEXT])
    base = dim_building(t).select("building_id", "bin", "property_id", "current_address", "borough", "latitude", "longitude").join(context, "property_id", "left")
    out = base
    for df, flag in zip((a, b, c), HISTORY, strict=True):
        out = out.join(one(df, flag), "building_id", "left")
    year = F.year("as_of")
    built = F.col("property_yearbuilt")
    usable = (F.col("property_numbldgs") == 1) & (F.col("property_unitsres") > 0)
    out = out.na.fill(0, [*COUNTS, *HISTORY]).withColumn("as_of", when.scalar())
    return out.withColumns({"building_age": F.when((built > 0) & (built <= year), year - built), "units_normalization_eligible": F.when(usable, 1).otherwise(0), "units_for_normalization": F.when(usable, F.col("property_unitsres"))})


def _age_sql(p: str, ages=AGES) -> str:
    return ", ".join(f"count(*) filter (age between {lo} and {hi}) as {p}_{n}" for n, lo, hi in ages)


def _open_sql(p: str, classes: str) -> str:
    return ", ".join(f"count(*) filter (violationstatus = 'OPEN' and \"class\" = '{k.upper()}') as {p}_{k}" for k in classes)


_AGED = "select *, datediff('day', cast({c} as date), as_of) as age from {f}, ao"
SQL_FEATURES = f"""{SQL_BUILDING},
  ao as (select least((select max(cast(created_date as date)) from fact_311_event), (select max(cast(inspectiondate as date)) from fact_hpd_violation), (select max(cast(violation_issue_date as date)) from fact_dob_violation)) as as_of),
  f1 as (select building_id, {_age_sql('complaints')} from ({_AGED.format(c='created_date', f='fact_311_event')}) where age >= 0 and building_id is not null group by 1),
  f2 as (select building_id, {_open_sql('hpd_open_class', 'abci')}, count(*) filter (violationstatus = 'OPEN') as hpd_active_violations, {_age_sql('hpd')} from ({_AGED.format(c='inspectiondate', f='fact_hpd_violation')}) where age >= 0 and building_id is not null group by 1),
  f3 as (select building_id, count(*) filter (violation_status = 'ACTIVE') as dob_active_violations, {_age_sql('dob')} from ({_AGED.format(c='violation_issue_date', f='fact_dob_violation')}) where age >= 0 and building_id is not null group by 1),
  ft as (select db.building_id, db.bin, db.property_id, db.current_address, db.borough, db.latitude, db.longitude, as_of, {', '.join(f'coalesce({c}, 0) as {c}' for c in COUNTS)},
      case when f1.building_id is null then 0 else 1 end as has_311_history, case when f2.building_id is null then 0 else 1 end as has_hpd_history, case when f3.building_id is null then 0 else 1 end as has_dob_history, p.numbldgs, p.unitsres, p.yearbuilt,
      case when p.yearbuilt > 0 and p.yearbuilt <= year(as_of) then year(as_of) - p.yearbuilt end as building_age, case when p.numbldgs = 1 and p.unitsres > 0 then 1 else 0 end as units_normalization_eligible
    from db left join dim_property p on db.property_id = p.property_id left join f1 on f1.building_id = db.building_id left join f2 on f2.building_id = db.building_id left join f3 on f3.building_id = db.building_id, ao)"""


def _sql_log(x: str, cap: int) -> str:
    return f"ln(1 + least(cast({x} as double), {float(cap)})) / ln({cap + 1.0}) * 100"


SQL_PARTS = {
    "311": _sql_log("3 * complaints_0_30 + 2 * complaints_31_90 + complaints_91_365", 96),
    "hpd_severity": _sql_log("hpd_open_class_a + 2 * hpd_open_class_b + 4 * hpd_open_class_c", 102),
    "hpd_recency": _sql_log("3 * hpd_0_30 + 2 * hpd_31_90 + hpd_91_365", 104),
    "dob_active": _sql_log("dob_active_violations", 4),
    "dob_recency": _sql_log("3 * dob_0_30 + 2 * dob_31_90 + dob_91_365", 6),
    "building_age_final": "case when building_age is null then 60.0 else least(cast(building_age as double), 160.0) / 160.0 * 100 end",
}
_TOTAL = f"0.25 * ({SQL_PARTS['311']}) + 0.28 * ({SQL_PARTS['hpd_severity']}) + 0.12 * ({SQL_PARTS['hpd_recency']}) + 0.15 * ({SQL_PARTS['dob_active']}) + 0.10 * ({SQL_PARTS['dob_recency']}) + 0.10 * ({SQL_PARTS['building_age_final']})"
SQL_SCORES = f"""{SQL_FEATURES},
  sc as (select *, {sql_round(_TOTAL)} as building_risk_score, {', '.join(f'{sql_round(x, 4)} as score_{n}' for n, x in SQL_PARTS.items())} from ft),
  lv as (select *, case when building_risk_score >= 74.81 then 'CRITICAL' when building_risk_score >= 54.52 then 'HIGH' when building_risk_score >= 22.98 then 'MEDIUM' else 'LOW' end as risk_level from sc)"""


def scores(t: Tables) -> DataFrame:
    """Features, score_<component>, building_risk_score, risk_level, age_imputed_flag, risk_as_of_date and model_version."""
    s = BUILDING_MODEL.apply(building_features(t)).withColumnsRenamed({"score": "building_risk_score", "level": "risk_level", "as_of": "risk_as_of_date"})
    return s.withColumns({"age_imputed_flag": F.col("building_age").isNull().cast("int"), "model_version": F.lit(MODEL_VERSION)})


PARTS = [f"score_{c.name}" for c in BUILDING_MODEL.components]
_SHOWN = ["complaints_0_30", "complaints_31_90", "complaints_91_365", "hpd_open_class_a", "hpd_open_class_b", "hpd_open_class_c", "hpd_open_class_i", "hpd_active_violations", "dob_active_violations"]


@C.add(f"with {SQL_SCORES} select building_id, property_id, building_risk_score, risk_level, {', '.join(PARTS)}, {', '.join(_SHOWN)}, cast(building_age as double) as building_age, case when building_age is null then 1 else 0 end as age_imputed_flag, units_normalization_eligible, {', '.join(HISTORY)}, strftime(as_of, '%Y-%m-%d') as risk_as_of_date from lv")
def q30_entity_risk_score(t: Tables) -> DataFrame:
    part = [N.round_half_up(F.col(c), 4).alias(c) for c in PARTS]
    return scores(t).select("building_id", "property_id", "building_risk_score", "risk_level", *part, *_SHOWN, F.col("building_age").cast("double").alias("building_age"), "age_imputed_flag", "units_normalization_eligible", *HISTORY, day("risk_as_of_date").alias("risk_as_of_date"))


_ROLL = f"ro as (select property_id, count(distinct building_id) as children, max(building_risk_score) as max_score, {sql_round('avg(building_risk_score)', 4)} as avg_score from lv where property_id is not null group by 1)"


@C.add(f"with {SQL_SCORES}, {_ROLL} select * from ro")
def q31_entity_rollup_max_avg(t: Tables) -> DataFrame:
    return M.rollup(scores(t), "property_id", "building_risk_score")


def property_events(t: Tables) -> DataFrame:
    """Events known by lot only, one row a lot: counts, raw signals, component scores and property_only_risk_score.

    Signals count only if they are there: the weights of the others are left out of the mean.
    """
    when = as_of(t)
    a = M.event_features(t.fact_311_event.where("building_id is null"), "property_id", "created_date", when, _ages("property_311", AGES[:3]))
    b = M.event_features(t.fact_hpd_violation.where("building_id is null"), "property_id", "inspectiondate", when, _ages("property_hpd", AGES[:3]), {f"property_hpd_open_class_{k}": c for k, c in _open(*"abc").items()})
    x = a.join(b, "property_id", "full").na.fill(0)
    weigh = lambda p: F.col(f"{p}_0_30") * 3 + F.col(f"{p}_31_90") * 2 + F.col(f"{p}_91_365")
    x = x.withColumns({"property_risk_311_raw": weigh("property_311"), "property_risk_hpd_severity_raw": F.col("property_hpd_open_class_a") + F.col("property_hpd_open_class_b") * 2 + F.col("property_hpd_open_class_c") * 4, "property_risk_hpd_recency_raw": weigh("property_hpd")})
    x = x.withColumns({f"property_score_{k}": N.log_score(F.col(f"property_risk_{k}_raw"), cap) for k, cap in PROPERTY_CAPS.items()})
    has = {"311": F.col("property_risk_311_raw") > 0}
    has["hpd_severity"] = has["hpd_recency"] = (F.col("property_risk_hpd_severity_raw") > 0) | (F.col("property_risk_hpd_recency_raw") > 0)
    return x.withColumn("property_only_risk_score", N.available_mean([(F.when(has[k], F.col(f"property_score_{k}")), w) for k, w in PROPERTY_WEIGHTS.items()]))


_PE = f"""
  p1 as (select property_id, {_age_sql('property_311', AGES[:3])} from ({_AGED.format(c='created_date', f='fact_311_event')}) where age >= 0 and property_id is not null and building_id is null group by 1),
  p2 as (select property_id, {_age_sql('property_hpd', AGES[:3])}, {_open_sql('property_hpd_open_class', 'abc')} from ({_AGED.format(c='inspectiondate', f='fact_hpd_violation')}) where age >= 0 and property_id is not null and building_id is null group by 1),
  pr as (select property_id, coalesce(3 * property_311_0_30 + 2 * property_311_31_90 + property_311_91_365, 0) as r1, coalesce(property_hpd_open_class_a + 2 * property_hpd_open_class_b + 4 * property_hpd_open_class_c, 0) as r2, coalesce(3 * property_hpd_0_30 + 2 * property_hpd_31_90 + property_hpd_91_365, 0) as r3 from p1 full join p2 using (property_id)),
  pw as (select *, case when r1 > 0 then 1 else 0 end as h1, case when r2 > 0 or r3 > 0 then 1 else 0 end as h2, {_sql_log('r1', 24)} as s1, {_sql_log('r2', 170)} as s2, {_sql_log('r3', 110)} as s3 from pr),
  pe as (select *, case when h1 + h2 > 0 then (25 * s1 * h1 + 28 * s2 * h2 + 12 * s3 * h2) / (25.0 * h1 + 40.0 * h2) end as only_score from pw)"""


@C.add(f"with {SQL_FEATURES}, {_PE} select property_id, r1 as property_risk_311_raw, r2 as property_risk_hpd_severity_raw, r3 as property_risk_hpd_recency_raw, {sql_round('only_score', 4)} as property_only_risk_score from pe")
def q32_availability_weighted_score(t: Tables) -> DataFrame:
    return property_events(t).select("property_id", *[f"property_risk_{k}_raw" for k in PROPERTY_CAPS], N.round_half_up(F.col("property_only_risk_score"), 4).alias("property_only_risk_score"))


EVENT_COLUMNS = [*[f"property_{s}_{n}" for s in ("311", "hpd") for n, *_ in AGES[:3]], *[f"property_hpd_open_class_{k}" for k in "abc"], *[f"property_risk_{k}_raw" for k in PROPERTY_CAPS]]


def property_scores(t: Tables) -> DataFrame:
    """One row a lot of the dimension: the greater of its buildings' greatest score and the score of its own events."""
    lots = t.dim_property.select("property_id", "bbl", "property_address", "borough", "zipcode", "latitude", "longitude", "yearbuilt", "numbldgs", "numfloors", "unitsres", "unitstotal", "landuse", "bldgclass")
    built = M.rollup(scores(t), "property_id", "building_risk_score").withColumnsRenamed({"children": "building_count", "max_score": "max_building_risk_score", "avg_score": "avg_building_risk_score"})
    x = lots.join(built, "property_id", "left").join(property_events(t), "property_id", "left")
    x = x.na.fill(0, ["building_count", *EVENT_COLUMNS]).na.fill(0.0, [f"property_score_{k}" for k in PROPERTY_CAPS])
    a, b = F.col("max_building_risk_score"), F.col("property_only_risk_score")
    source = F.when(a.isNotNull() & b.isNotNull(), SOURCES[0]).when(a.isNotNull(), SOURCES[1]).when(b.isNotNull(), SOURCES[2]).otherwise(SOURCES[3])
    x = x.withColumns({"property_risk_score": N.round_half_up(F.greatest(a, b)), "property_risk_source": source, "risk_as_of_date": as_of(t).scalar(), "model_version": F.lit(MODEL_VERSION)})
    return x.withColumn("property_risk_level", PROPERTY_LEVELS.level(F.col("property_risk_score")))


_LEVEL = "case when {s} is null then 'NO_DATA' when {s} < {a} then 'LOW' when {s} < {b} then 'MEDIUM' when {s} < {c} then 'HIGH' else 'CRITICAL' end"
SQL_PROPERTIES = f"""{SQL_SCORES}, {_PE}, {_ROLL},
  px as (select d.*, coalesce(children, 0) as building_count, max_score, avg_score, only_score, {sql_round('greatest(max_score, only_score)')} as property_risk_score, coalesce(s1, 0) as s1, coalesce(s2, 0) as s2, coalesce(s3, 0) as s3, coalesce(r1, 0) as r1, coalesce(r2, 0) as r2, coalesce(r3, 0) as r3,
    case when max_score is not null and only_score is not null then 'BUILDING_PLUS_PROPERTY_EVENTS' when max_score is not null then 'BUILDING_ONLY' when only_score is not null then 'PROPERTY_EVENTS_ONLY' else 'NO_RISK_DATA' end as property_risk_source from dim_property d left join ro using (property_id) left join pe using (property_id)),
  ps as (select *, {_LEVEL.format(s='property_risk_score', a='24.80', b='59.87', c='79.63')} as property_risk_level from px)"""


@C.add(f"with {SQL_PROPERTIES} select property_id, property_risk_score, property_risk_level, property_risk_source, building_count, max_score as max_building_risk_score, avg_score as avg_building_risk_score, {sql_round('only_score', 4)} as property_only_risk_score from ps")
def q33_property_risk_max(t: Tables) -> DataFrame:
    return property_scores(t).select("property_id", "property_risk_score", "property_risk_level", "property_risk_source", "building_count", "max_building_risk_score", "avg_building_risk_score", N.round_half_up(F.col("property_only_risk_score"), 4).alias("property_only_risk_score"))


_UP = sql_round("case when max_score is not null and only_score is not null then max_score + (100 - max_score) * only_score / 100 * 0.5 else coalesce(max_score, only_score) end")


@C.add(f"with {SQL_PROPERTIES}, up as (select property_id, {_UP} as score from ps) select property_id, score, {_LEVEL.format(s='score', a='24.82', b='59.67', c='78.96')} as level from up")
def q34_property_risk_uplift(t: Tables) -> DataFrame:
    """The older model: events of the lot lift the buildings' greatest score by half of what is left to 100."""
    a, b = F.col("max_building_risk_score"), F.col("property_only_risk_score")
    lifted = F.when(a.isNotNull() & b.isNotNull(), a + (F.lit(100) - a) * b / 100 * UPLIFT_FACTOR).otherwise(F.coalesce(a, b))
    return property_scores(t).select("property_id", N.round_half_up(lifted).alias("score")).withColumn("level", UPLIFT_LEVELS.level(F.col("score")))


# --- profiles and calibration ----------------------------------------------------------------------------------------


@C.add(f"select {sql_borough('borough')} as borough, count(*) as n, count(distinct bbl) as lots, count(distinct incident_address) as addresses, count(distinct agency) as agencies, count(*) filter (bbl is null or trim(bbl) = '') as no_lot from nyc_311 group by 1")
def q48_dq_profile(t: Tables) -> DataFrame:
    return t.nyc_311.groupBy(borough(F.col("borough")).alias("borough")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("bbl").alias("lots"), F.count_distinct("incident_address").alias("addresses"), F.count_distinct("agency").alias("agencies"), F.count_if(F.col("bbl").isNull() | (F.trim("bbl") == "")).alias("no_lot")
    )


@C.add(
    "with e as (select cast(count(*) as double) as r, cast(count(*) filter (bin is null or not regexp_matches(bin, '\\S')) as double) as m, cast(count(bin) - count(distinct bin) as double) as d, cast(count(*) filter (current_bbl is null or not regexp_matches(current_bbl, '\\S')) as double) as mb from building_identity) select 'rows' as name, r as value, r >= 1 as ok from e union all select 'missing_bin', m, m = 0 from e union all select 'duplicate_bin', d, d = 0 from e union all select 'missing_current_bbl', mb, mb = 0 from e"
)
def q49_grain_checks(t: Tables) -> DataFrame:
    return shown(Q.evaluate(t.building_identity, [Q.not_empty(), Q.missing("bin"), Q.duplicates("bin"), Q.missing("current_bbl")]))


_OUT_PARTS = " or ".join(f"score_{n} is null or score_{n} not between 0 and 100" for n in SQL_PARTS)


def score_rules() -> list[Q.Expectation]:
    return [Q.missing("building_risk_score"), Q.outside("building_risk_score", 0, 100), Q.not_in("risk_level", LEVELS), Q.when_wrong("outside_component", Q.any_of([~F.col(c).between(0, 100) for c in PARTS]))]


@C.add(
    f"with {SQL_SCORES} "
    + sql_gate(
        ("missing_building_risk_score", "(select count(*) from lv where building_risk_score is null)", "v = 0"),
        ("outside_building_risk_score", "(select count(*) from lv where not coalesce(building_risk_score between 0 and 100, false))", "v = 0"),
        ("invalid_risk_level", "(select count(*) from lv where coalesce(risk_level not in ('LOW', 'MEDIUM', 'HIGH', 'CRITICAL'), true))", "v = 0"),
        ("outside_component", f"(select count(*) from lv where {_OUT_PARTS})", "v = 0"),
    )
)
def q50_score_bounds(t: Tables) -> DataFrame:
    return shown(Q.evaluate(scores(t), score_rules()))


@C.add(f"with {SQL_SCORES}, qs as (select quantile_disc(building_risk_score, [0.5, 0.75, 0.9, 0.95, 0.975, 0.99, 0.995]) as v from lv where building_risk_score > 0) select unnest([0.5, 0.75, 0.9, 0.95, 0.975, 0.99, 0.995])::double as p, unnest(v) as value from qs")
def q51_quantile_calibration(t: Tables) -> DataFrame:
    return M.calibrate(scores(t), "building_risk_score", [0.5, 0.75, 0.9, 0.95, 0.975, 0.99, 0.995])


# --- serving ---------------------------------------------------------------------------------------------------------

RISK_OF_PROPERTY = ["property_risk_score", "property_risk_level", "property_risk_source", "building_count", "max_building_risk_score", "avg_building_risk_score", "property_only_risk_score"]
CONTEXT_OF_PROPERTY = ["yearbuilt", "numbldgs", "numfloors", "unitsres", "unitstotal", "landuse", "bldgclass"]


def serving_buildings(t: Tables) -> DataFrame:
    """Buildings with their risk and their lot's, as documents; the as-of date comes with the lot, NULL for none."""
    b = dim_building(t)
    risk = scores(t).select("building_id", "building_risk_score", F.col("risk_level").alias("building_risk_level"), *PARTS, *_SHOWN, "building_age", "age_imputed_flag")
    lots = property_scores(t).select("property_id", "bbl", "property_address", "zipcode", *RISK_OF_PROPERTY, *CONTEXT_OF_PROPERTY, "risk_as_of_date")
    x = b.join(risk, "building_id", "left").join(lots, "property_id", "left")
    return S.serving(x, "BUILDING", "current_address").withColumns({"search_aliases": F.col("address_aliases"), "serving_model_version": F.lit(MODEL_VERSION)})


def serving_properties(t: Tables) -> DataFrame:
    return S.serving(property_scores(t), "PROPERTY", "property_address").withColumn("serving_model_version", F.lit(MODEL_VERSION))


_POINT = "case when {t}latitude is not null and {t}longitude is not null then {t}latitude end as lat, case when {t}latitude is not null and {t}longitude is not null then {t}longitude end as lon"
SQL_SERVED = f"""sb as (select db.building_id, db.bin, db.property_id, 'BUILDING' as entity_type, case when trim(db.current_address) <> '' then upper(trim(db.current_address)) end as search_address, {_POINT.format(t='db.')}, array_to_string(list_sort(db.bbl_aliases), '|') as bbls, array_to_string(list_sort(db.address_aliases), '|') as aliases,
    lv.building_risk_score, lv.risk_level as building_risk_level, lv.hpd_active_violations, ps.property_address, ps.property_risk_score, ps.property_risk_level, ps.building_count, ps.zipcode, db.identity_status, db.match_method, db.match_confidence, db.resolution_status, case when ps.property_id is not null then strftime((select as_of from ao), '%Y-%m-%d') end as risk_as_of_date
    from db left join lv on lv.building_id = db.building_id left join ps on ps.property_id = db.property_id)"""


@C.add(f"with {SQL_PROPERTIES}, {SQL_SERVED} select * from sb")
def q52_serving_building(t: Tables) -> DataFrame:
    return serving_buildings(t).select(
        "building_id", "bin", "property_id", "entity_type", "search_address", F.col("location.lat").alias("lat"), F.col("location.lon").alias("lon"), F.array_join(F.array_sort("bbl_aliases"), "|").alias("bbls"), F.array_join(F.array_sort("search_aliases"), "|").alias("aliases"), "building_risk_score", "building_risk_level",
        "hpd_active_violations", "property_address", "property_risk_score", "property_risk_level", "building_count", "zipcode", "identity_status", "match_method", "match_confidence", "resolution_status", day("risk_as_of_date").alias("risk_as_of_date"),
    )


@C.add(f"with {SQL_PROPERTIES} select property_id, bbl, 'PROPERTY' as entity_type, case when trim(property_address) <> '' then upper(trim(property_address)) end as search_address, {_POINT.format(t='')}, building_count, property_risk_score, property_risk_level, property_risk_source, r1 as property_risk_311_raw, r2 as property_risk_hpd_severity_raw, r3 as property_risk_hpd_recency_raw, landuse, bldgclass from ps")
def q53_serving_property(t: Tables) -> DataFrame:
    return serving_properties(t).select(
        "property_id", "bbl", "entity_type", "search_address", F.col("location.lat").alias("lat"), F.col("location.lon").alias("lon"), "building_count", "property_risk_score", "property_risk_level", "property_risk_source",
        *[f"property_risk_{k}_raw" for k in PROPERTY_CAPS], "landuse", "bldgclass",
    )


@C.add(f"with {SQL_SCORES} select risk_level as level, count(*) as n, max(building_risk_score) as top, {sql_round('avg(building_risk_score)')} as mean from lv group by 1")
def q54_dashboard_tiles(t: Tables) -> DataFrame:
    return scores(t).groupBy(F.col("risk_level").alias("level")).agg(F.count(F.lit(1)).alias("n"), F.max("building_risk_score").alias("top"), N.round_half_up(F.avg("building_risk_score")).alias("mean"))


@C.add(f"with {SQL_SCORES} select building_id, building_risk_score as score from lv order by building_risk_score desc, building_id limit 10")
def q55_dashboard_top_risky(t: Tables) -> DataFrame:
    return scores(t).select("building_id", F.col("building_risk_score").alias("score")).orderBy(F.desc("score"), "building_id").limit(10)


_NORM = "upper(trim(regexp_replace({c}, '\\s+', ' ', 'g')))"


@C.add(
    f"""with ca as (select distinct 'BLD:' || bin as id, 1 as pr, {_NORM.format(c='a')} as k from (select bin, unnest(list_concat([current_address], coalesce(address_aliases, []))) as a from building_identity) where a is not null union select property_id, 2, {_NORM.format(c='property_address')} from dim_property where property_address is not null),
    b1 as (select k, min(id) filter (pr = 1) as b, min(id) filter (pr = 2) as p from ca group by 1),
    qq as (select distinct incident_address from nyc_311 where incident_address is not null)
    select incident_address as query, coalesce(b, p) as id, case when b is not null then 'BUILDING' else 'PROPERTY' end as entity_type from qq join b1 on {_NORM.format(c='incident_address')} = k"""
)
def q56_address_lookup(t: Tables) -> DataFrame:
    b = t.building_identity.select(F.concat(F.lit("BLD:"), F.col("bin")).alias("id"), F.explode(F.concat(F.array("current_address"), F.coalesce("address_aliases", F.array().cast("array<string>")))).alias("address"))
    p = t.dim_property.select(F.col("property_id").alias("id"), F.col("property_address").alias("address"))
    return S.lookup(t.nyc_311.select(F.col("incident_address").alias("query")), b, p)


@C.add(f"select a.bin, count(*) - 1 as neighbours from building_identity a join building_identity b on abs(a.latitude - b.latitude) < 0.001 and abs(a.longitude - b.longitude) < 0.002 where {SQL_DIST.format(a='a', b='b')} <= 50 group by 1")
def q57_proximity_count(t: Tables) -> DataFrame:
    """Other buildings within 50 m; points are counted before they meet, so that a stand-in point for "unknown" makes no pairs."""
    b = t.building_identity.where("latitude is not null and longitude is not null")
    spots = b.groupBy("latitude", "longitude").agg(F.count(F.lit(1)).alias("here"))
    other = spots.select(F.col("latitude").alias("lb"), F.col("longitude").alias("lob"), F.col("here").alias("there"))
    near = R.grid_pairs(spots.select("latitude", "longitude"), other, 50, ("latitude", "lb"), ("longitude", "lob")).groupBy("latitude", "longitude").agg((F.sum("there") - 1).alias("neighbours"))
    return b.join(near, ["latitude", "longitude"]).select("bin", "neighbours")


@C.add("select 'building_identity' as source, count(*) as n, count(*) filter (current_bbl in (select bbl from dim_property)) as covered from building_identity union all select 'fact_311_event', count(*), count(*) filter (source_bbl in (select bbl from dim_property)) from fact_311_event")
def q58_coverage_profile(t: Tables) -> DataFrame:
    lots = t.dim_property.select("bbl")
    return S.coverage(t.building_identity, "current_bbl", lots, "bbl", "building_identity").unionByName(S.coverage(t.fact_311_event, "source_bbl", lots, "bbl", "fact_311_event"))


@C.add(f"with {SQL_SCORES} select " + ", ".join(f"count(*) filter (({x}) >= 99.999) as full_{n}" for n, x in SQL_PARTS.items()) + ", count(*) filter (building_age is null) as age_imputed from lv")
def q59_saturation(t: Tables) -> DataFrame:
    return scores(t).agg(*[F.count_if(F.col(f"score_{n}") >= 99.999).alias(f"full_{n}") for n in SQL_PARTS], F.count_if(F.col("building_age").isNull()).alias("age_imputed"))


@C.add("select count(*) filter (a is not null and b is not null) as both, count(*) filter (a = b) as same, count(*) filter (a <> b) as different, count(*) filter (a is not null and b is null) as only_first, count(*) filter (a is null and b is not null) as only_second, count(*) filter (a is null and b is null) as neither from (select source_property_id as a, building_property_id as b from fact_311_event)")
def q60_key_agreement_matrix(t: Tables) -> DataFrame:
    return Q.key_agreement(t.fact_311_event, "source_property_id", "building_property_id")


@C.add("select count(*) as rows, count(*) filter (bbl is null or trim(bbl) = '') as missing, count(*) filter (trim(bbl) <> '' and not regexp_full_match(trim(bbl), '[0-9]{10}')) as malformed, count(*) filter (regexp_matches(trim(bbl), '\\.0+$')) as decimal_tail, count(bbl) - count(distinct bbl) as repeated from hpd")
def q61_raw_source_profile(t: Tables) -> DataFrame:
    return Q.source_profile(t.hpd, "bbl", "^[0-9]{10}$")


@C.add(f"with {SQL_FEATURES}, x as (select complaints_365 > 0 as a, hpd_365 > 0 as b from ft) select count(*) filter (a) as with_complaints, count(*) filter (b) as with_violations, count(*) filter (a and b) as with_both, count(*) filter (not a and not b) as with_none from x")
def q62_signal_coverage(t: Tables) -> DataFrame:
    a, b = F.col("complaints_365") > 0, F.col("hpd_365") > 0
    return building_features(t).agg(F.count_if(a).alias("with_complaints"), F.count_if(b).alias("with_violations"), F.count_if(a & b).alias("with_both"), F.count_if(~a & ~b).alias("with_none"))


# --- gates -----------------------------------------------------------------------------------------------------------


def _sql_entity_gate(dim: str, out: str, key: str, *more: tuple[str, str, str]) -> str:
    null, twice = "(select count(*) from {f} where {k} is null)", "(select count({k}) - count(distinct {k}) from {f})"
    return sql_gate(
        ("dim_rows", f"(select count(*) from {dim})", "v >= 1"), (f"dim_null_{key}", null.format(f=dim, k=key), "v = 0"), (f"dim_repeated_{key}", twice.format(f=dim, k=key), "v = 0"),
        ("rows", f"(select count(*) from {out})", f"v = (select count(*) from {dim})"), (f"out_null_{key}", null.format(f=out, k=key), "v = 0"), (f"out_repeated_{key}", twice.format(f=out, k=key), "v = 0"), *more,
    )


@C.add(f"with {SQL_FEATURES} {_sql_entity_gate('db', 'ft', 'building_id')}")
def q74_features_gate(t: Tables) -> DataFrame:
    return shown(Q.entity_gate(dim_building(t), building_features(t), "building_id", []))


@C.add(
    f"with {SQL_PROPERTIES} "
    + _sql_entity_gate(
        "dim_property", "ps", "property_id",
        ("outside_property_risk_score", "(select count(*) from ps where property_risk_score is not null and property_risk_score not between 0 and 100)", "v = 0"),
        ("invalid_property_risk_level", "(select count(*) from ps where coalesce(property_risk_level not in ('NO_DATA', 'LOW', 'MEDIUM', 'HIGH', 'CRITICAL'), true))", "v = 0"),
        ("invalid_property_risk_source", "(select count(*) from ps where coalesce(property_risk_source not in ('BUILDING_PLUS_PROPERTY_EVENTS', 'BUILDING_ONLY', 'PROPERTY_EVENTS_ONLY', 'NO_RISK_DATA'), true))", "v = 0"),
        ("no_data_consistency", "(select count(*) from ps where (property_risk_score is null) <> (property_risk_level = 'NO_DATA') or (property_risk_score is null) <> (property_risk_source = 'NO_RISK_DATA'))", "v = 0"),
        ("outside_component", "(select count(*) from ps where s1 not between 0 and 100 or s2 not between 0 and 100 or s3 not between 0 and 100)", "v = 0"),
        ("outside_property_only", "(select count(*) from ps where only_score is not null and only_score not between 0 and 100)", "v = 0"),
        ("outside_max_building", "(select count(*) from ps where max_score is not null and max_score not between 0 and 100)", "v = 0"),
        ("eligible_311", "(select count(distinct property_id) from fact_311_event, ao where building_id is null and property_id is not null and cast(created_date as date) <= as_of)", "v = (select count(*) from p1)"),
        ("eligible_hpd", "(select count(distinct property_id) from fact_hpd_violation, ao where building_id is null and property_id is not null and cast(inspectiondate as date) <= as_of)", "v = (select count(*) from p2)"),
    )
)
def q75_property_gate(t: Tables) -> DataFrame:
    """Rows, keys, ranges and the agreement of missing scores with their labels; and no eligible lot lost in counting."""
    score, level, source = F.col("property_risk_score"), F.col("property_risk_level"), F.col("property_risk_source")
    outside = lambda c: F.col(c).isNotNull() & ~F.col(c).between(0, 100)
    rules = [
        Q.when_wrong("outside_property_risk_score", outside("property_risk_score")),
        Q.not_in("property_risk_level", ["NO_DATA", *LEVELS]),
        Q.not_in("property_risk_source", SOURCES),
        Q.when_wrong("no_data_consistency", (score.isNull() != (level == "NO_DATA")) | (score.isNull() != (source == "NO_RISK_DATA"))),
        Q.when_wrong("outside_component", Q.any_of([~F.col(f"property_score_{k}").between(0, 100) for k in PROPERTY_CAPS])),
        Q.when_wrong("outside_property_only", outside("property_only_risk_score")),
        Q.when_wrong("outside_max_building", outside("max_building_risk_score")),
    ]
    when = as_of(t)
    counted = []
    for name, fact, at in (("eligible_311", t.fact_311_event, "created_date"), ("eligible_hpd", t.fact_hpd_violation, "inspectiondate")):
        only = fact.where("building_id is null and property_id is not null")
        lots = only.where(F.to_date(at) <= when.scalar()).agg(F.count_distinct("property_id")).scalar()
        n = Q.rows_of(M.event_features(only, "property_id", at, when, _ages("d")))
        counted.append(Q.Measure(name, lots, n, n))
    gates = Q.entity_gate(t.dim_property, property_scores(t), "property_id", rules)
    return shown(gates.unionByName(Q.gate(t.dim_property.sparkSession, counted)))


@C.add(
    f"with {SQL_PROPERTIES}, {SQL_SERVED} "
    + _sql_entity_gate(
        "db", "sb", "building_id",
        ("missing_building_risk_score", "(select count(*) from sb where building_risk_score is null)", "v = 0"),
        ("invalid_entity_type", "(select count(*) from sb where coalesce(entity_type <> 'BUILDING', true))", "v = 0"),
        ("wrong_as_of", "(select count(*) from sb where risk_as_of_date <> (select strftime(as_of, '%Y-%m-%d') from ao))", "v = 0"),
    )
)
def q76_serving_building_gate(t: Tables) -> DataFrame:
    other = F.col("risk_as_of_date").isNotNull() & (F.col("risk_as_of_date") != as_of(t).scalar())
    return shown(Q.entity_gate(dim_building(t), serving_buildings(t), "building_id", [Q.missing("building_risk_score"), Q.not_in("entity_type", ["BUILDING"]), Q.Expectation("wrong_as_of", F.count_if(other))]))


@C.add(
    f"with {SQL_PROPERTIES} "
    + _sql_entity_gate("dim_property", "ps", "property_id", ("missing_property_risk_level", "(select count(*) from ps where property_risk_level is null)", "v = 0"), ("invalid_entity_type", "0", "v = 0"))
)
def q77_serving_property_gate(t: Tables) -> DataFrame:
    return shown(Q.entity_gate(t.dim_property, serving_properties(t), "property_id", [Q.missing("property_risk_level"), Q.not_in("entity_type", ["PROPERTY"])]))


@C.add(f"with {SQL_FEATURES} " + sql_gate(("values_of_risk_as_of_date", "(select count(distinct as_of) from ft)", "v = 1"), ("null_risk_as_of_date", "(select count(*) from ft where as_of is null)", "v = 0")))
def q78_as_of_gate(t: Tables) -> DataFrame:
    """Both models share one as-of date."""
    both = scores(t).select("risk_as_of_date").unionByName(property_scores(t).select("risk_as_of_date"))
    return shown(Q.single_value(both, "risk_as_of_date"))


@C.add(f"with {SQL_BUILDING} " + sql_gate(("processed", "(select count(*) from db)", "v = (select count(*) from building_identity)"), ("in_sink", "(select count(*) from db)", "v = (select count(*) from building_identity)")))
def q79_sink_reconciliation(t: Tables) -> DataFrame:
    """Documents made, rows there were, and documents that carry their id when read back."""
    b = dim_building(t).select("building_id", "latitude", "longitude", "current_address")
    docs = S.documents_json(b.withColumn("current_address", blank_to_null(F.col("current_address"))))
    there = docs.agg(F.count(F.get_json_object("document", "$.building_id"))).scalar()
    return shown(Q.reconcile(b.sparkSession, Q.rows_of(docs), Q.rows_of(t.building_identity), there))


@C.add("select 1000 as n, 499500 as total")
def q80_range_smoke(t: Tables) -> DataFrame:
    """A generated range, counted and summed: shows that a session works, without any table."""
    return t.spark.range(0, 1000).agg(F.count(F.lit(1)).cast("int").alias("n"), F.sum("id").cast("int").alias("total"))
