"""Sources as data: columns, key, time, casts; and cleaning driven by them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lotline.functions import numbers as N
from lotline.functions import text as T
from lotline.functions.keys import lot_with_source, strip_zero_decimals, valid_lot
from lotline.operators.once import keep_one

# The columns of the raw feeds, all text.
# fmt: off
COMPLAINTS = (
    "unique_key", "created_date", "closed_date", "resolution_action_updated_date", "agency", "agency_name", "complaint_type", "descriptor",
    "descriptor_2", "status", "incident_address", "street_name", "incident_zip", "borough", "city", "bbl", "latitude", "longitude", "community_board",
    "council_district", "location_type", "open_data_channel_type",
)
HOUSING = (
    "violationid", "novid", "buildingid", "registrationid", "bbl", "bin", "boroid", "boro", "block", "lot", "housenumber", "lowhousenumber",
    "highhousenumber", "streetname", "apartment", "story", "zip", "class", "violationstatus", "currentstatus", "currentstatusid", "inspectiondate",
    "novissueddate", "currentstatusdate", "approveddate", "certifieddate", "originalcorrectbydate", "originalcertifybydate", "novtype",
    "novdescription", "rentimpairing", "latitude", "longitude", "communityboard", "councildistrict", "censustract", "nta",
)
SAFETY = (
    "violation_number", "violation_issue_date", "violation_status", "violation_type", "device_type", "bbl", "bin", "borough", "block", "lot",
    "house_number", "street", "city", "state", "zip", "latitude", "longitude", "community_board", "council_district", "census_tract_2020_",
    "neighborhood_tabulation_area_nta_2020_",
)
LOTS = (
    "bbl", "appbbl", "borocode", "borough", "block", "lot", "address", "landuse", "bldgclass", "yearbuilt", "yearalter1", "yearalter2", "numbldgs",
    "numfloors", "unitsres", "unitstotal", "lotarea", "bldgarea", "resarea", "comarea", "officearea", "retailarea", "garagearea", "strgearea",
    "factryarea", "otherarea", "lotfront", "lotdepth", "bldgfront", "bldgdepth", "builtfar", "residfar", "commfar", "facilfar", "latitude",
    "longitude", "xcoord", "ycoord", "zipcode", "cd", "council", "zonedist1", "zonedist2", "zonedist3", "overlay1", "overlay2", "spdist1", "zonemap",
    "splitzone", "ownername", "ownertype", "landmark", "histdist", "version", "plutomapid",
)

# fmt: on


@dataclass(frozen=True)
class SourceSpec:
    """What a feed's columns mean. ``lot_parts`` are (borough code or name, block, lot) for building a missing key,
    ``borough_name`` (code, name) columns of which the code decides the name, ``more_lots`` further lot keys."""

    name: str
    columns: tuple[str, ...]
    key: str
    event_time: str | None = None
    times: tuple[str, ...] = ()
    doubles: tuple[str, ...] = ("latitude", "longitude")
    ints: tuple[str, ...] = ()
    years: tuple[str, ...] = ()
    upper: tuple[str, ...] = ()
    collapsed: tuple[str, ...] = ()
    lot: str | None = "bbl"
    lot_parts: tuple[str, str, str] | None = None
    parts_by_name: bool = False
    numeric_tail: bool = False
    borough_name: tuple[str, str] | None = None
    more_lots: tuple[str, ...] = ()
    renames: dict[str, str] = field(default_factory=dict)
    valid_label: str = "SOURCE"

    def schema(self) -> StructType:
        return StructType([StructField(c, StringType()) for c in self.columns])


SPECS = {
    "complaints": SourceSpec("complaints", COMPLAINTS, "unique_key", "created_date", times=("created_date", "closed_date", "resolution_action_updated_date"), upper=("agency", "complaint_type", "status", "borough", "incident_address"), collapsed=("complaint_type",)),
    "housing": SourceSpec(
        "housing", HOUSING, "violationid", "inspectiondate",
        times=("inspectiondate", "novissueddate", "currentstatusdate", "approveddate", "certifieddate", "originalcorrectbydate", "originalcertifybydate"),
        upper=("boro", "class", "violationstatus", "currentstatus", "streetname", "novtype", "rentimpairing"), lot_parts=("boroid", "block", "lot"),
    ),
    "safety": SourceSpec("safety", SAFETY, "violation_number", "violation_issue_date", times=("violation_issue_date",), upper=("borough", "violation_status", "violation_type", "device_type", "street", "city", "state"), lot_parts=("borough", "block", "lot"), parts_by_name=True),
    "lots": SourceSpec(
        "lots", LOTS, "bbl", None,
        doubles=("numfloors", "lotarea", "bldgarea", "resarea", "comarea", "officearea", "retailarea", "garagearea", "strgearea", "factryarea", "otherarea", "lotfront", "lotdepth", "bldgfront", "bldgdepth", "builtfar", "residfar", "commfar", "facilfar", "latitude", "longitude"),
        ints=("numbldgs", "unitsres", "unitstotal", "xcoord", "ycoord"), years=("yearbuilt", "yearalter1", "yearalter2"), upper=("address", "bldgclass", "zonedist1", "ownername"),
        lot_parts=("borocode", "block", "lot"), numeric_tail=True, borough_name=("borocode", "borough"), more_lots=("appbbl",), renames={"version": "snapshot_version"}, valid_label="SOURCE_NORMALIZED",
    ),
}


def clean(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """One projection: trimmed texts, upper case where asked, casts that give NULL on garbage, the lot key with its
    provenance (source_<lot>, <lot>_source), and year, month and day of the event time. Columns the source lacks are NULL,
    further ones are left out; times and numbers that come typed are taken as they are."""
    kinds = dict(df.dtypes)
    raw = lambda c: F.col(f"`{c}`").cast("string") if c in kinds else F.lit(None).cast("string")
    out: dict[str, Column] = {}
    for c in spec.columns:
        x = F.trim(raw(c))
        if c in spec.upper:
            x = F.upper(x)
        if c in spec.collapsed:
            x = T.collapse(x)
        if c in spec.times:
            x = F.col(f"`{c}`").cast("timestamp") if kinds.get(c, "string") != "string" else F.coalesce(N.parse_millis(x), x.try_cast("timestamp"))
        elif c in spec.doubles:
            x = F.col(f"`{c}`") if kinds.get(c) == "double" else x.try_cast("double")
        elif c in spec.ints:
            x = F.col(f"`{c}`") if kinds.get(c) == "int" else N.safe_int(x)
        elif c in spec.years:
            x = N.positive(F.col(f"`{c}`") if kinds.get(c) == "int" else N.safe_int(x))
        elif c in spec.more_lots:
            x = valid_lot(strip_zero_decimals(x) if spec.numeric_tail else x)
        out[c] = x
    if spec.borough_name:
        code, name = spec.borough_name
        known = F.trim(raw(code))
        out[name] = F.when(known.isin(list(T.BOROUGH_NAMES)), T.borough(known)).otherwise(T.standardize(raw(name)))
    if spec.lot:
        source = strip_zero_decimals(F.trim(raw(spec.lot))) if spec.numeric_tail else F.trim(raw(spec.lot))
        out[f"source_{spec.lot}"] = F.trim(raw(spec.lot))
        if spec.lot_parts:
            code, block, lot = map(raw, spec.lot_parts)
            code = T.borough_to_code(code) if spec.parts_by_name else code
            out[spec.lot], out[f"{spec.lot}_source"] = lot_with_source(source, code, block, lot, spec.valid_label)
        else:
            out[spec.lot] = valid_lot(source)
    cols = [x.alias(spec.renames.get(c, c)) for c, x in out.items()]
    cleaned = df.select(*cols, *[c for c in ("run_id", "ingested_at", "_file") if c in kinds])
    if spec.event_time:
        t = F.col(spec.event_time)
        cleaned = cleaned.withColumns({"event_year": F.year(t), "event_month": F.month(t), "event_day": F.dayofmonth(t)})
    return cleaned


def latest(df: DataFrame, spec: SourceSpec, newest: list[str]) -> DataFrame:
    """The newest delivery of each key; rows without a key are left out."""
    return keep_one(df, F.nullif(F.col(spec.key), F.lit("")), [F.col(c) for c in newest])
