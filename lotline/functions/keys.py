"""Identifier normalisation: message keys, lot numbers, composite keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOT_PATTERN = "^[1-5][0-9]{9}$"


def squeeze_ends(c: Column) -> Column:
    """Trim any white space (tabs and line ends too), which ``trim`` leaves."""
    return F.btrim(c, F.lit(" \t\n\r\x0b\x0c"))


def strip_zero_decimals(c: Column) -> Column:
    """Without a decimal point that only zeros follow; texts without a point skip the pattern."""
    return F.when(F.contains(c, F.lit(".")), F.regexp_replace(c, r"\.0*$", "")).otherwise(c)


def message_key(c: Column) -> Column:
    """The number in a delivered identifier, as text.

    White space around it, leading zeros and a zero decimal part don't matter. NULL and blank give NULL. A text that
    is no number comes back trimmed, so that it can still be compared exactly.
    """
    t = squeeze_ends(c)
    number = strip_zero_decimals(t)
    return F.when(number.rlike("^[0-9]+$"), F.coalesce(F.nullif(F.ltrim(number, F.lit("0")), F.lit("")), F.lit("0"))).otherwise(F.nullif(t, F.lit("")))


def is_sequence_key(key: Column) -> Column:
    """True for keys that fit a 64-bit sequence number."""
    return key.rlike("^[0-9]{1,18}$")


def lot_number(c: Column) -> Column:
    """The ten digits of a lot key: plain, with zero decimals, or as borough, block and lot apart; else NULL."""
    t = strip_zero_decimals(squeeze_ends(c))
    parts = r"^([1-5])[-/ ]+([0-9]{1,5})[-/ ]+([0-9]{1,4})$"
    return F.when(t.rlike(LOT_PATTERN), t).when(
        t.rlike(parts),
        F.concat(
            F.regexp_extract(t, parts, 1),
            F.lpad(F.regexp_extract(t, parts, 2), 5, "0"),
            F.lpad(F.regexp_extract(t, parts, 3), 4, "0"),
        ),
    )


def valid_lot(c: Column) -> Column:
    """Trimmed key if it is ten digits, else NULL (no construction)."""
    t = F.trim(c)
    return F.when(t.rlike("^[0-9]{10}$"), t)


def constructed_lot(code: Column, block: Column, lot: Column) -> Column:
    """Borough code, block and lot padded to 1 + 5 + 4 digits; NULL if any part is malformed."""
    code, block, lot = F.trim(code), F.trim(block), F.trim(lot)
    ok = code.rlike("^[1-5]$") & block.rlike("^[0-9]{1,5}$") & lot.rlike("^[0-9]{1,4}$")
    return F.when(ok, F.concat(code, F.lpad(block, 5, "0"), F.lpad(lot, 4, "0")))


def lot_with_source(source: Column, code: Column, block: Column, lot: Column, valid_label: str = "SOURCE") -> tuple[Column, Column]:
    """(key, provenance): the source key if valid, else constructed from its parts, else NULL and MISSING."""
    src, made = valid_lot(source), constructed_lot(code, block, lot)
    label = F.when(src.isNotNull(), valid_label).when(made.isNotNull(), "CONSTRUCTED").otherwise("MISSING")
    return F.coalesce(src, made), label


def not_blank(c: Column) -> Column:
    """Neither NULL nor only white space."""
    return c.isNotNull() & c.rlike(r"\S")
