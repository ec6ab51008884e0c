"""Every query of the catalogue, by name."""

from __future__ import annotations

from lotline.plans import basics, risk, star
from lotline.plans.registry import Query


def queries() -> dict[str, Query]:
    return {**basics.C.queries, **star.C.queries, **risk.C.queries}


def oracle_sql() -> dict[str, str]:
    return {**basics.C.sql, **star.C.sql, **risk.C.sql}
