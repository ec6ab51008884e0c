"""Every core query with SQL gives the SQL's rows on the smallest tables."""

from __future__ import annotations

import pytest

from lotline.plans import catalog, problems
from tests.conftest import same_rows

QUERIES = {**catalog.queries(), **problems.queries()}
SQL = {**catalog.oracle_sql(), **problems.oracle_sql()}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    rows = [tuple(r) for r in df.select(*cols).collect()]
    assert len(set(cols)) == len(cols)
    if name in SQL:
        rel = duck.sql(f"select {', '.join(chr(34) + c + chr(34) for c in cols)} from ({SQL[name]})")
        assert same_rows(rows, rel.fetchall())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    """No query fails without rows, and no operator finds something in nothing."""
    n = QUERIES[name](spark, empty).count()
    if name.startswith("p"):
        assert n == 0
