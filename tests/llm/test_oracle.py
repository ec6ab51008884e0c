"""Every query of the subpackage that has SQL gives the SQL's rows on the smallest tables."""

from __future__ import annotations

import pytest

from lotline.llm import queries as Q
from tests.conftest import same_rows


def test_sql_belongs_to_queries():
    assert set(Q.oracle_sql()) <= set(Q.queries())


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query(spark, sf, duck, name):
    df = Q.queries()[name](spark, sf)
    cols = sorted(df.columns)
    rows = [tuple(r) for r in df.select(*cols).collect()]
    rel = duck.sql(f"select {', '.join(chr(34) + c + chr(34) for c in cols)} from ({Q.oracle_sql()[name]})")
    assert same_rows(rows, rel.fetchall())


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_no_unbounded_joins(spark, sf, name):
    text = Q.queries()[name](spark, sf)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "CartesianProduct" not in text
    assert "NestedLoopJoin" not in text


@pytest.mark.parametrize("name", sorted(set(Q.queries()) - {"p9_shares", "p9_plan"}))
def test_empty_tables(spark, empty, name):
    assert Q.queries()[name](spark, empty).count() == 0
