"""What the engine makes of the queries: pruned scans, pushed filters, no joins without equality."""

from __future__ import annotations

import re

import pytest

from lotline.plans import catalog, problems
from lotline.session import sizing

QUERIES = {**catalog.queries(), **problems.queries()}


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_unbounded_joins(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text
    assert "NestedLoopJoin" not in text


def schemas(text: str) -> str:
    return " ".join(re.findall(r"ReadSchema: (.*)", text))


def test_columns_are_pruned(spark, sf):
    s = schemas(plan(QUERIES["p6_found"](spark, sf)))
    assert "unique_key" in s
    assert "descriptor" not in s
    assert "novdescription" not in s
    s = schemas(plan(QUERIES["q30_entity_risk_score"](spark, sf)))
    assert "novdescription" not in s
    assert "incident_address" not in s


def test_filters_reach_the_scan(spark, sf):
    assert re.search(r"PushedFilters: .*version", plan(QUERIES["q43_dim_property"](spark, sf)))
    assert re.search(r"PushedFilters: .*IsNotNull\(latitude", plan(QUERIES["q57_proximity_count"](spark, sf)))


def test_sizing():
    big = sizing(100_000, 4000)
    assert big["spark.sql.shuffle.partitions"] == "200000"
    assert int(sizing(1, 8)["spark.sql.shuffle.partitions"]) == 16
