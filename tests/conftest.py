from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lotline.session import get_spark, ship

    s = get_spark(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
    )
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    d = Path("/root/testdata/sf0.001")
    if not d.exists():
        pytest.skip("no test tables")
    return str(d)


@pytest.fixture(scope="session")
def empty(spark, sf, tmp_path_factory):
    """The same tables without rows."""
    out = tmp_path_factory.mktemp("empty")
    for p in Path(sf).glob("*.parquet"):
        spark.read.parquet(str(p)).limit(0).coalesce(1).write.parquet(str(out / p.name))
    return str(out)


@pytest.fixture(scope="session")
def duck(sf):
    import duckdb

    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for p in Path(sf).glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from '{p}'")
    return con


def same_rows(a, b) -> bool:
    """Rows compared as sorted texts, columns by name; whole floats equal integers."""

    def norm(v):
        if v is None or v != v:
            return "~"
        if isinstance(v, float):
            return repr(round(v, 6) + 0.0)
        if isinstance(v, int) and not isinstance(v, bool):
            return repr(float(v))
        return str(v)

    return sorted(map(str, ([norm(v) for v in r] for r in a))) == sorted(map(str, ([norm(v) for v in r] for r in b)))
