"""A catalogue entry is a query with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lotline.session import table

Query = Callable[[SparkSession, str], DataFrame]


class Tables:
    """Tables of one directory by attribute."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark, self._folder = spark, folder

    @property
    def spark(self) -> SparkSession:
        return self._spark

    def __getattr__(self, name: str) -> DataFrame:
        return table(self._spark, self._folder, name)


class Catalog:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None):
        def register(f: Callable[[Tables], DataFrame]):
            self.queries[f.__name__] = lambda spark, d: f(Tables(spark, d))
            if sql:
                self.sql[f.__name__] = sql
            return f

        return register
