"""Registration of queries and short names shared by the binding modules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from siltworks.config import RunConfig

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

# One run for all queries.
CFG = RunConfig(run_time=dt.datetime(2001, 9, 1, 6, 0, 0), as_of=dt.date(2001, 9, 1), institution_code="SILT")
EVENT_NOW = dt.datetime(2024, 2, 1, 0, 0, 0)
RUN_SQL = "TIMESTAMP '2001-09-01 06:00:00'"
AS_OF_SQL = "DATE '2001-09-01'"


class Tables:
    """Tables of one folder by name.

    A table that a query names several times is read by a DataFrame each, so joins tell them apart; its
    footers are looked up for the first one only.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._schemas = spark, folder.rstrip("/"), {}

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._schemas:
            first = self.spark.read.parquet(self.path(name))
            self._schemas[name] = first.schema
            return first
        return self.spark.read.schema(self._schemas[name]).parquet(self.path(name))


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under a query name."""
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(spark, folder))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return add
