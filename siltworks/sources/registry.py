"""Declared source tables: where they are, who owns them, how fresh they must be."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Lineage of a table whose registry entry leaves it open.
DEFAULT_SYSTEM = "UNKNOWN"
DEFAULT_OWNER = "UNKNOWN"
DEFAULT_INGEST = "UNKNOWN"
DEFAULT_CLASS = "INTERNAL"

HOURS = {"minute": 1 / 60, "hour": 1, "day": 24}


@dataclass(frozen=True)
class SourceTable:
    """One table; values left at None come from its group."""

    name: str
    path: str
    source_file: str | None = None
    data_owner: str | None = None
    data_class: str | None = None
    loaded_at: str | None = None
    warn_after: tuple[int, str] | None = None
    error_after: tuple[int, str] | None = None
    columns: tuple[str, ...] = ()


@dataclass(frozen=True)
class SourceGroup:
    """Tables of one system with shared settings."""

    name: str
    source_system: str | None = None
    ingest_type: str | None = None
    data_owner: str | None = None
    data_class: str | None = None
    tables: tuple[SourceTable, ...] = field(default_factory=tuple)


class Registry:
    """Looks tables up by (group, table), names matched without case."""

    def __init__(self, *groups: SourceGroup):
        self._tables: dict[tuple[str, str], tuple[SourceGroup, SourceTable]] = {}
        for g in groups:
            for t in g.tables:
                key = (g.name.lower(), t.name.lower())
                if key in self._tables:
                    raise ValueError(f"table {key} is declared twice")
                self._tables[key] = (g, t)

    def entry(self, group: str, table: str) -> tuple[SourceGroup, SourceTable]:
        return self._tables[(group.lower(), table.lower())]

    def names(self) -> list[str]:
        return sorted(t.name for _, t in self._tables.values())

    def items(self):
        return list(self._tables.values())

    def read(self, spark: SparkSession, group: str, table: str) -> DataFrame:
        """Scan of the table; declared columns must be there."""
        _, t = self.entry(group, table)
        df = spark.read.parquet(t.path)
        lacking = {c.lower() for c in t.columns} - {c.lower() for c in df.columns}
        if lacking:
            raise ValueError(f"{t.name} lacks declared columns {sorted(lacking)}")
        return df

    def lineage(self, group: str, table: str, run_time: dt.datetime) -> dict[str, Column]:
        """Constant columns saying where rows come from; the file only where one is declared."""
        g, t = self.entry(group, table)
        values = {
            "_source_system": g.source_system or DEFAULT_SYSTEM,
            "_source_table": t.name.upper(),
            "_source_file": t.source_file,
            "_data_classification": t.data_class or g.data_class or DEFAULT_CLASS,
            "_data_owner": t.data_owner or g.data_owner or DEFAULT_OWNER,
            "_ingest_type": g.ingest_type or DEFAULT_INGEST,
        }
        columns = {k: F.lit(v) for k, v in values.items() if v is not None}
        columns["_loaded_at"] = F.lit(run_time).cast("timestamp_ntz")
        return columns


def add_lineage(df: DataFrame, registry: Registry, group: str, table: str, run_time: dt.datetime,
                loaded_at: str | None = None) -> DataFrame:
    """Lineage columns, and the source's own load time if its column is named."""
    columns = registry.lineage(group, table, run_time)
    if loaded_at:
        columns["_source_loaded_at"] = F.col(loaded_at)
    return df.withColumns(columns)


def source_freshness(spark: SparkSession, registry: Registry, now: dt.datetime) -> DataFrame:
    """Newest load time per table with limits, its age in hours and pass / warn / error."""
    out = None
    for g, t in registry.items():
        if not (t.loaded_at and (t.warn_after or t.error_after)):
            continue
        newest = registry.read(spark, g.name, t.name).agg(F.max(t.loaded_at).cast("timestamp_ntz").alias("max_loaded_at"))
        seconds = F.timestamp_diff("SECOND", F.col("max_loaded_at"), F.lit(now).cast("timestamp_ntz"))
        age = (seconds / 3600.0).cast("double")
        status = F.lit("pass")
        for limit, label in ((t.warn_after, "warn"), (t.error_after, "error")):
            if limit:
                over = age.isNull() | (age > limit[0] * HOURS[limit[1]])
                status = F.when(over, label).otherwise(status)
        row = newest.select(F.lit(g.name).alias("source_name"), F.lit(t.name).alias("table_name"),
                            "max_loaded_at", age.alias("age_hours"), status.alias("status"))
        out = row if out is None else out.unionByName(row)
    if out is None:
        raise ValueError("no registered table has a freshness limit")
    return out


def volume_monitor(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows per table and load day with the count of the day before and the change."""
    from pyspark.sql import Window

    out = None
    for name, (df, ts) in tables.items():
        day = df.groupBy(F.to_date(ts).alias("load_day")).agg(F.count("*").alias("n_rows"))
        day = day.select(F.lit(name).alias("table_name"), "load_day", "n_rows")
        out = day if out is None else out.unionByName(day)
    w = Window.partitionBy("table_name").orderBy("load_day")  # one row per day
    out = out.withColumn("previous_rows", F.lag("n_rows").over(w))
    return out.withColumn("row_change", F.col("n_rows") - F.col("previous_rows"))


def metadata_catalog(schemas: dict[str, dict[str, DataFrame]], catalog: str = "warehouse") -> DataFrame:
    """One row per column of every table in the given schemas, with the table's row count."""
    out = None
    for schema, tables in schemas.items():
        for name, df in tables.items():
            cells = F.array(*[
                F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                         F.lit(i).alias("ordinal_position")) for i, f in enumerate(df.schema, 1)])
            rows = df.agg(F.count("*").alias("row_count")).select(
                F.lit(catalog).alias("table_catalog"), F.lit(schema).alias("table_schema"),
                F.lit(name).alias("table_name"), F.inline(cells), "row_count")
            out = rows if out is None else out.unionByName(rows)
    return out


def metadata_audit(catalog_rows: DataFrame, run_time: dt.datetime) -> DataFrame:
    """Columns per table with the audit time."""
    counts = catalog_rows.groupBy("table_schema", "table_name").agg(F.count("*").alias("column_count"))
    return counts.withColumn("audit_ts", F.lit(run_time).cast("timestamp_ntz")).orderBy("table_schema", "table_name")
