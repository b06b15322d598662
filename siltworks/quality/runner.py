"""Run a suite of checks: count failures, grade them and store the failing rows."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.operators.windows import unused

_STARTS = re.compile(r"\s*([=<>]|!=|((not\s+)?(between|in)|is)\b)", re.I)


@dataclass(frozen=True)
class Check:
    """A named check.

    Give either ``failing`` (row condition over the table, evaluated together with
    all other such checks in one pass) or ``rows`` (function to failing rows).
    """

    name: str
    failing: Column | None = None
    rows: Callable[[DataFrame], DataFrame] | None = None
    where: Column | None = None
    severity: str = "error"
    warn_if: str = "!=0"
    error_if: str = "!=0"
    fail_calc: Column | None = None


def _meets(threshold: str) -> Column:
    """A threshold is what SQL has after the count: '>10', 'between 2 and 8', '!=0 and failures < 100.5'."""
    if not _STARTS.match(threshold):
        raise ValueError(f"threshold {threshold!r} is not like '>10'")
    return F.coalesce(F.expr(f"(failures {threshold})"), F.lit(False))


def grade(counts: DataFrame, checks: list[Check]) -> DataFrame:
    """Columns check_name, failures and status (error, warn or pass); with severity 'warn' nothing is worse than warn."""
    status = F.lit(None).cast("string")
    for c in checks:
        found = F.when(_meets(c.warn_if), "warn").otherwise("pass")
        if c.severity == "error":
            found = F.when(_meets(c.error_if), "error").otherwise(found)
        status = F.when(F.col("check_name") == c.name, found).otherwise(status)
    return counts.select("check_name", "failures", status.alias("status"))


def _hit(check: Check) -> Column:
    hit = check.failing if check.where is None else check.failing & check.where
    return F.coalesce(hit, F.lit(False))


def _failing_rows(df: DataFrame, check: Check) -> DataFrame:
    rows = df if check.where is None else df.where(check.where)
    return check.rows(rows) if check.failing is None else rows.where(check.failing)


def _turned(one: DataFrame, names: list[str]) -> DataFrame:
    """One row of counts as a row per check; cell i belongs to the i-th name."""
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"__{i}").alias("failures")) for i, n in enumerate(names)])))


def run_checks(df: DataFrame, checks: list[Check], store: str | None = None) -> DataFrame:
    """Summary: one row per check with failures and status.

    All row-condition checks share a single scan and aggregate.  With ``store`` the failing rows are
    written there (``failing_rows`` reads them) and the failures are counted from what was written, so
    every check is evaluated once; all row-condition checks share one scan and one write then.
    """
    again = [n for n, k in Counter(c.name for c in checks).items() if k > 1]
    if again or not checks:
        raise ValueError(f"checks need names of their own: {again}" if again else "no checks")
    try:  # thresholds are read before anything runs
        grade(df.sparkSession.range(0).select(F.lit("").alias("check_name"), F.col("id").alias("failures")), checks).schema
    except (ParseException, AnalysisException) as wrong:
        raise ValueError("a threshold is no SQL condition") from wrong
    simple = [c for c in checks if c.failing is not None]
    parts = []
    if simple and store is None:
        one = df.agg(*[F.count_if(_hit(c)).alias(f"__{i}") for i, c in enumerate(simple)])
        parts.append(_turned(one, [c.name for c in simple]))
    elif simple:
        mark, = unused(df, "check_no")
        numbers = F.array_compact(F.array(*[F.when(_hit(c), checks.index(c)) for c in simple]))
        df.withColumn(mark, F.explode(numbers)).write.mode("overwrite").partitionBy(mark).parquet(f"{store}/rows")
        kept = df.sparkSession.read.schema(T.StructType([T.StructField(mark, T.IntegerType())])).parquet(f"{store}/rows")
        one = kept.agg(*[F.count_if(F.col(mark) == checks.index(c)).alias(f"__{i}") for i, c in enumerate(simple)])
        parts.append(_turned(one, [c.name for c in simple]))
    for i, c in enumerate(checks):
        if c.rows is None:
            continue
        bad = _failing_rows(df, c)
        if store is not None:
            bad.write.mode("overwrite").parquet(f"{store}/check_no={i}")
            bad = df.sparkSession.read.schema(bad.schema).parquet(f"{store}/check_no={i}")
        n = bad.agg(F.coalesce((F.count("*") if c.fail_calc is None else c.fail_calc).cast("bigint"),
                               F.lit(0)).alias("failures"))
        parts.append(n.select(F.lit(c.name).alias("check_name"), "failures"))
    return grade(reduce(DataFrame.unionByName, parts), checks)


def failing_rows(df: DataFrame, checks: list[Check], store: str, name: str) -> DataFrame:
    """Rows of a check that ``run_checks(df, checks, store)`` has written."""
    at, check = next((i, c) for i, c in enumerate(checks) if c.name == name)
    if check.failing is None:
        return df.sparkSession.read.parquet(f"{store}/check_no={at}")
    mark, = unused(df, "check_no")
    schema = T.StructType([*df.schema.fields, T.StructField(mark, T.IntegerType())])
    return df.sparkSession.read.schema(schema).parquet(f"{store}/rows").where(F.col(mark) == at).drop(mark)


def require_columns(df: DataFrame, columns: list[str]) -> None:
    """A suite must not name columns the table lacks."""
    have = {c.lower() for c in df.columns}
    lacking = [c for c in columns if c.lower() not in have]
    if lacking:
        raise ValueError(f"no such columns: {lacking}")


def store_failures(df: DataFrame, checks: list[Check], folder: str) -> dict[str, str]:
    """Write the failing rows of each check to its own folder; returns the folders."""
    out = {}
    for c in checks:
        out[c.name] = f"{folder}/{c.name}"
        _failing_rows(df, c).write.mode("overwrite").parquet(out[c.name])
    return out
