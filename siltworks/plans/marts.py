"""Summaries over a keyed fact and its dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def enrollment_summary(rows: DataFrame, by: list[str], member: str, item: str, attempted: Column, earned: Column,
                       score: Column, success: Column) -> DataFrame:
    """Distinct members and items, totals, mean score and success rate per group."""
    rate = F.sum(F.when(success, 1).otherwise(0)) * 100.0 / F.nullif(F.count("*"), F.lit(0))
    return rows.groupBy(*by).agg(
        F.count_distinct(member).alias("member_count"), F.count_distinct(item).alias("item_count"),
        F.sum(attempted).alias("total_attempted"), F.sum(earned).alias("total_earned"),
        F.avg(score).alias("average_score"), rate.cast("double").alias("success_rate_pct"))


def retention(rows: DataFrame, member: str, period: str, sequence: str) -> DataFrame:
    """Members of a cohort (first period) seen in each later period, and their share.

    Rows are reduced to distinct (member, period) first, so nothing larger than
    that is joined.
    """
    seen = rows.select(member, period, sequence).distinct()
    first = seen.groupBy(member).agg(F.min(F.struct(period, sequence)).alias("__c"))
    first = first.select(member, F.col(f"__c.{period}").alias("cohort"))
    n = seen.join(first, member).groupBy("cohort", sequence).agg(F.count_distinct(member).alias("members"))
    most = F.max("members").over(Window.partitionBy("cohort"))  # one row per cohort and period
    return n.withColumn("retention_rate_pct", (F.col("members") * 100.0 / most).cast("double"))


def dashboard(fact: DataFrame, dims: list[tuple[DataFrame, str]], where: Column, by: list[str], member: str,
              measure: Column) -> DataFrame:
    """Members and totals per attribute over a star; each dimension comes with its key column."""
    rows = fact
    for dim, key in dims:
        rows = rows.join(dim, key)
    return rows.where(where).groupBy(*by).agg(F.count_distinct(member).alias("member_count"),
                                              F.sum(measure).alias("total"))


def detail(fact: DataFrame, dims: list[tuple[DataFrame, str]], where: Column, columns: list[str]) -> DataFrame:
    """Fact rows with chosen attributes of their dimensions."""
    rows = fact
    for dim, key in dims:
        rows = rows.join(dim, key)
    return rows.where(where).select(*columns)
