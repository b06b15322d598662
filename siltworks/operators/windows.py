"""Ordered operators that stay parallel when one group holds most of the rows.

A window puts all rows of a group into one task.  Here the rows are dealt into ranges
of (group, order, row hash) instead, which fixes one total order, and are written once
to the shared folder, which fixes the range of each row.  The window runs per (group,
range); a second window over one summary row per (group, range) carries values across
the cuts.  There is one form for all sizes.  Ranges hold about equally many rows, so
their number (``ranges``; by default the session's shuffle partitions) is what a user
raises with the data; it steers the balance only.  Rows equal in every column have
nothing to be told apart by and stay in one range.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltworks.config import shared_dir


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened where the table has them already."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def row_hash_of(df: DataFrame) -> Column:
    """64-bit hash of a row.  Maps, which have no hash, go in as JSON text."""
    kinds = dict(df.dtypes)
    cells = [F.to_json(F.struct(F.col(c))) if "map<" in kinds[c] else F.col(c) for c in df.columns]
    return F.xxhash64(*cells)


def in_ranges(df: DataFrame, order: list[str], chunk: str, ranges: int | None = None) -> DataFrame:
    """The table with the number of each row's range, rising with the ascending order (nulls first).

    Spark samples the order columns for the bounds, then the rows are written once and read back.
    """
    spark = df.sparkSession
    count = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(count, *order).withColumn(chunk, F.spark_partition_id())
    folder = shared_dir(spark)
    dealt.write.parquet(folder)
    return spark.read.schema(dealt.schema).parquet(folder)


def same(left: list[Column], right: list[Column]) -> Column:
    """All pairs equal, nulls equal to nulls."""
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) for x, y in zip(left, right)])


def attach(df: DataFrame, found: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Columns ``names`` of the row of ``found`` with the same keys (nulls equal), if any."""
    right = found.select(*[F.col(k).alias(f"__r_{i}") for i, k in enumerate(keys)],
                         *[F.col(n).alias(f"__f_{i}") for i, n in enumerate(names)])
    on = same([df[k] for k in keys], [right[f"__r_{i}"] for i in range(len(keys))])
    return df.join(right, on, "left").select(
        *[df[c] for c in df.columns], *[right[f"__f_{i}"].alias(n) for i, n in enumerate(names)])


def _neighbour(df, group, order, values, forward, ranges, tie):
    shift, edge = (F.lead, F.min_by) if forward else (F.lag, F.max_by)
    kept = [c for c in df.columns if c != tie]
    rank, near, chunk, last, inner, carried = unused(df, "__rank", "__near", "__chunk", "__last", "__inner", "__carried")
    rows = df.withColumns({rank: F.col(tie) if tie else row_hash_of(df),
                           near: F.struct(*[c.alias(n) for n, c in values.items()])})
    total_order = [*order, rank]
    rows = in_ranges(rows, [*group, *total_order], chunk, ranges)
    edges = rows.groupBy(*group, chunk).agg(edge(near, F.struct(*total_order)).alias(last))
    edges = edges.withColumn(carried, shift(last).over(Window.partitionBy(*group).orderBy(chunk)))
    w = Window.partitionBy(*group, chunk).orderBy(*total_order)
    rows = attach(rows.withColumn(inner, shift(near).over(w)), edges, [*group, chunk], [carried])
    found = rows.withColumn(near, F.coalesce(inner, carried))
    return found.select(*kept, *[F.col(near)[n].alias(n) for n in values])


def previous_values(df: DataFrame, group: list[str], order: list[str], values: dict[str, Column],
                    ranges: int | None = None, tie: str | None = None) -> DataFrame:
    """Add, per group, values of the row before in ascending order (``lag``).

    Rows equal in the order follow a hash of the row, or column ``tie``, which is then left out.
    """
    return _neighbour(df, group, order, values, False, ranges, tie)


def next_values(df: DataFrame, group: list[str], order: list[str], values: dict[str, Column],
                ranges: int | None = None, tie: str | None = None) -> DataFrame:
    """Add, per group, values of the row after in ascending order (``lead``); ties as in ``previous_values``."""
    return _neighbour(df, group, order, values, True, ranges, tie)


def running_sum(df: DataFrame, group: list[str], order: list[str], value: str, name: str,
                ranges: int | None = None) -> DataFrame:
    """Add the sum of ``value`` up to and including all rows equal in the order.

    The sum depends on group and order only: rows are summed to one per (group, order) first, those
    narrow rows are dealt into ranges, and the totals are joined back once.
    """
    chunk, part = unused(df, "__chunk", "__part")
    keys = [*group, *order]
    peers = in_ranges(df.groupBy(*keys).agg(F.sum(value).alias(part)), keys, chunk, ranges)
    return attach(df, running_totals(peers, group, order, part, name, chunk), keys, [name])


def running_totals(df: DataFrame, group: list[str], order: list[str], value: str, name: str, chunk: str,
                   whole: str | None = None) -> DataFrame:
    """Running sum over rows that are unique in group and order and have the number of their range.

    ``whole`` names a column for the sum of the group.
    """
    part, carried, inner = unused(df, "__part", "__carried", "__inner")
    per_group = Window.partitionBy(*group)
    before = per_group.orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    parts = df.groupBy(*group, chunk).agg(F.sum(value).alias(part))  # one row per group and range
    parts = parts.withColumn(carried, F.sum(part).over(before))
    if whole:
        parts = parts.withColumn(whole, F.sum(part).over(per_group))
    sums = df.withColumn(inner, F.sum(value).over(Window.partitionBy(*group, chunk).orderBy(*order)))
    sums = attach(sums, parts, [*group, chunk], [carried, *([whole] if whole else [])])
    total = F.coalesce(F.col(inner) + F.col(carried), inner, carried)
    return sums.withColumn(name, total).drop(inner, carried)


def global_row_number(df: DataFrame, order: list[str], name: str, ranges: int | None = None) -> DataFrame:
    """Number all rows 1..n in an order; rows equal in it follow a hash of the row."""
    rank, chunk, size, carried, inner = unused(df, "__rank", "__chunk", "__size", "__carried", "__inner")
    total_order = [*order, rank]
    rows = in_ranges(df.withColumn(rank, row_hash_of(df)), total_order, chunk, ranges)
    before = Window.orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(chunk).agg(F.count("*").alias(size))  # one row per range
    counts = counts.withColumn(carried, F.coalesce(F.sum(size).over(before), F.lit(0)))
    rows = rows.withColumn(inner, F.row_number().over(Window.partitionBy(chunk).orderBy(*total_order)))
    rows = attach(rows, counts, [chunk], [carried])
    return rows.select(*df.columns, (F.col(inner) + F.col(carried)).cast("bigint").alias(name))


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of each key in the given order.

    The rank filter becomes a group limit before the shuffle, so each map task
    sends at most one row per key, however large the key is.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def share_of_total(summary: DataFrame, count: str, name: str) -> DataFrame:
    """Percent of the column's total, two decimals; the input is one row per category."""
    total = F.sum(count).over(Window.partitionBy())
    return summary.withColumn(name, F.round(F.lit(100.0) * F.col(count) / total, 2))


def moving_zscore(df: DataFrame, group: list[str], period: str, metric: str, lookback: int = 1,
                  trend: int = 7, take_logs: bool = True, take_diffs: bool = True) -> DataFrame:
    """Distance of each period from the trailing mean, in trailing deviations.

    Input is one row per group and period.  The metric is ln(x) (null at zero),
    then the difference to ``lookback`` periods earlier; mean and sample
    deviation run over the ``trend`` periods before the current one.
    """
    w = Window.partitionBy(*group).orderBy(period)
    trailing = w.rowsBetween(-trend, -1)
    x = F.log(F.nullif(F.col(metric), F.lit(0))) if take_logs else F.col(metric).cast("double")
    out = df.withColumn("metric_test_value", x)
    if take_diffs:
        out = out.withColumn("metric_test_value",
                             F.col("metric_test_value") - F.lag("metric_test_value", lookback).over(w))
    out = out.withColumn("moving_average", F.avg("metric_test_value").over(trailing))
    out = out.withColumn("moving_stdev", F.stddev_samp("metric_test_value").over(trailing))
    gap = F.col("metric_test_value") - F.col("moving_average")
    return out.withColumn("sigma", F.try_divide(gap, F.col("moving_stdev")))
