"""Group summaries, pivots and exact percentiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltworks.operators.windows import attach, unused

#: Ranks of a percentile sketch are right to one part in this many.
ACCURACY = 10_000
#: Groups whose sketches go to the driver and back as a table of known size.
FEW_GROUPS = 1000

AGGREGATES = {"sum": F.sum, "max": F.max, "min": F.min, "avg": F.avg, "count": F.count}
COMPARISONS = {
    "=": lambda c, v: c == v, "!=": lambda c, v: c != v, "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v, ">": lambda c, v: c > v, ">=": lambda c, v: c >= v,
}


def latest_value(value: str, order: list[str]) -> Column:
    """Value at the greatest order; ties go to the greatest of the later order columns."""
    return F.max_by(F.col(value), F.struct(*order))


def earliest_value(value: str, order: list[str]) -> Column:
    return F.min_by(F.col(value), F.struct(*order))


def pivot_columns(column: str, values, agg: str = "sum", cmp: str = "=", prefix: str = "", suffix: str = "",
                  then_value=1, else_value=0, distinct: bool = False) -> list[Column]:
    """One aggregate column per value, for use in ``groupBy().agg(*...)``."""
    out = []
    for v in values:
        then = then_value if isinstance(then_value, Column) else F.lit(then_value)
        other = else_value if isinstance(else_value, Column) else F.lit(else_value)
        cell = F.when(COMPARISONS[cmp](F.col(column), F.lit(v)), then).otherwise(other)
        if distinct:
            made = {"count": F.count_distinct, "sum": F.sum_distinct}[agg](cell)
        else:
            made = AGGREGATES[agg](cell)
        out.append(made.alias(f"{prefix}{v}{suffix}"))
    return out


def greatest_per(system: str, value: str, names: dict[str, str]) -> list[Column]:
    """Greatest value of each system as its own aggregate column."""
    return [F.max(F.when(F.col(system) == s, F.col(value))).alias(n) for s, n in names.items()]


def pivot_ids(df: DataFrame, key: str, system: str, value: str, names: dict[str, str]) -> DataFrame:
    """One row per key with the greatest value of each system in its own column."""
    return df.groupBy(key).agg(*greatest_per(system, value, names))


def unpivot(df: DataFrame, keep: list[str], remove=(), cast_to: str = "string",
            field_name: str = "field_name", value_name: str = "value") -> DataFrame:
    """Columns to rows, all cast to one type; nulls stay."""
    skip = {c.lower() for c in [*keep, *remove]}
    turned = [c for c in df.columns if c.lower() not in skip]
    cast = df.select(*keep, *[F.col(c).cast(cast_to).alias(c) for c in turned])
    return cast.unpivot(keep, turned, field_name, value_name)


def column_values(df: DataFrame, column: str, max_records: int | None = None, where: Column | None = None,
                  order: list[Column] | None = None, default: list | None = None) -> DataFrame:
    """Distinct values with their counts, most frequent first, ties by value.

    ``order`` replaces that order (by ``column`` and ``n_rows``); ``default`` lists the values,
    with a count of 0, of a table without rows.
    """
    if where is not None:
        df = df.where(where)
    out = df.groupBy(column).agg(F.count("*").alias("n_rows"))
    if default:
        kind = df.schema[column].dataType
        none = df.agg(F.count("*")).scalar() == 0
        stand_in = df.sparkSession.range(1).where(none).select(F.explode(F.array(*[F.lit(v).cast(kind) for v in default])).alias(column))
        out = out.unionByName(stand_in.withColumn("n_rows", F.lit(0).cast("bigint")))
    out = out.orderBy(*(order or [F.desc("n_rows"), F.asc_nulls_last(column)]))
    return out if max_records is None else out.limit(max_records)


def single_value(df: DataFrame, value: Column, default, name: str = "value") -> DataFrame:
    """One row with an aggregate, or the default where it is null or there are no rows."""
    return df.agg(F.coalesce(value, F.lit(default)).alias(name))


def percentiles(df: DataFrame, group: list[str], value: str, quantiles: dict[str, float],
                accuracy: int = ACCURACY) -> DataFrame:
    """Interpolated percentiles per group, null for a group without values.

    The built-in aggregate keeps a group's distinct values in one task.  Here a mergeable sketch
    (rank error at most rows / ``accuracy``) names a narrow range of values around each percentile; a second
    pass counts what lies below, inside and above it exactly, and only the values inside, some
    8 / ``accuracy`` of the group, are sorted.  Nothing is written and no rows are shuffled but those counts.
    A rank outside its range, which the sketch's bound excludes, raises an error.
    A null counts nothing but keeps the row of its group.  Starts a job for the sketch.
    """
    number, size, marks, slot, zone, inside, n, top, bottom, upto = unused(
        df, "__value", "__size", "__marks", "__slot", "__zone", "__inside", "__n", "__top", "__bottom", "__upto")
    rows = df.select(*group, F.col(value).cast("double").alias(number))
    margin, wanted = 4.0 / accuracy, list(quantiles.values())
    shares = [x for q in wanted for x in (max(0.0, q - margin), min(1.0, q + margin))]
    # not-a-number is the greatest value; the sketch takes it as infinity
    ends = rows.groupBy(*group).agg(F.count(number).alias(size),
                                    F.percentile_approx(F.nanvl(number, F.lit(float("inf"))), shares, accuracy).alias(marks))
    few = ends.limit(FEW_GROUPS + 1).collect()
    if len(few) <= FEW_GROUPS:  # a table of known size, which Spark may broadcast
        ends = df.sparkSession.createDataFrame(few, ends.schema)
    if group:
        rows = attach(rows, ends, group, [size, marks])
    else:
        rows = rows.withColumns({size: F.lit(few[0][size]), marks: F.lit(few[0][marks]).cast("array<double>")})
    rows = rows.withColumn(slot, F.explode(F.array(*[F.lit(i) for i in range(len(wanted))])))
    low, high = F.element_at(marks, 2 * F.col(slot) + 1), F.element_at(marks, 2 * F.col(slot) + 2)
    high = F.when(high == float("inf"), F.lit(float("nan"))).otherwise(high)
    rows = rows.withColumn(zone, F.when(F.col(number) < low, -1).when(F.col(number) > high, 1).otherwise(0))
    rows = rows.withColumn(inside, F.when(F.col(zone) == 0, F.col(number)))
    cells = rows.groupBy(*group, slot, zone, inside).agg(F.count(number).alias(n), F.max(number).alias(top),
                                                         F.min(number).alias(bottom), F.max(size).alias(size))
    cells = cells.withColumn(upto, F.sum(n).over(Window.partitionBy(*group, slot).orderBy(zone, inside)))
    made, spread = [], []
    for i, (name, q) in enumerate(quantiles.items()):
        place = (F.col(size) - 1) * F.lit(q)

        def at(rank):
            # the first cell, in the order of zone and value, that reaches beyond the rank
            return F.min(F.when((F.col(slot) == i) & (F.col(upto) > rank),
                                F.struct(zone, inside, upto, n, top, bottom, rank.cast("bigint").alias("rank"))))

        spread += [at(F.floor(place)).alias(f"__low{i}"), at(F.ceil(place)).alias(f"__high{i}"), F.max(place - F.floor(place)).alias(f"__part{i}")]

        def worth(cell):
            # the rank next to the range is its neighbour on either side
            c = F.col(cell)
            return (F.when(c.isNull(), F.lit(None).cast("double")).when(c[zone] == 0, c[inside])
                    .when((c[zone] < 0) & (c["rank"] == c[upto] - 1), c[top]).when((c[zone] > 0) & (c["rank"] == c[upto] - c[n]), c[bottom])
                    .otherwise(F.raise_error(F.lit("percentile rank outside its range")).cast("double")))

        low_value, high_value = worth(f"__low{i}"), worth(f"__high{i}")
        part, infinite = F.col(f"__part{i}"), (F.abs(low_value) == float("inf")) | (F.abs(high_value) == float("inf"))
        made.append(F.when((part == 0) | (low_value == high_value), low_value)
                    .when(infinite, low_value * (1 - part) + high_value * part)
                    .otherwise(low_value + (high_value - low_value) * part).alias(name))
    return cells.groupBy(*group).agg(*spread).select(*group, *made)


def with_percentiles(df: DataFrame, group: list[str], value: str, quantiles: dict[str, float],
                     accuracy: int = ACCURACY) -> DataFrame:
    """Each row with the percentiles of its group: the windowed form, as a join to one row per group."""
    found = percentiles(df, group, value, quantiles, accuracy)
    if not group:
        return df.withColumns({n: found.select(n).scalar() for n in quantiles})
    return attach(df, found, group, list(quantiles))
