"""Generic table checks.  An empty result means the check passes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions.dates import shift
from siltworks.operators.joins import full_outer
from siltworks.operators.tables import symmetric_difference
from siltworks.operators.windows import next_values, previous_values, row_hash_of

IGNORE_RULES = ("all_values_are_missing", "any_value_is_missing")


def as_column(c) -> Column:
    return c if isinstance(c, Column) else F.expr(c)


def filtered(df: DataFrame, where=None) -> DataFrame:
    return df if where is None else df.where(where)


def fails(condition: Column) -> Column:
    """True only where the condition is false; a null condition does not fail."""
    return ~F.coalesce(condition, F.lit(True))


# --- one column ----------------------------------------------------------------

def not_null(df, column, where=None):
    return filtered(df, where).where(F.col(column).isNull())


def unique(df, column, where=None):
    """Repeated non-null values with their counts."""
    rows = filtered(df, where).where(F.col(column).isNotNull())
    return rows.groupBy(column).agg(F.count("*").alias("n_records")).where("n_records > 1")


def accepted_values(df, column, values, where=None):
    """Values outside the list with their counts; nulls pass."""
    counts = filtered(df, where).groupBy(column).agg(F.count("*").alias("n_records"))
    return counts.where(~F.col(column).isin(list(values)))


def not_accepted_values(df, column, values, where=None):
    return filtered(df, where).select(column).distinct().where(F.col(column).isin(list(values)))


def relationships(df, column, parent, parent_column, where=None):
    """Non-null values without a parent row."""
    child = filtered(df, where).where(F.col(column).isNotNull()).select(F.col(column).alias("from_field"))
    to = parent.select(F.col(parent_column).alias("to_field"))
    return child.join(to, F.col("from_field") == F.col("to_field"), "left_anti")


def relationships_where(df, column, parent, parent_column, from_condition=None, to_condition=None):
    return relationships(filtered(df, from_condition), column, filtered(parent, to_condition), parent_column)


def accepted_range(df, column, min_value=None, max_value=None, inclusive=True, where=None):
    if min_value is None and max_value is None:
        raise ValueError("give min_value, max_value or both")
    c, bad = F.col(column), []
    if min_value is not None:
        bad.append(c < min_value if inclusive else c <= min_value)
    if max_value is not None:
        bad.append(c > max_value if inclusive else c >= max_value)
    return filtered(df, where).where(reduce(lambda a, b: a | b, bad))


def at_least_one(df, column, group_by=()):
    """Groups (or the whole table) without a single non-null value."""
    out = df.groupBy(*group_by).agg(F.count(column).alias("filler_value"))
    return out.where("filler_value = 0")


def not_constant(df, column, group_by=()):
    return df.groupBy(*group_by).agg(F.count_distinct(column).alias("n_values")).where("n_values = 1")


def not_empty_string(df, column, trim=True):
    c = F.trim(F.col(column)) if trim else F.col(column)
    return df.where(c == "")


def not_null_proportion(df, column, at_least, at_most=1.0, group_by=()):
    share = (F.count(column) / F.count("*")).alias("not_null_proportion")
    out = df.groupBy(*group_by).agg(share)
    return out.where(~F.col("not_null_proportion").between(at_least, at_most))


def expression_is_true(df, expression, where=None):
    return filtered(df, where).where(fails(as_column(expression)))


def unique_combination(df, columns, where=None):
    """Repeated combinations with their counts; nulls are equal to each other."""
    counts = filtered(df, where).groupBy(*columns).agg(F.count("*").alias("n_records"))
    return counts.where("n_records > 1")


# --- two tables ------------------------------------------------------------------

def cardinality_equality(df, column, other, other_column):
    """Value counts that differ between the tables, labelled by side."""
    def counts(t, c):
        return t.groupBy(F.col(c).alias("value")).agg(F.count("*").alias("num_rows"))

    return symmetric_difference(counts(df, column), counts(other, other_column))


def _paired_counts(df, other, group_by, names):
    """Row counts of both tables, one row per group of either."""
    def counts(t):
        return t.groupBy(*group_by).agg(F.count("*").alias("n"))

    if not group_by:
        return counts(df).select(F.col("n").alias(names[0])).withColumn(names[1], counts(other).select("n").scalar())
    j = full_outer(counts(df), counts(other), list(group_by), unique=True)
    keys = [F.col(f"{s}_{g}").alias(f"{g}_{s}") for g in group_by for s in "ab"]
    return j.select(*keys, F.col("a_n").alias(names[0]), F.col("b_n").alias(names[1]))


def equal_rowcount(df, other, group_by=()):
    """Counts of both tables and their difference; all groups are kept, null where one side lacks a group."""
    out = _paired_counts(df, other, group_by, ("count_a", "count_b"))
    return out.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))


def equal_rowcount_failures(result: DataFrame) -> Column:
    return F.sum(F.coalesce("diff_count", F.lit(0)))


def fewer_rows_than(df, other, group_by=()):
    """Rows too many compared with the other table; equal counts are one failure."""
    ours, theirs = F.col("count_our_model"), F.col("count_comparison_model")
    out = _paired_counts(df, other, group_by, ("count_our_model", "count_comparison_model"))
    delta = F.when(ours > theirs, ours - theirs).when(ours == theirs, 1).otherwise(0)
    return out.withColumn("row_count_delta", delta.cast("bigint"))


def equality(df, other, columns=None):
    return symmetric_difference(df, other, columns)


def equality_failures() -> Column:
    """Differing rows plus how much the two sides differ in number."""
    side = F.when(F.col("which_diff") == "a_minus_b", 1).otherwise(-1)
    return F.count("*") + F.coalesce(F.abs(F.sum(side)), F.lit(0))


# --- ordered ---------------------------------------------------------------------

def mutually_exclusive_ranges(df, lower, upper, partition_by=(), gaps="allowed", zero_length_allowed=False,
                              ranges=None):
    """Ranges that end before they begin, overlap the next one, or break the gap rule."""
    rules = {"allowed": lambda a, b: a <= b, "not_allowed": lambda a, b: a == b, "required": lambda a, b: a < b}
    if gaps not in rules:
        raise ValueError(f"gaps is one of {sorted(rules)}")
    group = list(partition_by)
    spans = df.select(*group, F.col(lower).alias("lower_bound"), F.col(upper).alias("upper_bound"),
                      row_hash_of(df).alias("__tie"))
    order = ["lower_bound", "upper_bound"]
    out = next_values(spans, group, order,
                      {"next_lower_bound": F.col("lower_bound"), "has_next": F.lit(True)}, ranges, "__tie")
    low, high, following = F.col("lower_bound"), F.col("upper_bound"), F.col("next_lower_bound")
    out = out.withColumn("is_last_record", F.col("has_next").isNull()).drop("has_next")
    own = low <= high if zero_length_allowed else low < high
    out = out.withColumn("is_valid_range", F.coalesce(own, F.lit(False)))
    out = out.withColumn("is_valid_next", F.coalesce(rules[gaps](high, following), F.col("is_last_record")))
    return out.where(~(F.col("is_valid_range") & F.col("is_valid_next")))


def recency(df, field, datepart, interval, now, ignore_time=False, group_by=()):
    """Groups whose newest value is older than ``interval`` parts before ``now``."""
    newest, limit = F.max(field), shift(F.lit(now).cast("timestamp_ntz"), datepart, -interval)
    if ignore_time:
        newest, limit = newest.cast("date"), limit.cast("date")
    out = df.groupBy(*group_by).agg(newest.alias("most_recent")).withColumn("threshold", limit)
    return out.where(F.col("most_recent") < F.col("threshold"))


def sequential_values(df, column, interval=1, datepart=None, group_by=(), ranges=None):
    """Values that are not one step after the value before; the first of a group passes."""
    group, before = list(group_by), f"previous_{column}"
    rows = df.select(*group, column, row_hash_of(df).alias("__tie"))
    out = previous_values(rows, group, [column], {before: F.col(column)}, ranges, "__tie")
    wanted = F.col(before) + interval if datepart is None else shift(F.col(before), datepart, interval)
    here = F.col(column) if datepart is None else F.col(column).cast("timestamp_ntz")
    wanted = wanted if datepart is None else wanted.cast("timestamp_ntz")
    return out.where(here != wanted)


# --- generalized -------------------------------------------------------------------

def grouped_expression(df, expression, condition, group_by=(), where=None):
    """Groups (or the whole table) whose aggregate ``expression`` does not meet ``condition``."""
    out = filtered(df, where).groupBy(*group_by).agg(as_column(expression).alias("expression"))
    return out.where(fails(condition(F.col("expression"))))


def within(min_value=None, max_value=None, strictly=False):
    """Condition builder for bounds."""
    if min_value is None and max_value is None:
        raise ValueError("give min_value, max_value or both")

    def check(c: Column) -> Column:
        parts = []
        if min_value is not None:
            parts.append(c > min_value if strictly else c >= min_value)
        if max_value is not None:
            parts.append(c < max_value if strictly else c <= max_value)
        return reduce(lambda a, b: a & b, parts)

    return check


def expression_between(df, expression, min_value=None, max_value=None, group_by=(), where=None, strictly=False):
    return grouped_expression(df, expression, within(min_value, max_value, strictly), group_by, where)


def equal_expression(df, expression, other=None, other_expression=None, group_by=(), other_group_by=None,
                     where=None, other_where=None, tolerance=0.0, tolerance_percent=None):
    """Aggregates that differ between two tables by more than the tolerance."""
    other = df if other is None else other
    other_expression = expression if other_expression is None else other_expression
    other_group_by = group_by if other_group_by is None else other_group_by
    other_where = where if other_where is None else other_where

    def side(t, e, groups, cond):
        keys = [F.col(g).alias(f"col_{i}") for i, g in enumerate(groups, 1)]
        return filtered(t, cond).groupBy(*keys).agg(as_column(e).alias("v"))

    a, b = side(df, expression, group_by, where), side(other, other_expression, other_group_by, other_where)
    if group_by:
        names = [f"col_{i}" for i in range(1, len(group_by) + 1)]
        j = full_outer(a, b, names, unique=True)
        j = j.select(*[F.coalesce(f"a_{n}", f"b_{n}").alias(n) for n in names],
                     F.col("a_v").alias("expression"), F.col("b_v").alias("compare_expression"))
    else:
        j = a.select(F.col("v").alias("expression")).withColumn("compare_expression", b.select("v").scalar())
    x = F.coalesce("expression", F.lit(0))
    gap = F.abs(x - F.coalesce("compare_expression", F.lit(0)))
    j = j.withColumn("expression_difference", gap)
    j = j.withColumn("expression_difference_percent",
                     F.col("expression_difference") / F.nullif(F.col("expression") * F.lit(1.0), F.lit(0.0)))
    if tolerance_percent:
        return j.where(F.col("expression_difference_percent") > tolerance_percent)
    return j.where(F.col("expression_difference") > tolerance)


def keep_row(columns, ignore_row_if="all_values_are_missing") -> Column:
    """Condition that drops rows whose listed columns are all null, or any null."""
    if ignore_row_if not in IGNORE_RULES:
        raise ValueError(f"ignore_row_if is one of {IGNORE_RULES}")
    missing = [F.col(c).isNull() for c in columns]
    if ignore_row_if == "all_values_are_missing":
        return ~reduce(lambda a, b: a & b, missing)
    return ~reduce(lambda a, b: a | b, missing)
