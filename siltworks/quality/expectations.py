"""Expectations over tables, columns and distributions.

Row expectations return the failing rows, aggregate ones the failing groups with
the value found, schema ones one row per problem.  ``where`` filters rows first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.functions.dates import shift
from siltworks.functions.text import all_of, any_of, with_flags
from siltworks.operators.aggregate import percentiles
from siltworks.operators.windows import moving_zscore, previous_values
from siltworks.quality.checks import (
    accepted_range, accepted_values, equal_expression, expression_between, expression_is_true, fails, filtered,
    grouped_expression, keep_row, not_accepted_values, not_null, recency, unique, unique_combination, within,
)

# --- table shape -------------------------------------------------------------------


def _transform(names, transform):
    change = {"upper": str.upper, "lower": str.lower, None: str}[transform]
    return [change(n) for n in names]


def schema_problems(df: DataFrame, problems: list[tuple[str, str]]) -> DataFrame:
    """One row per problem (subject, problem), with the number of rows it concerns."""
    if not problems:
        empty = df.agg(F.count("*").alias("rows_checked")).where(F.lit(False))
        return empty.select(F.lit("").alias("subject"), F.lit("").alias("problem"), "rows_checked")
    cells = F.array(*[F.struct(F.lit(s).alias("subject"), F.lit(p).alias("problem")) for s, p in problems])
    return df.agg(F.count("*").alias("rows_checked")).select(F.inline(cells), "rows_checked")


def expect_column_to_exist(df, column_name, column_index=None, transform="upper"):
    have = _transform(df.columns, transform)
    name = _transform([column_name], transform)[0]
    if name not in have:
        return schema_problems(df, [(name, "missing")])
    place = have.index(name) + 1
    wrong = column_index is not None and place != max(column_index, 1)
    return schema_problems(df, [(name, f"at position {place}, expected {column_index}")] if wrong else [])


def expect_table_columns_to_contain_set(df, column_list, transform="upper"):
    have = set(_transform(df.columns, transform))
    return schema_problems(df, [(c, "missing") for c in _transform(column_list, transform) if c not in have])


def expect_table_columns_to_not_contain_set(df, column_list, transform="upper"):
    have = set(_transform(df.columns, transform))
    return schema_problems(df, [(c, "not wanted") for c in _transform(column_list, transform) if c in have])


def expect_table_columns_to_match_set(df, column_list, transform="upper"):
    have, want = _transform(df.columns, transform), _transform(column_list, transform)
    return schema_problems(df, [(c, "missing") for c in want if c not in have]
                           + [(c, "not expected") for c in have if c not in want])


def expect_table_columns_to_match_ordered_list(df, column_list, transform="upper"):
    have, want = _transform(df.columns, transform), _transform(column_list, transform)
    longest = max(len(have), len(want))
    pairs = zip(have + [None] * (longest - len(have)), want + [None] * (longest - len(want)))
    return schema_problems(df, [(str(w), f"position {i} holds {h}") for i, (h, w) in enumerate(pairs, 1) if h != w])


def expect_table_column_count_to_equal(df, value):
    n = len(df.columns)
    return schema_problems(df, [] if n == value else [("column_count", f"{n} columns, expected {value}")])


def expect_table_column_count_to_be_between(df, min_value=None, max_value=None):
    n = len(df.columns)
    low, high = (min_value is None or n >= min_value), (max_value is None or n <= max_value)
    return schema_problems(df, [] if low and high else [("column_count", f"{n} columns, out of bounds")])


def expect_table_column_count_to_equal_other_table(df, other):
    n, m = len(df.columns), len(other.columns)
    return schema_problems(df, [] if n == m else [("column_count", f"{n} columns, other table {m}")])


def expect_column_values_to_be_in_type_list(df, column, column_type_list):
    have = df.schema[column].dataType.simpleString()
    ok = have in [t.lower() for t in column_type_list]
    return schema_problems(df, [] if ok else [(column, f"type is {have}")])


def expect_column_values_to_be_of_type(df, column, column_type):
    return expect_column_values_to_be_in_type_list(df, column, [column_type])


# --- row counts and freshness --------------------------------------------------------

def expect_row_values_to_have_recent_data(df, column, datepart, interval, now, where=None):
    return recency(filtered(df, where), column, datepart, interval, now)


def expect_grouped_row_values_to_have_recent_data(df, group_by, timestamp_column, datepart, interval, now, where=None):
    return recency(filtered(df, where), timestamp_column, datepart, interval, now, group_by=group_by)


def expect_table_row_count_to_be_between(df, min_value=None, max_value=None, group_by=(), where=None, strictly=False):
    return expression_between(df, F.count("*"), min_value, max_value, group_by, where, strictly)


def expect_table_row_count_to_equal(df, value, group_by=(), where=None):
    return grouped_expression(df, F.count("*"), lambda c: c == value, group_by, where)


def expect_table_aggregation_to_equal_other_table(df, expression, other, **options):
    return equal_expression(df, expression, other, **options)


def expect_table_row_count_to_equal_other_table(df, other, factor=1, **options):
    return equal_expression(df, F.count("*"), other, F.count("*") * factor, **options)


def expect_table_row_count_to_equal_other_table_times_factor(df, other, factor, **options):
    return expect_table_row_count_to_equal_other_table(df, other, factor, **options)


# --- one column, row by row ------------------------------------------------------------

def expect_column_values_to_be_unique(df, column, where=None):
    return unique(df, column, where)


def expect_column_values_to_not_be_null(df, column, where=None):
    return not_null(df, column, where)


def expect_column_values_to_be_null(df, column, where=None):
    return filtered(df, where).where(F.col(column).isNotNull())


def expect_column_values_to_have_consistent_casing(df, column, display_inconsistent_columns=False):
    """Lower-case values that occur in more than one spelling, with the spellings if asked."""
    spelled = df.select(F.col(column).alias("spelling")).distinct()
    groups = spelled.where("spelling is not null").groupBy(F.lower("spelling").alias("lower_value"))
    if display_inconsistent_columns:
        bad = groups.agg(F.count("*").alias("n_spellings")).where("n_spellings > 1")
        on = F.lower(spelled["spelling"]) == bad["lower_value"]
        return spelled.join(bad, on).select("lower_value", "n_spellings", "spelling")
    return groups.agg(F.count("*").alias("n_spellings")).where("n_spellings > 1")


def expect_column_values_to_be_in_set(df, column, value_set, where=None):
    return accepted_values(df, column, value_set, where)


def expect_column_values_to_not_be_in_set(df, column, value_set, where=None):
    return not_accepted_values(df, column, value_set, where)


def expect_column_values_to_be_between(df, column, min_value=None, max_value=None, where=None, strictly=False):
    return accepted_range(df, column, min_value, max_value, not strictly, where)


def _along(df, column, sort_column, group_by, where, bad, ranges):
    rows = filtered(df, where)
    group, order = list(group_by), [sort_column] if sort_column == column else [sort_column, column]
    out = previous_values(rows, group, order, {"value_lag": F.col(column)}, ranges)
    return out.where(bad(F.col(column), F.col("value_lag")))


def expect_column_values_to_be_increasing(df, column, sort_column, where=None, strictly=True, group_by=(),
                                          ranges=None):
    """Rows not above the row before; rows equal in the sort column are ordered by value."""
    def bad(c, lag):
        return c <= lag if strictly else c < lag

    return _along(df, column, sort_column, group_by, where, bad, ranges)


def expect_column_values_to_be_decreasing(df, column, sort_column, where=None, strictly=True, group_by=(),
                                          ranges=None):
    def bad(c, lag):
        return c >= lag if strictly else c > lag

    return _along(df, column, sort_column, group_by, where, bad, ranges)


def expect_column_value_lengths_to_be_between(df, column, min_value=None, max_value=None, where=None, strictly=False):
    return expression_is_true(df, within(min_value, max_value, strictly)(F.length(column)), where)


def expect_column_value_lengths_to_equal(df, column, value, where=None):
    return expression_is_true(df, F.length(column) == value, where)


# --- patterns ---------------------------------------------------------------------------

def _join(match_on):
    if match_on not in ("any", "all"):
        raise ValueError("match_on is 'any' or 'all'")
    return any_of if match_on == "any" else all_of


def expect_column_values_to_match_regex(df, column, regex, where=None, flags=""):
    return expression_is_true(df, F.col(column).rlike(with_flags(regex, flags)), where)


def expect_column_values_to_not_match_regex(df, column, regex, where=None, flags=""):
    return expression_is_true(df, ~F.col(column).rlike(with_flags(regex, flags)), where)


def expect_column_values_to_match_regex_list(df, column, regex_list, match_on="any", where=None, flags=""):
    hits = [F.col(column).rlike(with_flags(r, flags)) for r in regex_list]
    return expression_is_true(df, _join(match_on)(hits), where)


def expect_column_values_to_not_match_regex_list(df, column, regex_list, match_on="any", where=None, flags=""):
    """With 'any' one pattern that does not match is enough; with 'all' none may match."""
    misses = [~F.col(column).rlike(with_flags(r, flags)) for r in regex_list]
    return expression_is_true(df, _join(match_on)(misses), where)


def expect_column_values_to_match_like_pattern(df, column, like_pattern, where=None):
    return expression_is_true(df, F.col(column).like(like_pattern), where)


def expect_column_values_to_not_match_like_pattern(df, column, like_pattern, where=None):
    return expression_is_true(df, ~F.col(column).like(like_pattern), where)


def expect_column_values_to_match_like_pattern_list(df, column, like_pattern_list, match_on="any", where=None):
    return expression_is_true(df, _join(match_on)([F.col(column).like(p) for p in like_pattern_list]), where)


def expect_column_values_to_not_match_like_pattern_list(df, column, like_pattern_list, match_on="any", where=None):
    return expression_is_true(df, _join(match_on)([~F.col(column).like(p) for p in like_pattern_list]), where)


# --- aggregates ----------------------------------------------------------------------------

def expect_column_distinct_count_to_equal(df, column, value, group_by=(), where=None):
    return grouped_expression(df, F.count_distinct(column), lambda c: c == value, group_by, where)


def expect_column_distinct_count_to_be_greater_than(df, column, value, group_by=(), where=None):
    return grouped_expression(df, F.count_distinct(column), lambda c: c > value, group_by, where)


def expect_column_distinct_count_to_be_less_than(df, column, value, group_by=(), where=None):
    return grouped_expression(df, F.count_distinct(column), lambda c: c < value, group_by, where)


def _value_table(df, column, value_set):
    """The wanted values as rows, in the type of the column."""
    kind = df.schema[column].dataType
    values = F.array(*[F.lit(v).cast(kind) for v in value_set])
    return df.agg(F.count("*").alias("n")).select(F.explode(values).alias("value_field"))


def expect_column_distinct_values_to_be_in_set(df, column, value_set, where=None):
    values = filtered(df, where).select(F.col(column).alias("value_field")).distinct()
    return values.where(~F.col("value_field").isin(list(value_set)))


def expect_column_distinct_values_to_contain_set(df, column, value_set, where=None):
    have = filtered(df, where).select(F.col(column).alias("value_field")).distinct()
    return _value_table(df, column, value_set).join(have, "value_field", "left_anti").distinct()


def expect_column_distinct_values_to_equal_set(df, column, value_set, where=None):
    """Values of only one side, labelled column or set."""
    extra = expect_column_distinct_values_to_be_in_set(df, column, value_set, where)
    lacking = expect_column_distinct_values_to_contain_set(df, column, value_set, where)
    return extra.withColumn("found_in", F.lit("column")).unionAll(lacking.withColumn("found_in", F.lit("set")))


def expect_column_distinct_count_to_equal_other_table(df, column, other=None, other_column=None,
                                                      where=None, other_where=None):
    """Both distinct counts where they differ; without another table it compares the table to itself."""
    other = df if other is None else other
    n = filtered(df, where).agg(F.count_distinct(column).alias("num_rows"))
    m = filtered(other, other_where).agg(F.count_distinct(other_column or column))
    out = n.withColumn("compare_num_rows", m.scalar())
    return out.where(F.col("num_rows") != F.col("compare_num_rows"))


def expect_column_mean_to_be_between(df, column, min_value=None, max_value=None, group_by=(), where=None,
                                     strictly=False):
    return expression_between(df, F.avg(column), min_value, max_value, group_by, where, strictly)


def expect_column_quantile_values_to_be_between(df, column, quantile, min_value=None, max_value=None, group_by=(),
                                                where=None, strictly=False):
    rows = filtered(df, where)
    found = percentiles(rows, list(group_by), column, {"expression": quantile})
    return found.where(fails(within(min_value, max_value, strictly)(F.col("expression"))))


def expect_column_median_to_be_between(df, column, min_value=None, max_value=None, group_by=(), where=None,
                                       strictly=False):
    return expect_column_quantile_values_to_be_between(df, column, 0.5, min_value, max_value, group_by, where, strictly)


def expect_column_stdev_to_be_between(df, column, min_value=None, max_value=None, group_by=(), where=None,
                                      strictly=False):
    return expression_between(df, F.stddev_samp(column), min_value, max_value, group_by, where, strictly)


def expect_column_unique_value_count_to_be_between(df, column, min_value=None, max_value=None, group_by=(),
                                                   where=None, strictly=False):
    return expression_between(df, F.count_distinct(column), min_value, max_value, group_by, where, strictly)


def expect_column_proportion_of_unique_values_to_be_between(df, column, min_value=None, max_value=None, group_by=(),
                                                            where=None, strictly=False):
    share = F.count_distinct(column) / F.count(column)
    return expression_between(df, share, min_value, max_value, group_by, where, strictly)


def expect_column_most_common_value_to_be_in_set(df, column, value_set, top_n=1, data_type="decimal(38,18)", strictly=False):
    """The ``top_n`` most frequent values (all of equal frequency count) that are not in the set.

    Values and set meet as text with ``data_type=None`` or "string", else both cast to that type (a value that does not
    fit it is in no set).  ``strictly``: every most frequent value has to be in the set; otherwise it is enough that one is.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("value_count"))
    levels = counts.select("value_count").distinct().orderBy(F.desc("value_count")).limit(top_n)
    top = counts.join(levels, "value_count", "left_semi")
    kind = data_type or "string"
    known = F.coalesce(F.col(column).try_cast(kind).isin([F.lit(v).try_cast(kind) for v in value_set]), F.lit(False))
    out = top.where(~known)
    if strictly:
        return out
    return out.where(top.where(known).agg(F.count("*") == 0).scalar())


def expect_column_max_to_be_between(df, column, min_value=None, max_value=None, group_by=(), where=None,
                                    strictly=False):
    return expression_between(df, F.max(column), min_value, max_value, group_by, where, strictly)


def expect_column_min_to_be_between(df, column, min_value=None, max_value=None, group_by=(), where=None,
                                    strictly=False):
    return expression_between(df, F.min(column), min_value, max_value, group_by, where, strictly)


def expect_column_sum_to_be_between(df, column, min_value=None, max_value=None, group_by=(), where=None,
                                    strictly=False):
    return expression_between(df, F.sum(column), min_value, max_value, group_by, where, strictly)


# --- several columns -----------------------------------------------------------------------

def expect_column_pair_values_A_to_be_greater_than_B(df, column_A, column_B, or_equal=False, where=None):
    a, b = F.col(column_A), F.col(column_B)
    return expression_is_true(df, a >= b if or_equal else a > b, where)


def expect_column_pair_values_to_be_equal(df, column_A, column_B, where=None):
    return expression_is_true(df, F.col(column_A) == F.col(column_B), where)


def expect_column_pair_values_to_be_in_set(df, column_A, column_B, value_pairs_set, where=None):
    allowed = any_of([(F.col(column_A) == a) & (F.col(column_B) == b) for a, b in value_pairs_set])
    return expression_is_true(df, allowed, where)


def expect_select_column_values_to_be_unique_within_record(df, column_list, ignore_row_if="all_values_are_missing",
                                                           where=None):
    """Rows in which a non-null value stands in more than one of the columns."""
    rows = filtered(df, where).where(keep_row(column_list, ignore_row_if))
    values = F.filter(F.array(*[F.col(c) for c in column_list]), lambda x: x.isNotNull())
    return rows.where(F.size(values) != F.size(F.array_distinct(values)))


def expect_multicolumn_sum_to_equal(df, column_list, sum_total, group_by=(), where=None):
    """Sum over rows and columns against a number or the sum of another column."""
    total = sum((F.sum(c) for c in column_list[1:]), F.sum(column_list[0]))
    target = F.sum(sum_total) if isinstance(sum_total, str) else F.lit(sum_total)
    out = filtered(df, where).groupBy(*group_by).agg(total.alias("column_sum"), target.alias("sum_total"))
    return out.where(fails(F.col("column_sum") == F.col("sum_total")))


def expect_compound_columns_to_be_unique(df, column_list, ignore_row_if="all_values_are_missing", where=None):
    return unique_combination(filtered(df, where).where(keep_row(column_list, ignore_row_if)), column_list)


# --- distributions --------------------------------------------------------------------------

def expect_column_values_to_be_within_n_moving_stdevs(df, column, date_column, end, period="day", lookback_periods=1,
                                                      trend_periods=7, test_periods=14, sigma_threshold=3,
                                                      sigma_threshold_upper=None, sigma_threshold_lower=None,
                                                      take_logs=True, take_diffs=True, group_by=()):
    """Periods in the last ``test_periods`` before ``end`` whose metric moved too far.

    The column is summed per group and period, so every later window holds one row
    per period.  See ``moving_zscore`` for the measure.
    """
    group = list(group_by)
    cut = F.date_trunc(period, F.col(date_column)).cast("timestamp_ntz")
    sums = df.groupBy(*group, cut.alias("metric_period")).agg(F.sum(column).alias("agg_metric_value"))
    scored = moving_zscore(sums, group, "metric_period", "agg_metric_value", lookback_periods, trend_periods,
                           take_logs, take_diffs)
    upper = sigma_threshold if sigma_threshold_upper is None else sigma_threshold_upper
    lower = -sigma_threshold if sigma_threshold_lower is None else sigma_threshold_lower
    last = F.date_trunc(period, F.lit(end).cast("timestamp_ntz")).cast("timestamp_ntz")
    first = shift(last, period, -test_periods)
    tested = scored.where((F.col("metric_period") >= first) & (F.col("metric_period") < last))
    return tested.where((F.col("sigma") > upper) | (F.col("sigma") < lower))


def expect_column_values_to_be_within_n_stdevs(df, column, group_by=(), sigma_threshold=3):
    """Group sums (or single values) further than n sample deviations from their mean."""
    if group_by:
        values = df.groupBy(*group_by).agg(F.sum(column).alias("metric_value"))
    else:
        values = df.withColumn("metric_value", F.col(column))
    stats = values.agg(F.struct(F.avg("metric_value").alias("mean"), F.stddev_samp("metric_value").alias("sd")))
    scored = values.withColumn("__s", stats.scalar())
    scored = scored.withColumn("metric_average", F.col("__s.mean")).withColumn("metric_stdev", F.col("__s.sd"))
    z = F.try_divide(F.col("metric_value") - F.col("metric_average"), F.col("metric_stdev"))
    scored = scored.drop("__s").withColumn("sigma", z)
    return scored.where(F.abs("sigma") > sigma_threshold)


def expect_row_values_to_have_data_for_every_n_datepart(df, date_col, date_part="day", interval=1, where=None,
                                                        test_start_date=None, test_end_date=None,
                                                        exclusion_condition=None):
    """Periods without a row, from the first date up to but not including the last."""
    rows = filtered(df, where)
    moment = F.col(date_col).cast("timestamp_ntz")
    bounds = rows.agg(F.min(moment).alias("lo"), F.max(moment).alias("hi"))
    lo = F.col("lo") if test_start_date is None else F.lit(test_start_date).cast("timestamp_ntz")
    hi = F.col("hi") if test_end_date is None else F.lit(test_end_date).cast("timestamp_ntz")
    lo = F.date_trunc(date_part, lo).cast("timestamp_ntz")
    hi = F.date_trunc(date_part, hi).cast("timestamp_ntz")
    step = F.expr(f"INTERVAL {int(interval)} {date_part}")
    spine = bounds.select(lo.alias("lo"), hi.alias("hi")).select(
        F.col("lo").alias("first"), F.col("hi"),
        F.explode(F.when(F.col("lo") < F.col("hi"), F.sequence("lo", "hi", step))).alias(f"date_{date_part}"))
    spine = spine.where(F.col(f"date_{date_part}") < F.col("hi")).select("first", f"date_{date_part}")
    here = F.date_trunc(date_part, F.col(date_col)).cast("timestamp_ntz")
    present = rows.select(here.alias("period")).distinct()
    if interval == 1:
        missing = spine.join(present, spine[f"date_{date_part}"] == present["period"], "left_anti")
    else:
        start = bounds.select(lo).scalar()
        steps = F.floor(F.timestamp_diff(date_part.upper(), start, F.col("period")) / interval) * interval
        slots = present.select(shift(start, date_part, steps).cast("timestamp_ntz").alias("period")).distinct()
        missing = spine.join(slots, spine[f"date_{date_part}"] == slots["period"], "left_anti")
    missing = missing.select(f"date_{date_part}")
    return missing if exclusion_condition is None else missing.where(exclusion_condition)
