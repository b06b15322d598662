"""Each check with an input it passes and one it fails."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltworks.quality import checks as q
from siltworks.quality import expectations as e
from siltworks.quality.runner import Check, failing_rows, require_columns, run_checks, store_failures


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(
        [(1, "2020-10-21", 0.0, 1.0, "a", "b", None, None), (2, "2020-10-22", 1.0, 0.0, "b", "ab", None, None),
         (3, "2020-10-23", 0.5, 0.5, "c", "abc", None, None), (4, "2020-10-23", 0.5, 0.5, "c", "abcd", None, None)],
        "idx int, date_col string, num_a double, num_b double, str_a string, str_b string, nul string, nul_2 string").cache()


@pytest.fixture(scope="module")
def mail(spark):
    return spark.createDataFrame([("ab@gmail.com", "91001"), ("ab@mail.com", "90210"), ("abc@gmail.com", "90026"),
                                  ("abc.com@gmail.com", "09876")], "email string, zip string").cache()


def n(df):
    return df.count()


@pytest.mark.parametrize("check,passing,failing,count", [
    (q.not_null, ("idx",), ("nul",), 4),
    (q.unique, ("idx",), ("date_col",), 1),
    (q.accepted_values, ("str_a", ["a", "b", "c"]), ("str_a", ["a"]), 2),
    (q.not_accepted_values, ("str_a", ["x"]), ("str_a", ["a", "c", "x"]), 2),
    (q.accepted_range, ("num_a", 0, 1), ("num_a", 0.5, 0.9), 2),
    (q.accepted_range, ("num_a", None, 1), ("num_a", 0, 1, False), 2),
    (q.at_least_one, ("idx",), ("nul",), 1),
    (q.at_least_one, ("idx", ["str_a"]), ("nul", ["str_a"]), 3),
    (q.not_constant, ("idx",), ("idx", ["date_col"]), 2),
    (q.not_empty_string, ("str_a",), ("str_a",), None),
    (q.not_null_proportion, ("idx", 1.0), ("nul", 0.5), 1),
    (q.expression_is_true, ("num_a + num_b = 1",), ("num_a > num_b",), 3),
    (q.expression_is_true, ("nul = 'x'",), ("idx < 4",), 1),
    (q.unique_combination, (["idx", "str_a"],), (["date_col", "str_a"],), 1),
    (q.sequential_values, ("idx",), ("idx", 2), 3),
    (e.expect_column_values_to_be_null, ("nul",), ("idx",), 4),
    (e.expect_column_values_to_be_increasing, ("idx", "idx"), ("num_b", "idx"), 2),
    (e.expect_column_values_to_be_increasing, ("date_col", "idx", None, False), ("date_col", "idx"), 1),
    (e.expect_column_values_to_be_decreasing, ("num_b", "num_a", None, False), ("idx", "idx"), 3),
    (e.expect_column_value_lengths_to_be_between, ("str_b", 1, 4), ("str_b", 1, 4, None, True), 2),
    (e.expect_column_value_lengths_to_equal, ("str_a", 1), ("str_b", 1), 3),
    (e.expect_column_distinct_count_to_equal, ("idx", 4), ("str_a", 4), 1),
    (e.expect_column_distinct_count_to_be_greater_than, ("idx", 3), ("idx", 4), 1),
    (e.expect_column_distinct_count_to_be_less_than, ("idx", 5), ("idx", 4), 1),
    (e.expect_column_distinct_values_to_be_in_set, ("str_a", ["a", "b", "c"]), ("str_a", ["a"]), 2),
    (e.expect_column_distinct_values_to_contain_set, ("str_a", ["a", "b"]), ("str_a", ["a", "z"]), 1),
    (e.expect_column_distinct_values_to_equal_set, ("str_a", ["a", "b", "c"]), ("str_a", ["a", "z"]), 3),
    (e.expect_column_mean_to_be_between, ("num_a", 0.5, 0.5), ("num_a", 0.6), 1),
    (e.expect_column_median_to_be_between, ("num_a", 0.5, 0.5), ("num_a", None, 0.4), 1),
    (e.expect_column_quantile_values_to_be_between, ("num_a", 0.95, 0.9, 1), ("num_a", 0.95, 0, 0.5), 1),
    (e.expect_column_stdev_to_be_between, ("num_a", 0, 2), ("num_a", 0.5), 1),
    (e.expect_column_unique_value_count_to_be_between, ("str_a", 1, 3), ("str_a", 3, None, (), None, True), 1),
    (e.expect_column_proportion_of_unique_values_to_be_between, ("num_a", 0, 0.75), ("num_a", 0.8), 1),
    (e.expect_column_most_common_value_to_be_in_set, ("num_a", [0.5]), ("num_a", [0.0, 1.0]), 1),
    (e.expect_column_max_to_be_between, ("num_a", 1, 1), ("num_a", 1, 1, (), None, True), 1),
    (e.expect_column_min_to_be_between, ("num_a", 0, 0), ("num_a", 0.1), 1),
    (e.expect_column_sum_to_be_between, ("num_a", 2, 2), ("num_a", 1, 2, ["idx"]), 3),
    (e.expect_column_pair_values_A_to_be_greater_than_B, ("idx", "num_a"), ("num_a", "idx"), 4),
    (e.expect_column_pair_values_to_be_equal, ("num_a", "num_a"), ("num_a", "num_b"), 2),
    (e.expect_column_pair_values_to_be_in_set, ("num_a", "num_b", [(0, 1), (1, 0), (0.5, 0.5)]), ("num_a", "num_b", [(0, 1)]), 3),
    (e.expect_select_column_values_to_be_unique_within_record, (["str_a", "str_b"],), (["num_a", "num_b"],), 2),
    (e.expect_multicolumn_sum_to_equal, (["num_a", "num_b"], 4), (["num_a", "num_b"], 4, ["idx"]), 4),
    (e.expect_compound_columns_to_be_unique, (["idx", "str_a"],), (["date_col", "num_a"],), 1),
    (e.expect_compound_columns_to_be_unique, (["nul", "nul_2"],), (["num_a", "nul"],), 1),
    (e.expect_column_to_exist, ("IDX", 1), ("missing",), 1),
    (e.expect_column_to_exist, ("idx",), ("idx", 2), 1),
    (e.expect_table_columns_to_contain_set, (["idx"],), (["x", "y"],), 2),
    (e.expect_table_columns_to_not_contain_set, (["x"],), (["IDX"],), 1),
    (e.expect_table_column_count_to_equal, (8,), (7,), 1),
    (e.expect_table_column_count_to_be_between, (1, 10), (1, 4), 1),
    (e.expect_column_values_to_be_of_type, ("num_a", "double"), ("num_a", "int"), 1),
    (e.expect_column_values_to_be_in_type_list, ("idx", ["INT", "bigint"]), ("idx", ["string"]), 1),
    (e.expect_table_row_count_to_equal, (4,), (5,), 1),
    (e.expect_table_row_count_to_be_between, (1, 4), (1, None, ["date_col"], None, True), 2),
    (e.expect_column_values_to_have_consistent_casing, ("str_a",), ("str_a",), None),
])
def test_pass_and_fail(data, check, passing, failing, count):
    assert n(check(data, *passing)) == 0
    if count is not None:
        assert n(check(data, *failing)) == count


@pytest.mark.parametrize("check,args,count", [
    (e.expect_column_values_to_match_regex, ("@[^.]*",), 0),
    (e.expect_column_values_to_match_regex, ("&[^.]*",), 4),
    (e.expect_column_values_to_match_regex, ("[A-Z]", None, "i"), 0),
    (e.expect_column_values_to_match_regex, ("[A-Z]", None, "c"), 4),
    (e.expect_column_values_to_not_match_regex, ("@[^.]*",), 4),
    (e.expect_column_values_to_match_regex_list, (["@[^.]*", "&[^.]*"],), 0),
    (e.expect_column_values_to_match_regex_list, (["#[^.]*", "&[^.]*"],), 4),
    (e.expect_column_values_to_match_regex_list, (["@[^.]*", "&[^.]*"], "all"), 4),
    (e.expect_column_values_to_not_match_regex_list, (["@[^.]*", "&[^.]*"],), 0),
    (e.expect_column_values_to_not_match_regex_list, (["@[^.]*", "@[^.]*"],), 4),
    (e.expect_column_values_to_not_match_regex_list, (["&[^.]*", "&[^.]*"], "all"), 0),
    (e.expect_column_values_to_not_match_regex_list, (["@[^.]*", "&[^.]*"], "all"), 4),
    (e.expect_column_values_to_match_like_pattern, ("%@%",), 0),
    (e.expect_column_values_to_match_like_pattern, ("%&%",), 4),
    (e.expect_column_values_to_not_match_like_pattern, ("%&%",), 0),
    (e.expect_column_values_to_not_match_like_pattern, ("%@%",), 4),
    (e.expect_column_values_to_match_like_pattern_list, (["%@%", "%&%"],), 0),
    (e.expect_column_values_to_match_like_pattern_list, (["%@%", "%&%"], "all"), 4),
    (e.expect_column_values_to_not_match_like_pattern_list, (["%@%", "%&%"],), 0),
    (e.expect_column_values_to_not_match_like_pattern_list, (["%@%", "%&%"], "all"), 4),
])
def test_patterns(mail, check, args, count):
    assert n(check(mail, "email", *args)) == count


def test_two_tables(spark, data):
    twice = data.withColumn("factor", F.lit(1)).unionAll(data.withColumn("factor", F.lit(2)))
    assert n(e.expect_table_row_count_to_equal_other_table(data, data)) == 0
    assert n(e.expect_table_row_count_to_equal_other_table(twice, data)) == 1
    assert n(e.expect_table_row_count_to_equal_other_table_times_factor(twice, data, 2)) == 0
    assert n(e.expect_table_row_count_to_equal_other_table_times_factor(twice, data, 2, group_by=["date_col"])) == 0
    assert n(q.equal_expression(twice, "sum(num_a)", data, "sum(num_a) * 2", ["idx"])) == 0
    assert n(q.equal_expression(twice, "sum(num_a)", data, "sum(num_a)", tolerance=1.9)) == 1
    assert n(q.equal_expression(twice, "sum(num_a)", data, "sum(num_a)", tolerance=2.0)) == 0
    assert n(e.expect_column_distinct_count_to_equal_other_table(twice, "idx", data)) == 0
    assert n(e.expect_column_distinct_count_to_equal_other_table(data, "idx", None, "str_a")) == 1
    assert n(e.expect_table_column_count_to_equal_other_table(twice, data)) == 1
    assert n(q.equality(data, data)) == 0 and n(q.equality(data, twice, ["idx"])) == 0
    diff = q.equality(data, data.where("idx > 1"), ["idx"])
    assert diff.agg(q.equality_failures()).first()[0] == 2
    same = q.equal_rowcount(data, data, ["str_a"])
    assert same.agg(q.equal_rowcount_failures(same)).first()[0] == 0
    more = q.equal_rowcount(twice, data)
    assert more.agg(q.equal_rowcount_failures(more)).first()[0] == 4
    assert [r["row_count_delta"] for r in q.fewer_rows_than(data, twice).collect()] == [0]
    assert [r["row_count_delta"] for r in q.fewer_rows_than(data, data).collect()] == [1]
    assert n(q.cardinality_equality(data, "str_a", data, "str_a")) == 0
    assert n(q.relationships(data, "idx", twice, "idx")) == 0
    assert n(q.relationships_where(data, "idx", twice, "idx", "idx > 2", "idx < 4")) == 1


@pytest.mark.parametrize("gaps,zero,count", [("allowed", False, 1), ("not_allowed", False, 2), ("required", True, 1), ("allowed", True, 0)])
def test_ranges(spark, gaps, zero, count):
    df = spark.createDataFrame([(1, 0, 5), (1, 5, 8), (1, 9, 9), (2, 1, 2)], "s int, lo int, hi int")
    assert n(q.mutually_exclusive_ranges(df, "lo", "hi", ["s"], gaps, zero)) == count


def test_range_edges(spark):
    df = spark.createDataFrame([(None, 5), (4, 6), (5, None)], "lo int, hi int")
    assert n(q.mutually_exclusive_ranges(df, "lo", "hi")) == 3
    with pytest.raises(ValueError):
        q.mutually_exclusive_ranges(df, "lo", "hi", gaps="some")


def test_recency_and_steps(spark):
    ts = spark.createDataFrame([(dt.datetime(2021, 1, 1, h),) for h in (0, 1, 2, 4)], "t timestamp_ntz")
    assert n(q.sequential_values(ts, "t", 1, "hour")) == 1
    now = dt.datetime(2021, 1, 1, 6)
    assert n(q.recency(ts, "t", "hour", 2, now)) == 0 and n(q.recency(ts, "t", "hour", 1, now)) == 1
    assert n(q.recency(ts, "t", "hour", 1, now, ignore_time=True)) == 0
    assert n(e.expect_row_values_to_have_recent_data(ts, "t", "day", 1, now)) == 0


def test_missing_periods(spark):
    days = [dt.date(2021, 1, d) for d in (1, 2, 4, 8, 9, 20)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    every = e.expect_row_values_to_have_data_for_every_n_datepart
    assert n(every(df, "d")) == 14
    assert n(every(df, "d", interval=7)) == 0
    assert n(every(df, "d", interval=3)) == 3
    assert n(every(df, "d", test_end_date="2021-01-03")) == 0
    assert n(every(df, "d", test_end_date="2021-01-05", exclusion_condition="date_day <> date'2021-01-03'")) == 0


def test_casing(spark):
    df = spark.createDataFrame([("a",), ("A",), ("b",), (None,)], "v string")
    assert n(e.expect_column_values_to_have_consistent_casing(df, "v")) == 1
    assert n(e.expect_column_values_to_have_consistent_casing(df, "v", True)) == 2


def test_deviations(spark):
    rows = [(dt.date(2021, 1, 1) + dt.timedelta(days=i), 100.0 + i % 3) for i in range(40)]
    rows[35] = (rows[35][0], 5000.0)
    df = spark.createDataFrame(rows, "d date, v double")
    out = e.expect_column_values_to_be_within_n_moving_stdevs(df, "v", "d", dt.datetime(2021, 2, 10))
    # the jump, and the fall back: -3.9 against a mean of 0.56 and a deviation of 1.48
    assert [r["metric_period"].day for r in out.orderBy("metric_period").collect()] == [5, 6]
    early = e.expect_column_values_to_be_within_n_moving_stdevs(df, "v", "d", dt.datetime(2021, 2, 3))
    assert n(early) == 0
    assert n(e.expect_column_values_to_be_within_n_stdevs(df, "v")) == 1


def test_runner(spark, data, tmp_path):
    suite = [Check("null", failing=F.col("nul").isNull(), error_if=">4"),
             Check("small", failing=F.col("idx") > 2, where=F.col("idx") < 4, severity="warn"),
             Check("fine", failing=F.col("idx") < 0), Check("dup", rows=lambda d: q.unique(d, "str_a"), warn_if=">1", error_if=">1")]
    got = {r["check_name"]: (r["failures"], r["status"]) for r in run_checks(data, suite).collect()}
    assert got == {"null": (4, "warn"), "small": (1, "warn"), "fine": (0, "pass"), "dup": (1, "pass")}
    folders = store_failures(data, suite, str(tmp_path))
    assert spark.read.parquet(folders["small"]).count() == 1
    with pytest.raises(ValueError):
        require_columns(data, ["idx", "absent"])
    with pytest.raises(ValueError):
        run_checks(data, [Check("x", failing=F.col("idx") > 1, warn_if="many")])


def test_thresholds(spark, data):
    """Whatever SQL has after the count: ranges, lists, fractions, further conditions on the count."""
    def status(**given):
        return run_checks(data, [Check("x", failing=F.col("nul").isNull(), **given)]).first().status

    assert status(error_if="between 2 and 4") == "error" and status(error_if="between 5 and 9") == "warn"
    assert status(error_if="> 3.5") == "error" and status(error_if=">= 4.5", warn_if="in (1, 2)") == "pass"
    assert status(error_if="!=0 and failures < 4", warn_if="not in (3, 5)") == "warn"
    assert status(error_if="<> 4 or failures = 4", severity="warn", warn_if="is not null") == "warn"
    for wrong in ("many", ">", "> 1 2", "between 3", "", "+ 1"):
        with pytest.raises(ValueError):
            status(warn_if=wrong)


def test_stored_failures(spark, data, tmp_path):
    """Failing rows are written and counted in one evaluation; names may hold anything, columns may clash, checks may find nothing."""
    seen = spark.sparkContext.accumulator(0)

    def count_up(x):
        seen.add(1)
        return x > 2

    wide = data.withColumn("check_no", F.lit("mine"))
    suite = [Check("null / 1", failing=F.col("nul").isNull(), error_if=">4"), Check("both", failing=F.col("idx") > 2),
             Check("slow", failing=F.udf(count_up, "boolean")("idx")), Check("fine", failing=F.col("idx") < 0),
             Check("dup", rows=lambda d: q.unique(d, "str_a")), Check("none", rows=lambda d: d.where("idx < 0")),
             Check("sum", rows=lambda d: d.where("idx > 2"), fail_calc=F.sum("idx"))]
    folder = str(tmp_path / "kept")
    out = run_checks(wide, suite, store=folder)
    once = seen.value
    got = {r.check_name: (r.failures, r.status) for r in out.collect()}
    assert seen.value == once == wide.count()
    assert got == {r.check_name: (r.failures, r.status) for r in run_checks(wide, suite).collect()}
    for c in suite:
        rows = failing_rows(wide, suite, folder, c.name)
        assert c.name == "sum" or rows.count() == got[c.name][0]
        if c.failing is not None:
            assert rows.dtypes == wide.dtypes and rows.exceptAll(wide.where(c.failing)).isEmpty()
    clean = [Check("fine", failing=F.col("idx") < 0)]
    assert run_checks(wide, clean, store=folder + "2").first().failures == 0
    assert failing_rows(wide, clean, folder + "2", "fine").count() == 0
    for wrong in ([], [clean[0], clean[0]]):
        with pytest.raises(ValueError):
            run_checks(wide, wrong)


def test_ignore_rules(data):
    assert data.where(q.keep_row(["nul", "nul_2"])).count() == 0
    assert data.where(q.keep_row(["nul", "idx"])).count() == 4
    assert data.where(q.keep_row(["nul", "idx"], "any_value_is_missing")).count() == 0
    with pytest.raises(ValueError):
        q.keep_row(["nul"], "never")
