"""Properties of the physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from siltworks.bindings import QUERIES
from siltworks.bindings.base import Tables
from siltworks.operators import joins, windows

FOLDER = "/root/testdata/sf0.001"
SLOW = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups")


def plan(df, capsys):
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_join_and_no_python(spark, capsys, name):
    assert not SLOW.search(plan(QUERIES[name](spark, FOLDER), capsys))


def test_first_per_key_limits_before_the_shuffle(spark, capsys):
    df = windows.first_per_key(Tables(spark, FOLDER).orders, ["o_custkey"], [F.desc("o_orderdate")])
    text = plan(df, capsys)
    assert text.index("WindowGroupLimit") < text.index("Exchange") or "Partial" in text
    assert "Partial" in text and "Final" in text


def test_filters_and_columns_reach_the_scan(spark, capsys):
    text = plan(QUERIES["mart_dashboard"](spark, FOLDER), capsys)
    assert "PushedFilters: [IsNotNull(o_orderdate)" in text or "GreaterThanOrEqual(o_orderdate" in text
    assert re.search(r"ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderdate:timestamp_ntz>", text)


def test_star_lookup_reads_only_needed_columns(spark, capsys):
    text = plan(QUERIES["star_lookup"](spark, FOLDER), capsys)
    assert "l_extendedprice" not in text and "c_mktsegment" not in text


def test_not_in_does_not_broadcast_a_list(spark, capsys):
    t = Tables(spark, FOLDER)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(joins.not_in(t.orders, "o_custkey", t.customer, "c_custkey"), capsys)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_not_in_null_rules(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    full, none = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([], "x int")
    with_null = spark.createDataFrame([(1,), (None,)], "x int")
    assert [r[0] for r in joins.not_in(left, "k", full, "x").collect()] == [2]
    assert joins.not_in(left, "k", with_null, "x").count() == 0
    assert joins.not_in(left, "k", none, "x").count() == 3


def test_full_outer_spreads_null_keys(spark, rows):
    a = spark.createDataFrame([(None, i) for i in range(300)] + [(1, 1)], "k int, v int")
    b = spark.createDataFrame([(None, 5), (1, 2), (2, 3)], "k int, w int")
    out = joins.full_outer(a, b, ["k"])
    assert out.count() == 303 and out.where("in_a and in_b").count() == 1
    assert out.where("not in_a").count() == 2
