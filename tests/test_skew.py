"""Ranged windows must equal plain ones, whatever the size of the largest group, and not depend on where rows lie."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from siltworks.operators import joins
from siltworks.operators import windows as w
from siltworks.operators.aggregate import percentiles
from siltworks.quality.checks import mutually_exclusive_ranges, sequential_values
from siltworks.sources.stored import history_intervals

RANGES = 13


@pytest.fixture(scope="module")
def hot(spark):
    """1200 rows; one group has half of them, one is null; order values repeat and may be null."""
    rnd = random.Random(5)
    rows = []
    for i in range(1200):
        group = "hot" if i % 2 else rnd.choice(["a", "b", "c", None, "d" + str(i)])
        when = None if rnd.random() < 0.03 else dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randrange(300))
        rows.append((i, group, when, rnd.choice([None, rnd.randrange(1000)]), "k%04d" % rnd.randrange(10**4)))
    return spark.createDataFrame(rows, "id long, g string, ts timestamp_ntz, v long, s string").repartition(7).cache()


@pytest.mark.parametrize("group", [["g"], []])
@pytest.mark.parametrize("order", [["ts", "id"], ["s", "id"], ["v", "ts", "id"]])
def test_neighbours(hot, rows, group, order):
    win = Window.partitionBy(*group).orderBy(*order)
    plain = hot.select("id", F.lag("v").over(win).alias("p"), F.lead("ts").over(win).alias("n"))
    out = w.previous_values(hot, group, order, {"p": F.col("v")}, RANGES)
    out = w.next_values(out, group, order, {"n": F.col("ts")}, RANGES).select("id", "p", "n")
    assert rows(out) == rows(plain)


@pytest.mark.parametrize("group", [["g"], []])
@pytest.mark.parametrize("order", [["ts"], ["ts", "id"], ["s"]])
def test_running_sum(hot, rows, group, order):
    plain = hot.select("id", F.sum("v").over(Window.partitionBy(*group).orderBy(*order)).alias("t"))
    assert rows(w.running_sum(hot, group, order, "v", "t", RANGES).select("id", "t")) == rows(plain)


def test_global_row_number(hot, rows):
    plain = hot.select("id", F.row_number().over(Window.orderBy("s", "id")).cast("bigint").alias("n"))
    assert rows(w.global_row_number(hot, ["s", "id"], "n", RANGES).select("id", "n")) == rows(plain)


@pytest.mark.parametrize("accuracy", [50, 10_000])
@pytest.mark.parametrize("group", [["g"], []])
def test_percentiles(hot, group, accuracy):
    quantiles = {"q0": 0.0, "q37": 0.37, "median": 0.5, "q100": 1.0}
    plain = hot.groupBy(*group).agg(*[F.percentile("v", F.lit(q)).alias(n) for n, q in quantiles.items()])
    split = percentiles(hot, group, "v", quantiles, accuracy)
    a = {r["g"] if group else 0: [r[n] for n in quantiles] for r in plain.collect()}
    b = {r["g"] if group else 0: [r[n] for n in quantiles] for r in split.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert b[k] == [None if x is None else pytest.approx(x) for x in a[k]], k


def test_percentiles_on_rows(hot, rows):
    win = Window.partitionBy("g")
    plain = hot.select("id", F.percentile("v", F.lit(0.5)).over(win).alias("m"))
    from siltworks.operators.aggregate import with_percentiles

    assert rows(with_percentiles(hot, ["g"], "v", {"m": 0.5}).select("id", "m")) == rows(plain)
    assert with_percentiles(hot, [], "v", {"m": 0.5}).select("m").distinct().count() == 1


def test_percentiles_of_a_value_in_half_of_the_rows(spark):
    """Ties, infinities, not-a-number; and ranges narrower than the table."""
    rows = [("t", 7.0)] * 500 + [("t", float(i)) for i in range(500)] + [("u", float("nan"))] * 3 + [("u", float("-inf")), ("u", 2.0), ("w", None)]
    rows += [("z", random.Random(i).random()) for i in range(5000)]
    df = spark.createDataFrame(rows, "g string, v double")
    quantiles = {"q1": 0.1, "m": 0.5, "q9": 0.9, "q99": 0.999}
    plain = {r[0]: r[1:] for r in df.groupBy("g").agg(*[F.percentile("v", F.lit(q)) for q in quantiles.values()]).collect()}
    for accuracy in (100, 10_000):
        out = {r[0]: r[1:] for r in percentiles(df, ["g"], "v", quantiles, accuracy).collect()}
        assert out.keys() == plain.keys()
        for g in out:
            assert [repr(x) if x is None or x != x else round(x, 9) for x in out[g]] == [
                repr(x) if x is None or x != x else round(x, 9) for x in plain[g]], g


def test_ranges_are_small_and_ordered(hot):
    out = w.in_ranges(hot, ["s", "id"], "c", RANGES)
    sizes = out.groupBy("c").agg(F.count("*").alias("n"), F.min("s").alias("lo"), F.max("s").alias("hi")).orderBy("c").collect()
    assert len(sizes) > 10 and max(r["n"] for r in sizes) < 400
    assert all(a["hi"] <= b["lo"] for a, b in zip(sizes, sizes[1:]))


def test_ties_do_not_depend_on_where_rows_lie(spark, hot, rows):
    tied = hot.withColumn("ts", F.expr("date_trunc('DAY', ts)")).withColumn("at", F.lit(1))
    seen = []
    for parts, ranges in ((3, 2), (11, 13), (1, 40)):
        moved = tied.repartition(parts, F.rand(parts))
        seen.append([rows(w.previous_values(moved, ["g"], ["ts"], {"p": F.col("id")}, ranges)),
                     rows(w.next_values(moved, [], ["at"], {"n": F.col("id")}, ranges)),
                     rows(w.running_sum(moved, ["g"], ["at"], "v", "t", ranges)),
                     rows(w.global_row_number(moved, ["at"], "n", ranges))])
    assert seen[0] == seen[1] == seen[2]


def test_columns_of_the_caller_stay(spark):
    df = spark.sql("select id as __mine, map('a', id) as __rank, id % 2 as __chunk, 1 as x from range(6)")
    out = w.previous_values(df, ["__chunk"], ["x"], {"p": F.col("__mine")}, 3)
    assert out.columns == ["__mine", "__rank", "__chunk", "x", "p"]
    assert out.where("p is null").count() == 2
    assert w.global_row_number(df, ["x"], "n", 3).select("n").distinct().count() == 6


@pytest.mark.parametrize("group", [["g"], []])
def test_empty_input(hot, group):
    none = hot.where("id < 0")
    assert w.previous_values(none, group, ["ts"], {"p": F.col("v")}, RANGES).count() == 0
    assert w.running_sum(none, group, ["ts"], "v", "t", RANGES).count() == 0
    assert w.global_row_number(none, ["ts"], "n", RANGES).count() == 0
    assert [tuple(r) for r in percentiles(none, group, "v", {"m": 0.5}).collect()] == ([] if group else [(None,)])


def test_checks_on_hot_groups(hot, rows):
    spans = hot.where("ts is not null").withColumn("until", F.expr("timestampadd(HOUR, 2 + id % 3, ts)"))
    args = (spans, "ts", "until", ["g"])
    assert rows(mutually_exclusive_ranges(*args, ranges=RANGES)) == rows(mutually_exclusive_ranges(*args, ranges=1))
    win = Window.partitionBy("g").orderBy("id")
    steps = hot.select("g", "id", F.lag("id").over(win).alias("previous_id")).where("id <> previous_id + 1")
    assert rows(sequential_values(hot, "id", group_by=["g"], ranges=RANGES)) == rows(steps)
    versions = hot.select("id", "g", "ts")
    a = history_intervals(versions, ["g"], "ts", ["id"], ranges=RANGES)
    assert rows(a) == rows(history_intervals(versions, ["g"], "ts", ["id"], ranges=1))


@pytest.mark.parametrize("share", [2, 1000])
def test_lookup_spreads_a_hot_key(spark, rows, share):
    """One key in half of the left rows (or in few): equal rows, and right rows copied for hot keys only."""
    left = spark.range(4000).select(F.when(F.col("id") % share == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    right = spark.range(4000).select(F.col("id").cast("int").alias("k"), F.lit("w").alias("w")).where("k % 3 = 0")
    with_null = left.unionByName(spark.createDataFrame([(None, -1)], "k long, v long"))
    hot = joins.hot_keys(with_null, ["k"], tasks=8)
    assert len(hot) == (1 if share == 2 else 0) and sum(hot.values()) <= 8
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for how in ("inner", "left", "left_semi", "left_anti"):
            assert rows(joins.lookup(with_null, right, ["k"], how)) == rows(with_null.join(right, "k", how)), how
        out = joins.lookup(left, right, ["k"], "inner").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(out) > 3 and max(r["count"] for r in out) < 1700  # of 2667 rows, 2000 of one key
    assert joins.hot_keys(left.limit(0), ["k"], 8) == {}


def test_points_in_ranges(spark, rows):
    """Random ranges, wide and narrow, open, backwards and equal ones, against a plain condition."""
    rnd = random.Random(2)
    spans = [(rnd.randrange(-500, 500), rnd.choice([0, 1, 3, 60, 700])) for _ in range(60)]
    spans = [(a, a + n) for a, n in spans] + [(5, 4), (None, 3), (3, None), (7, 7), (7, 7), (-2 ** 40, 2 ** 41)]
    points = spark.createDataFrame([(x,) for x in [*range(-600, 600, 7), None, 3, 3, 2 ** 45]], "p long")
    ranges = spark.createDataFrame(spans, "lo long, hi long").withColumn("__level", F.lit("x"))
    plain = points.join(ranges, F.expr("p between lo and hi"), "left")
    for bits in (1, 2, 4):
        assert rows(joins.join_points_in_ranges(points, "p", ranges, "lo", "hi", bits=bits)) == rows(plain)
    assert rows(joins.join_points_in_ranges(points, "p", ranges, "lo", "hi", "inner")) == rows(plain.where("lo is not null"))
    for kind in ("timestamp_ntz", "timestamp", "date"):
        at = lambda c: F.expr(f"cast(timestampadd(HOUR, cast({c} as int) * 5, timestamp_ntz'2024-01-01') as {kind})")
        p, r = points.where("p < 1000").select(at("p").alias("p")), ranges.where("hi < 2000").select(at("lo").alias("lo"), at("hi").alias("hi"))
        assert rows(joins.join_points_in_ranges(p, "p", r, "lo", "hi")) == rows(p.join(r, F.expr("p between lo and hi"), "left")), kind
    assert joins.join_points_in_ranges(points, "p", ranges.limit(0), "lo", "hi").where("lo is null").count() == points.count()
    with pytest.raises(ValueError):
        joins.join_points_in_ranges(points.selectExpr("cast(p as double) p"), "p", ranges, "lo", "hi")


def test_points_are_never_copied_whole(spark, rows, capsys, tmp_path):
    """Spark sees a small packed file and not the levels its rows are multiplied by, and ranges of a size it does not know."""
    spark.range(30000).selectExpr("id * 7 as p", "id % 3 as v").write.parquet(f"{tmp_path}/points")
    points = spark.read.parquet(f"{tmp_path}/points")
    ranges = spark.createDataFrame([(i * 1000, i * 1000 + (3000 if i % 2 else 2), str(i)) for i in range(40)], "lo long, hi long, name string")
    want = rows(points.join(ranges, F.expr("p between lo and hi"), "left"))
    for most, kind in (({}, "BuildRight"), ({"copied": 0}, "SortMergeJoin [__level")):
        out = joins.join_points_in_ranges(points, "p", ranges, "lo", "hi", **most)
        capsys.readouterr()
        out.explain()
        text = capsys.readouterr().out
        assert "BuildLeft" not in text and kind in text
        assert rows(out) == want


def test_a_range_is_few_blocks(spark):
    for bits in (1, 4):
        out = spark.sql("select 12345L as lo, 987654321L as hi").select(F.explode(joins.range_blocks(F.col("lo"), F.col("hi"), 32 // bits, bits)).alias("b"))
        size = F.expr(f"shiftleft(1L, {bits} * b.level)")
        n, total = out.agg(F.count("*"), F.sum(size)).first()
        assert total == 987654321 - 12345 + 1 and n <= 2 * (2 ** bits) * 32 // bits


def test_product_on_a_grid(spark, rows, capsys):
    a, b = spark.range(30).toDF("x"), spark.sql("select * from values (1, 'a'), (2, null), (2, null) as t(y, z)")
    out = joins.product(a, b, 90, (3, 2))
    assert out.columns == ["x", "y", "z"] and rows(out) == rows(a.crossJoin(b))
    out.explain()
    text = capsys.readouterr().out
    assert "Cartesian" not in text and "NestedLoop" not in text
    assert joins.product(a, b.limit(0), 0).count() == 0
    with pytest.raises(ValueError, match="90 rows"):
        joins.product(a, b, 89)
    with pytest.raises(ValueError, match="both sides"):
        joins.product(a, a, 10 ** 6)


@pytest.mark.parametrize("unique", [False, True])
def test_full_outer_of_repeated_and_null_keys(spark, rows, unique):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")] + ([] if unique else [(2, "d"), (2, "d")]), "k int, v string")
    b = spark.createDataFrame([(2, 5), (3, 6), (None, 7)] + ([] if unique else [(3, 6), (2, 8)]), "k int, w int")
    want = a.toDF("a_k", "a_v").join(b.toDF("b_k", "b_w"), F.expr("a_k = b_k"), "full_outer")
    want = want.withColumns({"in_a": F.col("a_v").isNotNull(), "in_b": F.col("b_w").isNotNull()})
    assert rows(joins.full_outer(a, b, ["k"], unique)) == rows(want)


def test_open_ended_ranges_stay_small(spark):
    days = spark.sql("select date'2024-01-01' + cast(id as int) as d from range(10)")
    spans = spark.sql("""select * from values (date'0001-01-01', date'9999-12-31', 1), (date'2024-01-05', date'9999-12-31', 2),
                         (date'2024-01-05', date'2024-01-04', 3), (date'2030-01-01', date'9999-12-31', 4), (null, date'2024-01-03', 5) as t(b, e, i)""")
    out = joins.join_days_in_ranges(days, "d", spans, "b", "e")
    assert out.where("i = 1").count() == 10 and out.where("i = 2").count() == 6 and out.where("i > 2").count() == 0
    assert out.count() == 16 and joins.join_days_in_ranges(days.limit(0), "d", spans, "b", "e").count() == 0
