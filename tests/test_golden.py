"""Known inputs and outputs of single operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltworks.functions import dates as d
from siltworks.functions import flags, keys, numbers, text, web
from siltworks.operators import aggregate, compare, tables, windows
from siltworks.plans import calendar

col = F.col


def test_surrogate_key(spark):
    rows = [("a", "b", "c", "0cc175b9c0f1b6a831c399e269772661", "7b193b3d33184464106f41ddf733783b"),
            ("a", None, "c", "0cc175b9c0f1b6a831c399e269772661", "4f32a73dc87b7bbb7a654d8898d58c7e"),
            (None, None, "c", "f14cc5cdce0420f4a5a6b6d9d7b85f39", "d9c538b129f1a3ad6ecfe55345c32a05")]
    df = spark.createDataFrame(rows, "a string, b string, c string, one string, all string")
    out = df.select("one", "all", keys.surrogate_key(col("a")).alias("k1"), keys.surrogate_key(col("a"), col("b"), col("c")).alias("k3"))
    assert all(r["one"] == r["k1"] and r["all"] == r["k3"] for r in out.collect())


def test_master_id_does_not_cut_long_numbers(spark):
    df = spark.createDataFrame([(7,)], "n long")
    assert df.select(keys.master_id(col("n"))).first()[0] == "DTU_PERSON_000000007"
    with pytest.raises(Exception, match="does not fit"):
        spark.createDataFrame([(10**9,)], "n long").select(keys.master_id(col("n"))).collect()


def test_urls(spark):
    rows = [("www.google.co.uk?utm_source=google&utm_medium=cpc", "www.google.co.uk", None, "cpc"),
            ("http://witanddelight.com/2018/01/tips/", "witanddelight.com", "2018/01/tips/", None),
            ("https://x.org/a/b?utm_medium=organic&utm_source=", "x.org", "a/b", "organic"),
            ("android-app://com.google/page", "com.google", None, None)]
    df = spark.createDataFrame(rows, "u string, host string, path string, medium string")
    for r in df.select("*", web.url_host(col("u")).alias("h"), web.url_path(col("u")).alias("p"),
                       web.url_parameter(col("u"), "utm_medium").alias("m"), web.url_parameter(col("u"), "utm_source").alias("s")).collect():
        assert (r["h"], r["m"]) == (r["host"], r["medium"])
        if not r["u"].startswith("android"):
            assert r["p"] == r["path"]
    assert df.select(web.url_parameter(col("u"), "utm_source")).collect()[2][0] is None


def test_numbers(spark):
    df = spark.createDataFrame([(3, 2, 1), (4, None, 3), (None, None, 2), (None, None, None)], "a int, b int, c int")
    cols = [col(c) for c in "abc"]
    assert [tuple(r) for r in df.select(numbers.safe_add(*cols), numbers.safe_subtract(*cols)).collect()] == [(6, 0), (7, 1), (2, -2), (0, 0)]
    q = spark.createDataFrame([(6, 0), (10, 5), (None, 2), (0, 3)], "n int, d int")
    assert [r[0] for r in q.select(numbers.safe_divide(col("n"), col("d"))).collect()] == [None, 2.0, None, 0.0]
    amounts = [190000.0, 290000.0, 320000.0, 399999.0, 400000.0, 470000.0, 510000.0, 610000.0, 600000.0]
    df = spark.createDataFrame([(a,) for a in amounts], "a double")
    got = [r[0] for r in df.select(numbers.width_bucket(col("a"), F.lit(200000.0), F.lit(600000.0), 4)).collect()]
    assert got == [0, 1, 2, 2, 3, 3, 4, 5, 5]
    place = [F.lit(x) for x in (48.864716, 2.349014, 52.379189, 4.899431)]
    one = spark.range(1).select(numbers.haversine(*place), numbers.haversine(*place, unit="km")).first()
    assert [int(x) for x in one] == [267, 430]
    with pytest.raises(ValueError):
        numbers.haversine(*place, unit="nm")


DATES = [
    (dt.date(2020, 11, 29), dict(prior=dt.date(2020, 11, 28), next=dt.date(2020, 11, 30), name="Sunday", short="Sun", dom=29, doy=334,
                                 dow=1, iso=7, ws=dt.date(2020, 11, 29), we=dt.date(2020, 12, 5), iws=dt.date(2020, 11, 23),
                                 iwe=dt.date(2020, 11, 29), simple=48, week=48, month="November", mshort="Nov")),
    (dt.date(2020, 12, 1), dict(prior=dt.date(2020, 11, 30), next=dt.date(2020, 12, 2), name="Tuesday", short="Tue", dom=1, doy=336,
                                dow=3, iso=2, ws=dt.date(2020, 11, 29), we=dt.date(2020, 12, 5), iws=dt.date(2020, 11, 30),
                                iwe=dt.date(2020, 12, 6), simple=48, week=49, month="December", mshort="Dec")),
]


@pytest.mark.parametrize("day,want", DATES)
def test_known_days(spark, day, want):
    x = F.lit(day)
    got = spark.range(1).select(
        d.yesterday(x).alias("prior"), d.tomorrow(x).alias("next"), d.day_name(x, False).alias("name"), d.day_name(x).alias("short"),
        d.day_of_month(x).alias("dom"), d.day_of_year(x).alias("doy"), d.day_of_week(x, False).alias("dow"), d.day_of_week(x).alias("iso"),
        d.week_start(x).alias("ws"), d.week_end(x).alias("we"), d.week_start(x, True).alias("iws"), d.week_end(x, True).alias("iwe"),
        d.week_of_year(x, "simple").alias("simple"), d.week_of_year(x).alias("week"), d.month_name(x, False).alias("month"),
        d.month_name(x).alias("mshort")).first().asDict()
    assert got == want


def test_times(spark):
    row = spark.range(1).select(
        d.from_unix(F.lit(1623076520)).cast("string"), d.from_unix(F.lit(1623076520000), "milliseconds").cast("string"),
        d.convert_timezone(F.lit("2021-06-07 14:35:20").cast("timestamp_ntz"), "America/Los_Angeles").cast("string"),
        d.round_to_day(F.lit("2021-06-07 07:35:20").cast("timestamp_ntz")).cast("date").cast("string"),
        d.round_to_day(F.lit("2021-06-07 14:35:20").cast("timestamp_ntz")).cast("date").cast("string"),
        d.to_unix(F.lit("2021-06-07 14:35:20").cast("timestamp_ntz"))).first()
    assert tuple(row) == ("2021-06-07 14:35:20", "2021-06-07 14:35:20", "2021-06-07 07:35:20", "2021-06-07", "2021-06-08", 1623076520)
    with pytest.raises(ValueError):
        d.from_unix(F.lit(1), "weeks")


def test_event_times(spark):
    df = spark.createDataFrame([("930",), ("0930",), ("2530",), ("2575",), (None,), ("x",)], "tm string")
    got = [r[0] for r in df.select(d.event_timestamp(F.lit("2024-03-01"), col("tm")).cast("string")).collect()]
    assert got == ["2024-03-01 09:30:00"] * 2 + [None] * 4


def test_year_steps_are_not_full_years(spark):
    row = spark.range(1).select(flags.age_in_year_steps(F.lit("2000-12-31").cast("date"), "2001-01-01"),
                                d.boundary_diff(F.lit("2000-12-31").cast("date"), F.lit("2001-01-01").cast("date"), "week")).first()
    assert tuple(row) == (1, 1)


def test_fiscal_and_academic_edges(spark):
    def parts(day):
        x = F.lit(day).cast("date")
        return tuple(spark.range(1).select(d.academic_year(x), d.fiscal_year(x), d.fiscal_quarter(x), d.fiscal_month(x), d.fiscal_period(x)).first())

    assert parts("2020-06-30") == ("2019-2020", 2020, 4, 12, "FY2020-Q4")
    assert parts("2020-07-01") == ("2019-2020", 2021, 1, 1, "FY2021-Q1")
    assert parts("2020-08-01") == ("2020-2021", 2021, 1, 2, "FY2021-Q1")


def test_text(spark):
    df = spark.createDataFrame([("Hello World",), ("9 lives - cat!",), ("already_fine",)], "s string")
    assert [r[0] for r in df.select(text.slugify(col("s"))).collect()] == ["hello_world", "_9_lives_cat", "already_fine"]
    df = spark.createDataFrame([("x Slate Person ID/123; y",), ("none",), (None,)], "s string")
    assert [r[0] for r in df.select(text.regex_capture(col("s"), "Slate Person ID/([0-9]+)")).collect()] == ["123", None, None]
    df = spark.createDataFrame([(" 7 ",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(text.safe_cast(col("s"), "int", -1)).collect()] == [7, -1, -1]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.createDataFrame([("x",)], "s string").select(text.safe_cast(col("s"), "int")).collect()
    with pytest.raises(ValueError):
        text.with_flags("a", "q")
    df = spark.createDataFrame([("abc",), ("xbc",), ("",)], "s string")
    assert [tuple(r) for r in df.select(text.regex_position(col("s"), "[BC]", "i"), text.regex_position(col("s"), "z*")).collect()] == [(2, 1), (2, 1), (0, 1)]
    df = spark.createDataFrame([("a1b22c3",), ("xyz",), ("",), (None,)], "s string")
    places = [text.regex_position(col("s"), "[0-9]+", position=p, occurrence=n) for p, n in ((1, 2), (3, 1), (5, 1), (1, 3), (1, 4), (9, 1))]
    assert [tuple(r) for r in df.select(*places).collect()] == [(4, 4, 5, 7, 0, 0), (0,) * 6, (0,) * 6, (None,) * 6]


def test_flags(spark):
    df = spark.createDataFrame([("Y", 1), ("N", 0), (" ", 2), (None, None), ("y", 1)], "f string, n int")
    got = [tuple(r) for r in df.select(flags.yes_no(col("f")), flags.one_zero(col("n")), flags.one_or_false(col("n"))).collect()]
    assert got == [(True, True, True), (False, False, False), (None, None, False), (None, None, False), (None, True, True)]


def test_deduplicate_keeps_rows_with_nulls(spark, rows):
    df = spark.createDataFrame([(1, "play", 1), (1, "play", 2), (2, "pause", 1), (3, None, 5)], "user_id int, event string, version int")
    assert rows(windows.first_per_key(df, ["user_id"], [F.desc("version")])) == [(1, "play", 2), (2, "pause", 1), (3, None, 5)]


def test_pivot_with_apostrophe(spark, rows):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")], "size string, color string")
    out = df.groupBy("size").agg(*aggregate.pivot_columns("color", ["red", "blue", "blue's"]))
    assert out.columns == ["size", "red", "blue", "blue's"] and rows(out) == [("M", 1, 0, 0), ("S", 1, 1, 1)]


def test_unpivot(spark, rows):
    df = spark.createDataFrame([(123, "2017-01-01", "active", True), (567, "2017-03-01", "churned", None)],
                               "customer_id int, created_at string, status string, is_updated boolean")
    out = aggregate.unpivot(df, ["customer_id", "created_at"], field_name="prop", value_name="val")
    assert rows(out) == [(123, "2017-01-01", "is_updated", "true"), (123, "2017-01-01", "status", "active"),
                         (567, "2017-03-01", "is_updated", None), (567, "2017-03-01", "status", "churned")]
    assert rows(aggregate.unpivot(df, ["customer_id"], ["CREATED_AT", "status"]))[0][1] == "is_updated"


def test_union_of_unlike_tables(spark, rows):
    a = spark.createDataFrame([(1, "drew", "pi"), (2, "bob", "e")], "id int, name string, favorite_number string")
    b = spark.createDataFrame([(1, "green", "7")], "id int, favorite_color string, favorite_number string")
    out = tables.union_relations({"a": a, "b": b}, exclude=["NAME"], source_column=None)
    assert sorted(out.columns) == ["favorite_color", "favorite_number", "id"] and out.count() == 3
    with pytest.raises(ValueError):
        tables.union_relations({"a": a}, include=["id"], exclude=["name"])
    assert tables.union_relations({"a": a, "b": b}, where=col("id") == 1).count() == 2


def test_compare_tables(spark, rows):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "col_a int, col_b string")
    b = spark.createDataFrame([(1, "a"), (2, "c")], "col_a int, col_b string")
    assert [tuple(r) for r in compare.compare_queries(a, b).collect()] == [(True, True, 1, 33.33), (True, False, 1, 33.33), (False, True, 1, 33.33)]
    assert rows(compare.compare_queries(a, b, summarize=False)) == [(2, "b", True, False), (2, "c", False, True)]
    s = compare.compare_schema(a.withColumn("x", F.lit(1)), b.select("col_b", "col_a"))
    assert [tuple(r)[:3] + tuple(r)[5:] for r in s.orderBy("column_name").collect()] == [
        ("col_a", 1, 2, False, True), ("col_b", 2, 1, False, True), ("x", 3, None, False, False)]


def test_compare_column_states(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "y"), (4, None), (5, "z"), (6, "w"), (None, "q")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "n"), (4, "u"), (5, None), (7, "m")], "k int, v string")
    got = {r["match_status"][0] + r["match_status"][-12:]: r["count_records"] for r in compare.compare_column(a, b, "k", "v").collect()}
    assert sum(got.values()) == 8 and len(got) == 7


def test_keyed_comparison_of_repeated_keys(spark, rows, capsys):
    """Pairs of repeated keys are counted, not made; keys that repeat are flagged; nulls in keys meet nothing."""
    a = spark.createDataFrame([(1, "x"), (1, "x"), (1, None), (2, "y"), (3, None), (None, "q"), (None, "q"), (5, "b")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (1, None), (1, "z"), (2, "y"), (4, "n"), (None, "q"), (5, "c"), (5, "b")], "k int, v string")
    pairs = a.toDF("ka", "va").withColumn("a", F.lit(1)).join(b.toDF("kb", "vb").withColumn("b", F.lit(1)), F.expr("ka = kb"), "full_outer").selectExpr("""
        case when va <=> vb then int(va is null) when a is null then 2 when b is null then 3 when va is null then 4 when vb is null then 5 else 6 end as s""")
    want = {r["s"]: r["count"] for r in pairs.groupBy("s").count().collect()}
    out = compare.compare_column(a, b, "k", "v").collect()
    state = {s: i for i, s in enumerate(compare.MATCH_STATES)}
    assert {state[r["match_status"]]: r["count_records"] for r in out} == want
    assert {state[r["match_status"]]: r["repeated_keys"] for r in out}[0] == 2
    both = rows(compare.compare_all_columns(a, b, "k").select("column_name", "missing_from_a", "missing_from_b", "repeated_keys"))
    assert both == [("K", 2, 3, 2), ("V", 2, 3, 2)]
    flags = {r["primary_key"]: r for r in compare.compare_column_verbose(a, b, "k", "v").where("primary_key is not null").collect()}
    assert {k for k, r in flags.items() if r["repeated_key"]} == {1, 5} and flags[2]["perfect_match"] and flags[4]["missing_from_a"]
    assert rows(compare.compare_presence(a, b, "k").where("k is not null")) == [
        (1, True, False, False), (2, True, False, False), (3, False, True, False), (4, False, False, True), (5, True, False, False)]
    compare.compare_all_columns(a, b, "k").explain()
    text = capsys.readouterr().out
    assert "Join" not in text and text.count("Exchange hashpartitioning") == 1


def test_comparison_holds_every_pair_of_rows(spark, rows):
    """Against a full outer join: keys that repeat on one side or both, nulls that face no row; rows without a key meet nothing."""
    a = spark.createDataFrame([(1, "x"), (1, "x"), (1, None), (2, "y"), (3, None), (5, "b"), (6, None), (6, None), (8, None)], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (1, None), (1, "z"), (2, "y"), (4, None), (5, "c"), (5, "b"), (7, "q"), (7, None), (8, None)], "k int, v string")
    twice = "(1, 5, 6, 7)"

    def flags(c, name):
        return f"""select coalesce(a.k, b.k) as primary_key, '{name}' as column_name,
            coalesce(a.{c} = b.{c} and a.k is not null and b.k is not null, a.{c} is null and b.{c} is null, false) as perfect_match,
            a.{c} is null and a.k is not null as null_in_a, b.{c} is null and b.k is not null as null_in_b, a.k is null as missing_from_a, b.k is null as missing_from_b,
            coalesce(a.k is not null and b.k is not null and not a.{c} <=> b.{c}, false) as conflicting_values, coalesce(a.k, b.k) in {twice} as repeated_key
            from {{a}} a full outer join {{b}} b on a.k = b.k"""

    want = spark.sql(flags("v", "v"), a=a, b=b)
    got = compare.compare_column_verbose(a, b, "k", "v")
    assert rows(got) == rows(want) and got.columns == want.columns and want.count() == 19
    assert got.where("perfect_match and (missing_from_a or missing_from_b)").count() == 0
    both = spark.sql(f"{flags('k', 'K')} union all {flags('v', 'V')}", a=a, b=b)
    assert rows(compare.compare_all_columns(a, b, "k", summarize=False)) == rows(both)
    names = ("perfect_match", "null_in_a", "null_in_b", "missing_from_a", "missing_from_b", "conflicting_values")
    sums = both.groupBy("column_name").agg(*[F.sum(F.col(n).cast("bigint")) for n in names], F.count_distinct(F.when(F.col("repeated_key"), F.col("primary_key"))))
    assert rows(compare.compare_all_columns(a, b, "k")) == rows(sums)
    lone = spark.createDataFrame([(None, "q"), (None, None)], "k int, v string")
    out = compare.compare_column_verbose(a.unionAll(lone), b.unionAll(lone.limit(1)), "k", "v")
    assert rows(out.where("primary_key is not null")) == rows(want)
    assert rows(out.where("primary_key is null").select("perfect_match", "null_in_a", "missing_from_a", "missing_from_b", "repeated_key")) == [
        (False, False, False, True, True), (False, False, True, False, False), (False, True, False, True, True)]
    counts = compare.compare_all_columns(a.unionAll(lone), b.unionAll(lone.limit(1)), "k").where("column_name = 'V'")
    per_row = out.agg(*[F.sum(F.col(n).cast("bigint")) for n in names])
    assert rows(counts.select(*names)) == rows(per_row)


def test_unequal_ranges_are_the_only_rows_compared(spark, rows):
    a = spark.range(5000).selectExpr("id", "if(id % 7 = 0, null, id) as v", "map('a', id) as m").drop("m")
    assert tables.unequal_ranges(a, a.repartition(5), a.columns) == []
    b = a.where("id <> 17").unionAll(spark.sql("select 9999L, 1L")).unionAll(a.where("id = 3"))
    found = tables.unequal_ranges(a, b, a.columns)
    assert 1 <= len(found) <= 3  # a row less, a row more, a row twice
    for ranges in (1, 1024):
        assert rows(tables.differing_flags(a, b, ranges=ranges)) == [(17, 17, True, False), (9999, 1, False, True)]
    assert tables.differing_flags(a.limit(0), a.limit(0)).count() == 0
    assert tables.differing_flags(a, a.limit(0)).count() == 5000


def test_most_common_value_options(spark):
    from siltworks.quality import expectations as e

    df = spark.createDataFrame([("1",), ("1",), ("2.0",), ("2.0",), ("x",), (None,)], "v string")
    bad = lambda *args, **kw: sorted(r["v"] for r in e.expect_column_most_common_value_to_be_in_set(df, "v", *args, **kw).collect())
    assert bad(["2"], strictly=True) == ["1"] and bad(["2"]) == []
    assert bad(["2"], data_type="string") == ["1", "2.0"] and bad(["2", "1"], strictly=True) == []
    assert bad(["x"], top_n=2, data_type=None) == [] and bad(["x"], top_n=2, data_type=None, strictly=True) == ["1", "2.0"]


def test_spines(spark):
    days = calendar.date_spine_between(spark, "2018-01-01", "2018-01-10")
    assert days.count() == 9
    assert calendar.date_spine_between(spark, "2018-01-01 00:00", "2018-01-11 00:00", "hour").count() == 240
    assert calendar.date_spine_between(spark, "2018-01-01", "2018-01-01").count() == 0
    one = spark.range(1)
    assert calendar.recursive_dates(one, F.lit("1980-01-01"), F.lit("2035-12-31")).count() == 20454
    assert calendar.base_dates(one, F.lit("2020-12-01"), 52, "week").count() == 53
    assert calendar.generate_series(spark, 10).count() == 10
    with pytest.raises(ValueError):
        calendar.generate_series(spark, 0)


def test_calendar_and_fiscal_tables(spark):
    days = calendar.date_spine_between(spark, "2015-01-01", "2022-12-31")
    dim = calendar.date_dimension(days)
    assert len(dim.columns) == 36 and dim.count() == 2921
    periods = calendar.fiscal_periods(dim, year_end_month=1)
    by_year = {r[0]: (r[1], r[2]) for r in periods.groupBy("fiscal_year_number").agg(
        F.count("*"), F.max("fiscal_week_of_year")).collect()}
    assert by_year[2017] == (53 * 7, 53) and by_year[2016] == (52 * 7, 52) and 2014 not in by_year
    assert periods.where("fiscal_week_of_year = 53").select("fiscal_period_number").distinct().collect()[0][0] == 12
    assert periods.groupBy("date_day").count().where("count > 1").count() == 0


def test_random_numbers_and_default_values(spark):
    from siltworks.functions.numbers import random_number

    x = spark.range(2000).select(random_number(1, col("id")).alias("a"), random_number(2, col("id")).alias("b"))
    got = x.agg(F.min("a"), F.max("a"), F.avg("a"), F.corr("a", "b")).first()
    assert 0 <= got[0] < 0.01 and 0.99 < got[1] < 1 and abs(got[2] - 0.5) < 0.03 and abs(got[3]) < 0.08
    assert x.repartition(5).agg(F.sum("a")).first()[0] == pytest.approx(x.agg(F.sum("a")).first()[0])
    none = spark.createDataFrame([], "v string")
    assert [tuple(r) for r in aggregate.column_values(none, "v", default=["p", "q"]).collect()] == [("p", 0), ("q", 0)]
    some = spark.createDataFrame([("b",), ("b",), ("a",)], "v string")
    assert [r[0] for r in aggregate.column_values(some, "v", order=[F.asc("v")], default=["p"]).collect()] == ["a", "b"]
