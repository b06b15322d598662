"""Ranks, neighbours, running values and histories.

Row counts that decide between one task per group and the split form come from the
base table, which bounds the derived one.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from siltworks.bindings.base import query
from siltworks.operators import joins, windows
from siltworks.plans.calendar import date_dimension, recursive_dates
from siltworks.plans.events import first_last_events
from siltworks.sources.stored import history_intervals

col = F.col


@query("deduplicate", """
select user_id, event_type, ts, event_id from (
  select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as rn from events) where rn = 1""")
def _(t):
    return windows.first_per_key(t.events.select("user_id", "event_type", "ts", "event_id"), ["user_id", "event_type"],
                                 [F.desc("ts"), F.desc("event_id")])


@query("current_row_pick", """
select o_custkey, o_orderkey, beg, fin from (
  select *, row_number() over (partition by o_custkey order by case when fin is null then 0 else 1 end, beg desc nulls first, o_orderkey) as rn
  from (select o_custkey, o_orderkey, case when o_orderpriority = '5-LOW' then null else o_orderdate end as beg,
    case when o_orderstatus = 'O' then null else o_orderdate + interval 30 day end as fin from orders)) where rn = 1""")
def _(t):
    rows = t.orders.select(
        "o_custkey", "o_orderkey", F.when(col("o_orderpriority") != "5-LOW", col("o_orderdate")).alias("beg"),
        F.when(col("o_orderstatus") != "O", F.timestamp_add("DAY", F.lit(30), col("o_orderdate"))).alias("fin"))
    return windows.first_per_key(rows, ["o_custkey"], [col("fin").isNotNull(), F.desc_nulls_first("beg"), col("o_orderkey")])


@query("first_last_event", """
with e as (select *, cast(ts as date) as day, date_trunc('hour', ts) as h from events)
select user_id, arg_min(event_type, (day, h, event_id)) as first_event_type, min(h) as first_event_timestamp,
  arg_max(event_type, (day, h, event_id)) as latest_event_type_from_reg, max(h) as latest_event_timestamp,
  count(*) > count(distinct h) as is_event_timestamp_ambiguous from e group by user_id""")
def _(t):
    e = t.events.withColumn("day", col("ts").cast("date")).withColumn("h", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return first_last_events(e, "user_id", "event_type", "day", "h", ["event_id"])


@query("ambiguous_event", """
select event_id, user_id, case when count(*) over (partition by user_id, h) > 1 then 'AMBIGUOUS' else event_type end as final_type
from (select *, date_trunc('hour', ts) as h from events)""")
def _(t):
    """Counts come from a partial aggregation; the events that look them up are spread by a salt, so a hot key is not one task."""
    e = t.events.select("event_id", "user_id", "event_type", F.date_trunc("hour", "ts").alias("h"))
    n = e.groupBy("user_id", "h").agg(F.count("*").alias("n"))
    label = F.when(col("n") > 1, "AMBIGUOUS").otherwise(col("event_type"))
    return joins.lookup(e, n, ["user_id", "h"], "inner").select("event_id", "user_id", label.alias("final_type"))


@query("priority_pick", """
select o_custkey, o_orderkey, o_orderpriority from (select *, row_number() over (partition by o_custkey
  order by case o_orderpriority when '1-URGENT' then 1 when '2-HIGH' then 2 else 3 end, o_orderdate, o_orderkey) as rn from orders) where rn = 1""")
def _(t):
    rank = F.when(col("o_orderpriority") == "1-URGENT", 1).when(col("o_orderpriority") == "2-HIGH", 2).otherwise(3)
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate")
    return windows.first_per_key(rows, ["o_custkey"], [rank, col("o_orderdate"), col("o_orderkey")]).drop("o_orderdate")


@query("global_row_number", """
select o_orderkey, row_number() over (order by o_orderdate, o_orderkey) as sequence_number from orders""")
def _(t):
    return windows.global_row_number(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"],
                                     "sequence_number").drop("o_orderdate")


@query("lag_sequence", """
select o_custkey, o_orderkey, o_orderdate, lag(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey) as previous_date
from orders""")
def _(t):
    return windows.previous_values(t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"],
                                   ["o_orderdate", "o_orderkey"], {"previous_date": col("o_orderdate")})


@query("range_overlap", """
select * from (select o_custkey, o_orderkey, beg, fin, lead(beg) over (partition by o_custkey order by beg, fin, o_orderkey) as next_beg
  from (select o_custkey, o_orderkey, o_orderdate as beg, o_orderdate + interval 60 day as fin from orders)) where fin > next_beg""")
def _(t):
    fin = F.timestamp_add("DAY", F.lit(60), col("o_orderdate"))
    rows = t.orders.select("o_custkey", "o_orderkey", col("o_orderdate").alias("beg"), fin.alias("fin"))
    out = windows.next_values(rows, ["o_custkey"], ["beg", "fin", "o_orderkey"], {"next_beg": col("beg")})
    return out.where("fin > next_beg")


@query("scd2_intervals", """
select o_custkey, o_orderkey, o_orderstatus, o_orderdate as effective_date,
  lead(o_orderdate) over w as end_date, lead(o_orderdate) over w is null as is_current
from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)""")
def _(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    return history_intervals(rows, ["o_custkey"], "o_orderdate", ["o_orderkey"]).drop("o_orderdate")


@query("dense_rank_weeks", """
select date_day, cast(dense_rank() over (partition by year(date_day) order by date_trunc('week', date_day)) as integer) as week_of_year
from (select distinct cast(o_orderdate as date) as date_day from orders)""")
def _(t):
    from pyspark.sql import Window

    days = t.orders.select(col("o_orderdate").cast("date").alias("date_day")).distinct()
    w = Window.partitionBy(F.year("date_day")).orderBy(F.trunc("date_day", "week"))  # at most 366 days a year
    return days.withColumn("week_of_year", F.dense_rank().over(w))


@query("nearest_rank", """
select week_end_date, month_end, cast(rank() over (partition by month_end order by abs(datediff('day', week_end_date, month_end))) as integer) as nearness
from (select distinct d as week_end_date, last_day(d) as month_end
  from (select cast(o_orderdate as date) as d from orders) where dayofweek(d) = 6)""")
def _(t):
    from pyspark.sql import Window

    bounds = t.orders.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    seen = t.orders.select(col("o_orderdate").cast("date").alias("date_day")).distinct()
    days = date_dimension(recursive_dates(bounds, col("lo"), col("hi"), "date_day")).join(seen, "date_day")
    ends = days.where("day_of_week = 7").select(col("date_day").alias("week_end_date"), col("month_end_date").alias("month_end"))
    w = Window.partitionBy("month_end").orderBy(F.abs(F.datediff("week_end_date", "month_end")))  # a month's Saturdays
    return ends.withColumn("nearness", F.rank().over(w))


@query("pct_of_total", """
select event_type, n, round(100.0 * n / sum(n) over (), 2) as pct from (select event_type, count(*) as n from events group by 1)""")
def _(t):
    return windows.share_of_total(t.events.groupBy("event_type").agg(F.count("*").alias("n")), "n", "pct")


@query("running_sum", """
select o_custkey, o_orderkey, cast(sum(cast(o_totalprice as decimal(18,2))) over (partition by o_custkey order by o_orderdate) as double) as running_total
from orders""")
def _(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", col("o_totalprice").cast("decimal(18,2)").alias("price"))
    out = windows.running_sum(rows, ["o_custkey"], ["o_orderdate"], "price", "running_total")
    return out.select("o_custkey", "o_orderkey", col("running_total").cast("double").alias("running_total"))


@query("moving_zscore", """
with p as (select event_type, cast(ts as date) as day, cast(sum(cast(value as decimal(18,2))) as double) as total from events group by 1, 2),
l as (select *, ln(nullif(total, 0)) - lag(ln(nullif(total, 0))) over (partition by event_type order by day) as x from p),
m as (select *, avg(x) over w as mean, stddev_samp(x) over w as sd from l
  window w as (partition by event_type order by day rows between 7 preceding and 1 preceding))
select event_type, day, total, round(x, 8) as x, round(mean, 8) as mean, round((x - mean) / nullif(sd, 0), 5) as sigma from m""")
def _(t):
    p = t.events.groupBy("event_type", col("ts").cast("date").alias("day")).agg(
        F.sum(col("value").cast("decimal(18,2)")).cast("double").alias("total"))
    out = windows.moving_zscore(p, ["event_type"], "day", "total")
    return out.select("event_type", "day", "total", F.round("metric_test_value", 8).alias("x"),
                      F.round("moving_average", 8).alias("mean"), F.round("sigma", 5).alias("sigma"))
