"""Group summaries, pivots, percentiles and marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltworks.bindings.base import query
from siltworks.operators import aggregate
from siltworks.plans import marts

col = F.col


def money(c):
    """Exact sum of a two-decimal column."""
    return F.sum(col(c).cast("decimal(18,2)")).cast("double")


@query("agg_summary", """
select user_id, count(*) as total_events, min(ts) as first_event, max(ts) as latest_event,
  count(distinct event_type) as event_types from events group by user_id""")
def _(t):
    return t.events.groupBy("user_id").agg(
        F.count("*").alias("total_events"), F.min("ts").alias("first_event"), F.max("ts").alias("latest_event"),
        F.count_distinct("event_type").alias("event_types"))


@query("agg_max_by", """
select user_id, arg_max(event_type, (date_trunc('hour', ts), event_id)) as latest_type,
  arg_min(event_type, (date_trunc('hour', ts), event_id)) as first_type from events group by user_id""")
def _(t):
    e = t.events.withColumn("h", F.date_trunc("hour", "ts"))
    return e.groupBy("user_id").agg(aggregate.latest_value("event_type", ["h", "event_id"]).alias("latest_type"),
                                    aggregate.earliest_value("event_type", ["h", "event_id"]).alias("first_type"))


@query("agg_conditional", """
select user_id, arg_min(event_type, (ts, event_id)) as first_type, min(ts) as first_ts,
  arg_max(event_type, (ts, event_id)) as last_type, max(ts) as last_ts from events group by user_id""")
def _(t):
    order = ["ts", "event_id"]
    return t.events.groupBy("user_id").agg(
        aggregate.earliest_value("event_type", order).alias("first_type"), F.min("ts").alias("first_ts"),
        aggregate.latest_value("event_type", order).alias("last_type"), F.max("ts").alias("last_ts"))


@query("agg_bool_or", """
select user_id, max(case when event_type = 'error' and value > 50 then true else false end) as had_big_error,
  max(case when event_type = 'purchase' then true else false end) as has_bought from events group by user_id""")
def _(t):
    big = (col("event_type") == "error") & (col("value") > 50)
    return t.events.groupBy("user_id").agg(F.bool_or(big).alias("had_big_error"),
                                           F.bool_or(col("event_type") == "purchase").alias("has_bought"))


@query("pivot", """
select o_custkey, cast(sum(case when o_orderstatus = 'O' then 1 else 0 end) as bigint) as n_O,
  cast(sum(case when o_orderstatus = 'F' then 1 else 0 end) as bigint) as n_F,
  max(case when o_orderstatus != 'P' then o_totalprice else 0 end) as not_P,
  count(distinct case when o_orderstatus = 'P' then o_orderpriority end) as prios_P from orders group by o_custkey""")
def _(t):
    return t.orders.groupBy("o_custkey").agg(
        *aggregate.pivot_columns("o_orderstatus", ["O", "F"], prefix="n_"),
        *aggregate.pivot_columns("o_orderstatus", ["P"], agg="max", cmp="!=", prefix="not_",
                                 then_value=col("o_totalprice"), else_value=0.0),
        *aggregate.pivot_columns("o_orderstatus", ["P"], agg="count", prefix="prios_", distinct=True,
                                 then_value=col("o_orderpriority"), else_value=F.lit(None)))


@query("pivot_ids", """
select user_id, max(case when event_type = 'purchase' then event_id end) as last_purchase,
  max(case when event_type = 'signup' then event_id end) as last_signup from events group by user_id""")
def _(t):
    return aggregate.pivot_ids(t.events, "user_id", "event_type", "event_id",
                               {"purchase": "last_purchase", "signup": "last_signup"})


@query("unpivot", """
select p_partkey, 'p_name' as prop, p_name as val from part union all select p_partkey, 'p_brand', nullif(p_brand, 'Brand#1') from part
union all select p_partkey, 'p_size', cast(p_size as varchar) from part""")
def _(t):
    rows = t.part.select("p_partkey", "p_name", F.nullif(col("p_brand"), F.lit("Brand#1")).alias("p_brand"), "p_type", "p_size")
    return aggregate.unpivot(rows, ["p_partkey"], remove=["P_TYPE"], field_name="prop", value_name="val")


@query("column_values_topn", """
select p_brand, count(*) as n_rows from part where p_size > 5 group by p_brand order by n_rows desc, p_brand limit 10""")
def _(t):
    return aggregate.column_values(t.part, "p_brand", 10, col("p_size") > 5)


@query("single_value", """
select 'max' as name, coalesce(max(o_totalprice), -1.0) as value from orders
union all select 'none', coalesce(max(o_totalprice), -1.0) from orders where o_orderstatus = 'X'""")
def _(t):
    a = aggregate.single_value(t.orders, F.max("o_totalprice"), -1.0)
    b = aggregate.single_value(t.orders.where("o_orderstatus = 'X'"), F.max("o_totalprice"), -1.0)
    return a.withColumn("name", F.lit("max")).unionByName(b.withColumn("name", F.lit("none")))


@query("percentile_median", """
select l_returnflag, l_linestatus, round(quantile_cont(l_extendedprice, 0.5), 4) as median_price,
  round(quantile_cont(l_extendedprice, 0.9), 4) as p90_price from lineitem group by 1, 2""")
def _(t):
    out = aggregate.percentiles(t.lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice",
                                {"median_price": 0.5, "p90_price": 0.9})
    return out.withColumns({c: F.round(c, 4) for c in ("median_price", "p90_price")})


ENROLMENTS_SQL = """
(select cast(year(o_orderdate) as integer) as term_year, c_mktsegment as department, o_custkey as student, l_partkey as course,
  cast(l_quantity as decimal(18,2)) as attempted, cast(case when l_returnflag = 'R' then 0 else l_quantity end as decimal(18,2)) as earned,
  cast(l_discount as decimal(18,2)) as score, l_returnflag as grade, o_orderstatus as status, o_orderkey, l_linenumber, l_extendedprice
 from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey)"""


def enrolments(t):
    """Order lines as enrolments: customer = student, part = course, order year = term."""
    j = t.lineitem.join(t.orders, col("l_orderkey") == col("o_orderkey")).join(t.customer, col("o_custkey") == col("c_custkey"))
    earned = F.when(col("l_returnflag") == "R", 0).otherwise(col("l_quantity"))
    return j.select(
        F.year("o_orderdate").alias("term_year"), col("c_mktsegment").alias("department"), col("o_custkey").alias("student"),
        col("l_partkey").alias("course"), col("l_quantity").cast("decimal(18,2)").alias("attempted"),
        earned.cast("decimal(18,2)").alias("earned"), col("l_discount").cast("decimal(18,2)").alias("score"),
        col("l_returnflag").alias("grade"), col("o_orderstatus").alias("status"), "o_orderkey", "l_linenumber", "l_extendedprice")


@query("mart_summary", f"""
select term_year, department, count(distinct student) as member_count, count(distinct course) as item_count,
  cast(sum(attempted) as double) as total_attempted, cast(sum(earned) as double) as total_earned,
  round(cast(sum(score) as double) / count(score), 6) as average_score,
  round(sum(case when grade in ('A', 'N') then 1 else 0 end) * 100.0 / nullif(count(*), 0), 4) as success_rate_pct
from {ENROLMENTS_SQL} group by 1, 2""")
def _(t):
    out = marts.enrollment_summary(enrolments(t), ["term_year", "department"], "student", "course", col("attempted"),
                                   col("earned"), col("score").cast("double"), col("grade").isin("A", "N"))
    return out.withColumns({
        "total_attempted": col("total_attempted").cast("double"), "total_earned": col("total_earned").cast("double"),
        "average_score": F.round("average_score", 6), "success_rate_pct": F.round("success_rate_pct", 4)})


@query("mart_retention", """
with seen as (select distinct o_custkey, cast(year(o_orderdate) as integer) as y from orders),
first as (select o_custkey, min(y) as cohort from seen group by 1),
n as (select cohort, y as term_year, count(distinct o_custkey) as members from seen join first using (o_custkey) group by 1, 2)
select cohort, term_year, members, round(members * 100.0 / max(members) over (partition by cohort), 4) as retention_rate_pct from n""")
def _(t):
    rows = t.orders.select("o_custkey", F.year("o_orderdate").alias("period"), F.year("o_orderdate").alias("term_year"))
    out = marts.retention(rows, "o_custkey", "period", "term_year")
    return out.withColumn("retention_rate_pct", F.round("retention_rate_pct", 4))


@query("mart_dashboard", """
select n_name, c_mktsegment, count(distinct o_custkey) as member_count, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
where o_orderdate >= timestamp '1997-01-01' and o_orderstatus = 'O' group by 1, 2""")
def _(t):
    customer = t.customer.withColumnRenamed("c_custkey", "o_custkey")
    nation = t.nation.withColumnRenamed("n_nationkey", "c_nationkey")
    keep = (col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")) & (col("o_orderstatus") == "O")
    out = marts.dashboard(t.orders, [(customer, "o_custkey"), (nation, "c_nationkey")], keep, ["n_name", "c_mktsegment"],
                          "o_custkey", col("o_totalprice").cast("decimal(18,2)"))
    return out.withColumn("total", col("total").cast("double"))


@query("mart_detail", """
select o_orderkey, c_name, c_mktsegment, n_name, o_totalprice from orders join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey where o_orderstatus in ('O', 'F') and c_acctbal > 0""")
def _(t):
    customer = t.customer.withColumnRenamed("c_custkey", "o_custkey")
    nation = t.nation.withColumnRenamed("n_nationkey", "c_nationkey")
    return marts.detail(t.orders, [(customer, "o_custkey"), (nation, "c_nationkey")],
                        col("o_orderstatus").isin("O", "F") & (col("c_acctbal") > 0),
                        ["o_orderkey", "c_name", "c_mktsegment", "n_name", "o_totalprice"])


@query("distinct_rows", "select distinct l_returnflag, l_linestatus, cast(l_shipdate as date) as ship_day from lineitem")
def _(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", col("l_shipdate").cast("date").alias("ship_day")).distinct()


@query("agg_having", """
select l_orderkey, l_linenumber, count(*) as n_records from lineitem group by 1, 2 having count(*) > 1""")
def _(t):
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n_records")).where("n_records > 1")


@query("agg_stats", """
select l_returnflag, round(stddev_samp(l_quantity), 6) as stdev, round(avg(l_quantity), 9) as mean,
  cast(sum(cast(l_quantity as decimal(18,2))) as double) as total, min(l_quantity) as low, max(l_quantity) as high,
  count(distinct l_quantity) / count(l_quantity) as distinct_share from lineitem group by 1""")
def _(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.round(F.stddev_samp("l_quantity"), 6).alias("stdev"), F.round(F.avg("l_quantity"), 9).alias("mean"),
        money("l_quantity").alias("total"), F.min("l_quantity").alias("low"), F.max("l_quantity").alias("high"),
        (F.count_distinct("l_quantity") / F.count("l_quantity")).alias("distinct_share"))


@query("agg_mode_topn", """
select l_shipmonth, n_rows from (select date_trunc('month', l_shipdate) as l_shipmonth, count(*) as n_rows from lineitem group by 1)
order by n_rows desc, l_shipmonth limit 5""")
def _(t):
    months = t.lineitem.select(F.date_trunc("month", "l_shipdate").cast("timestamp_ntz").alias("l_shipmonth"))
    return aggregate.column_values(months, "l_shipmonth", 5)
