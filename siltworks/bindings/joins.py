"""Joins, set operations, sort and limit."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltworks.bindings.base import query
from siltworks.functions.text import email_normalise
from siltworks.operators import joins, tables
from siltworks.plans.calendar import date_dimension, recursive_dates

col = F.col


@query("join_inner_compound", """
select l_orderkey, l_linenumber, l_partkey, o_custkey, n_name from lineitem
join (select distinct o_orderkey, o_orderdate, o_custkey from orders) on l_orderkey = o_orderkey and l_shipdate >= o_orderdate
join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey""")
def _(t):
    orders = t.orders.select("o_orderkey", "o_orderdate", "o_custkey")
    j = t.lineitem.join(orders, (col("l_orderkey") == col("o_orderkey")) & (col("l_shipdate") >= col("o_orderdate")))
    j = j.join(t.customer, col("o_custkey") == col("c_custkey")).join(t.nation, col("c_nationkey") == col("n_nationkey"))
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "o_custkey", "n_name")


@query("join_left", """
select o_orderkey, o_custkey, c_name, c_mktsegment from orders
left join (select * from customer where c_acctbal > 0) on o_custkey = c_custkey""")
def _(t):
    rich = t.customer.where("c_acctbal > 0")
    return t.orders.join(rich, col("o_custkey") == col("c_custkey"), "left").select(
        "o_orderkey", "o_custkey", "c_name", "c_mktsegment")


@query("star_lookup", """
select l_orderkey, l_linenumber, l_partkey, md5(cast(c_custkey as varchar)) as customer_key, md5(cast(p_partkey as varchar)) as part_key,
  md5(cast(s_suppkey as varchar)) as supplier_key, cast(strftime(o.o_orderdate, '%Y%m%d') as integer) as order_date_key,
  cast(strftime(l_shipdate, '%Y%m%d') as integer) as ship_date_key
from lineitem join orders o on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
left join (select * from part where p_size > 10) on l_partkey = p_partkey
left join (select * from supplier where s_acctbal > 0) on l_suppkey = s_suppkey""")
def _(t):
    bounds = t.orders.agg(F.min("o_orderdate").alias("lo"), F.date_add(F.max("o_orderdate"), 366).alias("hi"))
    days = recursive_dates(bounds, col("lo"), col("hi"))
    days = days.select("dt", F.date_format("dt", "yyyyMMdd").cast("int").alias("date_key"))

    def key(df, c, name):
        return df.select(c, F.md5(col(c).cast("string")).alias(name))

    j = t.lineitem.withColumn("ship_day", col("l_shipdate").cast("date"))
    orders = t.orders.select("o_orderkey", "o_custkey", col("o_orderdate").cast("date").alias("order_day"))
    j = j.join(orders, col("l_orderkey") == col("o_orderkey"))
    j = j.join(key(t.customer, "c_custkey", "customer_key"), col("o_custkey") == col("c_custkey"))
    j = j.join(key(t.part.where("p_size > 10"), "p_partkey", "part_key"), col("l_partkey") == col("p_partkey"), "left")
    j = j.join(key(t.supplier.where("s_acctbal > 0"), "s_suppkey", "supplier_key"), col("l_suppkey") == col("s_suppkey"), "left")
    for day, name in (("order_day", "order_date_key"), ("ship_day", "ship_date_key")):
        j = j.join(days.select(col("dt").alias(day), col("date_key").alias(name)), day, "left")
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "customer_key", "part_key", "supplier_key",
                    "order_date_key", "ship_date_key")


@query("join_anti", """
select c_custkey, c_name from customer c where not exists (
  select 1 from supplier s where lower(trim(concat(' ', s.s_name))) = lower(replace(c.c_name, 'Customer', 'SUPPLIER')))""")
def _(t):
    known = t.supplier.select(email_normalise(F.concat(F.lit(" "), "s_name")).alias("k"))
    mine = t.customer.withColumn("k", F.lower(F.replace("c_name", F.lit("Customer"), F.lit("SUPPLIER"))))
    return mine.join(known.distinct(), "k", "left_anti").select("c_custkey", "c_name")  # customers are unique: no key is hot


@query("join_semi", """
select c_custkey, c_name from customer where exists (select 1 from orders where o_custkey = c_custkey and o_orderpriority = '1-URGENT')""")
def _(t):
    """A customer with many orders sends one key per map task: the right side is reduced first."""
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").select(col("o_custkey").alias("c_custkey")).distinct()
    return t.customer.select("c_custkey", "c_name").join(urgent, "c_custkey", "left_semi")


@query("join_not_in", """
select o_orderkey, k from (select o_orderkey, case when o_orderstatus = 'P' then null else o_custkey end as k from orders)
where k not in (select c_custkey from customer where c_mktsegment = 'BUILDING')""")
def _(t):
    rows = t.orders.select("o_orderkey", F.when(col("o_orderstatus") != "P", col("o_custkey")).alias("k"))
    return joins.not_in(rows, "k", t.customer.where("c_mktsegment = 'BUILDING'"), "c_custkey")


@query("join_or_rewrite", """
with a as (select c_custkey as a_id, lower(replace(c_name, 'Customer', 'party')) as a_mail from customer),
b as (select s_suppkey + 50 as b_id, case when s_nationkey < 12 then lower(replace(s_name, 'Supplier', ' PARTY')) end as b_mail from supplier)
select a_id, b_id, a_mail from a join b on (trim(a_mail) = trim(b_mail)) or a_id = b_id""")
def _(t):
    a = t.customer.select(col("c_custkey").alias("a_id"), F.lower(F.replace("c_name", F.lit("Customer"), F.lit("party"))).alias("a_mail"))
    mail = F.lower(F.replace("s_name", F.lit("Supplier"), F.lit(" PARTY")))
    b = t.supplier.select((col("s_suppkey") + 50).alias("b_id"), F.when(col("s_nationkey") < 12, mail).alias("b_mail"))
    j = joins.join_on_either(a, b, F.trim("a_mail") == F.trim("b_mail"), col("a_id") == col("b_id"))
    return j.select("a_id", "b_id", "a_mail")


QUARTERS_SQL = """
select distinct date_trunc('quarter', o_orderdate)::date as beg,
  (date_trunc('quarter', o_orderdate) + interval 100 day)::date as fin from orders where o_orderstatus <> 'P'"""


def quarters(t):
    """Overlapping ranges: 101 days from the start of each quarter."""
    beg = F.trunc("o_orderdate", "quarter")
    return t.orders.where("o_orderstatus <> 'P'").select(beg.alias("beg"), F.date_add(beg, 100).alias("fin")).distinct()


@query("join_range_date", f"""
select o_orderkey, d as order_day, beg, fin from (select o_orderkey, cast(o_orderdate as date) as d from orders)
left join ({QUARTERS_SQL}) on d between beg and fin""")
def _(t):
    days = t.orders.select("o_orderkey", col("o_orderdate").cast("date").alias("order_day"))
    return joins.join_days_in_ranges(days, "order_day", quarters(t), "beg", "fin")


# Each day's range runs from eight o'clock far into the next day; each hour with a purchase has a short one.
SHIFTS_SQL = """
select distinct date_trunc('day', ts) + interval 8 hour as beg, date_trunc('day', ts) + interval 130623 second as fin from events
union all select distinct date_trunc('hour', ts) + interval 61 second, date_trunc('hour', ts) + interval 95 second from events where event_type = 'purchase'"""


@query("join_range_time", f"""
select event_id, ts, beg, fin from events left join ({SHIFTS_SQL}) on ts between beg and fin""")
def _(t):
    """Ranges of timestamps, wide and short ones, by aligned blocks instead of one row per second."""
    def after(unit, seconds):
        return F.expr(f"cast(timestampadd(SECOND, {seconds}, date_trunc('{unit}', ts)) as timestamp_ntz)")

    days = t.events.select(after("DAY", 28800).alias("beg"), after("DAY", 130623).alias("fin")).distinct()
    hours = t.events.where("event_type = 'purchase'").select(after("HOUR", 61).alias("beg"), after("HOUR", 95).alias("fin")).distinct()
    return joins.join_points_in_ranges(t.events.select("event_id", "ts"), "ts", days.unionAll(hours), "beg", "fin")


@query("join_cross_tables", """
select s_suppkey, s_name, n_nationkey, n_name from supplier cross join nation""")
def _(t):
    return joins.product(t.supplier.select("s_suppkey", "s_name"), t.nation.select("n_nationkey", "n_name"), most_rows=10**10)


@query("join_cross_config", """
select c_custkey, 'SILT' as institution_code, 'PERSON' as entity_type from customer""")
def _(t):
    return joins.with_config(t.customer.select("c_custkey"), institution_code="SILT", entity_type="PERSON")


@query("join_cross", """
select c_custkey, c_name, cast(i as integer) as series_number from customer cross join (select unnest(generate_series(1, 10)) as i)""")
def _(t):
    return joins.repeat_over_series(t.customer.select("c_custkey", "c_name"), 10, "series_number")


@query("join_full_outer", """
select a_k, b_k, a_n, b_n, a_k is not null as in_a, b_k is not null as in_b from
(select c_nationkey as a_k, count(*) as a_n from customer where c_mktsegment = 'BUILDING' and c_acctbal > 8000 group by 1)
full outer join (select s_nationkey as b_k, count(*) as b_n from supplier where s_acctbal > 5000 group by 1) on a_k = b_k""")
def _(t):
    a = t.customer.where("c_mktsegment = 'BUILDING' and c_acctbal > 8000").groupBy(col("c_nationkey").alias("k"))
    b = t.supplier.where("s_acctbal > 5000").groupBy(col("s_nationkey").alias("k"))
    return joins.full_outer(a.agg(F.count("*").alias("n")), b.agg(F.count("*").alias("n")), ["k"], unique=True)


@query("join_expr_key", """
select event_id, cast(strftime(ts, '%Y%m%d') as integer) as date_key, dayname(ts) as day_of_week_name,
  cast(strftime(ts + interval 3 day, '%Y%m%d') as integer) as due_date_key from events""")
def _(t):
    bounds = t.events.agg(F.min("ts").alias("lo"), F.date_add(F.max("ts"), 3).alias("hi"))
    days = date_dimension(recursive_dates(bounds, col("lo"), col("hi"), "date_day"))
    key = F.date_format("date_day", "yyyyMMdd").cast("int")
    seen = days.select(col("date_day").alias("d1"), key.alias("date_key"), "day_of_week_name")
    due = days.select(col("date_day").alias("d2"), key.alias("due_date_key"))
    e = t.events.select("event_id", col("ts").cast("date").alias("d1"), F.date_add("ts", 3).alias("d2"))
    return e.join(seen, "d1", "left").join(due, "d2", "left").drop("d1", "d2")


@query("join_using_full", """
select nationkey, customers, suppliers from
(select c_nationkey as nationkey, count(*) as customers from customer where c_acctbal > 9000 group by 1)
full outer join (select s_nationkey as nationkey, count(*) as suppliers from supplier group by 1) using (nationkey)""")
def _(t):
    a = t.customer.where("c_acctbal > 9000").groupBy(col("c_nationkey").alias("nationkey")).agg(F.count("*").alias("customers"))
    b = t.supplier.groupBy(col("s_nationkey").alias("nationkey")).agg(F.count("*").alias("suppliers"))
    return a.join(b, "nationkey", "full_outer")


# --- set operations -------------------------------------------------------------------

@query("union_all", """
select c_name as name, c_nationkey as nationkey, 'customer' as kind from customer
union all select s_name, s_nationkey, 'supplier' from supplier""")
def _(t):
    a = t.customer.select(col("c_name").alias("name"), col("c_nationkey").alias("nationkey"), F.lit("customer").alias("kind"))
    b = t.supplier.select(F.lit("supplier").alias("kind"), col("s_nationkey").alias("nationkey"), col("s_name").alias("name"))
    return a.unionByName(b)


@query("except_distinct", """
select o_custkey as id from orders except select c_custkey from customer where c_acctbal > 0""")
def _(t):
    return t.orders.select(col("o_custkey").alias("id")).subtract(t.customer.where("c_acctbal > 0").select("c_custkey"))


@query("intersect_distinct", """
select o_custkey as id from orders where o_orderstatus = 'P' intersect select c_custkey from customer where c_acctbal > 0""")
def _(t):
    a = t.orders.where("o_orderstatus = 'P'").select(col("o_custkey").alias("id"))
    return a.intersect(t.customer.where("c_acctbal > 0").select("c_custkey"))


@query("sym_diff", """
with a as (select distinct c_nationkey as nationkey, c_mktsegment as segment from customer where c_acctbal > 9500),
b as (select distinct c_nationkey as nationkey, c_mktsegment as segment from customer where c_acctbal < -500)
select 'a_minus_b' as which_diff, * from (select * from a except select * from b)
union all select 'b_minus_a', * from (select * from b except select * from a)""")
def _(t):
    c = t.customer.select(col("c_nationkey").alias("nationkey"), col("c_mktsegment").alias("segment"), "c_acctbal")
    cols = ["nationkey", "segment"]
    return tables.symmetric_difference(c.where("c_acctbal > 9500"), c.where("c_acctbal < -500"), cols)


@query("union_relations", """
select 'customer' as _source_relation, cast(c_custkey as varchar) as id, c_name as name, c_nationkey as nationkey, c_mktsegment as segment,
  cast(null as integer) as size from customer where c_custkey is not null
union all select 'supplier', cast(s_suppkey as varchar), s_name, s_nationkey, null, null from supplier
union all select 'part', cast(p_partkey as varchar), p_name, null, null, p_size from part""")
def _(t):
    rels = {
        "customer": t.customer.toDF("ID", "name", "nationkey", "balance", "segment"),
        "supplier": t.supplier.toDF("id", "name", "nationkey", "balance"),
        "part": t.part.select(col("p_partkey").alias("Id"), col("p_name").alias("name"), col("p_size").alias("size")),
    }
    out = tables.union_relations(rels, exclude=["BALANCE"], override={"id": "string"}, where=F.expr("id is not null"))
    return out.withColumnRenamed("ID", "id")


@query("union_by_pattern", """
select 'customer' as _source_relation, c_custkey as id, c_name as name from customer
union all select 'supplier', s_suppkey, s_name from supplier""")
def _(t):
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
    found = tables.match_tables(names, pattern="%ER", exclude="ord%")
    assert found == ["customer", "supplier"] and tables.match_tables(names, prefix="NAT") == ["nation"]
    rels = {n: getattr(t, n) for n in found}
    rels = {n: df.select(col(df.columns[0]).alias("id"), col(df.columns[1]).alias("name")) for n, df in rels.items()}
    return tables.union_relations(rels)


@query("order_by", "select c_custkey, c_mktsegment, c_acctbal from customer order by c_mktsegment, c_acctbal desc, c_custkey")
def _(t):
    return t.customer.select("c_custkey", "c_mktsegment", "c_acctbal").orderBy("c_mktsegment", F.desc("c_acctbal"), "c_custkey")


@query("limit_topn", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 25")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)
