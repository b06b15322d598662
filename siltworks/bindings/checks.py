"""Data-quality checks: each shows the failing rows of a condition the tables do not meet."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltworks.bindings.base import EVENT_NOW, query
from siltworks.quality import checks as q
from siltworks.quality.runner import Check, run_checks

col = F.col


def dirty_orders(t):
    """Orders with null and repeated values."""
    return t.orders.select("o_orderkey", F.when(col("o_orderstatus") != "P", col("o_custkey")).alias("o_custkey"),
                           F.nullif(col("o_orderpriority"), F.lit("5-LOW")).alias("o_orderpriority"), "o_totalprice",
                           F.when(col("o_orderstatus") == "O", F.lit("  ")).otherwise(col("o_orderstatus")).alias("o_orderstatus"))


DIRTY = """(select o_orderkey, case when o_orderstatus <> 'P' then o_custkey end as o_custkey, nullif(o_orderpriority, '5-LOW') as o_orderpriority,
  o_totalprice, case when o_orderstatus = 'O' then '  ' else o_orderstatus end as o_orderstatus from orders)"""


@query("dq_not_null", f"select * from {DIRTY} where o_custkey is null")
def _(t):
    return q.not_null(dirty_orders(t), "o_custkey")


@query("dq_unique", f"select o_custkey, count(*) as n_records from {DIRTY} where o_custkey is not null group by 1 having count(*) > 1")
def _(t):
    return q.unique(dirty_orders(t), "o_custkey")


@query("dq_accepted_values", f"""
select o_orderpriority, count(*) as n_records from {DIRTY} where o_orderpriority not in ('1-URGENT', '2-HIGH') and o_totalprice > 1000 group by 1""")
def _(t):
    return q.accepted_values(dirty_orders(t), "o_orderpriority", ["1-URGENT", "2-HIGH"], "o_totalprice > 1000")


@query("dq_relationships", f"""
select o_custkey as from_field from {DIRTY} where o_custkey is not null and o_custkey not in (select c_custkey from customer where c_acctbal > 0)""")
def _(t):
    return q.relationships(dirty_orders(t), "o_custkey", t.customer.where("c_acctbal > 0"), "c_custkey")


@query("dq_relationships_where", f"""
select o_custkey as from_field from {DIRTY} where o_custkey is not null and o_totalprice > 100000
  and o_custkey not in (select c_custkey from customer where c_mktsegment <> 'BUILDING')""")
def _(t):
    return q.relationships_where(dirty_orders(t), "o_custkey", t.customer, "c_custkey", "o_totalprice > 100000",
                                 "c_mktsegment <> 'BUILDING'")


@query("dq_accepted_range", "select l_orderkey, l_partkey, l_quantity from lineitem where l_quantity <= 2 or l_quantity >= 49")
def _(t):
    return q.accepted_range(t.lineitem, "l_quantity", 2, 49, inclusive=False).select("l_orderkey", "l_partkey", "l_quantity")


SPARSE = "(select c_nationkey, c_mktsegment, case when c_nationkey > 20 then c_acctbal end as balance from customer)"


def sparse(t):
    return t.customer.select("c_nationkey", "c_mktsegment", F.when(col("c_nationkey") > 20, col("c_acctbal")).alias("balance"))


@query("dq_at_least_one", f"select c_nationkey, count(balance) as filler_value from {SPARSE} group by 1 having count(balance) = 0")
def _(t):
    return q.at_least_one(sparse(t), "balance", ["c_nationkey"])


@query("dq_cardinality_equality", """
with a as (select c_nationkey as value, count(*) as num_rows from customer group by 1),
b as (select s_nationkey as value, count(*) as num_rows from supplier group by 1)
select 'a_minus_b' as which_diff, * from (select * from a except select * from b)
union all select 'b_minus_a', * from (select * from b except select * from a)""")
def _(t):
    return q.cardinality_equality(t.customer, "c_nationkey", t.supplier, "s_nationkey")


_PAIRED = """(select a.k as k_a, b.k as k_b, a.n as {0}, b.n as {1} from
(select c_nationkey as k, count(*) as n from customer where c_acctbal > 9000 group by 1) a
full outer join (select s_nationkey as k, count(*) as n from supplier group by 1) b on a.k = b.k)"""


def nations(t):
    return (t.customer.where("c_acctbal > 9000").select(col("c_nationkey").alias("k")),
            t.supplier.select(col("s_nationkey").alias("k")))


@query("dq_equal_rowcount", f"select *, abs(count_a - count_b) as diff_count from {_PAIRED.format('count_a', 'count_b')}")
def _(t):
    return q.equal_rowcount(*nations(t), ["k"])


@query("dq_fewer_rows", f"""
select *, cast(case when count_our_model > count_comparison_model then count_our_model - count_comparison_model
  when count_our_model = count_comparison_model then 1 else 0 end as bigint) as row_count_delta
from {_PAIRED.format('count_our_model', 'count_comparison_model')}""")
def _(t):
    return q.fewer_rows_than(*nations(t), ["k"])


@query("dq_equality", """
with a as (select o_custkey, o_orderstatus from orders), b as (select o_custkey, o_orderstatus from orders where o_totalprice < 300000),
x as (select distinct * from a except select * from b), y as (select distinct * from b except select * from a)
select 'a_minus_b' as which_diff, * from x union all select 'b_minus_a', * from y""")
def _(t):
    return q.equality(t.orders, t.orders.where("o_totalprice < 300000"), ["o_custkey", "o_orderstatus"])


@query("dq_expression", f"select o_orderkey, o_custkey, o_totalprice from {DIRTY} where not (o_custkey * 100 < o_totalprice)")
def _(t):
    return q.expression_is_true(dirty_orders(t), "o_custkey * 100 < o_totalprice").select("o_orderkey", "o_custkey", "o_totalprice")


RANGES = """(select o_custkey, o_orderdate as valid_from, case when o_orderstatus = 'P' then o_orderdate
  else o_orderdate + interval 90 day end as valid_to from orders)"""


def ranges(t):
    until = F.when(col("o_orderstatus") == "P", col("o_orderdate")).otherwise(F.timestamp_add("DAY", F.lit(90), col("o_orderdate")))
    return t.orders.select("o_custkey", col("o_orderdate").alias("valid_from"), until.alias("valid_to"))


@query("dq_ranges", f"""
select * from (select *, coalesce(lower_bound < upper_bound, false) as is_valid_range,
  coalesce(upper_bound <= next_lower_bound, is_last_record, false) as is_valid_next from (
    select o_custkey, valid_from as lower_bound, valid_to as upper_bound,
      lead(valid_from) over (partition by o_custkey order by valid_from, valid_to) as next_lower_bound,
      lead(1) over (partition by o_custkey order by valid_from, valid_to) is null as is_last_record from {RANGES}))
where not (is_valid_range and is_valid_next)""")
def _(t):
    return q.mutually_exclusive_ranges(ranges(t), "valid_from", "valid_to", ["o_custkey"])


@query("dq_not_accepted", f"select distinct o_orderpriority from {DIRTY} where o_orderpriority in ('1-URGENT', '5-LOW', '2-HIGH')")
def _(t):
    return q.not_accepted_values(dirty_orders(t), "o_orderpriority", ["1-URGENT", "5-LOW", "2-HIGH"])


@query("dq_not_constant", """
select p_brand, p_type, count(distinct p_size > 25) as n_values from part group by 1, 2 having count(distinct p_size > 25) = 1""")
def _(t):
    return q.not_constant(t.part.withColumn("is_big", col("p_size") > 25), "is_big", ["p_brand", "p_type"])


@query("dq_not_empty", f"select o_orderkey, o_orderstatus from {DIRTY} where trim(o_orderstatus) = ''")
def _(t):
    return q.not_empty_string(dirty_orders(t), "o_orderstatus").select("o_orderkey", "o_orderstatus")


@query("dq_not_null_prop", f"""
select c_mktsegment, count(balance) / count(*) as not_null_proportion from {SPARSE} group by 1
having not (count(balance) / count(*) between 0.5 and 1.0)""")
def _(t):
    return q.not_null_proportion(sparse(t), "balance", 0.5, group_by=["c_mktsegment"])


@query("dq_recency", """
select user_id, max(ts) as most_recent, timestamp '2024-01-31' as threshold from events group by 1 having max(ts) < timestamp '2024-01-31'""")
def _(t):
    return q.recency(t.events, "ts", "day", 1, EVENT_NOW, group_by=["user_id"])


@query("dq_sequential", """
select * from (select o_custkey, o_orderkey, lag(o_orderkey) over (partition by o_custkey order by o_orderkey) as previous_o_orderkey from orders)
where not (o_orderkey = previous_o_orderkey + 1)""")
def _(t):
    return q.sequential_values(t.orders, "o_orderkey", group_by=["o_custkey"])


@query("dq_unique_combo", f"""
select o_custkey, o_orderpriority, count(*) as n_records from {DIRTY} group by 1, 2 having count(*) > 1""")
def _(t):
    return q.unique_combination(dirty_orders(t), ["o_custkey", "o_orderpriority"])


@query("dq_runner", f"""
with d as (select * from {DIRTY}),
f as (select 'custkey_not_null' as check_name, count(*) as failures, 'error' as s from d where o_custkey is null
  union all select 'price_positive', count(*), 'error' from d where o_totalprice <= 0
  union all select 'status_not_blank', count(*), 'warn' from d where trim(o_orderstatus) = '' and o_totalprice > 1000
  union all select 'custkey_unique', count(*), 'error' from (select 1 from d where o_custkey is not null group by o_custkey having count(*) > 1)
  union all select 'same_as_paid', cast(count(*) + coalesce(abs(sum(w)), 0) as bigint), 'error' from (
    select 1 as w from (select o_custkey from d except select o_custkey from orders)
    union all select -1 from (select o_custkey from orders except select o_custkey from d)))
select check_name, failures, case when failures = 0 then 'pass' when s = 'warn' then 'warn'
  when check_name = 'custkey_unique' and failures <= 1000000000 then 'warn' else 'error' end as status from f""")
def _(t):
    """Three row checks share one scan; the others are one job each."""
    d = dirty_orders(t)
    return run_checks(d, [
        Check("custkey_not_null", failing=col("o_custkey").isNull()),
        Check("price_positive", failing=col("o_totalprice") <= 0),
        Check("status_not_blank", failing=F.trim("o_orderstatus") == "", where=col("o_totalprice") > 1000, severity="warn"),
        Check("custkey_unique", rows=lambda x: q.unique(x, "o_custkey"), error_if=">1000000000"),
        Check("same_as_paid", rows=lambda x: q.equality(x, t.orders, ["o_custkey"]), fail_calc=q.equality_failures()),
    ])


# --- generalized ------------------------------------------------------------------------

@query("exp_expression", """
select o_custkey, count(*) as expression from orders where o_orderstatus <> 'P' group by 1 having not (count(*) > 5)""")
def _(t):
    return q.grouped_expression(t.orders, "count(*)", lambda c: c > 5, ["o_custkey"], "o_orderstatus <> 'P'")


@query("exp_between", """
select l_suppkey, count(distinct l_partkey) as expression from lineitem where l_quantity > 10 group by 1
having not (count(distinct l_partkey) > 300 and count(distinct l_partkey) < 400)""")
def _(t):
    return q.expression_between(t.lineitem, F.count_distinct("l_partkey"), 300, 400, ["l_suppkey"], "l_quantity > 10", strictly=True)


@query("exp_equal_expression", """
with a as (select c_nationkey as col_1, count(*) as v from customer where c_acctbal > 0 group by 1),
b as (select s_nationkey as col_1, count(*) * 10 as v from supplier group by 1),
j as (select coalesce(a.col_1, b.col_1) as col_1, a.v as expression, b.v as compare_expression, abs(coalesce(a.v, 0) - coalesce(b.v, 0)) as expression_difference,
  abs(coalesce(a.v, 0) - coalesce(b.v, 0)) / nullif(a.v * 1.0, 0) as expression_difference_percent from a full outer join b on a.col_1 = b.col_1)
select col_1, expression, cast(compare_expression as bigint) as compare_expression, cast(expression_difference as bigint) as expression_difference,
  round(expression_difference_percent, 9) as expression_difference_percent from j where expression_difference_percent > 0.25""")
def _(t):
    out = q.equal_expression(t.customer, F.count("*"), t.supplier, F.count("*") * 10, ["c_nationkey"], ["s_nationkey"],
                             where="c_acctbal > 0", other_where="true", tolerance_percent=0.25)
    return out.withColumn("expression_difference_percent", F.round("expression_difference_percent", 9))


@query("exp_ignore_row_if", f"""
select o_orderkey, not (o_custkey is null and o_orderpriority is null) as kept_unless_all, not (o_custkey is null or o_orderpriority is null) as kept_unless_any
from {DIRTY}""")
def _(t):
    cols = ["o_custkey", "o_orderpriority"]
    return dirty_orders(t).select("o_orderkey", q.keep_row(cols).alias("kept_unless_all"),
                                  q.keep_row(cols, "any_value_is_missing").alias("kept_unless_any"))
