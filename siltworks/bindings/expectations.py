"""The 62 expectations, each on a condition the tables do not fully meet."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltworks.bindings.base import EVENT_NOW, query
from siltworks.bindings.checks import DIRTY, dirty_orders
from siltworks.quality import expectations as e

col = F.col


def expect(name: str, sql: str):
    return query(f"exp_{name}", sql)


def problems(*rows: tuple[str, str], table: str) -> str:
    """SQL of a schema check: one row per problem with the table's row count."""
    values = ", ".join(f"('{s}', '{p}')" for s, p in rows)
    return f"select subject, problem, rows_checked from (values {values}) v(subject, problem), (select count(*) as rows_checked from {table})"


# --- table shape ---------------------------------------------------------------------

@expect("column_to_exist", problems(("O_ORDERDATE", "at position 5, expected 2"), table="orders"))
def _(t):
    return e.expect_column_to_exist(t.orders, "o_orderdate", column_index=2)


@expect("table_column_count_to_be_between", problems(("column_count", "6 columns, out of bounds"), table="orders"))
def _(t):
    return e.expect_table_column_count_to_be_between(t.orders, 7, 9)


@expect("table_column_count_to_equal_other_table", problems(("column_count", "5 columns, other table 4"), table="customer"))
def _(t):
    return e.expect_table_column_count_to_equal_other_table(t.customer, t.supplier)


@expect("table_columns_to_not_contain_set", problems(("C_NAME", "not wanted"), table="customer"))
def _(t):
    return e.expect_table_columns_to_not_contain_set(t.customer, ["c_name", "c_ssn"])


@expect("table_columns_to_contain_set", problems(("c_email", "missing"), table="customer"))
def _(t):
    return e.expect_table_columns_to_contain_set(t.customer, ["C_NAME", "C_EMAIL"], transform="lower")


@expect("table_column_count_to_equal", problems(("column_count", "6 columns, expected 5"), table="part"))
def _(t):
    return e.expect_table_column_count_to_equal(t.part, 5)


@expect("table_columns_to_match_ordered_list", problems(
    ("S_NATIONKEY", "position 2 holds S_NAME"), ("S_NAME", "position 3 holds S_NATIONKEY"), table="supplier"))
def _(t):
    return e.expect_table_columns_to_match_ordered_list(t.supplier, ["s_suppkey", "s_nationkey", "s_name", "s_acctbal"])


@expect("table_columns_to_match_set", problems(("S_PHONE", "missing"), ("S_ACCTBAL", "not expected"), table="supplier"))
def _(t):
    return e.expect_table_columns_to_match_set(t.supplier, ["s_phone", "s_name", "s_suppkey", "s_nationkey"])


@expect("column_values_to_be_of_type", problems(("o_custkey", "type is bigint"), table="orders"))
def _(t):
    return e.expect_column_values_to_be_of_type(t.orders, "o_custkey", "int")


@expect("column_values_to_be_in_type_list", problems(("o_orderdate", "type is timestamp_ntz"), table="orders"))
def _(t):
    return e.expect_column_values_to_be_in_type_list(t.orders, "o_orderdate", ["date", "STRING"])


# --- counts and freshness -----------------------------------------------------------------

@expect("row_values_to_have_recent_data", """
select max(ts) as most_recent, timestamp '2024-01-31 23:00:00' as threshold from events where event_type = 'error' having max(ts) < timestamp '2024-01-31 23:00:00'""")
def _(t):
    return e.expect_row_values_to_have_recent_data(t.events, "ts", "hour", 1, EVENT_NOW, "event_type = 'error'")


@expect("grouped_row_values_to_have_recent_data", """
select user_id, event_type, max(ts) as most_recent, timestamp '2024-01-25' as threshold from events where value > 10
group by 1, 2 having max(ts) < timestamp '2024-01-25'""")
def _(t):
    return e.expect_grouped_row_values_to_have_recent_data(t.events, ["user_id", "event_type"], "ts", "week", 1, EVENT_NOW, "value > 10")


@expect("table_aggregation_to_equal_other_table", """
with a as (select c_nationkey as col_1, max(c_custkey) as v from customer group by 1), b as (select s_nationkey as col_1, max(s_suppkey) as v from supplier group by 1)
select coalesce(a.col_1, b.col_1) as col_1, a.v as expression, b.v as compare_expression, abs(coalesce(a.v, 0) - coalesce(b.v, 0)) as expression_difference,
  round(abs(coalesce(a.v, 0) - coalesce(b.v, 0)) / nullif(a.v * 1.0, 0), 9) as expression_difference_percent
from a full outer join b on a.col_1 = b.col_1 where abs(coalesce(a.v, 0) - coalesce(b.v, 0)) > 50""")
def _(t):
    out = e.expect_table_aggregation_to_equal_other_table(
        t.customer, "max(c_custkey)", t.supplier, other_expression="max(s_suppkey)", group_by=["c_nationkey"],
        other_group_by=["s_nationkey"], tolerance=50)
    return out.withColumn("expression_difference_percent", F.round("expression_difference_percent", 9))


@expect("table_row_count_to_be_between", """
select o_custkey, count(*) as expression from orders where o_orderstatus = 'O' group by 1 having not (count(*) >= 2 and count(*) <= 8)""")
def _(t):
    return e.expect_table_row_count_to_be_between(t.orders, 2, 8, ["o_custkey"], "o_orderstatus = 'O'")


def _counts_sql(left, right, factor):
    return f"""
with a as (select count(*) as v from {left}), b as (select cast(count(*) * {factor} as bigint) as v from {right})
select a.v as expression, b.v as compare_expression, abs(a.v - b.v) as expression_difference, round(abs(a.v - b.v) / nullif(a.v * 1.0, 0), 9) as expression_difference_percent
from a, b where abs(a.v - b.v) > 0"""


def _rounded(out):
    return out.withColumn("expression_difference_percent", F.round("expression_difference_percent", 9))


@expect("table_row_count_to_equal_other_table", _counts_sql("lineitem", "orders", 1))
def _(t):
    return _rounded(e.expect_table_row_count_to_equal_other_table(t.lineitem, t.orders))


@expect("table_row_count_to_equal_other_table_times_factor", _counts_sql("lineitem", "customer", 7))
def _(t):
    return _rounded(e.expect_table_row_count_to_equal_other_table_times_factor(t.lineitem, t.customer, 7))


@expect("table_row_count_to_equal", """
select l_returnflag, l_linestatus, count(*) as expression from lineitem where l_quantity > 5 group by 1, 2 having not (count(*) = 1)""")
def _(t):
    return e.expect_table_row_count_to_equal(t.lineitem, 1, ["l_returnflag", "l_linestatus"], "l_quantity > 5")


# --- one column --------------------------------------------------------------------------------

@expect("column_values_to_be_unique", f"""
select o_custkey, count(*) as n_records from {DIRTY} where o_custkey is not null and o_totalprice > 250000 group by 1 having count(*) > 1""")
def _(t):
    return e.expect_column_values_to_be_unique(dirty_orders(t), "o_custkey", "o_totalprice > 250000")


@expect("column_values_to_not_be_null", f"select * from {DIRTY} where o_orderpriority is null and o_totalprice > 1000")
def _(t):
    return e.expect_column_values_to_not_be_null(dirty_orders(t), "o_orderpriority", "o_totalprice > 1000")


@expect("column_values_to_be_null", f"select * from {DIRTY} where o_orderpriority is not null and o_orderstatus = 'P'")
def _(t):
    return e.expect_column_values_to_be_null(dirty_orders(t), "o_orderpriority", "o_orderstatus = 'P'")


@expect("column_values_to_have_consistent_casing", """
with v as (select distinct case when p_size > 25 then upper(p_type) else p_type end as spelling from part union select distinct p_name from part),
bad as (select lower(spelling) as lower_value, count(*) as n_spellings from v group by 1 having count(*) > 1)
select lower_value, n_spellings, spelling from v join bad on lower(spelling) = lower_value
union all select lower_value, n_spellings, spelling from (select lower(s) as lower_value, count(*) as n_spellings from (select distinct case when p_size > 25 then upper(p_name) else p_name end as s from part) group by 1 having count(*) > 1)
join (select distinct case when p_size > 25 then upper(p_name) else p_name end as spelling from part) on lower(spelling) = lower_value""")
def _(t):
    kinds = t.part.select(F.when(col("p_size") > 25, F.upper("p_type")).otherwise(col("p_type")).alias("v"))
    kinds = kinds.unionAll(t.part.select("p_name"))
    names = t.part.select(F.when(col("p_size") > 25, F.upper("p_name")).otherwise(col("p_name")).alias("v"))
    return e.expect_column_values_to_have_consistent_casing(kinds, "v", True).unionByName(
        e.expect_column_values_to_have_consistent_casing(names, "v", True))


@expect("column_values_to_be_in_set", """
select o_orderpriority, count(*) as n_records from orders where o_orderpriority not in ('1-URGENT', '2-HIGH') and o_orderstatus = 'F' group by 1""")
def _(t):
    return e.expect_column_values_to_be_in_set(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH"], "o_orderstatus = 'F'")


@expect("column_values_to_be_between", "select p_partkey, p_size from part where p_size <= 5 or p_size >= 45")
def _(t):
    return e.expect_column_values_to_be_between(t.part, "p_size", 5, 45, strictly=True).select("p_partkey", "p_size")


@expect("column_values_to_not_be_in_set", "select distinct o_orderstatus from orders where o_orderstatus in ('P', 'X') and o_totalprice > 5000")
def _(t):
    return e.expect_column_values_to_not_be_in_set(t.orders, "o_orderstatus", ["P", "X"], "o_totalprice > 5000")


def _along_sql(table, group, sort, value, op, where="true"):
    return f"""select * from (select {group}, {sort}, {value}, lag({value}) over (partition by {group} order by {sort}, {value}) as value_lag
from {table} where {where}) where {value} {op} value_lag"""


@expect("column_values_to_be_increasing", _along_sql("orders", "o_custkey", "o_orderdate", "o_totalprice", "<="))
def _(t):
    rows = t.orders.select("o_custkey", "o_orderdate", "o_totalprice")
    return e.expect_column_values_to_be_increasing(rows, "o_totalprice", "o_orderdate", group_by=["o_custkey"])


@expect("column_values_to_be_decreasing", _along_sql("orders", "o_custkey", "o_orderkey", "o_orderdate", ">", "o_orderstatus = 'O'"))
def _(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    return e.expect_column_values_to_be_decreasing(rows, "o_orderdate", "o_orderkey", "o_orderstatus = 'O'", strictly=False,
                                                   group_by=["o_custkey"]).drop("o_orderstatus")


@expect("column_value_lengths_to_be_between", "select doc_id, length(text) as n from documents where length(text) < 300 or length(text) > 2000")
def _(t):
    out = e.expect_column_value_lengths_to_be_between(t.documents, "text", 300, 2000)
    return out.select("doc_id", F.length("text").cast("bigint").alias("n"))


@expect("column_value_lengths_to_equal", "select p_partkey, p_brand from part where length(p_brand) <> 7 and p_size > 3")
def _(t):
    return e.expect_column_value_lengths_to_equal(t.part, "p_brand", 7, "p_size > 3").select("p_partkey", "p_brand")


# --- patterns -----------------------------------------------------------------------------------

def pages(out):
    return out.select("page_id", "url")


@expect("column_values_to_match_regex", r"select page_id, url from pages where not regexp_matches(url, '^HTTPS://', 'i')")
def _(t):
    return pages(e.expect_column_values_to_match_regex(t.pages, "url", "^HTTPS://", flags="i"))


@expect("column_values_to_not_match_regex", r"select page_id, url from pages where regexp_matches(url, '[?&]ref=') and length(url) > 40")
def _(t):
    return pages(e.expect_column_values_to_not_match_regex(t.pages, "url", "[?&]ref=", "length(url) > 40"))


@expect("column_values_to_match_regex_list", r"select page_id, url from pages where not (regexp_matches(url, '\.com/') and regexp_matches(url, '/en/'))")
def _(t):
    return pages(e.expect_column_values_to_match_regex_list(t.pages, "url", [r"\.com/", "/en/"], "all"))


@expect("column_values_to_not_match_regex_list", r"select page_id, url from pages where regexp_matches(url, '\.com/') and regexp_matches(url, '/en/')")
def _(t):
    return pages(e.expect_column_values_to_not_match_regex_list(t.pages, "url", [r"\.com/", "/en/"]))


@expect("column_values_to_match_like_pattern", "select page_id, url from pages where url not like 'https://%'")
def _(t):
    return pages(e.expect_column_values_to_match_like_pattern(t.pages, "url", "https://%"))


@expect("column_values_to_not_match_like_pattern", "select page_id, url from pages where url like '%?page=_&%'")
def _(t):
    return pages(e.expect_column_values_to_not_match_like_pattern(t.pages, "url", "%?page=_&%"))


@expect("column_values_to_match_like_pattern_list", "select page_id, url from pages where not (url like '%.com%' or url like '%.net%')")
def _(t):
    return pages(e.expect_column_values_to_match_like_pattern_list(t.pages, "url", ["%.com%", "%.net%"]))


@expect("column_values_to_not_match_like_pattern_list", "select page_id, url from pages where url like '%.com%' or url like '%#%'")
def _(t):
    return pages(e.expect_column_values_to_not_match_like_pattern_list(t.pages, "url", ["%.com%", "%#%"], "all"))


# --- aggregates ----------------------------------------------------------------------------------

@expect("column_distinct_count_to_equal", """
select user_id, count(distinct event_type) as expression from events where value > 30 group by 1 having not count(distinct event_type) = 5""")
def _(t):
    return e.expect_column_distinct_count_to_equal(t.events, "event_type", 5, ["user_id"], "value > 30")


@expect("column_distinct_count_to_be_greater_than", """
select l_suppkey, count(distinct l_partkey) as expression from lineitem group by 1 having not count(distinct l_partkey) > 500""")
def _(t):
    return e.expect_column_distinct_count_to_be_greater_than(t.lineitem, "l_partkey", 500, ["l_suppkey"])


@expect("column_distinct_count_to_be_less_than", """
select c_nationkey, count(distinct c_mktsegment) as expression from customer group by 1 having not count(distinct c_mktsegment) < 5""")
def _(t):
    return e.expect_column_distinct_count_to_be_less_than(t.customer, "c_mktsegment", 5, ["c_nationkey"])


@expect("column_distinct_values_to_be_in_set", """
select distinct o_orderpriority as value_field from orders where o_orderpriority not in ('1-URGENT', '2-HIGH', '9-NONE')""")
def _(t):
    return e.expect_column_distinct_values_to_be_in_set(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH", "9-NONE"])


@expect("column_distinct_values_to_contain_set", """
select value_field from (values ('1-URGENT'), ('8-NEVER'), ('9-NONE')) v(value_field) where value_field not in (select o_orderpriority from orders)""")
def _(t):
    return e.expect_column_distinct_values_to_contain_set(t.orders, "o_orderpriority", ["1-URGENT", "8-NEVER", "9-NONE"])


@expect("column_distinct_values_to_equal_set", """
select o_orderpriority as value_field, 'column' as found_in from orders where o_orderstatus = 'O' and o_orderpriority not in ('1-URGENT', '9-NONE') group by 1
union all select value_field, 'set' from (values ('1-URGENT'), ('9-NONE')) v(value_field) where value_field not in (select o_orderpriority from orders where o_orderstatus = 'O')""")
def _(t):
    return e.expect_column_distinct_values_to_equal_set(t.orders, "o_orderpriority", ["1-URGENT", "9-NONE"], "o_orderstatus = 'O'")


@expect("column_distinct_count_to_equal_other_table", """
select count(distinct o_custkey) as num_rows, (select count(distinct c_custkey) from customer) as compare_num_rows from orders
having count(distinct o_custkey) <> (select count(distinct c_custkey) from customer)
union all select count(distinct l_partkey), (select count(distinct p_partkey) from part where p_size > 10) from lineitem""")
def _(t):
    a = e.expect_column_distinct_count_to_equal_other_table(t.orders, "o_custkey", t.customer, "c_custkey")
    b = e.expect_column_distinct_count_to_equal_other_table(t.lineitem, "l_partkey", t.part, "p_partkey", other_where="p_size > 10")
    return a.unionByName(b)


def _between_sql(agg, group, table, low, high, digits=6, where="true"):
    return f"select {group}, round({agg}, {digits}) as expression from {table} where {where} group by {group} having not ({agg} between {low} and {high})"


def rounded(out, digits=6):
    return out.withColumn("expression", F.round("expression", digits))


@expect("column_mean_to_be_between", _between_sql("avg(value)", "user_id", "events", 40, 50))
def _(t):
    return rounded(e.expect_column_mean_to_be_between(t.events, "value", 40, 50, ["user_id"]))


@expect("column_median_to_be_between", _between_sql("quantile_cont(value, 0.5)", "user_id", "events", 30, 40))
def _(t):
    return rounded(e.expect_column_median_to_be_between(t.events, "value", 30, 40, ["user_id"]))


@expect("column_quantile_values_to_be_between", _between_sql("quantile_cont(l_quantity, 0.95)", "l_suppkey", "lineitem", 48, 49))
def _(t):
    return rounded(e.expect_column_quantile_values_to_be_between(t.lineitem, "l_quantity", 0.95, 48, 49, ["l_suppkey"]))


@expect("column_stdev_to_be_between", _between_sql("stddev_samp(l_quantity)", "l_suppkey", "lineitem", 14.2, 14.6))
def _(t):
    return rounded(e.expect_column_stdev_to_be_between(t.lineitem, "l_quantity", 14.2, 14.6, ["l_suppkey"]))


@expect("column_unique_value_count_to_be_between", """
select o_custkey, count(distinct o_orderpriority) as expression from orders group by 1 having not (count(distinct o_orderpriority) between 2 and 4)""")
def _(t):
    return e.expect_column_unique_value_count_to_be_between(t.orders, "o_orderpriority", 2, 4, ["o_custkey"])


@expect("column_proportion_of_unique_values_to_be_between", _between_sql(
    "count(distinct o_orderpriority) / count(o_orderpriority)", "o_custkey", "orders", 0.3, 0.6, 9))
def _(t):
    return rounded(e.expect_column_proportion_of_unique_values_to_be_between(t.orders, "o_orderpriority", 0.3, 0.6, ["o_custkey"]), 9)


@expect("column_most_common_value_to_be_in_set", """
with n as (select p_brand, count(*) as value_count from part group by 1), top as (select distinct value_count from n order by 1 desc limit 3)
select value_count, p_brand from n where value_count in (select value_count from top) and p_brand not in ('Brand#1', 'Brand#2')""")
def _(t):
    return e.expect_column_most_common_value_to_be_in_set(t.part, "p_brand", ["Brand#1", "Brand#2"], top_n=3)


@expect("column_max_to_be_between", _between_sql("max(value)", "user_id", "events", 100, 200))
def _(t):
    return rounded(e.expect_column_max_to_be_between(t.events, "value", 100, 200, ["user_id"]))


@expect("column_min_to_be_between", _between_sql("min(o_totalprice)", "o_custkey", "orders", 10000, 50000))
def _(t):
    return rounded(e.expect_column_min_to_be_between(t.orders, "o_totalprice", 10000, 50000, ["o_custkey"]))


@expect("column_sum_to_be_between", """
select l_suppkey, cast(sum(cast(l_quantity as decimal(18,2))) as double) as expression from lineitem group by 1
having not (sum(cast(l_quantity as decimal(18,2))) between 15000 and 16000)""")
def _(t):
    rows = t.lineitem.withColumn("l_quantity", col("l_quantity").cast("decimal(18,2)"))
    out = e.expect_column_sum_to_be_between(rows, "l_quantity", 15000, 16000, ["l_suppkey"])
    return out.withColumn("expression", col("expression").cast("double"))


# --- several columns ----------------------------------------------------------------------------------

@expect("column_pair_values_A_to_be_greater_than_B", "select l_orderkey, l_partkey, l_tax, l_discount from lineitem where not (l_discount >= l_tax) and l_quantity > 20")
def _(t):
    out = e.expect_column_pair_values_A_to_be_greater_than_B(t.lineitem, "l_discount", "l_tax", or_equal=True, where="l_quantity > 20")
    return out.select("l_orderkey", "l_partkey", "l_tax", "l_discount")


@expect("column_pair_values_to_be_equal", "select c_custkey, c_nationkey from customer where c_custkey <> c_nationkey")
def _(t):
    return e.expect_column_pair_values_to_be_equal(t.customer, "c_custkey", "c_nationkey").select("c_custkey", "c_nationkey")


@expect("column_pair_values_to_be_in_set", """
select l_orderkey, l_returnflag, l_linestatus from lineitem where not ((l_returnflag = 'A' and l_linestatus = 'F') or (l_returnflag = 'N' and l_linestatus = 'O'))""")
def _(t):
    out = e.expect_column_pair_values_to_be_in_set(t.lineitem, "l_returnflag", "l_linestatus", [("A", "F"), ("N", "O")])
    return out.select("l_orderkey", "l_returnflag", "l_linestatus")


@expect("select_column_values_to_be_unique_within_record", """
select l_orderkey, l_partkey, l_suppkey, l_linenumber from lineitem where l_partkey = l_suppkey or l_partkey = l_linenumber or l_suppkey = l_linenumber""")
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", col("l_linenumber").cast("bigint").alias("line"), "l_linenumber")
    out = e.expect_select_column_values_to_be_unique_within_record(rows, ["l_partkey", "l_suppkey", "line"])
    return out.drop("line")


@expect("multicolumn_sum_to_equal", """
select l_returnflag, cast(sum(cast(l_discount as decimal(18,2))) + sum(cast(l_tax as decimal(18,2))) as double) as column_sum, cast(100 as integer) as sum_total
from lineitem where l_quantity > 2 group by 1 having sum(cast(l_discount as decimal(18,2))) + sum(cast(l_tax as decimal(18,2))) <> 100""")
def _(t):
    rows = t.lineitem.withColumns({c: col(c).cast("decimal(18,2)") for c in ("l_discount", "l_tax")})
    out = e.expect_multicolumn_sum_to_equal(rows, ["l_discount", "l_tax"], 100, ["l_returnflag"], "l_quantity > 2")
    return out.withColumn("column_sum", col("column_sum").cast("double"))


@expect("compound_columns_to_be_unique", f"""
select o_custkey, o_orderpriority, count(*) as n_records from {DIRTY} where not (o_custkey is null or o_orderpriority is null) group by 1, 2 having count(*) > 1""")
def _(t):
    return e.expect_compound_columns_to_be_unique(dirty_orders(t), ["o_custkey", "o_orderpriority"], "any_value_is_missing")


# --- distributions ---------------------------------------------------------------------------------------

@expect("column_values_to_be_within_n_moving_stdevs", """
with p as (select event_type, date_trunc('day', ts) as metric_period, cast(sum(cast(value as decimal(18,2))) as double) as agg_metric_value from events group by 1, 2),
l as (select *, ln(nullif(agg_metric_value, 0)) - lag(ln(nullif(agg_metric_value, 0))) over (partition by event_type order by metric_period) as x from p),
m as (select *, avg(x) over w as mean, stddev_samp(x) over w as sd from l window w as (partition by event_type order by metric_period rows between 7 preceding and 1 preceding))
select event_type, cast(metric_period as timestamp) as metric_period, agg_metric_value, round((x - mean) / nullif(sd, 0), 5) as sigma from m
where metric_period >= timestamp '2024-01-18' and metric_period < timestamp '2024-02-01' and ((x - mean) / nullif(sd, 0) > 1.5 or (x - mean) / nullif(sd, 0) < -1)""")
def _(t):
    rows = t.events.withColumn("value", col("value").cast("decimal(18,2)"))
    cents = rows.groupBy("event_type", F.date_trunc("day", "ts").alias("ts")).agg(F.sum("value").cast("double").alias("value"))
    out = e.expect_column_values_to_be_within_n_moving_stdevs(
        cents, "value", "ts", EVENT_NOW, sigma_threshold_upper=1.5, sigma_threshold_lower=-1, group_by=["event_type"])
    return out.select("event_type", "metric_period", "agg_metric_value", F.round("sigma", 5).alias("sigma"))


@expect("column_values_to_be_within_n_stdevs", """
with v as (select o_custkey, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as metric_value from orders group by 1),
s as (select avg(metric_value) as a, stddev_samp(metric_value) as d from v)
select o_custkey, metric_value, round((metric_value - a) / nullif(d, 0), 6) as sigma from v, s where abs((metric_value - a) / nullif(d, 0)) > 2""")
def _(t):
    sums = t.orders.groupBy("o_custkey").agg(F.sum(col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("o_totalprice"))
    out = e.expect_column_values_to_be_within_n_stdevs(sums, "o_totalprice", ["o_custkey"], 2)
    return out.select("o_custkey", "metric_value", F.round("sigma", 6).alias("sigma"))


@expect("row_values_to_have_data_for_every_n_datepart", """
select h as date_hour from (select unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)) - interval 1 hour, interval 1 hour)) as h
  from events where event_type = 'signup') where h not in (select date_trunc('hour', ts) from events where event_type = 'signup') and hour(h) <> 3""")
def _(t):
    return e.expect_row_values_to_have_data_for_every_n_datepart(
        t.events, "ts", "hour", where="event_type = 'signup'", exclusion_condition="not(hour(date_hour) = 3)")
