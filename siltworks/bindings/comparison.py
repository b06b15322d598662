"""Comparison of a table with a changed copy of it."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltworks.bindings.base import query
from siltworks.operators import compare

col = F.col

# Two states of the orders table: the second lacks pending orders, has lower prices
# for one priority and null statuses for another; the first has null priorities.
A_SQL = """select o_orderkey, o_custkey, nullif(o_orderstatus, 'F') as o_orderstatus, o_totalprice, nullif(o_orderpriority, '3-MEDIUM') as o_orderpriority
  from orders where o_totalprice > 20000"""
B_SQL = """select o_orderkey, o_custkey, case when o_orderpriority = '4-NOT SPECIFIED' then null when o_orderpriority = '2-HIGH' then 'X' else nullif(o_orderstatus, 'F') end as o_orderstatus,
  case when o_orderpriority = '5-LOW' then o_totalprice - 1 else o_totalprice end as o_totalprice, nullif(o_orderpriority, '3-MEDIUM') as o_orderpriority
  from orders where o_orderstatus <> 'P'"""


def sides(t):
    low = F.nullif(col("o_orderpriority"), F.lit("3-MEDIUM"))
    status = F.nullif(col("o_orderstatus"), F.lit("F"))
    a = t.orders.where("o_totalprice > 20000").select(
        "o_orderkey", "o_custkey", status.alias("o_orderstatus"), "o_totalprice", low.alias("o_orderpriority"))
    prio = col("o_orderpriority")
    other = F.when(prio == "4-NOT SPECIFIED", None).when(prio == "2-HIGH", "X").otherwise(status)
    price = F.when(prio == "5-LOW", col("o_totalprice") - 1).otherwise(col("o_totalprice"))
    b = t.orders.where("o_orderstatus <> 'P'").select(
        "o_orderkey", "o_custkey", other.alias("o_orderstatus"), price.alias("o_totalprice"), low.alias("o_orderpriority"))
    return a, b


def _flags_sql(cols):
    return f"""
with a as ({A_SQL}), b as ({B_SQL}), x as (select {cols} from a intersect select {cols} from b),
y as (select {cols} from a except select {cols} from b), z as (select {cols} from b except select {cols} from a),
every as (select *, true as in_a, true as in_b from x union all select *, true, false from y union all select *, false, true from z)"""


_COUNTS = """ select in_a, in_b, count(*) as "count", round(100.0 * count(*) / sum(count(*)) over (), 2) as percent_of_total
from every group by 1, 2"""


@query("compare_queries", _flags_sql("*") + _COUNTS)
def _(t):
    return compare.compare_queries(*sides(t))


@query("compare_relations", _flags_sql("o_orderkey, o_custkey, o_orderstatus, o_orderpriority") + " select * from every where in_a <> in_b")
def _(t):
    return compare.compare_relations(*sides(t), exclude_columns=["O_TOTALPRICE"], summarize=False)


_REPEATED = """select o_orderkey from a group by 1 having count(*) > 1 union select o_orderkey from b group by 1 having count(*) > 1"""


@query("compare_column", f"""
with a as ({A_SQL}), b as ({B_SQL}),
pairs as (select a.o_orderkey as ka, b.o_orderkey as kb, a.o_orderstatus as va, b.o_orderstatus as vb from a full outer join b on a.o_orderkey = b.o_orderkey),
n as (select if(va is not distinct from vb, if(va is null, 1, 0), if(ka is null, 2, if(kb is null, 3, if(va is null, 4, if(vb is null, 5, 6))))) as state, count(*) as count_records,
  count(distinct coalesce(ka, kb)) filter (where coalesce(ka, kb) in ({_REPEATED})) as repeated_keys from pairs group by 1)
select 'o_orderstatus' as column_name, label as match_status, count_records, repeated_keys, round(100.0 * count_records / sum(count_records) over (), 2) as percent_of_total
from n join (values {', '.join(f"({i}, '{s}')" for i, s in enumerate(compare.MATCH_STATES))}) as labels(state, label) using (state)""")
def _(t):
    return compare.compare_column(*sides(t), "o_orderkey", "o_orderstatus")


def _cell_sql(c):
    return f"""select coalesce(a.o_orderkey, b.o_orderkey) as primary_key, '{c}' as column_name,
  coalesce(a.{c} = b.{c} and a.o_orderkey is not null and b.o_orderkey is not null, a.{c} is null and b.{c} is null, false) as perfect_match,
  a.{c} is null and a.o_orderkey is not null as null_in_a, b.{c} is null and b.o_orderkey is not null as null_in_b,
  a.o_orderkey is null as missing_from_a, b.o_orderkey is null as missing_from_b,
  coalesce(a.o_orderkey is not null and b.o_orderkey is not null and a.{c} is distinct from b.{c}, false) as conflicting_values,
  coalesce(a.o_orderkey, b.o_orderkey) in ({_REPEATED}) as repeated_key
from a full outer join b on a.o_orderkey = b.o_orderkey"""


@query("compare_column_verbose", f"with a as ({A_SQL}), b as ({B_SQL}) {_cell_sql('o_orderstatus')}")
def _(t):
    return compare.compare_column_verbose(*sides(t), "o_orderkey", "o_orderstatus")


@query("compare_all_columns", f"""
with a as ({A_SQL}), b as ({B_SQL}), main as ({' union all '.join(_cell_sql(c) for c in ('o_orderkey', 'o_orderstatus', 'o_totalprice', 'o_orderpriority'))})
select upper(column_name) as column_name, """ + ", ".join(
    f"cast(sum(case when {c} then 1 else 0 end) as bigint) as {c}" for c in
    ("perfect_match", "null_in_a", "null_in_b", "missing_from_a", "missing_from_b", "conflicting_values"))
    + ", count(distinct primary_key) filter (where repeated_key) as repeated_keys from main group by 1")
def _(t):
    return compare.compare_all_columns(*sides(t), "o_orderkey", exclude_columns=["O_CUSTKEY"])


@query("compare_schema", """
select * from (values ('k', 1, 1, 'bigint', 'bigint', true, true), ('name', 2, 2, 'string', 'string', true, true),
  ('nationkey', 3, 3, 'int', 'bigint', true, false), ('acctbal', 4, 5, 'double', 'double', false, true),
  ('mktsegment', 5, null, 'string', null, false, false), ('kind', null, 4, null, 'string', false, false))
  as v(column_name, a_ordinal_position, b_ordinal_position, a_data_type, b_data_type, has_ordinal_position_match, has_data_type_match),
  (select count(*) as rows_a from customer), (select count(*) as rows_b from supplier)""")
def _(t):
    a = t.customer.toDF("k", "name", "nationkey", "acctbal", "mktsegment")
    b = t.supplier.select(col("s_suppkey").alias("k"), col("s_name").alias("name"), col("s_nationkey").cast("bigint").alias("nationkey"),
                          F.lit("supplier").alias("kind"), col("s_acctbal").alias("acctbal"))
    out = compare.compare_schema(a, b)
    return out.withColumns({"rows_a": a.agg(F.count("*")).scalar(), "rows_b": b.agg(F.count("*")).scalar()})
