"""Loads, sinks, history and catalog reports.

Each query writes to a new folder in the shared one and reads the result back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from siltworks.bindings.base import CFG, EVENT_NOW, RUN_SQL, query
from siltworks.bindings.columns import registry
from siltworks.config import shared_dir
from siltworks.sources import loads, stored
from siltworks.sources import registry as reports

col = F.col


@query("csv_load_quarantine", f"""
select c_custkey as id, c_name as name, c_acctbal as balance, cast(null as varchar) as rejected_line, {RUN_SQL} as meta_ingest_time
from customer where c_mktsegment <> 'BUILDING'
union all select null, null, null, concat(c_custkey, ',', c_name, ',none'), {RUN_SQL} from customer where c_mktsegment = 'BUILDING'""")
def _(t):
    """Lines with a bad number are set aside, the others load."""
    folder = shared_dir(t.spark)
    amount = F.when(col("c_mktsegment") == "BUILDING", "none").otherwise(col("c_acctbal").cast("decimal(18,2)").cast("string"))
    lines = t.customer.select(F.concat_ws(",", col("c_custkey").cast("string"), col("c_name"), amount).alias("value"))
    lines.write.mode("overwrite").text(folder)
    good, rejected = loads.load_csv(t.spark, folder, "id bigint, name string, balance double", header=False)
    rows = good.unionByName(rejected, allowMissingColumns=True)
    return loads.stamp_missing(rows, {"meta_ingest_time": F.lit(CFG.run_time).cast("timestamp_ntz")})


@query("seed_load", """
select s_suppkey as code, s_name as name, s_acctbal > 0 as is_active, s_nationkey as sort_order from supplier""")
def _(t):
    """A reference CSV with blanks after the commas, in header and values."""
    folder = shared_dir(t.spark)
    parts = [F.concat(F.lit(" "), c.cast("string")) for c in (col("s_name"), col("s_acctbal") > 0, col("s_nationkey"))]
    rows = t.supplier.select("s_suppkey", *parts).toDF("code", " name", " is_active", " sort_order")
    rows.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False).csv(folder)
    return loads.load_seed(t.spark, folder, "code bigint, name string, is_active boolean, sort_order int")


@query("stamp_missing_lineage", f"""
select o_orderkey, case when o_orderstatus = 'F' then o_orderdate else {RUN_SQL} end as meta_ingest_time, 'TRADE' as meta_data_owner from orders""")
def _(t):
    rows = t.orders.select("o_orderkey", F.when(col("o_orderstatus") == "F", col("o_orderdate")).alias("meta_ingest_time"))
    return loads.stamp_missing(rows, {"meta_ingest_time": F.lit(CFG.run_time).cast("timestamp_ntz"), "meta_data_owner": F.lit("TRADE")})


@query("sink_table", "select c_custkey, c_nationkey, c_acctbal from customer")
def _(t):
    path = shared_dir(t.spark)
    stored.refresh(t.customer.select("c_custkey", "c_nationkey"), path)
    return stored.refresh(t.customer.select("c_custkey", "c_nationkey", "c_acctbal"), path)


@query("merge_upsert", """
select o_orderkey, o_orderstatus, case when o_orderstatus = 'O' then o_totalprice + 1 else o_totalprice end as o_totalprice from orders""")
def _(t):
    """Stored: all but pending orders.  Merged: open (changed price) and pending ones."""
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = shared_dir(t.spark)
    stored.merge_into(path, rows.where("o_orderstatus <> 'P'"), ["o_orderkey"], buckets=16)
    price = F.when(col("o_orderstatus") == "O", col("o_totalprice") + 1).otherwise(col("o_totalprice"))
    return stored.merge_into(path, rows.where("o_orderstatus <> 'F'").withColumn("o_totalprice", price), ["o_orderkey"])


@query("incremental_hwm", """
select o_orderkey, o_orderdate, case when o_orderdate <= (select max(o_orderdate) from orders where year(o_orderdate) < 1998) then 'first' else 'second' end as load
from orders where year(o_orderdate) < 1998 or o_orderdate > (select max(o_orderdate) from orders where year(o_orderdate) < 1998)""")
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderdate")
    path = shared_dir(t.spark)
    stored.append_newer(path, rows.where(F.year("o_orderdate") < 1998).withColumn("load", F.lit("first")), "o_orderdate")
    return stored.append_newer(path, rows.withColumn("load", F.lit("second")), "o_orderdate")


@query("scd2_snapshot", """
select c_custkey, c_mktsegment, timestamp '2024-01-01' as updated_at, timestamp '2024-01-01' as valid_from,
  case when c_acctbal < 0 then timestamp '2024-01-05' end as valid_to from customer where c_nationkey < 20
union all select c_custkey, 'CHANGED', timestamp '2024-01-05', timestamp '2024-01-05', null from customer where c_acctbal < 0
union all select c_custkey, c_mktsegment, timestamp '2024-01-01', timestamp '2024-01-01', null from customer where c_nationkey >= 20 and c_acctbal >= 0""")
def _(t):
    """Second run: negative balances changed later, nations from 20 on are new, the rest is as stored."""
    def at(day):
        return F.lit(day).cast("timestamp_ntz").alias("updated_at")

    first = t.customer.where("c_nationkey < 20").select("c_custkey", "c_mktsegment", at("2024-01-01"))
    path = shared_dir(t.spark)
    stored.snapshot_into(path, first, ["c_custkey"], "updated_at", "day-1")
    changed = t.customer.where("c_acctbal < 0").select("c_custkey", F.lit("CHANGED").alias("c_mktsegment"), at("2024-01-05"))
    same = t.customer.where("c_acctbal >= 0").select("c_custkey", "c_mktsegment", at("2024-01-01"))
    return stored.snapshot_into(path, changed.unionByName(same), ["c_custkey"], "updated_at", "day-5")


@query("schema_evolve", """
select 'append' as policy, s_suppkey, s_name, cast(null as integer) as s_nationkey, s_acctbal from supplier where s_acctbal < 5000
union all select 'append', s_suppkey, null, s_nationkey, s_acctbal from supplier where s_acctbal >= 5000
union all select 'sync', s_suppkey, null, null, s_acctbal from supplier where s_acctbal < 5000
union all select 'sync', s_suppkey, null, s_nationkey, s_acctbal from supplier where s_acctbal >= 5000""")
def _(t):
    old = t.supplier.where("s_acctbal < 5000").select("s_suppkey", "s_name", "s_acctbal")
    new = t.supplier.where("s_acctbal >= 5000").select("s_suppkey", "s_nationkey", "s_acctbal")
    a = stored.evolve(old, new, "append_new_columns").withColumn("policy", F.lit("append"))
    s = stored.evolve(old, new, "sync_all_columns").withColumn("policy", F.lit("sync"))
    return a.unionByName(s, allowMissingColumns=True)


@query("clustered_write", """
select o_orderkey, o_custkey, o_orderdate from orders where o_custkey between 100 and 200""")
def _(t):
    folder = shared_dir(t.spark)
    stored.write_clustered(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), folder, ["o_custkey", "o_orderdate"])
    return t.spark.read.parquet(folder).where(col("o_custkey").between(100, 200))


@query("bucketed_join", """
select l_orderkey, l_linenumber, l_partkey, o_custkey, cast(strftime(o_orderdate, '%Y%m%d') as integer) as order_date_key, c_mktsegment
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey""")
def _(t):
    """Fact and dimension stored in buckets of the key they share, joined where they lie."""
    folder, run = shared_dir(t.spark), uuid.uuid4().hex
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    orders = t.orders.select(col("o_orderkey").alias("l_orderkey"), "o_custkey", F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("order_date_key"))
    fact = stored.write_bucketed(lines, f"silt_lines_{run}", f"{folder}/lines", ["l_orderkey"], 16)
    keyed = stored.write_bucketed(orders, f"silt_orders_{run}", f"{folder}/orders", ["l_orderkey"], 16)
    people = t.customer.select(col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return fact.join(keyed, "l_orderkey").join(people, "o_custkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", "o_custkey", "order_date_key", "c_mktsegment")


@query("clustered_write_two_keys", """
select o_orderkey, o_custkey, o_orderdate from orders where o_custkey between 100 and 200 or o_orderdate < timestamp '1995-06-01'""")
def _(t):
    folder = shared_dir(t.spark)
    stored.write_clustered(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), folder, ["o_custkey", "o_orderdate"], files=32)
    rows = t.spark.read.parquet(folder)
    return rows.where(col("o_custkey").between(100, 200) | (col("o_orderdate") < F.lit("1995-06-01").cast("timestamp_ntz")))


@query("source_freshness", """
with f as (select 'sales' as source_name, 'orders' as table_name, max(o_orderdate) as max_loaded_at, 24 as w, 9600 as e from orders
  union all select 'web', 'events', max(ts), 24, 48 from events),
g as (select *, datediff('second', max_loaded_at, date_trunc('second', timestamp '2024-02-01')) as s0, epoch(timestamp '2024-02-01') - epoch(max_loaded_at) as s from f)
select source_name, table_name, max_loaded_at, trunc(s) / 3600.0 as age_hours,
  case when trunc(s) / 3600.0 > e then 'error' when trunc(s) / 3600.0 > w then 'warn' else 'pass' end as status from g""")
def _(t):
    return reports.source_freshness(t.spark, registry(t), EVENT_NOW)


@query("volume_monitor", """
select table_name, load_day, n_rows, lag(n_rows) over w as previous_rows, n_rows - lag(n_rows) over w as row_change from (
  select 'orders' as table_name, cast(o_orderdate as date) as load_day, count(*) as n_rows from orders group by 2
  union all select 'events', cast(ts as date), count(*) from events group by 2)
window w as (partition by table_name order by load_day)""")
def _(t):
    return reports.volume_monitor({"orders": (t.orders, "o_orderdate"), "events": (t.events, "ts")})


def layers(t):
    return {"DEPOSIT": {"customer": t.customer, "orders": t.orders},
            "DETERGE": {"nation": t.nation, "part": t.part}, "DISTRIBUTE": {"events": t.events}}


_TYPES = "case data_type when 'BIGINT' then 'bigint' when 'INTEGER' then 'int' when 'VARCHAR' then 'string' when 'DOUBLE' then 'double' when 'TIMESTAMP' then 'timestamp_ntz' end"
_SCHEMA = "case when table_name in ('customer', 'orders') then 'DEPOSIT' when table_name = 'events' then 'DISTRIBUTE' else 'DETERGE' end"
_COLUMNS = f"""
from information_schema.columns join (select 'customer' as n, count(*) as row_count from customer union all select 'orders', count(*) from orders
  union all select 'nation', count(*) from nation union all select 'part', count(*) from part union all select 'events', count(*) from events)
  on table_name = n"""


@query("metadata_catalog", f"""
select 'warehouse' as table_catalog, {_SCHEMA} as table_schema, table_name, column_name, {_TYPES} as data_type,
  cast(ordinal_position as integer) as ordinal_position, row_count {_COLUMNS}""")
def _(t):
    return reports.metadata_catalog(layers(t))


@query("metadata_audit", f"""
select {_SCHEMA} as table_schema, table_name, count(*) as column_count, {RUN_SQL} as audit_ts {_COLUMNS} group by 1, 2""")
def _(t):
    return reports.metadata_audit(reports.metadata_catalog(layers(t)), CFG.run_time)
