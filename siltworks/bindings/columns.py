"""Projections, cleaning, flags, keys and lineage."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltworks.bindings.base import CFG, RUN_SQL, query
from siltworks.functions import flags, keys, text
from siltworks.operators import compare, joins, tables
from siltworks.plans.staging import Stage, stage
from siltworks.sources.registry import Registry, SourceGroup, SourceTable, add_lineage

col = F.col


def registry(t) -> Registry:
    """The given tables as two source systems."""
    return Registry(
        SourceGroup("sales", source_system="SALES", ingest_type="FILES", data_owner="TRADE", tables=(
            SourceTable("customer", t.path("customer"), source_file="customer.parquet", data_class="PII",
                        columns=("c_custkey", "c_name")),
            SourceTable("orders", t.path("orders"), loaded_at="o_orderdate", warn_after=(1, "day"),
                        error_after=(400, "day"), columns=("o_orderkey",)),
            SourceTable("supplier", t.path("supplier"), data_owner="PURCHASING"),
        )),
        SourceGroup("web", tables=(
            SourceTable("events", t.path("events"), loaded_at="ts", warn_after=(24, "hour"), error_after=(48, "hour")),
            SourceTable("pages", t.path("pages")),
        )),
    )


@query("scan_registry", "select * from orders")
def _(t):
    return registry(t).read(t.spark, "sales", "orders")


@query("stage_rename", """
select o_orderkey as order_number, o_custkey as customer_id, cast(o_orderdate as date) as order_date,
  case o_orderpriority when '1-URGENT' then null else o_orderpriority end as priority_code,
  cast(o_totalprice as decimal(15,2)) as order_amount
from orders""")
def _(t):
    raw = t.orders.withColumn("prio", F.nullif(col("o_orderpriority"), F.lit("1-URGENT")))
    return stage(raw, Stage({"o_orderkey": "order_number", "o_custkey": "customer_id",
                             "o_orderdate": ("order_date", "date"), "prio": "priority_code",
                             "o_totalprice": ("order_amount", "money")}))


@query("stage_key_filter", """
select o_orderkey, prio, status from (
  select o_orderkey, nullif(o_orderpriority, '5-LOW') as prio, nullif(o_orderstatus, 'P') as status from orders)
where prio is not null and status is not null""")
def _(t):
    rows = t.orders.select("o_orderkey", F.nullif(col("o_orderpriority"), F.lit("5-LOW")).alias("prio"),
                           F.nullif(col("o_orderstatus"), F.lit("P")).alias("status"))
    return tables.require_keys(rows, ["prio", "status"])


YN = "case o_orderstatus when 'O' then 'Y' when 'F' then 'N' end"
ONE = "case o_orderstatus when 'O' then 1 when 'F' then 0 end"


@query("flag_yn", f"""
select o_orderkey, case when f = 'Y' then true when f = 'N' then false end as is_open
from (select o_orderkey, {YN} as f from orders)""")
def _(t):
    return t.orders.select("o_orderkey", flags.yes_no(F.expr(YN)).alias("is_open"))


@query("flag_10_tristate", f"""
select o_orderkey, case when f = 1 then true when f = 0 then false end as is_open
from (select o_orderkey, {ONE} as f from orders)""")
def _(t):
    return t.orders.select("o_orderkey", flags.one_zero(F.expr(ONE)).alias("is_open"))


@query("flag_10_twostate", f"""
select o_orderkey, case when f = 1 then true else false end as is_open
from (select o_orderkey, {ONE} as f from orders)""")
def _(t):
    return t.orders.select("o_orderkey", flags.one_or_false(F.expr(ONE)).alias("is_open"))


# A name that is blank for one segment, with outer blanks elsewhere.
RAW_NAME = "case when c_mktsegment = 'BUILDING' then '   ' else concat('  ', c_name, ' ') end"
# A mail text that is blank for one segment and has upper case and outer blanks elsewhere.
RAW_MAIL = "case when c_mktsegment = 'MACHINERY' then ' ' else concat(' ', replace(c_name, '#', '.'), '@Mail.Edu ') end"


@query("blank_to_null", f"select c_custkey, nullif(trim(n), '') as name from (select c_custkey, {RAW_NAME} as n from customer)")
def _(t):
    return t.customer.select("c_custkey", text.blank_to_null(F.expr(RAW_NAME)).alias("name"))


TOKEN = "case c_mktsegment when 'BUILDING' then ' N/A ' when 'MACHINERY' then '0' when 'FURNITURE' then '' else c_mktsegment end"


@query("null_tokens", f"""
select c_custkey, case when trim(v) in ('', 'NULL', 'N/A', '0') then null else v end as segment
from (select c_custkey, {TOKEN} as v from customer)""")
def _(t):
    return t.customer.select("c_custkey", text.null_tokens(F.expr(TOKEN)).alias("segment"))


@query("first_non_blank", f"""
select c_custkey, coalesce(nullif(trim(n), ''), nullif(trim(s), '')) as display_name
from (select c_custkey, {RAW_NAME} as n, concat(c_mktsegment, ' ') as s from customer)""")
def _(t):
    return t.customer.select("c_custkey", text.first_non_blank(
        F.expr(RAW_NAME), F.concat("c_mktsegment", F.lit(" "))).alias("display_name"))


@query("clean_string", "select p_partkey, trim(upper(concat(' ', p_type, ' '))) as type_code, trim(upper(p_name)) as name_code from part")
def _(t):
    return t.part.select("p_partkey", text.clean_string(F.concat(F.lit(" "), "p_type", F.lit(" "))).alias("type_code"),
                         text.clean_string(col("p_name")).alias("name_code"))


@query("email_normalise", f"""
select c_custkey, case when trim(m) = '' then null else lower(trim(m)) end as email
from (select c_custkey, {RAW_MAIL} as m from customer)""")
def _(t):
    return t.customer.select("c_custkey", text.email_normalise(F.expr(RAW_MAIL)).alias("email"))


AMOUNT_TEXT = "case o_orderpriority when '5-LOW' then ' ' when '1-URGENT' then null else cast(o_custkey as string) end"


@query("safe_cast_default", f"""
select o_orderkey, case when v is null or trim(v) = '' then cast(-1 as integer) else cast(v as integer) end as value
from (select o_orderkey, {AMOUNT_TEXT.replace('string', 'varchar')} as v from orders)""")
def _(t):
    return t.orders.select("o_orderkey", text.safe_cast(F.expr(AMOUNT_TEXT), "int", -1).alias("value"))


MAYBE_DATE = "case o_orderstatus when 'P' then 'unknown' else {} end"


@query("try_cast", f"""
select o_orderkey, try_cast(v as date) as order_date from (
  select o_orderkey, {MAYBE_DATE.format("strftime(o_orderdate, '%Y-%m-%d')")} as v from orders)""")
def _(t):
    v = F.expr(MAYBE_DATE.format("date_format(o_orderdate, 'yyyy-MM-dd')"))
    return t.orders.select("o_orderkey", text.try_cast(v, "date").alias("order_date"))


@query("strict_cast", """
select o_orderkey, cast(o_orderdate as date) as order_date, cast(o_totalprice as decimal(15,2)) as amount,
  cast(cast(o_orderdate as varchar) as timestamp) as order_time
from orders""")
def _(t):
    return t.orders.select("o_orderkey", col("o_orderdate").cast("date").alias("order_date"),
                           col("o_totalprice").cast("decimal(15,2)").alias("amount"),
                           col("o_orderdate").cast("string").cast("timestamp_ntz").alias("order_time"))


@query("date_multi_format", """
select o_orderkey, case when v similar to '[0-9]{4}-[0-9]{2}-[0-9]{2}' then cast(strptime(v, '%Y-%m-%d') as date)
  when v similar to '[0-9]{2}/[0-9]{2}/[0-9]{4}' then cast(strptime(v, '%m/%d/%Y') as date) end as order_date
from (select o_orderkey, case o_orderstatus when 'O' then strftime(o_orderdate, '%Y-%m-%d')
  when 'F' then strftime(o_orderdate, '%m/%d/%Y') else strftime(o_orderdate, '%d.%m.%Y') end as v from orders)""")
def _(t):
    v = (F.when(col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd"))
         .when(col("o_orderstatus") == "F", F.date_format("o_orderdate", "MM/dd/yyyy"))
         .otherwise(F.date_format("o_orderdate", "dd.MM.yyyy")))
    return t.orders.select("o_orderkey", text.parse_date(v).alias("order_date"))


@query("name_split", """
select c_custkey, split_part(n, ',', 1) as last_name, trim(split_part(n, ',', 2)) as first_name
from (select c_custkey, concat(c_name, ', ', c_mktsegment) as n from customer)""")
def _(t):
    n = F.concat("c_name", F.lit(", "), "c_mktsegment")
    return t.customer.select("c_custkey", text.last_name(n).alias("last_name"), text.first_name(n).alias("first_name"))


@query("regex_capture", r"""
select page_id, nullif(regexp_extract(url, 'page=([0-9]+)', 1), '') as page_number,
  nullif(regexp_extract(url, '/([a-z]{2})/', 1), '') as language from pages""")
def _(t):
    return t.pages.select("page_id", text.regex_capture(col("url"), "page=([0-9]+)").alias("page_number"),
                          text.regex_capture(col("url"), "/([a-z]{2})/").alias("language"))


@query("list_split_explode", """
select p_partkey, trim(unnest(string_split(concat(p_brand, ' ; ', p_type, ';', replace(p_name, ' ', ' ;  ')), ';'))) as item
from part""")
def _(t):
    items = F.concat("p_brand", F.lit(" ; "), "p_type", F.lit(";"), F.replace("p_name", F.lit(" "), F.lit(" ;  ")))
    return t.part.select("p_partkey", F.explode(text.split_list(items)).alias("item"))


@query("add_lineage", f"""
select c_custkey, 'SALES' as _source_system, 'CUSTOMER' as _source_table, 'customer.parquet' as _source_file,
  'PII' as _data_classification, 'TRADE' as _data_owner, 'FILES' as _ingest_type, {RUN_SQL} as _loaded_at from customer""")
def _(t):
    r = registry(t)
    return add_lineage(r.read(t.spark, "sales", "customer").select("c_custkey"), r, "sales", "customer", CFG.run_time)


@query("add_lineage_ts", f"""
select event_id, ts, 'UNKNOWN' as _source_system, 'EVENTS' as _source_table, 'INTERNAL' as _data_classification,
  'UNKNOWN' as _data_owner, 'UNKNOWN' as _ingest_type, {RUN_SQL} as _loaded_at, ts as _source_loaded_at from events""")
def _(t):
    r = registry(t)
    return add_lineage(r.read(t.spark, "web", "events").select("event_id", "ts"), r, "web", "events", CFG.run_time, "ts")


@query("star_except", """
select s_suppkey as src_s_suppkey_raw, s_name as src_s_name_raw, s_acctbal as src_s_acctbal_raw from supplier""")
def _(t):
    return tables.star(t.supplier, ["S_NATIONKEY"], prefix="src_", suffix="_raw")


@query("nullcheck_table", """
select c_custkey, nullif(c_name, '') as c_name, c_nationkey, c_acctbal,
  nullif(case when c_mktsegment = 'BUILDING' then '' else c_mktsegment end, '') as c_mktsegment from customer""")
def _(t):
    dirty = t.customer.withColumn("c_mktsegment", F.expr("case when c_mktsegment = 'BUILDING' then '' else c_mktsegment end"))
    return tables.nullcheck_table(dirty)


_SPARSE = "nullif(o_orderpriority, '5-LOW')"


@query("surrogate_key", f"""
select o_orderkey, md5(concat_ws('-', coalesce(cast(o_orderkey as varchar), '_dbt_utils_surrogate_key_null_'),
  coalesce({_SPARSE}, '_dbt_utils_surrogate_key_null_'))) as order_key,
  md5(coalesce({_SPARSE}, '_dbt_utils_surrogate_key_null_')) as priority_key from orders""")
def _(t):
    p = F.expr(_SPARSE)
    return t.orders.select("o_orderkey", keys.surrogate_key(col("o_orderkey"), p).alias("order_key"),
                           keys.surrogate_key(p).alias("priority_key"))


@query("surrogate_key_legacy", f"""
select o_orderkey, md5(concat_ws('-', cast(o_orderkey as varchar), coalesce({_SPARSE}, ''))) as order_key from orders""")
def _(t):
    return t.orders.select("o_orderkey", keys.surrogate_key(col("o_orderkey"), F.expr(_SPARSE),
                                                            nulls_as_empty=True).alias("order_key"))


@query("row_hash", f"""
select o_orderkey, md5(concat_ws('||', cast(o_custkey as varchar), o_orderstatus, coalesce({_SPARSE}, ''))) as row_hash
from orders""")
def _(t):
    return t.orders.select("o_orderkey", keys.row_hash(col("o_custkey"), col("o_orderstatus"), F.expr(_SPARSE)).alias("row_hash"))


@query("dq_label", f"""
select c_custkey, case when n is null then 'MISSING_NAME' when m is null then 'MISSING_EMAIL'
  when c_acctbal < 0 then 'NEGATIVE_BALANCE' else 'COMPLETE' end as data_quality_flag
from (select c_custkey, c_acctbal, nullif(trim({RAW_NAME}), '') as n, nullif(trim({RAW_MAIL}), '') as m from customer)""")
def _(t):
    name, mail = text.blank_to_null(F.expr(RAW_NAME)), text.blank_to_null(F.expr(RAW_MAIL))
    label = flags.first_rule([(name.isNull(), "MISSING_NAME"), (mail.isNull(), "MISSING_EMAIL"),
                              (col("c_acctbal") < 0, "NEGATIVE_BALANCE")], "COMPLETE")
    return t.customer.select("c_custkey", label.alias("data_quality_flag"))


@query("presence_flags", """
select coalesce(c_custkey, s_suppkey) as id, c_custkey is not null and s_suppkey is not null as in_both,
  c_custkey is not null and s_suppkey is null as only_a, c_custkey is null and s_suppkey is not null as only_b
from customer full outer join supplier on c_custkey = s_suppkey""")
def _(t):
    j = compare.compare_presence(t.customer.select(col("c_custkey").alias("id")), t.supplier.select(col("s_suppkey").alias("id")), "id")
    return j.withColumnRenamed("k", "id")


@query("active_flag", """
select o_orderkey, e is null or e >= date '1999-01-01' as is_active
from (select o_orderkey, case when o_orderstatus = 'P' then null else cast(o_orderdate as date) end as e from orders)""")
def _(t):
    end = F.when(col("o_orderstatus") != "P", col("o_orderdate").cast("date"))
    return t.orders.select("o_orderkey", flags.is_open(end, "1999-01-01").alias("is_active"))


@query("age_year_diff", """
select o_orderkey, cast(2020 - year(o_orderdate) as integer) as age, 2020 - year(o_orderdate) >= 24 as is_independent
from orders""")
def _(t):
    born = col("o_orderdate").cast("date")
    return t.orders.select("o_orderkey", flags.age_in_year_steps(born, "2020-01-01").alias("age"),
                           flags.is_independent(born, "2020-01-01").alias("is_independent"))


@query("mask_column", """
select c_custkey, concat('XXX-XX-', right(c_name, 4)) as seen_by_analyst, c_name as seen_by_registrar from customer""")
def _(t):
    allowed = ["REGISTRAR", "ADMIN"]
    return t.customer.select("c_custkey", text.mask_unless(col("c_name"), "ANALYST", allowed).alias("seen_by_analyst"),
                             text.mask_unless(col("c_name"), "REGISTRAR", allowed).alias("seen_by_registrar"))


@query("row_access_filter", """
select c_custkey, c_nationkey from customer
where c_nationkey in (select n_nationkey from nation join region on n_regionkey = r_regionkey where r_name = 'ASIA')""")
def _(t):
    grants = t.nation.join(t.region, col("n_regionkey") == col("r_regionkey"))
    grants = grants.select(col("r_name").alias("user_name"), col("n_nationkey").alias("c_nationkey"))
    return joins.keep_entitled(t.customer.select("c_custkey", "c_nationkey"), grants, "ASIA", "c_nationkey")


@query("pattern_filter", """
select page_id, url, url like '%.org%' as is_org from pages
where url like '%?%' and url not like '%#%' and (url like 'http://%' or url like 'https://%')""")
def _(t):
    u = col("url")
    rows = t.pages.where(u.contains("?") & ~u.contains("#") & (u.startswith("http://") | u.startswith("https://")))
    return rows.select("page_id", "url", u.like("%.org%").alias("is_org"))
