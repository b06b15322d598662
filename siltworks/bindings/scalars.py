"""Text, web, number and date functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltworks.bindings.base import query
from siltworks.functions import dates as d
from siltworks.functions import keys, numbers, text, web
from siltworks.plans.calendar import generate_series

col = F.col


@query("str_functions", """
select p_partkey, trim(concat(' ', p_name)) as trimmed, lower(p_type) as low, upper(p_name) as up,
  replace(p_name, ' ', '-') as dashed, cast(length(p_name) as integer) as len, left(p_name, 3) as head,
  right(p_name, 3) as tail, cast(position(' ' in p_name) as integer) as blank_at, p_brand || '/' || p_type as joined,
  nullif(p_brand, 'Brand#1') || p_type as null_joined,
  concat_ws('|', coalesce(nullif(p_brand, 'Brand#1'), ''), p_type) as ws_joined,
  lpad(cast(p_size as varchar), 4, '0') as padded, split_part(p_name, ' ', 2) as second, p_name like '%ring%' as has_ring
from part""")
def _(t):
    name, brand = col("p_name"), F.nullif(col("p_brand"), F.lit("Brand#1"))
    return t.part.select(
        "p_partkey", F.trim(F.concat(F.lit(" "), name)).alias("trimmed"), F.lower("p_type").alias("low"),
        F.upper(name).alias("up"), F.replace(name, F.lit(" "), F.lit("-")).alias("dashed"), F.length(name).alias("len"),
        F.left(name, F.lit(3)).alias("head"), F.right(name, F.lit(3)).alias("tail"), F.instr(name, " ").alias("blank_at"),
        F.concat("p_brand", F.lit("/"), "p_type").alias("joined"), F.concat(brand, "p_type").alias("null_joined"),
        F.concat_ws("|", F.coalesce(brand, F.lit("")), "p_type").alias("ws_joined"),
        F.lpad(col("p_size").cast("string"), 4, "0").alias("padded"),
        F.split_part(name, F.lit(" "), F.lit(2)).alias("second"), name.like("%ring%").alias("has_ring"))


BARE = "replace(replace(url, 'https://', ''), 'http://', '')"
HOST = "split_part(split_part({}, '/', 1), '?', 1)"


@query("url_host", f"select page_id, {HOST.format(BARE)} as host, {HOST.format(BARE)} as host_without_scheme from pages")
def _(t):
    bare = F.regexp_replace("url", "^https?://", "")
    return t.pages.select("page_id", web.url_host(col("url")).alias("host"),
                          web.url_host(bare).alias("host_without_scheme"))


@query("url_path", f"""
select page_id, case when strpos(u, '/') > 0 then split_part(substr(u, strpos(u, '/') + 1), '?', 1) end as path
from (select page_id, {BARE} as u from pages)""")
def _(t):
    return t.pages.select("page_id", web.url_path(col("url")).alias("path"))


@query("url_parameter", """
select page_id, nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') as page,
  nullif(split_part(split_part(url, 'ref=', 2), '&', 1), '') as ref from pages""")
def _(t):
    return t.pages.select("page_id", web.url_parameter(col("url"), "page").alias("page"),
                          web.url_parameter(col("url"), "ref").alias("ref"))


@query("hash_md5", "select doc_id, md5(concat(cast(doc_id as varchar), text)) as doc_hash from documents")
def _(t):
    return t.documents.select("doc_id", keys.text_hash(col("doc_id"), col("text")).alias("doc_hash"))


@query("slugify", """
select p_partkey, regexp_replace(regexp_replace(regexp_replace(lower(s), '[ -]+', '_', 'g'), '[^a-z0-9_]+', '', 'g'),
  '^([0-9])', '_\\1') as slug
from (select p_partkey, concat(p_size, ' - ', p_name, ' / ', p_brand) as s from part)""")
def _(t):
    s = F.concat(col("p_size").cast("string"), F.lit(" - "), "p_name", F.lit(" / "), "p_brand")
    return t.part.select("p_partkey", text.slugify(s).alias("slug"))


@query("regex_instr", r"""
select page_id, case when regexp_matches(url, '[0-9]+')
  then cast(strpos(url, regexp_extract(url, '[0-9]+')) as integer) else 0 end as digit_at,
  case when regexp_matches(url, 'x*') then 1 else 0 end as empty_match_at,
  regexp_matches(url, '\.org') as is_org from pages""")
def _(t):
    u = col("url")
    return t.pages.select("page_id", text.regex_position(u, "[0-9]+").alias("digit_at"),
                          text.regex_position(u, "x*").alias("empty_match_at"), u.rlike(r"\.org").alias("is_org"))


@query("regex_flags", """
select doc_id, regexp_matches(text, 'THE', 'i') as any_case, regexp_matches(text, 'THE', 'c') as exact_case,
  regexp_matches(text, '(?m)^the') as line_start, regexp_matches(text, '(?is)the.*and') as across_lines from documents""")
def _(t):
    c = col("text")
    return t.documents.select(
        "doc_id", c.rlike(text.with_flags("THE", "i")).alias("any_case"),
        c.rlike(text.with_flags("THE", "c")).alias("exact_case"),
        c.rlike(text.with_flags("^the", "m")).alias("line_start"),
        c.rlike(text.with_flags("the.*and", "is")).alias("across_lines"))


@query("format_master_id", "select c_custkey, concat('DTU_PERSON_', lpad(cast(c_custkey as varchar), 9, '0')) as master_id from customer")
def _(t):
    return t.customer.select("c_custkey", keys.master_id(col("c_custkey")).alias("master_id"))


@query("safe_add_subtract", """
select o_orderkey, coalesce(a, 0) + coalesce(b, 0) + o_custkey as added,
  coalesce(a, 0) - coalesce(b, 0) - o_custkey as subtracted
from (select o_orderkey, o_custkey, case when o_orderstatus = 'P' then null else o_orderkey end as a,
  case when o_orderpriority = '5-LOW' then null else o_custkey end as b from orders)""")
def _(t):
    a = F.when(col("o_orderstatus") != "P", col("o_orderkey"))
    b = F.when(col("o_orderpriority") != "5-LOW", col("o_custkey"))
    c = col("o_custkey")
    return t.orders.select("o_orderkey", numbers.safe_add(a, b, c).alias("added"),
                           numbers.safe_subtract(a, b, c).alias("subtracted"))


@query("safe_divide", """
select l_orderkey, l_partkey, l_linenumber, l_extendedprice / nullif(l_discount, 0) as ratio from lineitem""")
def _(t):
    return t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber",
                             numbers.safe_divide(col("l_extendedprice"), col("l_discount")).alias("ratio"))


@query("width_bucket", """
select o_orderkey, cast(case when o_totalprice < 100000 then 0 when o_totalprice >= 400000 then 7
  else floor((o_totalprice - 100000) * 6 / 300000.0) + 1 end as integer) as bucket from orders""")
def _(t):
    return t.orders.select("o_orderkey", numbers.width_bucket(
        col("o_totalprice"), F.lit(100000.0), F.lit(400000.0), 6).alias("bucket"))


# Coordinates made of the table's numbers.
LAT1, LON1 = "(c_nationkey * 6.5 - 80)", "(c_acctbal / 60)"
LAT2, LON2 = "(c_acctbal / 200)", "(c_nationkey * 12.5 - 150)"
_CHORD = (f"power(sin(radians(({LAT2} - {LAT1}) / 2)), 2) + cos(radians({LAT1})) * cos(radians({LAT2}))"
          f" * power(sin(radians(({LON2} - {LON1}) / 2)), 2)")


@query("haversine", f"""
select c_custkey, round(2 * 3961 * asin(sqrt({_CHORD})), 3) as miles,
  round(2 * 3961 * asin(sqrt({_CHORD})) * 1.60934, 3) as kilometres from customer""")
def _(t):
    places = [F.expr(x).cast("double") for x in (LAT1, LON1, LAT2, LON2)]
    return t.customer.select("c_custkey", F.round(numbers.haversine(*places), 3).alias("miles"),
                             F.round(numbers.haversine(*places, unit="km"), 3).alias("kilometres"))


@query("ln_safe", "select l_orderkey, l_partkey, l_linenumber, round(ln(nullif(l_discount, 0)), 9) as ln_discount from lineitem")
def _(t):
    return t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber",
                             F.round(numbers.ln_safe(col("l_discount")), 9).alias("ln_discount"))


@query("greatest_coalesce", """
select o_orderkey, greatest(coalesce(a, timestamp '1900-01-01'), coalesce(b, timestamp '1900-01-01')) as latest
from (select o_orderkey, case when o_orderstatus = 'P' then null else o_orderdate end as a,
  case when o_orderpriority = '5-LOW' then null else timestamp '1998-01-01' end as b from orders)""")
def _(t):
    a = F.when(col("o_orderstatus") != "P", col("o_orderdate"))
    b = F.when(col("o_orderpriority") != "5-LOW", F.lit("1998-01-01").cast("timestamp_ntz"))
    low = F.lit("1900-01-01").cast("timestamp_ntz")
    return t.orders.select("o_orderkey", numbers.greatest_or(low, a, b).alias("latest"))


@query("generate_series", "select unnest(generate_series(1, (select count(*) from orders))) as generated_number")
def _(t):
    return generate_series(t.spark, t.orders.count())


@query("event_timestamp", """
select o_orderkey, try_strptime(concat(strftime(o_orderdate, '%Y-%m-%d'), lpad(tm, 4, '0')), '%Y-%m-%d%H%M') as event_time
from (select o_orderkey, o_orderdate, cast(o_custkey as varchar) as tm from orders)""")
def _(t):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return t.orders.select("o_orderkey", d.event_timestamp(day, col("o_custkey")).alias("event_time"))


# --- dates -----------------------------------------------------------------------------

@query("date_part", """
select event_id, cast(date_part('year', ts) as integer) as y, cast(date_part('quarter', ts) as integer) as q,
  cast(date_part('month', ts) as integer) as m, cast(date_part('day', ts) as integer) as dd,
  cast(date_part('hour', ts) as integer) as h, cast(date_part('minute', ts) as integer) as mi from events""")
def _(t):
    parts = {"y": "year", "q": "quarter", "m": "month", "dd": "day", "h": "hour", "mi": "minute"}
    return t.events.select("event_id", *[d.date_part(p, col("ts")).alias(n) for n, p in parts.items()])


@query("day_of_week", """
select o_orderkey, cast(dayofweek(o_orderdate) + 1 as integer) as day_of_week,
  cast(isodow(o_orderdate) as integer) as day_of_week_iso from orders""")
def _(t):
    day = col("o_orderdate")
    return t.orders.select("o_orderkey", d.day_of_week(day, iso=False).alias("day_of_week"),
                           d.day_of_week(day).alias("day_of_week_iso"))


@query("day_month_name", """
select o_orderkey, dayname(o_orderdate) as day_long, left(dayname(o_orderdate), 3) as day_short,
  monthname(o_orderdate) as month_long, left(monthname(o_orderdate), 3) as month_short from orders""")
def _(t):
    day = col("o_orderdate")
    return t.orders.select("o_orderkey", d.day_name(day, False).alias("day_long"), d.day_name(day).alias("day_short"),
                           d.month_name(day, False).alias("month_long"), d.month_name(day).alias("month_short"))


@query("day_of_month_year", """
select o_orderkey, cast(dayofmonth(o_orderdate) as integer) as day_of_month,
  cast(dayofyear(o_orderdate) as integer) as day_of_year from orders""")
def _(t):
    return t.orders.select("o_orderkey", d.day_of_month(col("o_orderdate")).alias("day_of_month"),
                           d.day_of_year(col("o_orderdate")).alias("day_of_year"))


@query("week_start_end", """
select o_orderkey, d - cast(dayofweek(d) as integer) as week_start, d - cast(dayofweek(d) as integer) + 6 as week_end
from (select o_orderkey, cast(o_orderdate as date) as d from orders)""")
def _(t):
    day = col("o_orderdate").cast("date")
    return t.orders.select("o_orderkey", d.week_start(day).alias("week_start"), d.week_end(day).alias("week_end"))


@query("iso_week", """
select o_orderkey, cast(date_trunc('week', d) as date) as week_start, cast(date_trunc('week', d) as date) + 6 as week_end,
  cast(week(d) as integer) as week_number from (select o_orderkey, cast(o_orderdate as date) as d from orders)""")
def _(t):
    day = col("o_orderdate").cast("date")
    return t.orders.select("o_orderkey", d.week_start(day, iso=True).alias("week_start"),
                           d.week_end(day, iso=True).alias("week_end"), d.week_of_year(day).alias("week_number"))


@query("week_of_year", """
select o_orderkey, cast(week(o_orderdate) as integer) as iso_week,
  cast(ceil(dayofyear(o_orderdate) / 7.0) as integer) as simple_week from orders""")
def _(t):
    return t.orders.select("o_orderkey", d.week_of_year(col("o_orderdate")).alias("iso_week"),
                           d.week_of_year(col("o_orderdate"), "simple").alias("simple_week"))


@query("convert_timezone", """
select event_id, ts - interval 5 hour as new_york, ts + interval 330 minute as kolkata from events""")
def _(t):
    """January times: New York is 5 hours behind UTC, Kolkata 5.5 hours ahead."""
    return t.events.select("event_id", d.convert_timezone(col("ts"), "America/New_York").alias("new_york"),
                           d.convert_timezone(col("ts"), "Asia/Kolkata").alias("kolkata"))


@query("unix_time", """
select event_id, cast(floor(epoch(ts)) as bigint) as seconds, date_trunc('second', ts) as from_seconds,
  date_trunc('millisecond', ts) as from_millis, ts as from_micros, ts as from_nanos from events""")
def _(t):
    micros = d.unix_micros(col("ts"))
    rows = t.events.select("event_id", d.to_unix(col("ts")).alias("seconds"), micros.alias("us"))

    return rows.select("event_id", "seconds", d.from_unix(col("seconds")).alias("from_seconds"),
                       d.from_unix(F.floor(col("us") / 1000), "milliseconds").alias("from_millis"),
                       d.from_unix(col("us"), "microseconds").alias("from_micros"),
                       d.from_unix(col("us").cast("decimal(25,0)") * 1000, "nanoseconds").alias("from_nanos"))


@query("round_timestamp", "select event_id, date_trunc('day', ts + interval 12 hour) as nearest_day from events")
def _(t):
    return t.events.select("event_id", d.round_to_day(col("ts")).cast("timestamp_ntz").alias("nearest_day"))


@query("relative_days", """
select event_id, cast(ts - interval 5 hour as date) as today, cast(ts as date) - 1 as yesterday,
  cast(ts as date) + 1 as tomorrow from events""")
def _(t):
    return t.events.select("event_id", d.today(col("ts"), "America/New_York").alias("today"),
                           d.yesterday(col("ts").cast("date")).alias("yesterday"),
                           d.tomorrow(col("ts").cast("date")).alias("tomorrow"))


@query("n_periods", """
select o_orderkey, d - 10 as days_ago, d + 10 as days_away, cast(date_trunc('week', d - 21) as date) as weeks_ago,
  cast(date_trunc('week', d + 21) as date) as weeks_away,
  cast(date_trunc('month', d - interval 4 month) as date) as months_ago,
  cast(date_trunc('month', d + interval 4 month) as date) as months_away
from (select o_orderkey, cast(o_orderdate as date) as d from orders)""")
def _(t):
    day = col("o_orderdate")
    return t.orders.select(
        "o_orderkey", d.n_days_ago(10, day).alias("days_ago"), d.n_days_away(10, day).alias("days_away"),
        d.n_weeks_ago(3, day).alias("weeks_ago"), d.n_weeks_away(3, day).alias("weeks_away"),
        d.n_months_ago(4, day).alias("months_ago"), d.n_months_away(4, day).alias("months_away"))


@query("last_next_period", """
select o_orderkey, cast(date_trunc('week', d - 7) as date) as last_week, cast(date_trunc('week', d + 7) as date) as next_week,
  cast(date_trunc('month', d - interval 1 month) as date) as last_month,
  cast(date_trunc('month', d + interval 1 month) as date) as next_month,
  left(monthname(d - interval 1 month), 3) as last_month_name, monthname(d + interval 1 month) as next_month_name,
  cast(month(d - interval 1 month) as integer) as last_month_number,
  cast(month(d + interval 1 month) as integer) as next_month_number
from (select o_orderkey, cast(o_orderdate as date) as d from orders)""")
def _(t):
    day = col("o_orderdate")
    return t.orders.select(
        "o_orderkey", d.last_week(day).alias("last_week"), d.next_week(day).alias("next_week"),
        d.last_month(day).alias("last_month"), d.next_month(day).alias("next_month"),
        d.last_month_name(day).alias("last_month_name"), d.next_month_name(day, False).alias("next_month_name"),
        d.last_month_number(day).alias("last_month_number"), d.next_month_number(day).alias("next_month_number"))


@query("periods_since", """
select event_id, cast(datediff('day', ts, timestamp '2024-02-01') as integer) as days,
  cast(datediff('day', date_trunc('week', ts), date_trunc('week', timestamp '2024-02-01')) // 7 as integer) as weeks,
  cast(datediff('month', ts, timestamp '2024-02-01') as integer) as months,
  cast(datediff('year', ts, timestamp '2024-02-01') as integer) as years,
  cast(datediff('hour', ts, timestamp '2024-02-01') as integer) as hours from events""")
def _(t):
    now = F.lit("2024-02-01").cast("timestamp_ntz")
    names = {"days": "day", "weeks": "week", "months": "month", "years": "year", "hours": "hour"}
    return t.events.select("event_id", *[d.periods_since(col("ts"), now, p).alias(n) for n, p in names.items()])


@query("date_arith", """
select o_orderkey, o_orderdate + interval 36 hour as plus_hours, cast(d + interval 2 month as date) as plus_months,
  cast(datediff('quarter', d, date '2001-08-01') as integer) as quarters, cast(date_trunc('quarter', d) as date) as quarter_start,
  last_day(d) as month_end, cast(date_trunc('quarter', d) + interval 3 month as date) - 1 as quarter_end,
  make_date(year(d), 12, 31) as year_end
from (select o_orderkey, o_orderdate, cast(o_orderdate as date) as d from orders)""")
def _(t):
    day = col("o_orderdate").cast("date")
    return t.orders.select(
        "o_orderkey", d.shift(col("o_orderdate"), "hour", 36).alias("plus_hours"),
        d.shift_date(day, "month", 2).alias("plus_months"),
        d.boundary_diff(day, F.lit("2001-08-01").cast("date"), "quarter").alias("quarters"),
        d.trunc_date(day, "quarter").alias("quarter_start"), d.last_day(day).alias("month_end"),
        d.last_day(day, "quarter").alias("quarter_end"), d.last_day(day, "year").alias("year_end"))


@query("date_literals", """
select o_orderkey, make_date(year(d), month(d), 1) as first_of_month,
  make_timestamp(year(d), month(d), day(d), 13, 45, 30.25) as moment
from (select o_orderkey, cast(o_orderdate as date) as d from orders)""")
def _(t):
    y, m, dd = F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate")
    return t.orders.select("o_orderkey", d.make_day(y, m, 1).alias("first_of_month"),
                           d.make_moment(y, m, dd, 13, 45, 30, 250_000).alias("moment"))


@query("academic_fiscal_parts", """
select o_orderkey, case when m >= 8 then concat(y, '-', y + 1) else concat(y - 1, '-', y) end as academic_year,
  cast(case when m >= 7 then y + 1 else y end as integer) as fiscal_year,
  cast(case when m between 7 and 9 then 1 when m >= 10 then 2 when m <= 3 then 3 else 4 end as integer) as fiscal_quarter,
  cast(case when m >= 7 then m - 6 else m + 6 end as integer) as fiscal_month,
  concat('FY', case when m >= 7 then y + 1 else y end, '-Q',
    case when m between 7 and 9 then 1 when m >= 10 then 2 when m <= 3 then 3 else 4 end) as fiscal_period
from (select o_orderkey, year(o_orderdate) as y, month(o_orderdate) as m from orders)""")
def _(t):
    day = col("o_orderdate")
    return t.orders.select(
        "o_orderkey", d.academic_year(day).alias("academic_year"), d.fiscal_year(day).alias("fiscal_year"),
        d.fiscal_quarter(day).alias("fiscal_quarter"), d.fiscal_month(day).alias("fiscal_month"),
        d.fiscal_period(day).alias("fiscal_period"))
