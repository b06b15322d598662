"""Calendar tables over the date range of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltworks.bindings.base import query
from siltworks.plans import calendar

col = F.col


def order_bounds(t):
    return t.orders.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))


def order_days(t):
    """Every day from the first to the last order."""
    return calendar.recursive_dates(order_bounds(t), col("lo"), col("hi"), "date_day")


@query("date_spine", """
select unnest(generate_series(min(o_orderdate), max(o_orderdate) - interval 1 day, interval 1 day)) as date_day from orders""")
def _(t):
    return calendar.date_spine(order_bounds(t), col("lo"), col("hi"))


@query("base_dates", """
select unnest(generate_series(day - interval 240 hour, day + interval 23 hour, interval 1 hour)) as date_hour
from (select date_trunc('day', max(ts)) as day from events)""")
def _(t):
    last = t.events.agg(F.max("ts").alias("now"))
    return calendar.base_dates(last, col("now"), 240, "hour")


DAYS_SQL = """(select unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day))::date as d from orders)"""


@query("date_dimension", f"""
select d as date_day, d - 1 as prior_date_day, d + 1 as next_date_day, py as prior_year_date_day, ov as prior_year_over_year_date_day,
  (dayofweek(d) + 1)::integer as day_of_week, isodow(d)::integer as day_of_week_iso, dayname(d) as day_of_week_name,
  left(dayname(d), 3) as day_of_week_name_short, day(d)::integer as day_of_month, dayofyear(d)::integer as day_of_year,
  d - dayofweek(d)::integer as week_start_date, d - dayofweek(d)::integer + 6 as week_end_date, week(d)::integer as week_of_year,
  d - (isodow(d) - 1)::integer as iso_week_start_date, d - (isodow(d) - 1)::integer + 6 as iso_week_end_date, week(d)::integer as iso_week_of_year,
  ov - dayofweek(ov)::integer as prior_year_week_start_date, ov - dayofweek(ov)::integer + 6 as prior_year_week_end_date,
  week(ov)::integer as prior_year_week_of_year, ov - (isodow(ov) - 1)::integer as prior_year_iso_week_start_date,
  ov - (isodow(ov) - 1)::integer + 6 as prior_year_iso_week_end_date, week(ov)::integer as prior_year_iso_week_of_year,
  month(d)::integer as month_of_year, monthname(d) as month_name, left(monthname(d), 3) as month_name_short,
  date_trunc('month', d)::date as month_start_date, last_day(d) as month_end_date,
  date_trunc('month', py)::date as prior_year_month_start_date, last_day(py) as prior_year_month_end_date,
  quarter(d)::integer as quarter_of_year, date_trunc('quarter', d)::date as quarter_start_date,
  (date_trunc('quarter', d) + interval 3 month)::date - 1 as quarter_end_date, year(d)::integer as year_number,
  date_trunc('year', d)::date as year_start_date, make_date(year(d), 12, 31) as year_end_date
from (select d, (d - interval 1 year)::date as py, d - 364 as ov from {DAYS_SQL})""")
def _(t):
    return calendar.date_dimension(order_days(t))


# Weeks run from Sunday to Saturday; a year ends on the Saturday nearest the last of January.
# The closings are found by trying the seven days around each month end, and a day belongs to the first closing after it.
FISCAL_SQL = f"""
with days as (select d from {DAYS_SQL}),
month_ends as (select last_day(d) as me from days where month(d) = 1 group by 1),
closings as (select me + k::integer as fe from month_ends, range(-3, 4) r(k) where dayofweek(me + k::integer) = 6),
known as (select cast(fe as date) as fe from closings where exists (select 1 from days where d = cast(fe as date) - 6)),
fiscal as (select d as date_day, cast(year(min(fe)) - 1 as integer) as fiscal_year_number,
    (select max(p.fe) from known p where p.fe < d) + 1 as fiscal_year_start_date, min(fe) as fiscal_year_end_date,
    d - cast(dayofweek(d) as integer) as week_start_date, d - cast(dayofweek(d) as integer) + 6 as week_end_date,
    cast((d - cast(dayofweek(d) as integer) - (select max(p.fe) from known p where p.fe < d) - 1) // 7 + 1 as integer) as fiscal_week_of_year
  from days join known on fe >= d group by d having (select max(p.fe) from known p where p.fe < d) is not null)"""


@query("fiscal_year_dates", FISCAL_SQL + " select * from fiscal")
def _(t):
    return calendar.fiscal_year_dates(calendar.date_dimension(order_days(t)), year_end_month=1)


@query("fiscal_periods", FISCAL_SQL + """,
periods as (select cast(unnest(range(1, 13)) as integer) as n, unnest([1, 5, 10, 14, 18, 23, 27, 31, 36, 40, 44, 49]) as first_week,
  unnest([4, 9, 13, 17, 22, 26, 30, 35, 39, 43, 48, 53]) as last_week)
select date_day, fiscal_year_number, week_start_date, week_end_date, fiscal_week_of_year,
  cast(fiscal_week_of_year - first_week + 1 as integer) as fiscal_week_of_period, n as fiscal_period_number,
  cast(ceil(n / 3) as integer) as fiscal_quarter_number, cast(n - 3 * (ceil(n / 3) - 1) as integer) as fiscal_period_of_quarter
from fiscal join periods on fiscal_week_of_year between first_week and last_week""")
def _(t):
    return calendar.fiscal_periods(calendar.date_dimension(order_days(t)), year_end_month=1)


@query("recursive_dates", """
with recursive s as (select min(o_orderdate)::date as dt, max(o_orderdate)::date as last from orders
  union all select dt + 1, last from s where dt < last) select dt from s""")
def _(t):
    return calendar.recursive_dates(order_bounds(t), col("lo"), col("hi"))
