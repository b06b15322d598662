"""Date spines, the calendar dimension and fiscal years."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions import dates as d


def generate_series(spark, upper_bound: int, name: str = "generated_number") -> DataFrame:
    """1..upper_bound."""
    if upper_bound <= 0:
        raise ValueError("upper_bound must be positive")
    return spark.range(1, upper_bound + 1).withColumnRenamed("id", name)


def date_spine(bounds: DataFrame, start: Column, end: Column, part: str = "day") -> DataFrame:
    """One row per part from start up to but not including end; ``bounds`` is a one-row table.

    Days come first, spread over tasks; finer parts are made within each day, so no row
    holds more than one day of them.
    """
    name = f"date_{part}"
    lo, hi = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    rows = bounds.select(lo.alias("lo"), hi.alias("hi")).where("lo < hi")
    step = F.expr(f"INTERVAL 1 {part}")
    if part not in ("hour", "minute", "second"):
        rows = rows.select("hi", F.explode(F.sequence("lo", "hi", step)).alias(name))
    else:
        days = rows.select("lo", "hi", F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 day"))).alias("day"))
        days = days.repartition("day")
        rows = days.select("hi", F.explode(F.sequence(F.col("day"), F.col("day") + F.expr("INTERVAL 1 day") - step, step)).alias(name))
    return rows.where(F.col(name) < F.col("hi")).select(name)


def date_spine_between(spark, start: str, end: str, part: str = "day") -> DataFrame:
    return date_spine(spark.range(1), F.lit(start), F.lit(end), part)


def base_dates(bounds: DataFrame, today: Column, n_parts: int, part: str = "day") -> DataFrame:
    """The last ``n_parts`` parts up to and including ``today``."""
    day = today.cast("date")
    start = d.shift(day.cast("timestamp_ntz"), part, -n_parts)
    return date_spine(bounds, start, d.tomorrow(day), part)


def recursive_dates(bounds: DataFrame, start: Column, end: Column, name: str = "dt") -> DataFrame:
    """Days from start to end, both included."""
    return bounds.select(F.explode(F.sequence(start.cast("date"), end.cast("date"))).alias(name))


def date_dimension(days: DataFrame, day: str = "date_day") -> DataFrame:
    """Calendar attributes per day, with the matching days of the prior year."""
    x = F.col(day).cast("date")
    prior = d.shift_date(x, "year", -1)
    over = d.shift_date(x, "day", -364)
    return days.select(
        x.alias("date_day"),
        d.yesterday(x).alias("prior_date_day"),
        d.tomorrow(x).alias("next_date_day"),
        prior.alias("prior_year_date_day"),
        over.alias("prior_year_over_year_date_day"),
        d.day_of_week(x, iso=False).alias("day_of_week"),
        d.day_of_week(x, iso=True).alias("day_of_week_iso"),
        d.day_name(x, short=False).alias("day_of_week_name"),
        d.day_name(x).alias("day_of_week_name_short"),
        d.day_of_month(x).alias("day_of_month"),
        d.day_of_year(x).alias("day_of_year"),
        *_weeks(x, ""), d.week_of_year(x).alias("week_of_year"),
        *_weeks(x, "iso_", True), d.week_of_year(x).alias("iso_week_of_year"),
        *_weeks(over, "prior_year_"), d.week_of_year(over).alias("prior_year_week_of_year"),
        *_weeks(over, "prior_year_iso_", True), d.week_of_year(over).alias("prior_year_iso_week_of_year"),
        F.month(x).alias("month_of_year"),
        d.month_name(x, short=False).alias("month_name"),
        d.month_name(x).alias("month_name_short"),
        *_span(x, "month", "month_"), *_span(prior, "month", "prior_year_month_"),
        F.quarter(x).alias("quarter_of_year"), *_span(x, "quarter", "quarter_"),
        F.year(x).alias("year_number"), *_span(x, "year", "year_"),
    )


def _weeks(x: Column, prefix: str, iso: bool = False):
    return [d.week_start(x, iso).alias(f"{prefix}week_start_date"), d.week_end(x, iso).alias(f"{prefix}week_end_date")]


def _span(x: Column, part: str, prefix: str):
    return [d.trunc_date(x, part).alias(f"{prefix}start_date"), d.last_day(x, part).alias(f"{prefix}end_date")]


def closing_week_end(year: Column, year_end_month: int, week_start_day: int) -> Column:
    """The last day of the fiscal year that closes in a calendar year: of the days on which weeks
    end, the one nearest the last day of the closing month."""
    month_end = F.last_day(F.make_date(year, F.lit(year_end_month), F.lit(1)))
    since_week_end = F.pmod(F.dayofweek(month_end) - (week_start_day - 1), F.lit(7))  # week days count from Sunday = 1
    return F.date_add(month_end, F.when(since_week_end <= 3, -since_week_end).otherwise(7 - since_week_end))


def fiscal_year_dates(calendar: DataFrame, year_end_month: int = 12, week_start_day: int = 1,
                      shift_year: int = 1) -> DataFrame:
    """Days with their fiscal year, which ends on the week end nearest the end of ``year_end_month``.

    All values follow from the day alone.  Years whose start or end the calendar does not
    hold are left out, so only the bounds of the calendar are looked up.
    """
    day = F.col("date_day")

    def closing(offset):
        return closing_week_end(F.year(day) + offset, year_end_month, week_start_day)

    closes = (F.when(day <= closing(-1), F.year(day) - 1).when(day <= closing(0), F.year(day))
              .otherwise(F.year(day) + 1))
    opens_after = closing_week_end(closes - 1, year_end_month, week_start_day)
    week = F.date_sub(day, F.pmod(F.dayofweek(day) - week_start_day, F.lit(7)))
    days = calendar.select(
        "date_day", (closes - shift_year).alias("fiscal_year_number"),
        F.date_add(opens_after, 1).alias("fiscal_year_start_date"),
        closing_week_end(closes, year_end_month, week_start_day).alias("fiscal_year_end_date"),
        week.alias("week_start_date"), F.date_add(week, 6).alias("week_end_date"))
    # A year is known when the calendar holds the first day of the weeks that end it and the year before.
    bounds = calendar.agg(F.min("date_day").alias("lo"), F.max("date_day").alias("hi"))
    known = ((F.date_sub("fiscal_year_start_date", 7) >= bounds.select("lo").scalar())
             & (F.date_sub("fiscal_year_end_date", 6) <= bounds.select("hi").scalar()))
    number = F.floor(F.datediff("week_start_date", "fiscal_year_start_date") / 7).cast("int") + 1
    return days.where(known).withColumn("fiscal_week_of_year", number)


def fiscal_periods(calendar: DataFrame, year_end_month: int = 12, week_start_day: int = 1,
                   shift_year: int = 1) -> DataFrame:
    """Quarters of 13 weeks cut into periods of 4, 5 and 4; the last period takes a 53rd week."""
    starts = [13 * q + w for q in range(4) for w in (1, 5, 10)]  # first week of each of the 12 periods
    week = F.col("fiscal_week_of_year")
    period = sum((F.when(week >= w, 1).otherwise(0) for w in starts[1:]), F.lit(1))
    days = fiscal_year_dates(calendar, year_end_month, week_start_day, shift_year).withColumn("period", period)
    first = F.element_at(F.array(*[F.lit(w) for w in starts]), F.col("period"))
    return days.select(
        "date_day", "fiscal_year_number", "week_start_date", "week_end_date", "fiscal_week_of_year",
        (week - first + 1).alias("fiscal_week_of_period"), F.col("period").alias("fiscal_period_number"),
        (F.floor((F.col("period") - 1) / 3).cast("int") + 1).alias("fiscal_quarter_number"),
        (F.pmod(F.col("period") - 1, F.lit(3)) + 1).alias("fiscal_period_of_quarter"))
