"""Date and time columns.

Days of the week count from Sunday = 1 unless ``iso`` is set (Monday = 1), and
``now`` / ``today`` are always passed in.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIX_UNITS = {"seconds": 1_000_000, "milliseconds": 1_000, "microseconds": 1}
TIME_PARTS = ("hour", "minute", "second")


def as_date(value) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("date")


# --- parts -----------------------------------------------------------------

def date_part(part: str, c: Column) -> Column:
    return F.date_part(F.lit(part), c)


def day_of_week(c: Column, iso: bool = True) -> Column:
    return F.weekday(c) + 1 if iso else F.dayofweek(c)


def day_name(c: Column, short: bool = True) -> Column:
    return F.date_format(c, "E" if short else "EEEE")


def month_name(c: Column, short: bool = True) -> Column:
    return F.date_format(c, "MMM" if short else "MMMM")


def day_of_month(c: Column) -> Column:
    return F.dayofmonth(c)


def day_of_year(c: Column) -> Column:
    return F.dayofyear(c)


def week_start(c: Column, iso: bool = False) -> Column:
    return F.date_sub(c, F.weekday(c)) if iso else F.date_sub(c, F.dayofweek(c) - 1)


def week_end(c: Column, iso: bool = False) -> Column:
    return F.date_add(week_start(c, iso), 6)


def week_of_year(c: Column, mode: str = "iso") -> Column:
    """ISO week number, or with mode 'simple' the seventh part of the day of year, rounded up."""
    if mode == "iso":
        return F.weekofyear(c)
    if mode == "simple":
        return F.ceil(F.dayofyear(c) / 7).cast("int")
    raise ValueError("mode is 'iso' or 'simple'")


# --- arithmetic ------------------------------------------------------------

def shift(c: Column, part: str, n) -> Column:
    """Timestamp moved by ``n`` parts."""
    step = n if isinstance(n, Column) else F.lit(n)
    return F.timestamp_add(part.upper(), step.cast("bigint"), c)


def shift_date(c: Column, part: str, n: int) -> Column:
    """Date moved by ``n`` days, weeks, months, quarters or years."""
    months = {"month": 1, "quarter": 3, "year": 12}
    if part in months:
        return F.add_months(c, n * months[part])
    return F.date_add(c, n * {"day": 1, "week": 7}[part])


def trunc_date(c: Column, part: str) -> Column:
    return as_date(c) if part == "day" else F.trunc(as_date(c), part)


def last_day(c: Column, part: str = "month") -> Column:
    """Last date of the week (Monday based), month, quarter or year."""
    if part == "month":
        return F.last_day(c)
    return F.date_sub(shift_date(trunc_date(c, part), part, 1), 1)


def boundary_diff(start: Column, end: Column, part: str) -> Column:
    """How many starts of ``part`` lie between the two, not how many full parts."""
    if part in TIME_PARTS:
        a, b = (F.date_trunc(part, x).cast("timestamp_ntz") for x in (start, end))
        return F.timestamp_diff(part.upper(), a, b).cast("int")
    years = F.year(end) - F.year(start)
    if part == "year":
        return years
    if part == "quarter":
        return years * 4 + F.quarter(end) - F.quarter(start)
    if part == "month":
        return years * 12 + F.month(end) - F.month(start)
    if part == "week":
        return (F.datediff(week_start(as_date(end), iso=True), week_start(as_date(start), iso=True)) / 7).cast("int")
    if part == "day":
        return F.datediff(end, start)
    raise ValueError(f"unknown part {part!r}")


def periods_since(c: Column, now, part: str = "day") -> Column:
    return boundary_diff(c, F.lit(now), part)


def round_to_day(ts: Column) -> Column:
    """Start of the nearest day: noon and later go to the next one."""
    return F.date_trunc("day", shift(ts, "hour", 12))


# --- relative to a given day -------------------------------------------------

def yesterday(c: Column) -> Column:
    return F.date_sub(c, 1)


def tomorrow(c: Column) -> Column:
    return F.date_add(c, 1)


def n_days_ago(n: int, day) -> Column:
    return F.date_sub(as_date(day), n)


def n_days_away(n: int, day) -> Column:
    return n_days_ago(-n, day)


def n_weeks_ago(n: int, day) -> Column:
    """Monday of the week ``n`` weeks before."""
    return F.trunc(F.date_sub(as_date(day), 7 * n), "week")


def n_weeks_away(n: int, day) -> Column:
    return n_weeks_ago(-n, day)


def n_months_ago(n: int, day) -> Column:
    """First day of the month ``n`` months before."""
    return F.trunc(F.add_months(as_date(day), -n), "month")


def n_months_away(n: int, day) -> Column:
    return n_months_ago(-n, day)


def last_week(day) -> Column:
    return n_weeks_ago(1, day)


def next_week(day) -> Column:
    return n_weeks_away(1, day)


def last_month(day) -> Column:
    return n_months_ago(1, day)


def next_month(day) -> Column:
    return n_months_away(1, day)


def last_month_name(day, short: bool = True) -> Column:
    return month_name(last_month(day), short)


def next_month_name(day, short: bool = True) -> Column:
    return month_name(next_month(day), short)


def last_month_number(day) -> Column:
    return F.month(last_month(day))


def next_month_number(day) -> Column:
    return F.month(next_month(day))


# --- zones, epochs, literals -------------------------------------------------

def convert_timezone(c: Column, target: str, source: str = "UTC") -> Column:
    """Wall-clock time in ``target`` of a wall-clock time in ``source``."""
    return F.convert_timezone(F.lit(source), F.lit(target), c.cast("timestamp_ntz"))


def today(now, time_zone: str = "UTC") -> Column:
    return convert_timezone(F.lit(now), time_zone).cast("date")


def _epoch() -> Column:
    return F.lit("1970-01-01").cast("timestamp_ntz")


def from_unix(c: Column, unit: str = "seconds") -> Column:
    """UTC wall-clock time of a count since 1970, whatever the session's zone."""
    if unit == "nanoseconds":
        micros = F.floor(c / 1000)
    elif unit in UNIX_UNITS:
        micros = c.cast("bigint") * UNIX_UNITS[unit]
    else:
        raise ValueError(f"unit is one of {[*UNIX_UNITS, 'nanoseconds']}")
    return F.timestamp_add("MICROSECOND", micros.cast("bigint"), _epoch())


def unix_micros(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", _epoch(), ts.cast("timestamp_ntz"))


def to_unix(ts: Column) -> Column:
    """Whole seconds since 1970 of a UTC wall-clock time."""
    return F.floor(unix_micros(ts) / 1_000_000)


def make_day(year, month, day) -> Column:
    return F.make_date(*[x if isinstance(x, Column) else F.lit(x) for x in (year, month, day)])


def make_moment(year, month, day, hour=0, minute=0, second=0, micro=0) -> Column:
    parts = [x if isinstance(x, Column) else F.lit(x) for x in (year, month, day, hour, minute, second, micro)]
    seconds = (parts[5] + parts[6] / 1_000_000).cast("decimal(16,6)")
    return F.make_timestamp_ntz(*parts[:5], seconds)


def event_timestamp(day: Column, minute_text: Column) -> Column:
    """Day and clock digits ('930', '0930') as a timestamp; null where they are no time."""
    digits = F.lpad(minute_text.cast("string"), 4, "0")
    is_clock = digits.rlike("^([01][0-9]|2[0-3])[0-5][0-9]$")
    minutes = F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int")
    return F.when(is_clock, F.timestamp_add("MINUTE", minutes, day.try_cast("date").cast("timestamp_ntz")))


# --- academic and fiscal years -------------------------------------------------

def academic_year(c: Column, first_month: int = 8) -> Column:
    """'2020-2021' for dates from August 2020 to July 2021."""
    start = F.year(c) - F.when(F.month(c) >= first_month, 0).otherwise(1)
    return F.concat_ws("-", start.cast("string"), (start + 1).cast("string"))


def fiscal_month(c: Column, first_month: int = 7) -> Column:
    return F.pmod(F.month(c) - first_month, F.lit(12)) + 1


def fiscal_year(c: Column, first_month: int = 7) -> Column:
    """Named after the calendar year it ends in."""
    return F.year(c) + F.when(F.month(c) >= first_month, 1).otherwise(0)


def fiscal_quarter(c: Column, first_month: int = 7) -> Column:
    return (F.floor((fiscal_month(c, first_month) - 1) / 3) + 1).cast("int")


def fiscal_period(c: Column, first_month: int = 7) -> Column:
    return F.concat(
        F.lit("FY"), fiscal_year(c, first_month).cast("string"),
        F.lit("-Q"), fiscal_quarter(c, first_month).cast("string"),
    )
