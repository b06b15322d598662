"""Flags and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def yes_no(c: Column) -> Column:
    """Y is true, N is false, anything else is null."""
    return F.when(c == "Y", True).when(c == "N", False)


def one_zero(c: Column) -> Column:
    """1 is true, 0 is false, anything else is null."""
    return F.when(c == 1, True).when(c == 0, False)


def one_or_false(c: Column) -> Column:
    """1 is true, anything else (null too) is false."""
    return F.coalesce(c == 1, F.lit(False))


def first_rule(rules, otherwise: str) -> Column:
    """Label of the first rule that holds; ``rules`` is a list of (condition, label)."""
    label = None
    for condition, text in rules:
        label = F.when(condition, text) if label is None else label.when(condition, text)
    return label.otherwise(otherwise)


def presence(a: Column, b: Column, names=("in_both", "only_a", "only_b")) -> list[Column]:
    """Three flags: both values there, only the first, only the second."""
    both, only_a, only_b = names
    return [
        (a.isNotNull() & b.isNotNull()).alias(both),
        (a.isNotNull() & b.isNull()).alias(only_a),
        (a.isNull() & b.isNotNull()).alias(only_b),
    ]


def is_open(end: Column, as_of) -> Column:
    """True when there is no end or it is not before ``as_of``; never null."""
    return end.isNull() | (end.cast("date") >= F.lit(as_of).cast("date"))


def age_in_year_steps(birth: Column, as_of) -> Column:
    """Difference of the calendar years, whatever the day."""
    return F.year(F.lit(as_of).cast("date")) - F.year(birth)


def is_independent(birth: Column, as_of, years: int = 24) -> Column:
    return age_in_year_steps(birth, as_of) >= years
