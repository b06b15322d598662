"""Cleaning, casting and matching of text columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for "no value" in landed files.
NULL_TOKENS = ("", "NULL", "N/A", "0")

# Accepted date shapes and their formats.
DATE_SHAPES = (
    (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
    (r"^\d{2}/\d{2}/\d{4}$", "MM/dd/yyyy"),
)

# Regex option letters that may be folded into a pattern.
REGEX_FLAGS = "icms"


def clean_string(c: Column) -> Column:
    """Code columns: no outer blanks, upper case."""
    return F.trim(F.upper(c))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def null_tokens(c: Column, tokens=NULL_TOKENS) -> Column:
    """Null where the trimmed text is one of ``tokens``, else the text as it is."""
    return F.when(~F.trim(c).isin(list(tokens)), c)


def first_non_blank(*cols: Column) -> Column:
    return F.coalesce(*[blank_to_null(c) for c in cols])


def email_normalise(c: Column) -> Column:
    return F.nullif(F.lower(F.trim(c)), F.lit(""))


def safe_cast(c: Column, data_type: str, default=None) -> Column:
    """Null and blank give ``default``; other text is cast, and bad text raises."""
    blank = c.isNull() | (F.trim(c.cast("string")) == "")
    return F.when(blank, F.lit(default).cast(data_type)).otherwise(c.cast(data_type))


def try_cast(c: Column, data_type: str) -> Column:
    """Null where the text does not hold a value of the type."""
    return c.try_cast(data_type)


def parse_date(c: Column, shapes=DATE_SHAPES) -> Column:
    """Date by the first shape whose regex the text matches, else null."""
    return F.coalesce(*[
        F.when(c.rlike(pattern), F.try_to_timestamp(c, F.lit(fmt)).cast("date"))
        for pattern, fmt in shapes
    ])


def last_name(c: Column) -> Column:
    """Part before the comma of 'Last, First'."""
    return F.split_part(c, F.lit(","), F.lit(1))


def first_name(c: Column) -> Column:
    """Part after the comma of 'Last, First'."""
    return F.trim(F.split_part(c, F.lit(","), F.lit(2)))


def regex_capture(c: Column, pattern: str, group: int = 1) -> Column:
    """Captured group, null where nothing matches."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def split_list(c: Column, separator: str = ";") -> Column:
    """Array of the trimmed parts of a separated text."""
    return F.split(F.trim(c), rf"\s*{separator}\s*")


def is_email(c: Column) -> Column:
    """Has an at sign and no blank."""
    return c.contains("@") & ~c.contains(" ")


def slugify(c: Column) -> Column:
    """Lower case; blanks and dashes to one '_'; other marks dropped; '_' before a leading digit."""
    joined = F.regexp_replace(F.lower(c), "[ -]+", "_")
    plain = F.regexp_replace(joined, "[^a-z0-9_]+", "")
    return F.regexp_replace(plain, "^([0-9])", "_$1")


def mask_unless(c: Column, role: str, allowed, mask: str = "XXX-XX-", keep: int = 4) -> Column:
    """The value for allowed roles; for others a mask and the last ``keep`` characters."""
    hidden = F.concat(F.lit(mask), F.right(c, F.lit(keep)))
    return F.when(F.lit(role).isin(list(allowed)), c).otherwise(hidden)


def with_flags(pattern: str, flags: str = "") -> str:
    """Fold option letters into the pattern: i, m and s turn an option on, c turns case off."""
    unknown = sorted(set(flags) - set(REGEX_FLAGS))
    if unknown:
        raise ValueError(f"unknown regex flags {unknown}; choose from {REGEX_FLAGS}")
    if "c" in flags and "i" in flags:
        raise ValueError("flags c and i exclude each other")
    on = "".join(f for f in "ims" if f in flags)
    if "c" in flags:
        return f"(?{on}-i)" + pattern
    return f"(?{on})" + pattern if on else pattern


def regex_position(c: Column, pattern: str, flags: str = "", position: int = 1, occurrence: int = 1) -> Column:
    """1-based place of a match, also an empty one; 0 without a match, null for null.

    The search starts at ``position`` and takes match number ``occurrence``; what stands
    before the start, or before the end of the match before, is not seen by the pattern.
    """
    if position < 1 or occurrence < 1:
        raise ValueError("position and occurrence count from 1")
    regex = F.lit(with_flags(pattern, flags))
    if (position, occurrence) == (1, 1):
        return F.regexp_instr(c, regex)

    def following(state, _):
        rest = F.substring(c, state["taken"] + 1, F.length(c))
        found = F.regexp_instr(rest, regex)
        passed = found - 1 + F.greatest(F.length(F.regexp_substr(rest, regex)), F.lit(1))
        missed = (found == 0) | (state["at"] < 0) | (state["taken"] > F.length(c))
        return F.struct(F.when(missed, state["taken"]).otherwise(state["taken"] + passed).alias("taken"),
                        F.when(missed, -1).otherwise(state["taken"] + found).alias("at"))

    start = F.struct(F.lit(position - 1).alias("taken"), F.lit(0).alias("at"))
    at = F.aggregate(F.sequence(F.lit(1), F.lit(occurrence)), start, following)["at"]
    return F.when(c.isNotNull(), F.greatest(at, F.lit(0)))


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_of(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)
