"""Hash keys and readable ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltworks.config import MASTER_ID_PREFIX, NULL_KEY_TOKEN


def surrogate_key(*cols: Column, nulls_as_empty: bool = False) -> Column:
    """md5 of the columns as text, joined by '-'; a null has its own token (or counts as '')."""
    token = "" if nulls_as_empty else NULL_KEY_TOKEN
    return F.md5(F.concat_ws("-", *[F.coalesce(c.cast("string"), F.lit(token)) for c in cols]))


def row_hash(*cols: Column) -> Column:
    """md5 over tracked attributes; nulls count as empty text."""
    return F.md5(F.concat_ws("||", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))


def text_hash(*cols: Column) -> Column:
    """md5 of the joined texts; null if any is null."""
    return F.md5(F.concat(*[c.cast("string") for c in cols]))


def master_id(number: Column, prefix: str = MASTER_ID_PREFIX, digits: int = 9) -> Column:
    """Prefix and zero-padded number; a number too long for the pad raises instead of being cut."""
    text = number.cast("string")
    fits = F.length(text) <= digits
    return F.when(fits, F.concat(F.lit(prefix), F.lpad(text, digits, "0"))).otherwise(
        F.raise_error(F.concat(F.lit("master id does not fit its digits: "), text))
    )
