"""Parts of URL texts.  Inputs without a scheme work too, so ``parse_url`` is not enough."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Address starts that are not part of the host.
HOST_PREFIXES = ("android-app://", "http://", "https://")


def _part(c: Column, separator: str, n: int) -> Column:
    return F.split_part(c, F.lit(separator), F.lit(n))


def _without(c: Column, prefixes) -> Column:
    return F.regexp_replace(c, "|".join(prefixes), "")


def url_host(c: Column) -> Column:
    """Text up to the first '/' or '?', without scheme."""
    return _part(_part(_without(c, HOST_PREFIXES), "/", 1), "?", 1)


def url_path(c: Column) -> Column:
    """Text between the first '/' and '?'; null where there is no '/'."""
    bare = _without(c, ("http://", "https://"))
    slash = F.instr(bare, "/")
    return F.when(slash > 0, _part(F.substring(bare, slash + 1, F.length(bare)), "?", 1))


def url_parameter(c: Column, name: str) -> Column:
    """Value of one query parameter, empty as null."""
    return F.nullif(_part(_part(c, f"{name}=", 2), "&", 1), F.lit(""))
