"""Column selection, unions and set differences over whole tables."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Ranges of row hashes that tables are compared in.
RANGES = 1024


def filtered_columns(df: DataFrame, leave_out=()) -> list[str]:
    skip = {c.lower() for c in leave_out}
    return [c for c in df.columns if c.lower() not in skip]


def star(df: DataFrame, leave_out=(), prefix: str = "", suffix: str = "") -> DataFrame:
    """All columns but some, matched without case, with prefix and suffix."""
    return df.select(*[F.col(c).alias(f"{prefix}{c}{suffix}") for c in filtered_columns(df, leave_out)])


def nullcheck_table(df: DataFrame) -> DataFrame:
    """Empty text to null in every text column."""
    return df.select(*[
        F.nullif(F.col(f.name), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema
    ])


def require_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.dropna(subset=keys)


def union_relations(tables: Mapping[str, DataFrame], include=None, exclude=None, override: Mapping[str, str] | None = None,
                    source_column: str | None = "_source_relation", where: Column | None = None) -> DataFrame:
    """Union of unlike tables: all columns, missing ones null, names matched without case.

    ``override`` maps a column to a type; ``where`` filters each table before the union.
    """
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    wanted = {c.lower() for c in include} if include else None
    dropped = {c.lower() for c in exclude or ()}
    types = {k.lower(): v for k, v in (override or {}).items()}
    out = None
    for name, df in tables.items():
        if where is not None:
            df = df.where(where)
        cols = [c for c in df.columns if c.lower() not in dropped and (wanted is None or c.lower() in wanted)]
        picked = [F.col(c).cast(types[c.lower()]).alias(c) if c.lower() in types else F.col(c) for c in cols]
        if source_column:
            picked = [F.lit(name).alias(source_column), *picked]
        df = df.select(*picked)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("no tables to union")
    return out


def match_tables(names, pattern: str | None = None, prefix: str | None = None, exclude: str = "") -> list[str]:
    """Names that fit a LIKE pattern or a prefix and not the exclude pattern, without case."""
    def like(text: str, p: str) -> bool:
        rx = re.escape(p.lower()).replace("%", ".*").replace("_", ".")
        return re.fullmatch(rx, text.lower()) is not None

    shape = pattern if pattern is not None else f"{prefix}%"
    return sorted(n for n in names if like(n, shape) and not (exclude and like(n, exclude)))


def side_flags(a: DataFrame, b: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Distinct rows of both tables with ``in_a`` and ``in_b``: one shuffle, nulls equal."""
    cols = columns or a.columns
    both = a.select(*cols, F.lit(True).alias("in_a"), F.lit(False).alias("in_b")).unionAll(
        b.select(*cols, F.lit(False).alias("in_a"), F.lit(True).alias("in_b")))
    return both.groupBy(*cols).agg(F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))


def fingerprints(df: DataFrame, columns: list[str], ranges: int) -> DataFrame:
    """Per range of row hashes: number, sums and exclusive or of two 64-bit hashes, whatever the order of the rows."""
    cells = [F.to_json(F.struct(F.col(c))) if "map<" in dict(df.dtypes)[c] else F.col(c) for c in columns]
    h = df.select(F.xxhash64(*cells).alias("h"), F.xxhash64(F.lit(1), *cells).alias("h2"))
    wide = lambda c: F.sum(F.col(c).cast("decimal(20,0)"))  # noqa: E731  a sum of longs may pass 64 bits
    return h.groupBy(F.pmod("h", F.lit(ranges)).cast("int").alias("range")).agg(
        F.count("*").alias("n"), wide("h").alias("sum_1"), wide("h2").alias("sum_2"), F.bit_xor("h").alias("xor_1"), F.bit_xor("h2").alias("xor_2"))


def unequal_ranges(a: DataFrame, b: DataFrame, columns: list[str], ranges: int = RANGES) -> list[int]:
    """Ranges of row hashes in which the tables do not hold the same rows equally often; one small row per range moves.

    Equal fingerprints of different rows would need a count, two sums and two exclusive ors of independent
    hashes to agree by chance.  Starts a job.
    """
    prints = [fingerprints(df.select(*columns), columns, ranges) for df in (a, b)]
    values = F.struct(*[c for c in prints[0].columns if c != "range"])
    # a side without rows in a range gives one print there, so does agreement of both
    pairs = prints[0].select("range", values.alias("print")).unionAll(prints[1].select("range", values.alias("print")))
    found = pairs.groupBy("range").agg((F.count("*") == 2).alias("two"), (F.min("print") == F.max("print")).alias("same"))
    return sorted(r["range"] for r in found.where("not (two and same)").collect())


def differing_flags(a: DataFrame, b: DataFrame, columns: list[str] | None = None, ranges: int = RANGES) -> DataFrame:
    """Distinct rows of only one table, with ``in_a`` and ``in_b``.

    Tables are compared by fingerprints first; only rows in ranges that differ are shuffled and compared, so equal
    tables of any size move one row per range and task.
    """
    cols = columns or a.columns
    differ = unequal_ranges(a, b, cols, ranges)
    cells = [F.to_json(F.struct(F.col(c))) if "map<" in dict(a.dtypes)[c] else F.col(c) for c in cols]
    mine = F.pmod(F.xxhash64(*cells), F.lit(ranges)).cast("int")
    kept = (lambda df: df) if len(differ) == ranges else lambda df: df.where(mine.isin(differ) if differ else F.lit(False))
    return side_flags(kept(a.select(*cols)), kept(b.select(*cols)), cols).where(F.col("in_a") != F.col("in_b"))


def symmetric_difference(a: DataFrame, b: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Distinct rows of only one table, labelled a_minus_b or b_minus_a."""
    flags = differing_flags(a, b, columns)
    label = F.when(F.col("in_a"), "a_minus_b").otherwise("b_minus_a")
    return flags.withColumn("which_diff", label).drop("in_a", "in_b")
