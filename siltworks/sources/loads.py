"""CSV loads and load metadata."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.functions.text import any_of

CORRUPT = "_corrupt"


def load_csv(spark: SparkSession, path, schema: T.StructType | str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """Good rows and rejected lines of CSV files; a bad line never stops the load and comes out as it landed.

    Lines are read as text, so a rejected one keeps its quotes and blanks, and parsed to text columns that are cast
    here: whether a line is good depends on all its columns, whatever a query selects.  With ``header`` the first
    line of each file, which must be equal in all of them, is no row.  Blank lines are no rows; a
    quoted value ends on its line.
    """
    typed = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wide = ", ".join([*[f"`{f.name}` string" for f in typed], f"`{CORRUPT}` string"])
    lines = spark.read.text(path).where("trim(value) <> ''")
    if header:
        first = lines.limit(1).first()
        lines = lines.where(F.col("value") != F.lit(first["value"])) if first else lines
    parsed = F.from_csv("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = lines.select("value", parsed.alias("row"))
    cells = {f.name: F.col(f"row.`{f.name}`") for f in typed}
    values = {f.name: cells[f.name].try_cast(f.dataType) for f in typed}
    broken = F.col("row").isNull() | F.col(f"row.`{CORRUPT}`").isNotNull()
    bad = any_of([broken, *[cells[n].isNotNull() & v.isNull() for n, v in values.items()]])
    good = rows.where(~bad).select(*[v.alias(n) for n, v in values.items()])
    return good, rows.where(bad).select(F.col("value").alias("rejected_line"))


def load_seed(spark: SparkSession, path, schema: str) -> DataFrame:
    """Small reference CSV with declared types; outer blanks of names and values are dropped."""
    raw = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True) \
        .option("ignoreTrailingWhiteSpace", True).csv(path)
    raw = raw.toDF(*[re.sub(r"\s+", "", c) for c in raw.columns])
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(schema)])


def stamp_missing(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Fill load metadata only where a row lacks it; columns not there yet are added."""
    have = set(df.columns)
    return df.withColumns({c: F.coalesce(F.col(c), v) if c in have else v for c, v in values.items()})
