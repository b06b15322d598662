"""Comparison of two tables by rows, by key and by schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.operators.tables import differing_flags, filtered_columns, side_flags
from siltworks.operators.windows import share_of_total

# Match states of a compared column, in report order.
MATCH_STATES = (
    "✅: perfect match",
    "✅: both are null",
    "🤷: ‍missing from a",
    "🤷: missing from b",
    "🤷: value is null in a only",
    "🤷: value is null in b only",
    "🙅: ‍values do not match",
)


def compare_queries(a: DataFrame, b: DataFrame, summarize: bool = True) -> DataFrame:
    """Distinct rows by side: counts with percent, or the rows of one side only."""
    if not summarize:
        return differing_flags(a, b)
    counts = side_flags(a, b).groupBy("in_a", "in_b").agg(F.count("*").alias("count"))
    return share_of_total(counts, "count", "percent_of_total").orderBy(F.desc("in_a"), F.desc("in_b"))


def compare_relations(a: DataFrame, b: DataFrame, exclude_columns=(), summarize: bool = True) -> DataFrame:
    cols = filtered_columns(a, exclude_columns)
    return compare_queries(a.select(*cols), b.select(*cols), summarize)


def _tagged(a: DataFrame, b: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Both tables under one another: ``k``, ``c0``.. and the side as ``in_a``, ``in_b`` (1 or 0).

    Rows without a key match nothing, so ``lone`` (the side, for them only) keeps those of a and b apart.
    Maps, which have no order and cannot be grouped, become JSON.
    """
    def side(df, name):
        kinds = dict(df.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)]).dtypes)
        mine = [(F.to_json(c) if "map<" in kinds[f"c{i}"] else F.col(c)).alias(f"c{i}") for i, c in enumerate(columns)]
        return df.select(F.col(key).alias("k"), *mine, F.when(F.col(key).isNull(), F.lit(name)).alias("lone"),
                         F.lit(int(name == "a")).alias("in_a"), F.lit(int(name == "b")).alias("in_b"))

    return side(a, "a").unionByName(side(b, "b"))


def keyed_sides(a: DataFrame, b: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per key of either table: ``k``, ``n_a``, ``n_b`` and each column's value on each side (``a0``, ``b0``, ..).

    One aggregation of both tables, without a join; rows are combined before the shuffle, so a key may
    hold any number of them.  Where a key repeats (``repeated``) a value is the least one of its side.
    Rows without a key are one row per side.
    """
    cells = [F.min(F.when(F.col(f"in_{s}") == 1, F.col(f"c{i}"))).alias(f"{s}{i}") for i in range(len(columns)) for s in "ab"]
    out = _tagged(a, b, key, columns).groupBy("k", "lone").agg(F.sum("in_a").alias("n_a"), F.sum("in_b").alias("n_b"), *cells)
    return out.withColumn("repeated", F.greatest("n_a", "n_b") > 1).drop("lone")


def compare_column(a: DataFrame, b: DataFrame, key: str, column: str) -> DataFrame:
    """Counts of the match states of one column over rows paired by key.

    Repeated keys count every pair of their rows, from the counts of their values on either side; the
    pairs are never made.  ``repeated_keys`` tells how many of a state's keys repeat.
    """
    cells = _tagged(a, b, key, [column]).groupBy("k", "lone", "c0").agg(F.sum("in_a").alias("a"), F.sum("in_b").alias("b"))
    null = F.col("c0").isNull()
    keys = cells.groupBy("k", "lone").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum(F.when(null, F.col("a")).otherwise(0)).alias("a0"),
        F.sum(F.when(null, F.col("b")).otherwise(0)).alias("b0"), F.sum(F.when(null, 0).otherwise(F.col("a") * F.col("b"))).alias("same"))
    a_, b_, a0, b0, same = (F.col(c) for c in ("a", "b", "a0", "b0", "same"))
    only_a, only_b = b_ == 0, a_ == 0
    # in the order of MATCH_STATES; a null that no row faces counts as null on both sides
    weights = [same, a0 * b0 + F.when(only_a, a0).when(only_b, b0).otherwise(0), F.when(only_b, b_ - b0).otherwise(0),
               F.when(only_a, a_ - a0).otherwise(0), a0 * (b_ - b0), (a_ - a0) * b0, (a_ - a0) * (b_ - b0) - same]
    repeated = F.greatest(a_, b_) > 1
    sums = keys.agg(*[F.struct(F.lit(i).alias("__state"), F.sum(w).alias("count_records"),
                               F.count(F.when(repeated & (w > 0), 1)).alias("repeated_keys")).alias(f"s{i}") for i, w in enumerate(weights)])
    counts = sums.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(weights))]))).where("count_records > 0")
    label = F.element_at(F.array(*[F.lit(s) for s in MATCH_STATES]), F.col("__state") + 1)
    counts = counts.select("__state", F.lit(column).alias("column_name"), label.alias("match_status"), "count_records", "repeated_keys")
    return share_of_total(counts, "count_records", "percent_of_total").orderBy("__state").drop("__state")


def paired_rows(a: DataFrame, b: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The rows of a full outer join by key, in the columns of ``keyed_sides``: every pair of rows of a key, every row alone.

    Keys with at most one row a side come from one aggregation; only the rows of keys that repeat are joined,
    by inner joins, whose hot keys Spark splits.
    """
    every, once = _tagged(a, b, key, columns), keyed_sides(a, b, key, columns).where("k is not null and not repeated")
    many = keyed_sides(a, b, key, []).where("k is not null and repeated")
    left, right = (every.where(f"in_{s} = 1").select("k", *[F.col(f"c{i}").alias(f"{s}{i}") for i in range(len(columns))]) for s in "ab")
    parts = [once, left.join(many.where("n_a > 0 and n_b > 0"), "k").join(right, "k"),
             left.join(many.where("n_b = 0"), "k"), right.join(many.where("n_a = 0"), "k")]
    for s, df in (("a", left), ("b", right)):
        lone = df.where("k is null")
        parts.append(lone.withColumns({"n_a": F.lit(int(s == "a")), "n_b": F.lit(int(s == "b")), "repeated": lone.agg(F.count("*") > 1).scalar()}))
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def _cell_flags(i: int) -> dict:
    """Flags of one column of paired rows; a row that faces none matches nothing, its nulls neither."""
    a, b, in_a, in_b = F.col(f"a{i}"), F.col(f"b{i}"), F.col("n_a") > 0, F.col("n_b") > 0
    equal = a.eqNullSafe(b)
    return {
        "perfect_match": in_a & in_b & equal,
        "null_in_a": in_a & a.isNull(),
        "null_in_b": in_b & b.isNull(),
        "missing_from_a": ~in_a,
        "missing_from_b": ~in_b,
        "conflicting_values": in_a & in_b & ~equal,
    }


def compare_column_verbose(a: DataFrame, b: DataFrame, key: str, column: str) -> DataFrame:
    """Flags of one column for every pair of rows; ``repeated_key`` where the key has several rows on a side."""
    j = paired_rows(a, b, key, [column])
    return j.select(F.col("k").alias("primary_key"), F.lit(column).alias("column_name"),
                    *[v.alias(n) for n, v in _cell_flags(0).items()], F.col("repeated").alias("repeated_key"))


def _summed_flags(a: DataFrame, b: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Flags summed over all pairs of rows, from counts per key and per key and value; the pairs are never made.

    One aggregation by grouping sets, which combines rows before its only shuffle, so a key may hold any number of them.
    """
    others = [i for i, c in enumerate(columns) if c != key]  # the key itself is equal in every pair
    sets = [["k", "lone"], *[["k", "lone", f"c{i}"] for i in others]]
    nulls = [F.sum(F.when(F.col(f"c{i}").isNull(), F.col(f"in_{s}")).otherwise(0)).alias(f"{s}{i}") for i in range(len(columns)) for s in "ab"]
    values = [f"c{i}" for i in others]
    cells = _tagged(a, b, key, columns).groupingSets([[F.col(c) for c in x] for x in sets], "k", "lone", *values).agg(
        F.sum("in_a").alias("a"), F.sum("in_b").alias("b"), *nulls, *[F.grouping(c).alias(f"no_{c}") for c in values])
    a_, b_, whole = F.col("a"), F.col("b"), reduce(lambda x, y: x & y, [F.col(f"no_{c}") == 1 for c in values], F.lit(True))

    def total(value, where):
        return F.sum(F.when(where, value).otherwise(0))

    sums = []
    for i, c in enumerate(columns):
        same = total(a_ * b_, whole if i not in others else F.col(f"no_c{i}") == 0)
        sums.append(F.struct(
            F.lit(c.upper()).alias("column_name"), same.alias("perfect_match"),
            total(F.col(f"a{i}") * F.greatest(b_, F.lit(1)), whole).alias("null_in_a"),
            total(F.col(f"b{i}") * F.greatest(a_, F.lit(1)), whole).alias("null_in_b"),
            total(b_, whole & (a_ == 0)).alias("missing_from_a"), total(a_, whole & (b_ == 0)).alias("missing_from_b"),
            (total(a_ * b_, whole) - same).alias("conflicting_values"),
            F.count(F.when(whole & F.col("k").isNotNull() & (F.greatest(a_, b_) > 1), 1)).alias("repeated_keys")).alias(f"__{c}"))
    one = cells.agg(*sums)
    return one.select(F.inline(F.array(*[F.col(f"__{c}") for c in columns]))).orderBy("column_name")


def compare_all_columns(a: DataFrame, b: DataFrame, key: str, exclude_columns=(), summarize: bool = True) -> DataFrame:
    """Flags of all columns over every pair of rows; summed per column (with the number of repeated keys) or one row per pair and column."""
    cols = filtered_columns(a, exclude_columns)
    if summarize:
        return _summed_flags(a, b, key, cols)
    j = paired_rows(a, b, key, cols)
    cells = F.array(*[F.struct(F.lit(c.upper()).alias("column_name"), *[v.alias(n) for n, v in _cell_flags(i).items()],
                               F.col("repeated").alias("repeated_key")) for i, c in enumerate(cols)])
    return j.select(F.col("k").alias("primary_key"), F.inline(cells))


def compare_presence(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row per key of either table: ``k``, ``in_both``, ``only_a``, ``only_b``; one aggregation, no join."""
    j = keyed_sides(a, b, key, [])
    in_a, in_b = F.col("n_a") > 0, F.col("n_b") > 0
    return j.select("k", (in_a & in_b).alias("in_both"), (in_a & ~in_b).alias("only_a"), (~in_a & in_b).alias("only_b"))


def compare_schema(a: DataFrame, b: DataFrame) -> DataFrame:
    """Columns of both tables by name, with position and type match."""
    spark = a.sparkSession

    def cols(df, p):
        rows = [(f.name, i, f.dataType.simpleString()) for i, f in enumerate(df.schema, 1)]
        return spark.createDataFrame(rows, f"column_name string, {p}_ordinal_position int, {p}_data_type string")

    j = cols(a, "a").join(cols(b, "b"), "column_name", "full_outer")
    return j.select(
        "column_name", "a_ordinal_position", "b_ordinal_position", "a_data_type", "b_data_type",
        F.coalesce(F.expr("a_ordinal_position = b_ordinal_position"), F.lit(False)).alias("has_ordinal_position_match"),
        F.coalesce(F.expr("a_data_type = b_data_type"), F.lit(False)).alias("has_data_type_match"),
    ).orderBy(F.coalesce("a_ordinal_position", "b_ordinal_position"))
