"""Joins that need more than ``DataFrame.join``.

No side is broadcast by hint, but for blocks of ranges and tables whose bytes were counted before: Spark broadcasts a
side whose size it has checked against ``spark.sql.autoBroadcastJoinThreshold``.  The adaptive skew join splits hot
keys of inner joins of two shuffled sides; where it does not (full outer, semi and
anti joins, joins to an aggregate), ``lookup`` finds hot keys with a sketch and spreads them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.operators.windows import row_hash_of, unused

#: Most hot keys that a join spreads; a key beyond them holds less than a share of 1 / HOT_KEYS.
HOT_KEYS = 64
#: Bytes of range blocks that every task may hold, and those of a block beside its range's values.
COPIED_BYTES = 32 << 20
BLOCK_BYTES = 64


def join_on_either(left: DataFrame, right: DataFrame, first: Column, second: Column) -> DataFrame:
    """Inner join on ``first OR second`` without a nested loop.

    Two equi joins; pairs that meet ``first`` are left out of the second one, so
    no pair comes twice and nothing has to be deduplicated.
    """
    by_first = left.join(right, first)
    by_second = left.join(right, second).where(~F.coalesce(first, F.lit(False)))
    return by_first.unionAll(by_second)


def hot_keys(df: DataFrame, keys: list[str], tasks: int, most: int = HOT_KEYS) -> dict[int, int]:
    """Hashes of keys that hold more rows than a task's fair share, with the number of such shares.

    One pass with a frequent-items sketch, which is merged map-side; at most ``most`` keys come back.
    Starts a job.
    """
    key = F.when(reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys]), F.xxhash64(*keys))
    sketch = F.call_function("approx_top_k", F.col("key"), F.lit(most), F.lit(16 * most))
    total, tops = df.select(key.alias("key")).where("key is not null").agg(F.count("*"), sketch).first()
    fair = max(1, -(-total // tasks))
    return {t["item"]: -(-t["count"] // fair) for t in tops or [] if t["count"] > fair}


def bytes_of(df: DataFrame) -> Column:
    """An aggregate: the bytes that the rows take as text, and those of a block beside each."""
    return F.sum(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))) + BLOCK_BYTES)


def copied_if_small(df: DataFrame, copied: int = COPIED_BYTES) -> DataFrame:
    """The table, marked to be copied to all tasks if its rows were counted at ``copied`` bytes or less.  Starts a job."""
    return df.hint("broadcast") if (df.agg(bytes_of(df)).first()[0] or 0) <= copied else df


def lookup(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", tasks: int | None = None) -> DataFrame:
    """Join (inner, left, left_semi or left_anti) to a right side that has one row per key.

    Keys that hold more left rows than one of ``tasks`` (by default the shuffle partitions) should get are
    named by a sketch; their left rows are spread by a row hash over as many tasks as they fill, and
    only their right rows are copied, to at most two a task in all.  All other keys join plainly.  Null
    keys match nothing.  The rows are the same whatever the sketch says.
    """
    tasks = tasks or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(left, keys, tasks)
    if not hot:
        return left.join(right, keys, how)
    salt, = unused(left, "__salt")
    shares = F.create_map(*[F.lit(x) for pair in hot.items() for x in pair])

    def copies(df: DataFrame) -> Column:
        # the same hash on both sides: keys come in under one type
        typed = [F.col(k).cast(left.schema[k].dataType) for k in keys]
        return F.coalesce(F.element_at(shares, F.xxhash64(*typed)), F.lit(1))

    mine = left.withColumn(salt, F.pmod(row_hash_of(left), copies(left)).cast("int"))
    theirs = right.withColumn(salt, F.explode(F.sequence(F.lit(0), copies(right).cast("int") - 1)))
    return mine.join(theirs, [*keys, salt], how).drop(salt)


def spread_days(df: DataFrame, begin: Column, end: Column, day: str) -> DataFrame:
    """One row per day from begin to end, both included; empty where begin is after end or one is null."""
    days = F.when(begin <= end, F.sequence(begin, end))
    return df.withColumn(day, F.explode(days))


def join_days_in_ranges(days: DataFrame, day: str, ranges: DataFrame, begin: str, end: str,
                        how: str = "left") -> DataFrame:
    """Join each day to the ranges it lies in, as an equi join on single days.

    Ranges are cut to the first and last of the days before they are spread, so an
    open-ended range makes no more rows than there are days to meet.
    """
    name, = unused(ranges, "__day")
    first, last = (days.agg(f(F.col(day).cast("date")).alias("d")).scalar() for f in (F.min, F.max))
    lo, hi = F.col(begin).cast("date"), F.col(end).cast("date")
    lo = F.when(lo.isNotNull() & first.isNotNull(), F.greatest(lo, first))
    hi = F.when(hi.isNotNull() & last.isNotNull(), F.least(hi, last))
    spread = spread_days(ranges, lo, hi, name)
    return days.join(spread, days[day] == spread[name], how).drop(name)


def whole_number(df: DataFrame, column: str) -> Column:
    """A date, timestamp or whole number as a bigint in the same order (days, microseconds, the number)."""
    kind = dict(df.dtypes)[column]
    c = F.col(column)
    if kind == "date":
        return F.unix_date(c).cast("bigint")
    if kind == "timestamp_ntz":
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), c)
    if kind == "timestamp":
        return F.unix_micros(c)
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return c.cast("bigint")
    raise ValueError(f"{column} is {kind}; ranges are of dates, timestamps or whole numbers (scale others first)")


def range_blocks(lo: Column, hi: Column, levels: int, bits: int) -> Column:
    """The aligned blocks that make up lo..hi (both included): structs of level and index, each number in one of them.

    A block of level k holds 2 ** (bits * k) numbers.  A level adds less than two times 2 ** bits blocks.
    """
    radix = 1 << bits

    def at(level: int) -> Column:
        begin = _up(lo, bits * level)
        end = F.shiftright(hi + 1, bits * level)
        inner_begin, inner_end = _up(begin, bits) * radix, F.shiftright(end, bits) * radix
        whole = (inner_begin >= inner_end) if level + 1 < levels else F.lit(True)
        none = F.expr("array()").cast("array<bigint>")

        def run(x, y):
            return F.when(x < y, F.sequence(x, y - 1)).otherwise(none)

        indexes = F.when(whole, run(begin, end)).otherwise(F.concat(run(begin, inner_begin), run(inner_end, end)))
        return F.transform(indexes, lambda i: F.struct(F.lit(level).alias("level"), i.alias("index")))

    return F.concat(*[at(k) for k in range(levels)])


def _up(x: Column, bits: int) -> Column:
    """Ceiling of x / 2 ** bits."""
    return -F.shiftright(-x, bits)


def join_points_in_ranges(points: DataFrame, point: str, ranges: DataFrame, begin: str, end: str, how: str = "left",
                          bits: int = 4, copied: int = COPIED_BYTES) -> DataFrame:
    """Join each point to the ranges begin..end (both included) it lies in; ``how`` is inner or left.

    For timestamps and whole numbers of any width: a range becomes aligned blocks (``range_blocks``), a point
    one block per level that ranges use, and both meet in an equi join, so nothing is spread by unit and no pair
    is tried in vain.  Ranges that are open at an end (null) or run backwards hold nothing, null points match
    nothing.  Blocks measured at ``copied`` bytes or less are copied to all tasks, others meet the points over a
    shuffle; points, which Spark takes for as small as they are before the levels multiply them, are never copied.
    Starts two small jobs (the widest range, the levels in use with their blocks and bytes).
    """
    if how not in ("inner", "left"):
        raise ValueError("how is inner or left")
    level, index = unused(points.select(*points.columns, *[F.lit(0).alias(c) for c in ranges.columns if c not in points.columns]), "__level", "__index")
    lo, hi = whole_number(ranges, begin), whole_number(ranges, end)
    known = ranges.where(F.col(begin).isNotNull() & F.col(end).isNotNull() & (lo <= hi))
    widest = known.agg(F.max(hi - lo)).first()[0]
    levels = 1 if widest is None else -(-max(1, int(widest).bit_length()) // bits) + 1
    cut = known.withColumn(level, F.explode(range_blocks(lo, hi, levels, bits)))
    cut = cut.withColumns({index: F.col(f"{level}.index"), level: F.col(f"{level}.level")})
    sizes = {r[0]: r[1] for r in cut.groupBy(level).agg(bytes_of(ranges).alias("size")).collect()}  # at most `levels` rows
    used = sorted(sizes)
    own = whole_number(points, point)
    placed = points.where(F.col(point).isNotNull()).withColumn(level, F.explode(F.array(*[F.lit(k) for k in used]).cast("array<int>")))
    shift = F.lit(None).cast("bigint")
    for k in used:
        shift = F.when(F.col(level) == k, F.shiftright(own, bits * k)).otherwise(shift)
    how_met = "broadcast" if sum(sizes.values()) <= copied else "merge"
    pairs = placed.withColumn(index, shift).join(cut.hint(how_met), [level, index]).drop(level, index)
    if how == "inner":
        return pairs
    met = pairs.select(point).distinct()
    return pairs.unionByName(points.join(met, point, "left_anti"), allowMissingColumns=True)


def not_in(left: DataFrame, key: str, right: DataFrame, right_key: str) -> DataFrame:
    """SQL ``NOT IN``: a null on the right removes every row, a null on the left its own row.

    An anti join plus two right-side counts, so the right side may be of any size.
    """
    n_right = right.agg(F.count("*")).scalar()
    n_null = right.agg(F.count(F.when(F.col(right_key).isNull(), 1))).scalar()
    keep = (n_right == 0) | ((n_null == 0) & F.col(key).isNotNull())
    return left.join(right, left[key] == right[right_key], "left_anti").where(keep)


def full_outer(a: DataFrame, b: DataFrame, keys: list[str], unique: bool = False) -> DataFrame:
    """Full outer join; columns ``a_<name>``, ``b_<name>`` and the flags ``in_a``, ``in_b``.

    Null keys never match.  ``unique`` says that no key repeats on either side, as after an
    aggregation: then one join does it.  Otherwise a key may be hot, and no engine splits a
    full outer join, so matches come from an inner join and the rest from two lookups of keys.
    """
    def side(df: DataFrame, p: str) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{p}_{c}") for c in df.columns])

    left, right = side(a, "a"), side(b, "b")
    on = reduce(lambda x, y: x & y, [left[f"a_{k}"] == right[f"b_{k}"] for k in keys])
    yes, no = F.lit(True), F.lit(False)
    if unique:
        marked = left.withColumn("in_a", yes).join(right.withColumn("in_b", yes), on, "full_outer")
        return marked.withColumns({c: F.coalesce(F.col(c), no) for c in ("in_a", "in_b")}).select(
            *left.columns, *right.columns, "in_a", "in_b")
    matched = left.join(right, on).withColumns({"in_a": yes, "in_b": yes})

    def alone(df, p, other, q):
        known = other.select(*[F.col(f"{q}_{k}").alias(f"{p}_{k}") for k in keys]).distinct()
        return lookup(df, known, [f"{p}_{k}" for k in keys], "left_anti").withColumns(
            {"in_a": F.lit(p == "a"), "in_b": F.lit(p == "b")})

    out = matched.unionByName(alone(left, "a", right, "b"), allowMissingColumns=True)
    return out.unionByName(alone(right, "b", left, "a"), allowMissingColumns=True).select(
        *left.columns, *right.columns, "in_a", "in_b")


def product(a: DataFrame, b: DataFrame, most_rows: int, blocks: tuple[int, int] = (8, 8)) -> DataFrame:
    """Every row of ``a`` with every row of ``b``, on a grid of row blocks.

    Each block of ``a`` meets each block of ``b`` in one task, by an equi join, so a task holds a block of
    either and no side is broadcast.  A product of more than ``most_rows`` rows is refused.  Starts two counts.
    """
    n, m = a.count(), b.count()
    if n * m > most_rows:
        raise ValueError(f"the product has {n * m} rows, more than {most_rows}")
    if twice := {c.lower() for c in a.columns} & {c.lower() for c in b.columns}:
        raise ValueError(f"both sides have {sorted(twice)}")
    x, y = unused(a.limit(0).join(b.limit(0), F.lit(False)), "__x", "__y")
    rows, columns = blocks

    def dealt(df, own, own_blocks, other, other_blocks):
        place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(own_blocks)).cast("int")
        return df.withColumn(own, place).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(other_blocks - 1))))

    return dealt(a, x, rows, y, columns).join(dealt(b, y, columns, x, rows), [x, y]).drop(x, y)


def repeat_over_series(df: DataFrame, count: int, name: str) -> DataFrame:
    """Each row once per number 1..count: the product of a table and a series, without a join."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(1), F.lit(count))))


def with_config(df: DataFrame, **values) -> DataFrame:
    """One-row settings as constant columns."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def keep_entitled(df: DataFrame, entitlements: DataFrame, user: str, key: str) -> DataFrame:
    """Rows whose key the user is entitled to see (``entitlements``: user_name, key)."""
    mine = entitlements.where(F.col("user_name") == user).select(key)
    return df.join(mine, key, "left_semi")
