"""Stored tables: full refresh, merge, incremental append, history and layout.

Tables are plain Parquet folders, written with ``DataFrameWriter`` alone.  What a run may replace is a
partition column, so Spark's dynamic partition overwrite rewrites just the partitions a run touches:

- merged tables are partitioned by a hash of the key (``key_of_<n>``, n buckets);
- history tables keep current rows apart from closed ones (``closed_in``: ``current`` or the run that closed them);
- appended tables carry their high-water mark as a whole number, whose greatest value Parquet's statistics tell.

A job writes to a staging folder and moves partitions when all its tasks are done, so a lost executor or a
failed job leaves the table as it was.  A table has one writer at a time; where several write, use
a catalog whose tables have transactions.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.operators.joins import hot_keys, whole_number
from siltworks.operators.windows import first_per_key, next_values, row_hash_of, unused

POLICIES = ("sync_all_columns", "append_new_columns", "fail")
BUCKETS = 64
BUCKET_NAME = re.compile(r"key_of_(\d+)")
MARK = "_mark"
CLOSED_IN, CURRENT = "closed_in", "current"
#: Buckets' fair shares that one key of a bucketed table may hold.
MOST_SHARES = 4
#: Rows of each key that the cuts of a clustered layout are taken from.
LAYOUT_SAMPLE = 10_000


def _technical(name: str) -> bool:
    return name in (MARK, CLOSED_IN) or BUCKET_NAME.fullmatch(name) is not None


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table with its technical columns; None where there is no folder, or one without rows."""
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a stored table, under all columns that any of its files has."""
    found = _stored(spark, path)
    if found is None:
        raise FileNotFoundError(f"no rows in {path}")
    return found.drop(*[c for c in found.columns if _technical(c)])


def _conform(source: DataFrame, target: DataFrame) -> DataFrame:
    """The source under the types of the columns that are stored already."""
    kinds = {f.name: f.dataType for f in target.schema}
    return source.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in source.columns])


def _replace(df: DataFrame, path: str, part: str) -> None:
    """Write rows over the partitions they lie in; the others stay as they are."""
    balanced = df.hint("rebalance", part)  # files of one partition from as many tasks as it fills
    balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)


def refresh(df: DataFrame, path: str) -> DataFrame:
    """Write the whole table anew."""
    df.write.mode("overwrite").parquet(path)
    return read_table(df.sparkSession, path)


def merge_into(path: str, source: DataFrame, keys: list[str], on_schema_change: str = "append_new_columns",
               buckets: int = BUCKETS) -> DataFrame:
    """Replace stored rows whose keys are in the source, add the others; the table afterwards.

    Only partitions that a source key falls into are read and written.  ``buckets`` counts for the first
    write; later ones follow the table.  A policy that drops columns rewrites all partitions.  Null keys match
    nothing, rows of a repeated source key all come in.  Source columns take the types they are stored under.
    """
    spark = source.sparkSession
    target = _stored(spark, path)
    if target is not None:
        named = [m for c in target.columns if (m := BUCKET_NAME.fullmatch(c))]
        if not named:
            raise ValueError(f"{path} is not partitioned by a key")
        buckets = int(named[0][1])
    part = f"key_of_{buckets}"

    def dealt(df: DataFrame) -> DataFrame:
        return df.withColumn(part, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))

    if target is None:
        _replace(dealt(source), path, part)
        return read_table(spark, path)
    rows = target.drop(part)
    source = _conform(source, rows)
    evolve(rows.limit(0), source.limit(0), on_schema_change)  # a change the policy refuses stops here
    if on_schema_change != "sync_all_columns" or not set(rows.columns) - set(source.columns):
        touched = [r[0] for r in dealt(source).select(part).distinct().collect()]  # at most `buckets`
        rows = target.where(F.col(part).isin(touched) if touched else F.lit(False)).drop(part)
    _replace(dealt(merge_rows(rows, source, keys, on_schema_change)), path, part)
    return read_table(spark, path)


def high_water_mark(spark: SparkSession, path: str) -> int | None:
    """Greatest mark of an appended table, from the statistics in the files' footers: no row is read."""
    return marks_plan(spark, path).first()[0]


def marks_plan(spark: SparkSession, path: str) -> DataFrame:
    """The aggregate that ``high_water_mark`` runs; in a session of its own, so that of the caller keeps its settings."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path).agg(F.max(MARK))


def append_newer(path: str, source: DataFrame, ts: str, on_schema_change: str = "append_new_columns") -> DataFrame:
    """Add source rows above the table's high-water mark (all, where it has none); the table afterwards.

    Stored files are neither read nor rewritten, unless the policy drops columns.  Source rows without a time
    come in with the first load only.
    """
    spark = source.sparkSession
    target = _stored(spark, path)
    if target is not None:
        source = _conform(source, target)
    # the first column of every file: Spark looks it up in the footers by its place
    marked = source.select(whole_number(source, ts).alias(MARK), "*")
    if target is None:
        marked.write.parquet(path)
        return read_table(spark, path)
    rows = target.drop(MARK)
    aligned = evolve(rows.limit(0), source.limit(0), on_schema_change)
    mark = high_water_mark(spark, path)
    added = marked if mark is None else marked.where(F.col(MARK) > mark)
    if set(rows.columns) - set(aligned.columns):
        # the stored rows under fewer columns; Spark refuses to overwrite what it reads, so by way of a copy beside the table
        side = f"{path.rstrip('/')}_narrowed"
        target.select(MARK, *[c for c in rows.columns if c in aligned.columns]).write.mode("overwrite").parquet(side)
        spark.read.parquet(side).write.mode("overwrite").parquet(path)
    added.write.mode("append").parquet(path)
    return read_table(spark, path)


def merge_rows(target: DataFrame, source: DataFrame, keys: list[str],
               on_schema_change: str = "append_new_columns") -> DataFrame:
    """Rows after a merge: target rows without a source match, and all source rows.

    Keys are unique in the target, so none is hot there; the source is reduced to its keys first.
    """
    kept = target.join(source.select(*keys).distinct(), keys, "left_anti").select(*target.columns)
    return evolve(kept, source, on_schema_change)


def newer_rows(source: DataFrame, target: DataFrame | None, ts: str) -> DataFrame:
    """Source rows above the target's high-water mark; all of them when it has none."""
    if target is None:
        return source
    mark = target.agg(F.max(ts)).scalar()
    return source.where(mark.isNull() | (F.col(ts) > mark))


def evolve(target: DataFrame, incoming: DataFrame, on_schema_change: str) -> DataFrame:
    """Target rows and incoming rows under the schema the policy asks for."""
    if on_schema_change not in POLICIES:
        raise ValueError(f"on_schema_change is one of {POLICIES}")
    new = [c for c in incoming.columns if c not in target.columns]
    gone = [c for c in target.columns if c not in incoming.columns]
    if on_schema_change == "fail" and (new or gone):
        raise ValueError(f"schema changed: new {new}, gone {gone}")
    if on_schema_change == "sync_all_columns":
        target = target.drop(*gone)
    return target.unionByName(incoming, allowMissingColumns=True)


def write_bucketed(df: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Write a table in ``buckets`` files by the hash of its keys, sorted by them, and list it in the session's catalog as ``name``.

    Two tables in as many buckets of equal keys join without a shuffle or a sort.  A key that holds more than
    a bucket's fair share several times over would make one file of them all, and is refused: such
    rows are better joined with ``joins.lookup``.  Starts a job for that check.
    """
    hot = {k: n for k, n in hot_keys(df, keys, buckets).items() if n > MOST_SHARES}
    if hot:
        raise ValueError(f"{len(hot)} keys of {keys} hold more than {MOST_SHARES} buckets each")
    dealt = df.repartition(buckets, *keys)  # one file a bucket
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def open_bucketed(spark: SparkSession, name: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """List a table that another session wrote with ``write_bucketed``."""
    columns = spark.read.parquet(path).schema.toDDL()
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"create table `{name}` ({columns}) using parquet clustered by ({by}) sorted by ({by}) into {buckets} buckets location '{path}'")
    return spark.table(name)


def _cuts(df: DataFrame, column: str, parts: int, sample: int) -> list:
    """Up to ``parts`` - 1 rising values that cut a sample of the column (rows of the least row hashes) evenly."""
    found = df.select(column).where(F.col(column).isNotNull()).orderBy(F.xxhash64(F.lit(7), F.monotonically_increasing_id())).limit(sample)
    values = sorted(r[0] for r in found.collect())
    return sorted({values[len(values) * i // parts] for i in range(1, parts)}) if values else []


def z_order(df: DataFrame, keys: list[str], bits: int = 4, sample: int = LAYOUT_SAMPLE) -> Column:
    """Interleaved bits of each key's rank among 2 ** ``bits`` shares of its values; rows near in all keys are near in it.

    The shares are cut by a sample of at most ``sample`` values a key, which reach the driver; they steer the
    layout only.
    """
    ranks = []
    for k in keys:
        above = [F.when(F.col(k) >= F.lit(c), 1).otherwise(0) for c in _cuts(df, k, 1 << bits, sample)]
        ranks.append(reduce(lambda x, y: x + y, above, F.lit(0)))
    return reduce(lambda x, y: x.bitwiseOR(y), [
        F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)), bit * len(keys) + i)
        for i, rank in enumerate(ranks) for bit in range(bits)], F.lit(0))


def write_clustered(df: DataFrame, path: str, keys: list[str], partition_by: list[str] | None = None, files: int | None = None,
                    bits: int = 4) -> None:
    """Range-partitioned, sorted files, so file and row-group statistics prune on each of the keys.

    One key is the order itself; several are interleaved (``z_order``), so a filter on any of them skips most files.
    A row hash ends the range key, so rows of one hot key fill several files.  ``files``: by default the shuffle partitions.
    """
    z, = unused(df, "__z")
    order = [F.col(keys[0])] if len(keys) == 1 else [F.col(z)]
    laid = df if len(keys) == 1 else df.withColumn(z, z_order(df, keys, bits))
    count = [files] if files else []
    out = laid.repartitionByRange(*count, *order, row_hash_of(df)).sortWithinPartitions(*order, *keys).drop(z).write.mode("overwrite")
    (out.partitionBy(*partition_by) if partition_by else out).parquet(path)


# --- history -----------------------------------------------------------------------

def history_intervals(df: DataFrame, key: list[str], ts: str, tie: list[str] = (),
                      ranges: int | None = None) -> DataFrame:
    """Valid-from / valid-to of each version; the newest one is current."""
    out = next_values(df.withColumn("effective_date", F.col(ts)), key, [ts, *tie], {"end_date": F.col(ts)}, ranges)
    return out.withColumn("is_current", F.col("end_date").isNull())


def snapshot(stored: DataFrame | None, incoming: DataFrame, key: list[str], updated_at: str) -> DataFrame:
    """Next state of a history table (columns of ``incoming`` plus valid_from, valid_to).

    A stored current row is closed when a newer version of its key comes in; that
    version and unseen keys are opened.  Everything else stays as it is.
    """
    newest = first_per_key(incoming, key, [F.col(updated_at).desc_nulls_last()])
    opened = newest.withColumn("valid_from", F.col(updated_at))
    opened = opened.withColumn("valid_to", F.lit(None).cast(incoming.schema[updated_at].dataType))
    if stored is None:
        return opened
    marks = newest.select(*key, F.col(updated_at).alias("__new"))
    closed = stored.join(marks, key, "left")
    ends_now = F.col("valid_to").isNull() & (F.col("__new") > F.col("valid_from"))
    closed = closed.withColumn("valid_to", F.when(ends_now, F.col("__new")).otherwise(F.col("valid_to")))
    current = stored.where("valid_to is null").select(*key, F.col("valid_from").alias("__old"))
    fresh = opened.join(current, key, "left")
    fresh = fresh.where(F.col("__old").isNull() | (F.col(updated_at) > F.col("__old")))
    return closed.drop("__new").select(*opened.columns).unionByName(fresh.drop("__old").select(*opened.columns))


def snapshot_into(path: str, incoming: DataFrame, key: list[str], updated_at: str, run: str) -> DataFrame:
    """Bring a stored history table to its next state (``snapshot``); the table afterwards.

    Only current rows are read and written again: rows that this run closes go to a partition named by ``run``,
    which no earlier run may have used; what earlier runs closed is not touched.
    """
    spark = incoming.sparkSession
    target = _stored(spark, path)
    if run == CURRENT or (target is not None and not target.where(F.col(CLOSED_IN) == run).isEmpty()):
        raise ValueError(f"run {run!r} is in use")
    current = None if target is None else target.where(F.col(CLOSED_IN) == CURRENT).drop(CLOSED_IN)
    state = snapshot(current, incoming, key, updated_at)
    _replace(state.withColumn(CLOSED_IN, F.when(F.col("valid_to").isNull(), CURRENT).otherwise(run)), path, CLOSED_IN)
    return read_table(spark, path)
