"""Documents dealt over buckets, and keys that buckets exchange.

Fingerprints of a large corpus do not fit a shuffle row by row.  Here each bucket of documents (some
megabytes of text) names every key once, as sorted arrays cut by key range; one group per range sees
which buckets share a key and answers those buckets.  A key that a third of all documents hold comes
once per bucket, so no task gets more than one entry per key and bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS_PER_PARTITION = 8
#: Stands for a null id: before all others.
NO_ID = -(1 << 63)


def place() -> Column:
    """Mixed number of a row's place in its files."""
    return F.xxhash64(F.monotonically_increasing_id())


def deal(docs: DataFrame, key: str, text: str, keep: bool = False, per_partition: int = BUCKETS_PER_PARTITION) -> DataFrame:
    """Columns ``bucket``, ``id``, ``text`` and, with ``keep``, the whole row as ``row``.

    The number of buckets follows the number of input partitions, so a bucket stays at a fixed share
    of ``spark.sql.files.maxPartitionBytes``.  Rows go by their place in the input, so rows equal in
    every column do not meet in one bucket; ``docs`` has to be read from files (or written before),
    where a task that runs again sees the same rows in the same order.
    """
    n = per_partition * max(1, docs.rdd.getNumPartitions())
    source = F.col(f"`{key}`"), F.col(f"`{text}`")
    cols = [F.pmod(place(), F.lit(n)).cast("int").alias("bucket"),
            source[0].cast("long").alias("id"), source[1].cast("string").alias("text")]
    if keep:
        cols.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return docs.select(*cols)


def deal_by_bytes(docs: DataFrame, key: str, text: str, bucket_bytes: int, more: dict | None = None) -> DataFrame:
    """Columns ``bucket``, ``id``, ``text`` and ``more``, with about ``bucket_bytes`` of text in a bucket; rows go by place as in ``deal``."""
    source = F.col(f"`{key}`"), F.col(f"`{text}`")
    total = docs.agg(F.sum(F.octet_length(source[1].cast("string")))).first()[0] or 0
    n = max(1, -(-total // bucket_bytes))
    return docs.select(F.pmod(place(), F.lit(n)).cast("int").alias("bucket"), source[0].cast("long").alias("id"),
                       source[1].cast("string").alias("text"), *[c.alias(k) for k, c in (more or {}).items()])


def key_ranges(df: DataFrame) -> int:
    """A power of two, at least twice the number of shuffle partitions."""
    return 1 << (2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()


def cut(keys: np.ndarray, ranges: int) -> Iterator[tuple[int, slice]]:
    """Slices of sorted unsigned keys by their leading bits; empty ranges are left out."""
    part = (keys >> np.uint64(65 - ranges.bit_length())).astype(np.int64) if ranges > 1 else np.zeros(len(keys), np.int64)
    at = np.flatnonzero(np.diff(part, prepend=-1))
    for i, lo in enumerate(at):
        yield int(part[lo]), slice(int(lo), int(at[i + 1]) if i + 1 < len(at) else len(keys))


def squeeze(ranked: np.ndarray) -> bytes:
    """Rising unsigned keys as the byte planes of their gaps: the high planes are zeros, which compress."""
    gaps = np.diff(ranked, prepend=np.uint64(0))
    return gaps.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unsqueeze(planes: bytes) -> np.ndarray:
    gaps = np.frombuffer(planes, np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(gaps).view("<u8").ravel(), dtype=np.uint64)


def lists(parts: list[np.ndarray], kind) -> pa.Array:
    """A list column of the given arrays."""
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0)
    if kind == pa.int64() and flat.dtype == np.uint64:
        flat = flat.view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(kind.to_pandas_dtype(), copy=False), kind))


def flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the length of each list."""
    if len(column) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    column = pa.concat_arrays(column.chunks)
    sizes = np.diff(column.offsets.to_numpy(zero_copy_only=False))
    return column.flatten().to_numpy(zero_copy_only=False), sizes


def shared_keys(named: DataFrame) -> DataFrame:
    """Answer each bucket with its keys that come more than once.

    ``named``: part int, bucket int, keys array<bigint> (unsigned, each once per bucket), again
    array<tinyint> (1: comes more than once in this bucket).  Result: bucket int, keys array<bigint>.
    """
    def answer(table: pa.Table) -> pa.Table:
        keys, sizes = flat(table["keys"])
        again, _ = flat(table["again"])
        bucket = np.repeat(table["bucket"].to_numpy(), sizes)
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        same = ranked[1:] == ranked[:-1]
        more = np.zeros(len(keys), bool)
        more[order[1:][same]] = True
        more[order[:-1][same]] = True
        more |= again > 0
        back = np.flatnonzero(more)
        back = back[np.argsort(bucket[back], kind="stable")]
        return by_bucket(bucket[back], {"keys": (keys[back], pa.int64())})

    return named.groupBy("part").applyInArrow(answer, "bucket int, keys array<bigint>")


def by_bucket(bucket: np.ndarray, columns: dict) -> pa.Table:
    """One row per bucket (already in bucket order) with list columns."""
    at = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = [*at[1:], len(bucket)]
    out = {"bucket": pa.array(bucket[at].astype(np.int32), pa.int32())}
    for name, (values, kind) in columns.items():
        out[name] = lists([values[a:b] for a, b in zip(at, ends)], kind)
    return pa.table(out)


def member(values: np.ndarray, ranked: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(ranked):
        return np.zeros(len(values), bool)
    at = np.searchsorted(ranked, values)
    at[at == len(ranked)] = 0
    return ranked[at] == values
