"""Exact top-k by integer inner product (norm-bucketed retrieval).

Rows are grouped by length into buckets of similar length, longest first.  A bounded number of the
longest rows gives every query a first threshold.  Blocks of queries then meet only the buckets whose
longest row can still beat a threshold of the block.  Inside a meeting each query has a local cosine
threshold, threshold / (query length * longest length): where it is high, candidates are pruned by
the range that it leaves for the query's largest coordinate, else by length; products of the rest are exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltworks.config import keep, shared_dir
from siltworks.llm import dealing

TOP = 5
EVERY = 50
SCALE = 256
BUCKET = 4096
BLOCK = 1024
SEEDS = 1024
COORDINATE_FROM = 0.8
EXACT = 2.0 ** 52


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k greatest scores, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


def _products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Integer products; in doubles where every partial sum is exact in them."""
    size = np.abs(rows).max(initial=0) * np.abs(query).max(initial=0) * max(1, rows.shape[1])
    if size < EXACT:
        return (rows @ query).astype(np.int64)
    return (rows.astype(np.int64) * query.astype(np.int64)).sum(axis=1)


def top_products(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = TOP, every: int = EVERY,
                 scale: int = SCALE, bucket: int = BUCKET, block: int = BLOCK, seeds: int = SEEDS,
                 coordinate_from: float = COORDINATE_FROM) -> DataFrame:
    """Columns ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``: each query's k best rows.

    Components become floor(scale * x).  Queries are rows whose key is divisible by ``every``; every
    other row of the same number of components is a candidate.  Rows with a null key, a null vector or
    a null or non-finite component take no part.  Rows that repeat a key, or a key and its vector, are each a
    query and a candidate of their own, so a ``query_id`` may come with several lists of k.
    """
    spark = vectors.sparkSession
    folder = shared_dir(spark)
    x = F.col(f"`{vector}`").cast("array<double>")
    sound = ~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), x.alias("x")).where(F.col("id").isNotNull() & sound)
    rows = rows.select("id", F.transform("x", lambda v: F.floor(v * scale)).alias("q"))
    rows = rows.withColumn("no", F.monotonically_increasing_id())  # fixed by the write
    rows = rows.withColumn("length", F.sqrt(F.aggregate("q", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))))
    rows = keep(rows, f"{folder}/rows")
    n = rows.count()
    ranged = rows.repartitionByRange(max(1, -(-n // bucket)), F.desc("length"), "no").withColumn("bucket", F.spark_partition_id())
    ranged = keep(ranged, f"{folder}/ranged")
    tops = ranged.groupBy("bucket", F.size("q").alias("dim")).agg(F.max("length").alias("longest"))

    # at most `seeds` rows of a query's own dimension give it a threshold that its result cannot fall below
    longest = rows.orderBy(F.desc("length"), "id", "no").limit(seeds).collect()
    seed: dict[int, tuple] = {}
    for dim in {len(r["q"]) for r in longest}:
        mine = [r for r in longest if len(r["q"]) == dim]
        seed[dim] = (np.array([r["q"] for r in mine], np.float64).reshape(len(mine), dim), np.array([r["no"] for r in mine]))

    def begin(batches):
        for batch in batches:
            least = []
            for no, q in zip(batch["no"].to_pylist(), batch["q"].to_pylist()):
                found, numbers = seed.get(len(q), (None, None))
                scores = _products(found, np.array(q, np.float64))[numbers != no] if found is not None else np.zeros(0)
                least.append(float(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else float("-inf"))
            yield pa.RecordBatch.from_arrays([batch["no"], batch["id"], batch["q"], batch["length"], pa.array(least, pa.float64())],
                                             ["no", "id", "q", "length", "least"])

    queries = rows.where(F.col("id") % every == 0).mapInArrow(begin, "no bigint, id bigint, q array<bigint>, length double, least double")
    blocks = max(1, -(-n // every // block))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("no"), F.lit(blocks)).cast("int")).withColumn("dim", F.size("q"))
    queries = keep(queries, f"{folder}/queries")
    # the length that a row needs for some query of the block: least / length (any, where least is not positive)
    need = F.when(F.col("length") > 0, F.col("least") / F.col("length")).otherwise(F.lit(float("-inf")))
    needs = queries.groupBy("block", "dim").agg(F.min(F.when(F.col("least") <= 0, F.lit(float("-inf"))).otherwise(need)).alias("need"))
    meet = needs.join(tops, "dim").where(F.col("longest") * (1 + 1e-9) >= F.col("need")).select("block", "bucket", "dim")
    meet = keep(meet, f"{folder}/meetings")  # one row per query block and bucket
    left = queries.join(meet, ["block", "dim"])
    right = ranged.withColumn("dim", F.size("q")).join(meet, ["bucket", "dim"])

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if len(a) and len(b):
            dim = a["dim"][0].as_py()
            q = dealing.flat(a["q"])[0].astype(np.float64).reshape(-1, dim)
            p = dealing.flat(b["q"])[0].astype(np.float64).reshape(-1, dim)
            ids, numbers, length = b["id"].to_numpy(), b["no"].to_numpy(), b["length"].to_numpy()
            order = np.argsort(-length, kind="stable")
            p, ids, numbers, length = p[order], ids[order], numbers[order], length[order]
            unit = p / np.maximum(length, 1e-300)[:, None]
            for own, name, vec, size, least in zip(a["no"].to_numpy(), a["id"].to_numpy(), q, a["length"].to_numpy(), a["least"].to_numpy()):
                stop, pick = len(p), None
                if least > 0:  # a row must be long enough, |p| >= least / |q|
                    stop = int(np.searchsorted(-length, -(least / size) * (1 - 1e-9), "right"))
                    local = least / (size * length[0]) if length[0] else 1.0
                    if local >= coordinate_from:
                        f = int(np.abs(vec).argmax())
                        cosine, share = min(1.0, local), vec[f] / size
                        spread = np.sqrt(max(0.0, (1 - cosine * cosine) * (1 - share * share)))
                        pick = np.flatnonzero(np.abs(unit[:stop, f] - share * cosine) <= spread + abs(share) * (1 - cosine) + 1e-9)
                pick = slice(0, stop) if pick is None else pick
                names, scores = ids[pick], _products(p[pick], vec)
                good = np.flatnonzero((numbers[pick] != own) & (scores >= least))
                best = good[_best(scores[good], names[good], k)]
                for column, values in zip(out, (np.full(len(best), own), np.full(len(best), name), names[best], scores[best])):
                    column.append(values)
        joined = [np.concatenate(c).astype(np.int64) if c else np.zeros(0, np.int64) for c in out]
        return pa.table(dict(zip(("no", "query_id", "vec_id", "score"), joined)))

    on = ("block", "bucket", "dim")
    found = left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(search, "no bigint, query_id bigint, vec_id bigint, score bigint")
    # a query meets few buckets, each with k rows at most
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("no").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
