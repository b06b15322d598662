"""Cleaning and packing of the corpus: each stage works on all that the one before kept."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.config import folders_made, keep, remove, shared_dir
from siltworks.llm import jaccard_join, packing, substring_dedup, toxicity
from siltworks.operators.windows import unused

ORACLE_SQL = None  # hashes, learned weights and byte-pair ids are beyond SQL

_scratch: list[str] = []


def stage(fn):
    """What the stage before was made from goes, now that its rows are written; unless ``docs`` still reads it."""
    @wraps(fn)
    def begin(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = docs.inputFiles() if _scratch else []
        for folder in _scratch:
            if not any(folder in f for f in read):
                remove(spark, folder)
        with folders_made() as made:
            out = fn(spark, docs, sf_dir)
        _scratch[:] = made
        return out

    return begin


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity model does not reject, each by its own text; ids may be null or repeat."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    kept = toxicity.score_toxicity(docs, labels, keep=True).where("predicted = 0")
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


@stage
def keep_one_of_a_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that with the smallest id, a null id before all others.

    A row's number is its place in the written rows of the stage before.
    """
    row, = unused(docs, "_row")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    found = jaccard_join.shingle_groups(numbered.select(row, "text"), key=row)
    found = found.where("id <> component").select(F.col("id").alias(row), "component")
    found = keep(found.unionAll(found.select(F.col("component").alias(row), "component").distinct()), f"{shared_dir(spark)}/grouped")
    rank = F.struct(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"), F.col(row).alias("row"))
    best = found.join(numbered.select(row, rank.alias("rank")), row).groupBy("component").agg(F.min("rank").alias("rank"))
    copies = found.select(row).join(best.select(F.col("rank.row").alias(row)), row, "left_anti")
    return numbered.join(copies, row, "left_anti").drop(row)


@stage
def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words that repeat an earlier passage; texts that lose nothing stay as they are."""
    out = substring_dedup.remove_repeated(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row.text"))
    kept = out.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    size = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("row.n_chars"))
    made = {"text": text, "n_chars": size}
    return kept.select(*[made.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


@stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, with their token ids."""
    out = packing.pack(docs.select("doc_id", "text"))
    return out.select(F.col("id").alias("doc_id"), "start", F.expr("octet_length(ids) div 4").cast("bigint").alias("length"),
                      "doc_tokens", "sequence_id", "offset", F.crc32("ids").alias("ids_crc32"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", keep_one_of_a_group),
    ("substring dedup", drop_repeated_passages),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage, from ``documents``; each stage's rows are written to the shared folder and read again."""
    folder = shared_dir(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (_, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = keep(docs, f"{folder}/stage-{i}")
            if i:
                remove(spark, f"{folder}/stage-{i - 1}")
    return docs
