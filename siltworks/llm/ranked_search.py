"""The k best texts for each of a set of queries (term at a time, a limited number of accumulators).

Scores are sums over a query's terms of weight * impact, both integers.  One scan counts the texts that hold
each query term.  A second scan goes over blocks of texts: a block keeps postings of query terms only and
works each query term at a time, rarest first.  A text gets an accumulator when it first meets a term; once
all terms that are left together cannot lift a new text over the kth partial score, no accumulators
are made any more and the survivors alone are brought to their exact score.  Each block
gives at most k rows a query, and a rank limit before the shuffle cuts them again.

Queries are shipped to the tasks in slices below ``query_bytes``; each slice is a scan of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltworks.llm.words import LOWER, Words

TOP = 10
BLOCK_BYTES = 8 << 20
QUERY_BYTES = 8 << 20
# Fixed values of the score.
WEIGHT_SCALE, IMPACT_SCALE, TERM_SCALE, LENGTH_SCALE, LENGTH_SHARE = 1000, 1_000_000_000, 1000, 8, 75
#: Digits, Latin letters and everything beyond ASCII.
TERM = np.zeros(256, bool)
TERM[0x30:0x3A] = TERM[0x61:0x7B] = TERM[0x80:] = True


def in_blocks(batches, size: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """Columns ``id`` and ``text`` in runs of about ``size`` bytes of text; a longer text is a run of its own."""
    held, have = [], 0
    for batch in batches:
        length = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, lo = np.cumsum(length), 0
        while lo < len(length):
            before = int(ends[lo - 1]) if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, before + size - have, "right")))
            held.append(batch.slice(lo, hi - lo))
            have += int(ends[hi - 1]) - before
            lo = hi
            if have >= size or lo < len(length):
                yield pa.Table.from_batches(held)
                held, have = [], 0
    if held:
        yield pa.Table.from_batches(held)


class Queries:
    """Terms of a slice of queries: ``vocabulary`` (sorted hashes) and per query its terms with their repeats."""

    def __init__(self, texts: list[str | None]):
        words = Words(pa.array(texts, pa.string()), TERM, LOWER)
        self.vocabulary, back = np.unique(words.hashes, return_inverse=True)
        self.terms = [np.unique(back[a:b], return_counts=True) for a, b in zip(words.first[:-1], words.first[1:])]


def postings(texts, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Term, text and number of occurrences, by term and text; and the number of terms of each text."""
    words = Words(texts, TERM, LOWER)
    n = max(1, len(words.first) - 1)
    if not len(vocabulary):
        none = np.zeros(0, np.int64)
        return none, none, none, words.counts
    at = np.searchsorted(vocabulary, words.hashes)
    at[at == len(vocabulary)] = 0
    known = vocabulary[at] == words.hashes
    pairs, tf = np.unique(at[known] * n + words.text_of()[known], return_counts=True)
    return pairs // n, pairs % n, tf.astype(np.int64), words.counts


def weight(df: int, n_docs: int) -> int:
    return math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


def damping(n_terms: np.ndarray, n_docs: int, all_terms: int) -> np.ndarray:
    """m of each text; in Python's integers, since the product may pass 64 bits."""
    sizes, back = np.unique(n_terms, return_inverse=True)
    m = [100 - LENGTH_SHARE + (LENGTH_SHARE * int(n) * n_docs) // max(1, all_terms) for n in sizes]
    return np.array(m, np.int64)[back] if len(m) else np.zeros(0, np.int64)


def best_texts(lists: list[tuple[np.ndarray, np.ndarray]], bounds: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places and scores of the k best texts (ties to the smaller id).

    ``lists``: per term, rarest first, the texts that hold it (rising) and what each gets; ``bounds``: the most
    that terms from here on can add.
    """
    scores = np.zeros(len(ids), np.int64)
    survivors = None
    for i, (texts, gains) in enumerate(lists):
        if survivors is None and i:
            made = np.flatnonzero(scores)
            if len(made) >= k:
                kth = np.partition(scores[made], len(made) - k)[len(made) - k]
                if bounds[i] < kth:  # at a tie a new text could still win by its id
                    survivors = made[scores[made] + bounds[i] >= kth]
        if survivors is None:
            scores[texts] += gains
        elif len(texts):
            at = np.searchsorted(texts, survivors)
            at[at == len(texts)] = 0
            same = texts[at] == survivors
            scores[survivors[same]] += gains[at[same]]
    found = np.flatnonzero(scores > 0) if survivors is None else survivors
    if len(found) > k:
        kth = np.partition(scores[found], len(found) - k)[len(found) - k]
        found = found[scores[found] >= kth]
    found = found[np.lexsort((ids[found], -scores[found]))[:k]]
    return found, scores[found]


def search(docs: DataFrame, queries: DataFrame, k: int = TOP, key: str = "doc_id", text: str = "text", query_key: str = "item_id",
           query_text: str = "text", block_bytes: int = BLOCK_BYTES, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """Columns ``query`` (the query's key), ``rank`` (from 1), ``id`` and ``score``: each query's k best texts with a score above 0.

    Terms are runs of digits, Latin letters (A-Z in lower case) and characters beyond ASCII; null and empty texts have none and
    are no result of any query.  Every row of ``docs`` is a candidate: rows that repeat an id or a text each
    take a rank; a null id comes before others at a tie.  Every row of ``queries`` is a query; one without
    terms has no result.  Empty tables give an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(-(1 << 63))).alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    asked = queries.select(F.col(f"`{query_key}`").alias("query"), F.col(f"`{query_text}`").cast("string").alias("text"))
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(1, -(-total // query_bytes))
    dealt = asked.withColumn("slice", F.pmod(F.xxhash64("query", "text"), F.lit(slices)))
    out = None
    for s in range(slices):
        found = _search_slice(spark, rows, dealt.where(F.col("slice") == s).drop("slice"), k, block_bytes)
        out = found if out is None else out.unionAll(found)
    return out


def _search_slice(spark, rows: DataFrame, asked: DataFrame, k: int, block_bytes: int) -> DataFrame:
    mine = asked.collect()  # below query_bytes
    ready = Queries([r["text"] for r in mine])
    names = spark.createDataFrame([(i, r["query"]) for i, r in enumerate(mine)],
                                  f"no int, query {asked.schema['query'].dataType.simpleString()}")
    vocabulary = ready.vocabulary

    def count(batches):
        df, n_docs, n_terms = np.zeros(len(vocabulary), np.int64), 0, 0
        for block in in_blocks(batches, block_bytes):
            terms, _, _, sizes = postings(block["text"], vocabulary)
            df += np.bincount(terms, minlength=len(vocabulary))
            n_docs += int((sizes > 0).sum())
            n_terms += int(sizes.sum())
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"term": np.concatenate([[-2, -1], seen]), "n": np.concatenate([[n_docs, n_terms], df[seen]])})

    # one row per term of the slice reaches the driver
    counted = {r["term"]: r["n"] for r in rows.mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    n_docs, all_terms = counted.get(-2, 0), counted.get(-1, 0)
    df = np.array([counted.get(t, 0) for t in range(len(vocabulary))], np.int64)
    weights = np.array([weight(int(x), n_docs) for x in df], np.int64)
    plans = []
    for terms, repeats in ready.terms:
        terms_, repeats_ = terms[df[terms] > 0], repeats[df[terms] > 0]
        order = np.argsort(df[terms_], kind="stable")  # rarest first
        plans.append((terms_[order], repeats_[order] * weights[terms_[order]]))

    def rank(batches):
        for block in in_blocks(batches, block_bytes):
            ids = block["id"].to_numpy()
            term, doc, tf, sizes = postings(block["text"], vocabulary)
            impact = (IMPACT_SCALE * tf) // (TERM_SCALE * tf + LENGTH_SCALE * damping(sizes, n_docs, all_terms)[doc])
            at = np.searchsorted(term, np.arange(len(vocabulary) + 1))
            most = np.zeros(len(vocabulary), np.int64)
            held = np.flatnonzero(np.diff(at))
            if len(held):
                most[held] = np.maximum.reduceat(impact, at[held])
            out = [[], [], []]
            for no, (terms, share) in enumerate(plans):
                bounds = np.cumsum((share * most[terms])[::-1])[::-1]
                found, scores = best_texts([(doc[at[t]:at[t + 1]], w * impact[at[t]:at[t + 1]]) for t, w in zip(terms, share)], bounds, ids, k)
                out[0].append(np.full(len(found), no))
                out[1].append(ids[found])
                out[2].append(scores)
            if out[0]:
                yield pa.RecordBatch.from_pydict({"no": np.concatenate(out[0]).astype(np.int32), "id": np.concatenate(out[1]),
                                                  "score": np.concatenate(out[2])})

    found = rows.mapInArrow(rank, "no int, id bigint, score bigint")
    place = F.row_number().over(Window.partitionBy("no").orderBy(F.desc("score"), "id"))
    found = found.withColumn("rank", place).where(F.col("rank") <= k).join(F.broadcast(names), "no")  # names: the slice's queries
    return found.select("query", F.col("rank").cast("int").alias("rank"), F.nullif("id", F.lit(-(1 << 63))).alias("id"), "score")
