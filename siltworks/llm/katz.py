"""Katz backoff over word n-grams of a given order, down to unigrams and one unknown word.

Counts are Good-Turing discounted up to a count of five.  A context gives what its discounts leave to
the words it was never followed by, in proportion to their lower-order probability, by a weight that
makes its probabilities sum to one exactly.  A context with a count over five, whose followers may all
be undiscounted, also reserves one count, so every word has a probability above zero.  A token that its
longest context was never followed by is asked for again in the context one word shorter, and so on; the
weights of all contexts left behind multiply.  A context that training never saw has weight one.

Texts are dealt into buckets.  Each bucket names every distinct n-gram once with its training count;
one group per key range adds the counts up and answers the buckets that share a key (an n-gram that one
bucket alone has needs no answer), which makes the partitioned count tables.  The first bucket that has
an n-gram adds it to its context's sums (what follows a context was also seen after the shorter one, so
its lower-order probability needs no weight); one group per key range turns the sums into backoff weights
and applies them to the tokens that wait for them, all orders in one pass.  No table is collected: only the counts of counts are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.config import keep, shared_dir
from siltworks.llm import dealing
from siltworks.llm.words import GRAM_BASE, LOWER, U64, Words, mix

BUCKET_BYTES = 6_000_000
CUT = 5
#: Longest n-gram; a third order needs more disk than the counts of two (README has the figures).
ORDER = 2
FOLDS = 10
START, END = U64(0x1F83D9ABFB41BD6B), U64(0x5BE0CD19137E2179)
BASE_ADD = 0.1
#: Not a bucket: rows with the counts of counts of a key range.
STATS = 1 << 30


@dataclass(frozen=True)
class Discounts:
    """``total``: tokens, ``types``: distinct ones, ``ratio``: r* / r for counts 0 to CUT, 1 beyond."""

    total: int
    types: int
    ratio: tuple[float, ...]

    def discounted(self, counts: np.ndarray) -> np.ndarray:
        return np.asarray(self.ratio)[np.minimum(counts, CUT + 1)] * counts


def good_turing(of_counts: list[int]) -> tuple[float, ...]:
    """Katz's ratios from n_1 .. n_(CUT+1); where the counts of counts are too few for ratios between
    0 and 1, the absolute discount n_1 / (n_1 + 2 n_2) of every count up to CUT."""
    n = [0, *of_counts]
    if all(n[1:]):
        a = (CUT + 1) * n[CUT + 1] / n[1]
        if a < 1:
            found = [((r + 1) * n[r + 1] / (r * n[r]) - a) / (1 - a) for r in range(1, CUT + 1)]
            if all(0 < d < 1 for d in found):
                return (0.0, *found, 1.0)
    cut = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    return (0.0, *[(r - cut) / r for r in range(1, CUT + 1)], 1.0)


class Tokens:
    """Tokens of a bucket (words, then one end per text), the n-grams that end at each and their contexts.

    One start stands before each text; an n-gram of more words than stand there, start included, is
    none.  ``at[n]``: tokens with an n-gram, ``grams[n]`` and ``contexts[n]``: fingerprints per token.
    """

    def __init__(self, texts: pa.ChunkedArray, order: int):
        words = Words(texts, fold=LOWER)
        n_texts = len(words.first) - 1
        twice = 2 * np.arange(n_texts)
        line = np.empty(len(words) + 2 * n_texts, U64)
        line[np.arange(len(words)) + 2 * words.text_of() + 1] = words.hashes
        begins = words.first[:-1] + twice
        line[begins], line[words.first[1:] + twice + 1] = START, END
        real = np.ones(len(line), bool)
        real[begins] = False
        at = np.flatnonzero(real)
        token, before = line[at], line[at - 1]
        self.counts = words.counts + 1
        self.text = np.repeat(np.arange(n_texts), self.counts)
        ends = np.cumsum(self.counts)
        self.last = ends - 1
        place = np.arange(len(token)) - np.repeat(ends - self.counts, self.counts)
        self.opening = place == 0
        self.grams, self.contexts, self.at = {1: token}, {}, {1: np.arange(len(token))}
        for n in range(2, order + 1):
            self.contexts[n] = before if n == 2 else shifted(self.grams[n - 1])
            self.grams[n] = mix(self.contexts[n] * U64(GRAM_BASE) + token)
            self.at[n] = np.flatnonzero(place >= n - 2)


def shifted(values: np.ndarray) -> np.ndarray:
    """Each token's value of the token before it; the first has 0."""
    return np.concatenate([values[:0], np.zeros(min(1, len(values)), values.dtype), values[:-1]])


def score_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES,
                order: int = ORDER) -> DataFrame:
    """Columns ``id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Learns from texts whose crc32(key as text) mod 10 is not 0 (a null key counts as an empty text, so
    it is held out).  Words are runs without ASCII white space with A-Z in lower case; a null or empty
    text is its end token alone.  Rows that repeat a key are scored, and counted, each on its own.
    Without any training text every score is that of one unknown word: 0.  ``order`` is the longest
    n-gram, 1 or more; a token near the start of a text has fewer words, and one start, before it.
    """
    if order < 1:
        raise ValueError("order must be 1 or more")
    spark = docs.sparkSession
    folder = shared_dir(spark)
    # shuffles of a finished step are not needed again: every step's result is a table
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    try:
        return _score(docs, key, text, bucket_bytes, folder, order)
    finally:
        spark.conf.set(setting, before)


def _score(docs: DataFrame, key: str, text: str, bucket_bytes: int, folder: str, order: int) -> DataFrame:
    ranges = dealing.key_ranges(docs)
    held = F.crc32(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).cast("binary")) % FOLDS == 0
    dealt = dealing.deal_by_bytes(docs, key, text, bucket_bytes, {"held_out": held})

    def name_counts(table: pa.Table) -> pa.Table:
        t = Tokens(table["text"], order)
        weight = (~table["held_out"].to_numpy())[t.text].astype(np.float64)
        rows = {"n": [], "part": [], "keys": [], "counts": []}
        for n, at in t.at.items():
            keys, back = np.unique(t.grams[n][at], return_inverse=True)
            counts = np.bincount(back, weight[at], len(keys)).astype(np.int64)
            for part, s in dealing.cut(keys, ranges):
                for name, value in zip(rows, (n, part, keys[s], counts[s])):
                    rows[name].append(value)
        return pa.table({"n": pa.array(rows["n"], pa.int32()), "part": pa.array(rows["part"], pa.int32()),
                         "bucket": pa.array([table["bucket"][0].as_py()] * len(rows["n"]), pa.int32()),
                         "keys": pa.array([dealing.squeeze(k) for k in rows["keys"]], pa.binary()), "counts": dealing.lists(rows["counts"], pa.int64())})

    def add_up(table: pa.Table) -> pa.Table:
        """Answers in the order of a bucket's keys: 0 where no other bucket has the key, else
        2 * (total + 1), and 1 more for the one bucket that speaks for it."""
        rows = [dealing.unsqueeze(k) for k in table["keys"].to_pylist()]
        keys, sizes = np.concatenate(rows), np.array([len(r) for r in rows])
        counts, _ = dealing.flat(table["counts"])
        bucket = np.repeat(table["bucket"].to_numpy(), sizes)
        order = np.lexsort((bucket, keys))
        new = np.ones(len(keys), bool)
        new[1:] = keys[order][1:] != keys[order][:-1]
        lead = np.flatnonzero(new)
        times = np.diff(np.append(lead, len(keys)))
        total = np.add.reduceat(counts[order], lead)
        of_counts = np.bincount(np.minimum(total, CUT + 2), minlength=CUT + 3)[1:CUT + 2]
        stats = np.append(of_counts, [total.sum(), (total > 0).sum()])
        code = np.empty(len(keys), np.int64)
        code[order] = np.where(np.repeat(times > 1, times), 2 * (np.repeat(total, times) + 1) + new, 0)
        answers = [*np.split(code, np.cumsum(sizes)[:-1]), stats]
        n_rows = len(answers)
        return pa.table({"n": pa.array([table["n"][0].as_py()] * n_rows, pa.int32()),
                         "part": pa.array([table["part"][0].as_py()] * n_rows, pa.int32()),
                         "bucket": pa.array([*table["bucket"].to_pylist(), STATS], pa.int32()),
                         "totals": dealing.lists(answers, pa.int64())})

    counted = dealt.groupBy("bucket").applyInArrow(name_counts, "n int, part int, bucket int, keys binary, counts array<bigint>")
    counted = counted.groupBy("n", "part").applyInArrow(add_up, "n int, part int, bucket int, totals array<bigint>")
    counted.write.partitionBy("n").parquet(f"{folder}/counts")
    counted = dealt.sparkSession.read.schema("part int, bucket int, totals array<bigint>, n int").parquet(f"{folder}/counts")
    sums = counted.where(f"bucket = {STATS}").groupBy("n").agg(
        *[F.sum(F.get("totals", F.lit(i))).alias(f"s{i}") for i in range(CUT + 3)]).collect()
    by_order = {r["n"]: [int(x) for x in r[1:]] for r in sums}
    empty = [0] * (CUT + 3)
    cuts = {n: Discounts(s[CUT + 1], s[CUT + 2], good_turing(s[:CUT + 1]))
            for n, s in ((n, by_order.get(n, empty)) for n in range(1, order + 1))}
    one = cuts[1]
    seen_mass = sum(one.ratio[r] * r * n for r, n in zip(range(1, CUT + 1), by_order.get(1, empty)))
    many = one.total - sum(r * n for r, n in zip(range(1, CUT + 1), by_order.get(1, empty)))
    space = one.total + 1.0  # one count is reserved here too, so an unknown word always has a share
    unknown = 1.0 - (seen_mass + many) / space

    def evaluate(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return _nothing()
        t = Tokens(left["text"], order)
        orders = right["n"].to_numpy() if len(right) else np.zeros(0, int)
        weight = (~left["held_out"].to_numpy())[t.text].astype(np.float64)

        def totals(n: int):
            """Training count of every token's n-gram, and the tokens at which this bucket speaks for one."""
            at = t.at[n]
            keys, first, back = np.unique(t.grams[n][at], return_index=True, return_inverse=True)
            total = np.bincount(back, weight[at], len(keys)).astype(np.int64)
            speaks = np.ones(len(keys), bool)
            where = dict(dealing.cut(keys, ranges))
            mine = right.filter(pa.array(orders == n))
            for part, answer in zip(mine["part"].to_pylist(), mine["totals"]):
                code = answer.values.to_numpy()
                s = where[part]
                total[s] = np.where(code > 0, (code >> 1) - 1, total[s])
                speaks[s] = (code == 0) | (code & 1 > 0)
            count = np.zeros(len(t.text), np.int64)
            count[at] = total[back]
            return count, at[first[speaks & (total > 0)]]

        c1, _ = totals(1)
        p = lower = np.where(c1 > 0, one.discounted(c1) / space, unknown)
        seen, count = np.ones(len(p), np.int64), c1
        names, mass, share, context = [], [], [], {}
        for n in range(2, order + 1):
            # every token but an end has one follower, so the count of a context is that of its own n-gram
            follows = shifted(count)
            follows[t.opening] = c1[t.last] if n == 2 else 0  # as many starts as ends
            count, mine = totals(n)
            direct = cuts[n].discounted(count) / np.maximum(follows + (follows > CUT), 1)
            names.append(t.contexts[n][mine])
            mass.append(cuts[n].discounted(count[mine]))
            share.append(lower[mine])
            seen[count > 0] = n
            p = np.where(count > 0, direct, p)
            lower, context[n] = direct, follows
        n_texts = len(left)
        add = lambda x: np.bincount(t.text, x, n_texts).astype(float)
        base = np.log10((c1 + BASE_ADD) / (one.total + BASE_ADD * (one.types + 1)))

        names, back = np.unique(np.concatenate([np.zeros(0, U64), *names]), return_inverse=True)
        mass = np.bincount(back, np.concatenate([np.zeros(0), *mass]), len(names)).astype(float)
        share = np.bincount(back, np.concatenate([np.zeros(0), *share]), len(names)).astype(float)
        waits = {n: np.flatnonzero((seen < n) & (follows > 0)) for n, follows in context.items()}
        asked = np.concatenate([np.zeros(0, U64), *[t.contexts[n][w] for n, w in waits.items()]])
        doc = np.concatenate([np.zeros(0, np.int64), *[t.text[w] for w in waits.values()]])
        count = np.concatenate([np.zeros(0, np.int64), *[context[n][w] for n, w in waits.items()]])
        waits = np.lexsort((doc, asked))
        asked, doc, count = asked[waits], doc[waits], count[waits]
        new = np.ones(len(waits), bool)
        new[1:] = (asked[1:] != asked[:-1]) | (doc[1:] != doc[:-1])
        lead = np.flatnonzero(new)
        times = np.diff(np.append(lead, len(waits)))
        asked, doc, count = asked[lead], doc[lead], count[lead]
        sums, asks = dict(dealing.cut(names, ranges)), dict(dealing.cut(asked, ranges))
        parts = sorted(sums.keys() | asks.keys())
        none = slice(0, 0)
        n_rows = n_texts + len(parts)
        blank = lambda k, kind: pa.nulls(k, kind)
        texts = {"id": left["id"].combine_chunks(), "held_out": left["held_out"].combine_chunks(),
                 "n_tokens": pa.array(t.counts), "n_known": pa.array(add((c1 > 0).astype(float)).astype(np.int64)),
                 "base_score": pa.array(add(base)), "score": pa.array(add(np.log10(p)))}
        chunk = {name: dealing.lists([v[where.get(i, none)] for i in parts], kind) for name, v, where, kind in (
            ("mass", mass, sums, pa.float64()), ("share", share, sums, pa.float64()),
            ("asked", asked, asks, pa.int64()), ("doc", doc, asks, pa.int64()), ("times", times, asks, pa.int64()),
            ("count", count, asks, pa.int64()))}
        chunk = {"keys": pa.array([dealing.squeeze(names[sums.get(i, none)]) for i in parts], pa.binary()), **chunk}
        out = {"part": pa.concat_arrays([blank(n_texts, pa.int32()), pa.array(parts, pa.int32())]),
               "bucket": pa.array([left["bucket"][0].as_py()] * n_rows, pa.int32()),
               "at": pa.concat_arrays([pa.array(np.arange(n_texts, dtype=np.int64)), blank(len(parts), pa.int64())])}
        for name, a in texts.items():
            out[name] = pa.concat_arrays([a, blank(len(parts), a.type)])
        for name, a in chunk.items():
            out[name] = pa.concat_arrays([blank(n_texts, a.type), a])
        return pa.table(out)

    evaluated = dealt.groupBy("bucket").cogroup(counted.where(f"bucket < {STATS}").groupBy("bucket")).applyInArrow(evaluate, _EVALUATED)
    evaluated = keep(evaluated, f"{folder}/evaluated")

    def weigh(table: pa.Table) -> pa.Table:
        """Backoff weights of the contexts that are asked for, as log10, summed per waiting text."""
        keys = np.concatenate([dealing.unsqueeze(k) for k in table["keys"].to_pylist()])
        names, back = np.unique(keys, return_inverse=True)
        mass = np.bincount(back, dealing.flat(table["mass"])[0], len(names))
        share = np.bincount(back, dealing.flat(table["share"])[0], len(names))
        asked, sizes = dealing.flat(table["asked"])
        count = dealing.flat(table["count"])[0]
        at = np.searchsorted(names, asked.view(U64))
        left = 1.0 - mass[at] / (count + (count > CUT))
        weight = np.log10(left / (1.0 - share[at])) * dealing.flat(table["times"])[0]
        where = np.stack([np.repeat(table["bucket"].to_numpy().astype(np.int64), sizes), dealing.flat(table["doc"])[0]])
        texts, back = np.unique(where, axis=1, return_inverse=True)
        return pa.table({"bucket": pa.array(texts[0].astype(np.int32), pa.int32()), "at": texts[1],
                         "weight": np.bincount(back, weight, texts.shape[1]).astype(float)})

    waited = evaluated.where("part is not null").select("part", "bucket", *_CHUNK).groupBy("part").applyInArrow(
        weigh, "bucket int, at bigint, weight double")
    waited = waited.groupBy("bucket", "at").agg(F.sum("weight").alias("weight"))
    texts = evaluated.where("part is null")
    out = texts.join(waited, ["bucket", "at"], "left")
    return out.select("id", "held_out", "n_tokens", "n_known", F.lit(one.total).cast("bigint").alias("train_tokens"),
                      "base_score", (F.col("score") + F.coalesce("weight", F.lit(0.0))).alias("score"))


_CHUNK = ("keys", "mass", "share", "asked", "doc", "times", "count")
_EVALUATED = ("part int, bucket int, at bigint, id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
              "base_score double, score double, keys binary, mass array<double>, share array<double>, "
              "asked array<bigint>, doc array<bigint>, times array<bigint>, count array<bigint>")


def _nothing() -> pa.Table:
    longs, doubles = pa.list_(pa.int64()), pa.list_(pa.float64())
    kinds = {"part": pa.int32(), "bucket": pa.int32(), "at": pa.int64(), "id": pa.int64(), "held_out": pa.bool_(),
             "n_tokens": pa.int64(), "n_known": pa.int64(), "base_score": pa.float64(), "score": pa.float64(),
             "keys": pa.binary(), "mass": doubles, "share": doubles, "asked": longs, "doc": longs, "times": longs, "count": longs}
    return pa.table({k: pa.array([], v) for k, v in kinds.items()})
