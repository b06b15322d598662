"""Frequent phrases and how firmly their words belong together (Misra-Gries summaries, then exact counts).

1. Buckets of documents count their phrases under 48-bit fingerprints, exactly, as sorted arrays cut by
   fingerprint range.  Per range one group merges these into a Misra-Gries summary whose capacity
   exceeds the range's mass divided by the threshold: after every merge all counters sink by the one
   that does not fit any more, so a phrase that reaches the threshold keeps a counter, whatever the order.
   Counter plus all that sank is an upper bound; fingerprints below the threshold go.
2. Buckets learn which of their fingerprints survive and count those phrases by their words; sums
   over all buckets are exact, and a phrase that came only by a collision falls below the threshold.

A summary takes memory for mass / threshold counters and ranges follow the corpus, so no group grows with it; a
phrase that a third of all documents hold is one entry a bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltworks.config import keep, shared_dir
from siltworks.llm import dealing
from siltworks.llm.words import LOWER, U64, Words, grams, hash_word, mix

LEAST = 30
LONGEST = 4
TOP = 2000
BUCKET_BYTES = 4 << 20
#: Phrases in a range, about.
RANGE_MASS = 4 << 20
#: Counters a summary has, as a multiple of mass / threshold.
ROOM = 4
SPARE_BITS = 16
NO_LANG = "und"
SPELLED = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("a", pa.int64())])

BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?"]] = True
BREAK[0x0A:0x0E] = True
#: Bytes of words: no blank, tab or break.
INSIDE = ~BREAK
INSIDE[[0x20, 0x09]] = False


class Phrases:
    """Words of a bucket and, per length, where phrases begin and their hashes (which also depend on the language)."""

    def __init__(self, table: pa.Table):
        self.words = Words(table["text"], INSIDE, LOWER)
        langs = table["lang"].combine_chunks().dictionary_encode()
        if isinstance(langs, pa.ChunkedArray):
            langs = langs.combine_chunks()
        self.langs = langs.dictionary.to_pylist()
        of_text = langs.indices.to_numpy(zero_copy_only=False)
        self.lang = of_text[self.words.text_of()] if len(of_text) else np.zeros(0, np.int64)
        self.salt = np.array([hash_word(x) for x in self.langs] or [0], U64)
        breaks = np.zeros(len(self.words.data) + 1, np.int32)
        np.cumsum(BREAK[self.words.data], out=breaks[1:])
        self.piece = breaks[self.words.begin]
        self.text = self.words.text_of()

    def of(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every phrase of ``length`` words inside one piece."""
        hashes = grams(self.words.hashes, length)
        n = len(hashes)
        if not n:
            return np.zeros(0, np.int64), hashes
        last = length - 1
        inside = (self.piece[:n] == self.piece[last:last + n]) & (self.text[:n] == self.text[last:last + n])
        begin = np.flatnonzero(inside)
        return begin, mix(hashes[begin] + self.salt[self.lang[begin]] + U64(length))

    def spelled(self, begin: np.ndarray, length: int) -> pa.Array:
        """The phrases of ``length`` words from the given words on, joined by blanks, A-Z in lower case."""
        words = self.words
        at = (begin[:, None] + np.arange(length)).ravel()
        size = words.end[at] - words.begin[at] + (np.arange(len(at)) % length < length - 1)  # with the blank behind it
        ends = np.cumsum(size)
        taken = np.repeat(words.begin[at] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)
        data = LOWER[words.data[taken]]
        blanks = np.delete(ends, np.s_[length - 1::length]) - 1
        data[blanks] = 0x20
        offsets = np.concatenate([[0], ends[length - 1::length]]).astype(np.int32)
        return pa.StringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(data))


class Summary:
    """Misra-Gries counters under sorted keys, mergeable; ``sunk`` bounds what any key has lost."""

    def __init__(self, capacity: int):
        self.capacity, self.sunk = capacity, 0
        self.keys, self.counts = np.zeros(0, U64), np.zeros(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        every = np.concatenate([self.keys, keys])
        self.keys, back = np.unique(every, return_inverse=True)
        # doubles hold these sums exactly below 2 ** 53
        self.counts = np.bincount(back, np.concatenate([self.counts, counts]), len(self.keys)).astype(np.int64)
        if len(self.keys) > self.capacity:
            place = len(self.counts) - self.capacity - 1
            least = int(np.partition(self.counts, place)[place])
            self.sunk += least
            held = self.counts > least
            self.keys, self.counts = self.keys[held], self.counts[held] - least

    def at_least(self, threshold: int) -> np.ndarray:
        """Every key whose count may reach the threshold."""
        return self.keys[self.counts + self.sunk >= threshold]


def _squeeze_counts(counts: np.ndarray) -> bytes:
    return counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unsqueeze_counts(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _dealt(docs: DataFrame, text: str, lang: str, bucket_bytes: int) -> tuple[DataFrame, int]:
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(body))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    # by the row's place in its files: rows equal in every column go to different buckets
    return docs.select(F.pmod(dealing.place(), F.lit(buckets)).cast("int").alias("bucket"), body.alias("text"),
                       F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(NO_LANG)).alias("lang")), total


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST,
                  bucket_bytes: int = BUCKET_BYTES, range_mass: int = RANGE_MASS, room: int = ROOM) -> DataFrame:
    """Columns ``lang``, ``size`` (words), ``phrase`` and ``a``: phrases of up to ``longest`` words with a count of at least
    ``least`` per language; the row of size 0 and phrase '' counts all words of the language."""
    dealt, total = _dealt(docs, text, lang, bucket_bytes)
    # a phrase of each length begins at a word, a word takes some five bytes
    ranges = max(dealing.key_ranges(docs), 1 << (max(1, longest * total // 5 // range_mass) - 1).bit_length())

    def name(table: pa.Table) -> pa.Table:
        phrases, found = Phrases(table), []
        for n in range(1, longest + 1):
            found.append(np.unique(phrases.of(n)[1] >> U64(SPARE_BITS), return_counts=True))
        keys = np.concatenate([k for k, _ in found])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], np.concatenate([c for _, c in found])[order]
        parts = list(dealing.cut(keys << U64(SPARE_BITS), ranges))
        return pa.table({"part": pa.array([p for p, _ in parts], pa.int32()),
                         "bucket": pa.array([table["bucket"][0].as_py()] * len(parts), pa.int32()),
                         "mass": pa.array([int(counts[s].sum()) for _, s in parts], pa.int64()),
                         "keys": pa.array([dealing.squeeze(keys[s]) for _, s in parts], pa.binary()),
                         "counts": pa.array([_squeeze_counts(counts[s]) for _, s in parts], pa.binary())})

    def survive(table: pa.Table) -> pa.Table:
        mass = sum(table["mass"].to_pylist())
        summary = Summary(room * (mass // least) + 1)
        held, size = [], 0

        def merge():
            summary.merge(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
            held.clear()

        for keys, counts in zip(table["keys"], table["counts"]):
            held.append((dealing.unsqueeze(keys.as_py()), _unsqueeze_counts(counts.as_py())))
            size += len(held[-1][0])
            if size > max(1 << 18, summary.capacity):
                merge()
                size = 0
        if held:
            merge()
        kept = summary.at_least(least)
        answers = [dealing.squeeze(k[dealing.member(k, kept)]) for k in (dealing.unsqueeze(x.as_py()) for x in table["keys"])]
        return pa.table({"bucket": table["bucket"], "keys": pa.array(answers, pa.binary())})

    def spell(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if len(left):
            phrases = Phrases(left)
            langs = pa.array(phrases.langs, pa.string())
            known = [dealing.unsqueeze(k) for k in right["keys"].to_pylist()] if len(right) else []
            known = np.sort(np.concatenate(known)) if known else np.zeros(0, U64)
            no, n = np.unique(phrases.lang, return_counts=True)
            found.append((langs.take(pa.array(no)), 0, pa.array([""] * len(no), pa.string()), n))
            for size in range(1, longest + 1):
                begin, hashes = phrases.of(size)
                kept = dealing.member(hashes >> U64(SPARE_BITS), known)
                begin = begin[kept]
                _, at, n = np.unique(hashes[kept], return_index=True, return_counts=True)
                begin = begin[at]
                found.append((langs.take(pa.array(phrases.lang[begin])), size, phrases.spelled(begin, size), n))
        tables = [pa.table({"lang": a, "size": pa.array(np.full(len(a), k, np.int32)), "phrase": p, "a": pa.array(n.astype(np.int64))})
                  for a, k, p, n in found]
        return pa.concat_tables(tables) if tables else SPELLED.empty_table()

    named = dealt.groupBy("bucket").applyInArrow(name, "part int, bucket int, mass bigint, keys binary, counts binary")
    survivors = named.groupBy("part").applyInArrow(survive, "bucket int, keys binary")
    spelled = dealt.groupBy("bucket").cogroup(survivors.groupBy("bucket")).applyInArrow(spell, "lang string, size int, phrase string, a bigint")
    return spelled.groupBy("lang", "size", "phrase").agg(F.sum("a").alias("a")).where((F.col("a") >= least) | (F.col("size") == 0))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP,
                 **sizes) -> DataFrame:
    """Each language's ``top`` phrases: ``lang``, ``rank`` (from 1), ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    A phrase of 2 to ``longest`` words with a >= ``least`` occurrences is cut in two; score is floor(2000000 a / (l + r)),
    the least of all cuts (the first of equal ones).  A phrase inside a longer one with at least 80 % of its occurrences goes.
    A null language is ``und``; null and empty texts have no words; repeated rows count each.  Phrases do not
    cross ``. , ; : ! ?`` or line breaks.  Order: score, a (both falling), phrase (by bytes).
    ``docs`` has to be read from files, or written: buckets go by a row's place there.
    """
    folder = shared_dir(docs.sparkSession)
    counted = keep(phrase_counts(docs, text, lang, least, longest, **sizes), f"{folder}/phrases")
    phrases = counted.where("size >= 2").withColumn("w", F.split("phrase", " "))

    def run(begin, n):
        return F.array_join(F.slice("w", begin, n), " ")

    wide = lambda c: F.col(c).cast("decimal(20,0)")  # noqa: E731  products of counts may pass 64 bits
    cuts = phrases.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "cut", run(F.lit(1), F.col("cut")).alias("head"),
                       run(F.col("cut") + 1, F.col("size") - F.col("cut")).alias("tail"))
    parts = counted.where("size >= 1")
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l")), ["lang", "head"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r")), ["lang", "tail"])
    cuts = cuts.withColumn("wide_a", wide("a")).withColumn("wide_lr", wide("l") + wide("r"))
    cuts = cuts.withColumn("score", F.expr("(2000000 * wide_a) div wide_lr"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))

    inner = phrases.where("size >= 3").withColumn("size_in", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    inner = inner.withColumn("begin", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("size_in") + 1)))
    inner = inner.groupBy("lang", run(F.col("begin"), F.col("size_in")).alias("phrase")).agg(F.max("a").alias("longer"))
    scored = scored.join(inner, ["lang", "phrase"], "left")
    scored = scored.where(F.col("longer").isNull() | (100 * wide("longer") < 80 * wide("a")))

    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase"))
    ranked = scored.withColumn("rank", place).where(F.col("rank") <= top)
    words = counted.where("size = 0").select("lang", F.col("a").alias("n"))
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "best.l", "best.r", "n", "best.score")
