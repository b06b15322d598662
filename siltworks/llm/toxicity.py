"""Toxicity by a weighted lexicon, matched by Aho-Corasick in folded text.

Folding writes letters that look alike as one (other scripts, full width, accents) and reads digits
and signs that stand for letters.  The lexicon holds beginnings of words and whole words that the
labelled sample shows more in toxic texts; an entry's weight is the lower bound of its log odds, so a few
texts are enough, whatever share of the sample their language has.  Entries count where a word begins,
unless they lie in an exception phrase.  The sum of weights, normalised by length, and its share
per word go through a logistic curve fitted on the same sample.
"""

from __future__ import annotations

import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters of other scripts that look like Latin ones, and signs read as letters.
HOMOGLYPHS = dict(zip("авеікмнорсtухѕјԁһӏαβεικνορτυχ", "abeikmhopctyxsjdhlabeiknoptux"))
SIGNS = dict(zip("0134578@$!", "oieastbasi"))
EXCEPTIONS = ("trash can", "clown fish", "class clown", "sore loser award")

SAMPLE = 8000
LEAST_SUPPORT = 3  # toxic texts
DEVIATIONS = 2.0  # of the log odds, to their lower bound
LEAST_ODDS = 0.7  # of the lower bound: about twice as frequent
CLEARLY_BETTER = 0.5
BEGINNINGS = (4, 5, 6)
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2
WORD = regex.compile(r"[\p{L}\p{M}]+")
CRIES = regex.compile(r"[!\uFF01]+(?![\p{L}\p{M}\p{N}@$])")  # at the end of a word "!" stands for no letter


def folding() -> dict[int, str]:
    """Table for ``str.translate``: by rule for capitals, accents and full width, else from the fixed values."""
    table = {}
    for code in [*range(0x41, 0x5B), *range(0xC0, 0x250), *range(0x386, 0x52A), *range(0xFF01, 0xFF5F)]:
        plain = unicodedata.normalize("NFKD", chr(code).lower())
        plain = "".join(c for c in plain if not unicodedata.combining(c)).lower()
        plain = "".join(HOMOGLYPHS.get(c, SIGNS.get(c, c)) for c in plain)
        if plain and plain != chr(code):
            table[code] = plain
    table.update({ord(c): v for c, v in SIGNS.items()})
    table.update({ord(c): v for c, v in HOMOGLYPHS.items()})
    return table


FOLDING = folding()


def fold(text: str) -> str:
    if "!" in text or "\uFF01" in text:
        text = CRIES.sub(lambda found: "." * len(found[0]), text)
    return text.translate(FOLDING)


@dataclass(frozen=True)
class Model:
    """``entries``: word beginning, or a whole word with a blank at its end -> weight."""

    entries: dict[str, float]
    curve: tuple[float, float, float]
    exceptions: tuple[str, ...] = EXCEPTIONS

    def automaton(self) -> ahocorasick.Automaton:
        automaton = ahocorasick.Automaton()
        for entry, weight in self.entries.items():
            automaton.add_word(entry.rstrip(" "), (len(entry.rstrip(" ")), weight, entry.endswith(" ")))
        for phrase in self.exceptions:
            if fold(phrase) not in automaton:
                automaton.add_word(fold(phrase), (len(phrase), None, True))
        if len(automaton):
            automaton.make_automaton()
        return automaton

    def features(self, text: str, automaton: ahocorasick.Automaton) -> tuple[float, float]:
        """Weight over the root of the number of words, and weight per word."""
        text = fold(text)
        hits, spared = [], []
        if len(automaton):
            for end, (length, weight, whole) in automaton.iter(text):
                begin = end - length + 1
                if begin and text[begin - 1].isalpha() or whole and end + 1 < len(text) and text[end + 1].isalpha():
                    continue
                if weight is None:
                    spared.append((begin, end))
                else:
                    hits.append((begin, end, weight))
        per_word: dict[int, float] = {}
        spared.sort()
        begins, reach = [a for a, _ in spared], list(accumulate((b for _, b in spared), max))
        for begin, end, weight in hits:
            before = bisect_right(begins, begin)  # an exception that begins no later and ends no earlier spares the hit
            if not before or reach[before - 1] < end:
                per_word[begin] = max(per_word.get(begin, 0.0), weight)
        total = sum(per_word.values())
        n = max(1, len(text.split()))
        return total / n ** 0.5, total / n

    def score(self, features: np.ndarray) -> np.ndarray:
        a, b, c = self.curve
        z = a + b * np.log1p(features[:, 0]) + c * np.log1p(features[:, 1])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def lexicon(texts: list[str], toxic: np.ndarray) -> dict[str, float]:
    """Entries in some toxic texts whose odds are high at their lower bound; a longer one only where it is clearly better."""
    bad, good = Counter(), Counter()
    for text, y in zip(texts, toxic):
        words = set(WORD.findall(fold(text)))
        (bad if y else good).update({w[:n] for w in words for n in BEGINNINGS if len(w) >= n} | {w + " " for w in words if len(w) >= 3})
    n_bad, n_good = int(toxic.sum()), int((~toxic).sum())
    out: dict[str, float] = {}
    for entry, n in sorted(bad.items(), key=lambda x: (len(x[0]), x[0])):
        if n < LEAST_SUPPORT:
            continue
        cells = np.array([n, n_bad - n, good[entry], n_good - good[entry]]) + 0.5
        odds = float(np.log(cells) @ (1, -1, -1, 1) - DEVIATIONS * np.sqrt((1 / cells).sum()))
        shorter = [out.get(entry.rstrip(" ")[:k], 0.0) for k in range(min(BEGINNINGS), len(entry))]
        if odds >= LEAST_ODDS and odds > max(shorter, default=0.0) + CLEARLY_BETTER:
            out[entry] = odds
    return out


def fit(texts: list[str], toxic: list[int], exceptions: tuple[str, ...] = EXCEPTIONS) -> Model:
    """Lexicon, then the curve by Newton steps with a small ridge; repeated texts count once."""
    seen = dict(zip(texts, toxic))
    texts, y = list(seen), np.array([bool(v) for v in seen.values()], bool)
    if not y.any() or y.all():
        rate = (y.sum() + 0.5) / (len(y) + 1)
        return Model({}, (float(np.log(rate / (1 - rate))) if len(y) else -3.0, 0.0, 0.0), exceptions)
    model = Model(lexicon(texts, y), (0.0, 0.0, 0.0), exceptions)
    automaton = model.automaton()
    x = np.log1p(np.array([model.features(t, automaton) for t in texts]))
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(3)
    ridge = np.diag([1e-3, 1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w = w + step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return Model(model.entries, (float(w[0]), float(w[1]), float(w[2])), exceptions)


def sampled(docs: DataFrame, labels: DataFrame, key: str, text: str, sample: int) -> tuple[list[str], list[int]]:
    """At most ``sample`` labelled texts, one per id, outside the held-out fold, those with the least key hash."""
    y = labels.select(F.col(f"`{key}`").cast("long").alias("id"), F.col("toxic").alias("y")).where("id is not null and y is not null")
    y = y.where(F.crc32(F.col("id").cast("string").cast("binary")) % FOLDS != HELD_OUT)
    y = y.orderBy(F.xxhash64("id"), "id", "y").limit(sample)  # so many rows of two numbers: small enough to broadcast
    d = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    # one text and one label per id, however often they repeat: the greatest label, the text with the least hash
    y = y.groupBy("id").agg(F.max("y").alias("y"))
    d = d.join(F.broadcast(y.select("id")), "id").withColumn("text", F.coalesce("text", F.lit("")))
    d = d.groupBy("id").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
    rows = d.join(F.broadcast(y), "id").select("least.text", "y", "id").collect()
    rows.sort(key=lambda r: r[2])
    return [r[0] for r in rows], [r[1] for r in rows]


def score_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE,
                   threshold: float = THRESHOLD, keep: bool = False) -> DataFrame:
    """Columns ``id``, ``held_out``, ``score`` and ``predicted``, one row per document; with ``keep``, its whole row as ``row``.

    The model is fitted on at most ``sample`` labelled texts whose crc32(key as text) mod 4 is not 2,
    chosen by key hash; only texts enter a score.  A null or empty text scores as one without entries.
    Null keys are not held out and their texts are scored; labels with a null key or value are not
    used.  Without labels, or with one kind only, the score is the (smoothed) rate of the sample.
    """
    model = fit(*sampled(docs, labels, key, text, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                texts = part["row"].field(at) if keep else part["text"]
                x = np.array([model.features("" if t is None else str(t), automaton) for t in texts.to_pylist()]).reshape(-1, 2)
                score = pa.array(model.score(x))
                yield pa.RecordBatch.from_pydict({"row": part["row"], "score": score} if keep else
                                                 {"id": part["id"], "held_out": part["held_out"], "score": score})

    def held(id_):
        return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False)).alias("held_out")

    at, id_ = docs.columns.index(text), F.col(f"`{key}`")
    if keep:  # a text travels once, inside its row
        source = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
        schema = T.StructType([source.schema["row"], T.StructField("score", T.DoubleType())])
        id_ = F.col(f"row.`{key}`")
        out = source.mapInArrow(run, schema).select(id_.cast("long").alias("id"), held(id_), "score", "row")
    else:
        source = docs.select(id_.cast("long").alias("id"), held(id_), F.col(f"`{text}`").cast("string").alias("text"))
        out = source.mapInArrow(run, "id bigint, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
