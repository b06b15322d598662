"""Licence texts in files, found by a generalised suffix automaton of licence tokens.

The automaton accepts every run of consecutive words of every template.  Streaming a file through it
gives matching statistics: at each word, the longest template run that ends there.  Matches that
cannot be made longer are chained per template, in the order of both texts, into covered spans.
Streaming starts only where two neighbouring words stand side by side in some template; elsewhere the
statistics are at most one word long.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from importlib.resources import files

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.llm import dealing
from siltworks.llm.words import LETTERS, LOWER, Words, grams

# Phrases that count wherever their words stand consecutively, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

LEAST_MATCH = 4
LEAST_COVER = 0.6
MOST_GAP = 20
PHRASE_SCORE = 0.5


def read_templates() -> dict[str, str]:
    """Notices of this package: a file's first paragraph is the template ``<file>-notice``, what follows it ``<file>-body``."""
    out = {}
    for file in sorted(files("siltworks.llm").joinpath("notices").iterdir(), key=lambda f: f.name):
        if file.name.endswith(".txt"):
            notice, body = file.read_text("utf-8").split("\n\n", 1)
            name = file.name.removesuffix(".txt")
            out[f"{name}-notice"], out[f"{name}-body"] = notice, body
    return out


class SuffixAutomaton:
    """Generalised over several sequences; every state knows where its runs end in each of them."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.ends = [-1], [0], [set()]
        for name, sequence in enumerate(sequences):
            last = 0
            for at, token in enumerate(sequence):
                last = self._extend(last, token)
                self.ends[last].add((name, at))
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                self.ends[self.link[state]] |= self.ends[state]

    def _new(self, length: int, after: dict, link: int) -> int:
        self.next.append(after)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.next) - 1

    def _clone(self, p: int, token: int, q: int) -> int:
        copy = self._new(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p != -1 and self.next[p].get(token) == q:
            self.next[p][token] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, token: int) -> int:
        if token in self.next[last]:
            q = self.next[last][token]
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, token, q)
        state, p = self._new(self.length[last] + 1, {}, 0), last
        while p != -1 and token not in self.next[p]:
            self.next[p][token] = state
            p = self.link[p]
        if p != -1:
            q = self.next[p][token]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._clone(p, token, q)
        return state

    def statistics(self, tokens: list[int]) -> Iterator[tuple[int, int]]:
        """State and length of the longest run that ends at each token."""
        state = length = 0
        for token in tokens:
            while state and token not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if token in self.next[state]:
                state = self.next[state][token]
                length += 1
            else:
                length = 0
            yield state, length


class Scanner:
    """The automaton of all templates and phrases, with what single states mean."""

    def __init__(self, templates: dict[str, str], phrases: dict[str, str]):
        self.labels = [*templates, *phrases.values()]
        self.n_templates = len(templates)
        words = Words(pa.array([*templates.values(), *phrases]), LETTERS, LOWER)
        self.known = np.unique(words.hashes)
        numbers = np.searchsorted(self.known, words.hashes)
        self.sequences = [numbers[a:b].tolist() for a, b in zip(words.first[:-1], words.first[1:])]
        self.pairs = np.unique(grams(words.hashes, 2)[words.whole(2)[:max(len(words) - 1, 0)]])
        heads = [self.known[s[:2]] for s in self.sequences[self.n_templates:]]
        self.heads = np.unique(np.concatenate([grams(h, 2) for h in heads])) if heads else np.zeros(0, np.uint64)
        self.automaton = SuffixAutomaton(self.sequences)
        # a phrase ends at the state that its run belongs to, and at all states that link to that one
        auto = self.automaton
        self.phrases = [[] for _ in auto.next]
        for state in range(1, len(auto.next)):
            for name, at in auto.ends[state]:
                size = len(self.sequences[name])
                if name >= self.n_templates and at == size - 1 and auto.length[auto.link[state]] < size <= auto.length[state]:
                    self.phrases[state].append((name, size))
        for state in sorted(range(1, len(auto.next)), key=lambda x: auto.length[x]):
            self.phrases[state] = sorted({*self.phrases[state], *self.phrases[auto.link[state]]})

    def scan(self, words: Words) -> list[dict]:
        """What is found in each text: base places and template spans."""
        out = [{"base": [], "spans": []} for _ in words.first[:-1]]
        pairs = grams(words.hashes, 2)
        inside = words.whole(2)[:len(pairs)]
        hit = dealing.member(pairs, self.pairs) & inside
        head = dealing.member(pairs, self.heads) & inside
        edge = np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8))
        begins, ends = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)  # words begin .. end, both included
        heads = np.concatenate([[0], np.cumsum(head)])
        useful = (ends - begins + 1 >= LEAST_MATCH) | (heads[ends] > heads[begins])
        text = words.text_of()
        found: dict[int, list] = {}
        for lo, hi in zip(begins[useful].tolist(), ends[useful].tolist()):
            start = int(words.first[text[lo]])
            tokens = np.searchsorted(self.known, words.hashes[lo:hi + 1]).tolist()
            row = list(self.automaton.statistics(tokens))
            for k, (state, length) in enumerate(row):
                for name, size in self.phrases[state]:
                    if length >= size:
                        out[text[lo]]["base"].append((lo + k - size + 1 - start, self.labels[name]))
                longest = k + 1 == len(row) or row[k + 1][1] <= length
                if longest and length >= LEAST_MATCH:
                    found.setdefault(int(text[lo]), []).append((lo + k - start, length, state))
        for i, matches in found.items():
            out[i]["spans"] = self.chain(matches)
        return out

    def chain(self, matches: list[tuple[int, int, int]]) -> list[tuple[str, int, int, float]]:
        """Chains of matches per template: rising in text and template, gaps of at most MOST_GAP words.

        The best chain of a template, and further ones that share no text with better ones and cover
        LEAST_COVER of it, so a notice that stands twice gives two spans.
        """
        out = []
        places: dict[int, list] = {}
        for end, length, state in matches:
            for name, at in self.automaton.ends[state]:
                if name < self.n_templates:
                    places.setdefault(name, []).append((end, at, length))
        for name, found in places.items():
            found.sort()
            best: list[tuple[int, int]] = []  # covered template words, first text word
            for i, (end, at, length) in enumerate(found):
                pick = (length, end - length + 1)
                for j in range(i - 1, -1, -1):
                    before, was, _ = found[j]
                    if end - length - before > MOST_GAP:
                        if end - before > MOST_GAP + len(self.sequences[name]):
                            break
                        continue
                    new = min(length, at - was, end - before)
                    if new > 0 and best[j][0] + new > pick[0]:
                        pick = (best[j][0] + new, best[j][1])
                best.append(pick)
            taken: list[tuple[int, int]] = []  # disjoint spans by their begin
            for i in sorted(range(len(best)), key=lambda i: (-best[i][0], best[i][1])):
                cover, span = best[i][0] / len(self.sequences[name]), (best[i][1], found[i][0])
                if taken and cover < LEAST_COVER:
                    break
                at = bisect_left(taken, span)
                if (at == 0 or taken[at - 1][1] < span[0]) and (at == len(taken) or span[1] < taken[at][0]):
                    taken.insert(at, span)
                    out.append((self.labels[name], *span, cover))
        return sorted(out)


def scan_licences(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None,
                  phrases: dict[str, str] | None = None) -> DataFrame:
    """Columns ``id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``,
    ``score`` and ``spans`` (label, first word, last word, share of the template covered).

    Words are runs of digits, letters and anything beyond ASCII, with A-Z in lower case.  A template is
    a label where a chain covers LEAST_COVER of it; those of this package are notices and their bodies, so
    a body whose opening sentence is gone has its own label.  The score is the best cover, at least PHRASE_SCORE
    where a phrase stands.  A null or empty text has no words, no labels and score 0; null and repeated
    keys are kept as they are, one row out per row in.
    """
    templates, phrases = templates or read_templates(), phrases or PHRASES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, phrases)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                words = Words(part["text"], LETTERS, LOWER)
                rows = scanner.scan(words)
                columns: list[list] = [[] for _ in range(7)]
                for row in rows:
                    starts = [s for s, _ in row["base"]]
                    base = {x for _, x in row["base"]}
                    more = {label for label, _, _, cover in row["spans"] if cover >= LEAST_COVER}
                    score = max([PHRASE_SCORE * bool(starts), *(min(1.0, s[3]) for s in row["spans"])])
                    for column, value in zip(columns, (len(starts), min(starts, default=None), max(starts, default=None),
                                                       ",".join(sorted(base)), ",".join(sorted(base | more)), score,
                                                       [dict(zip(("label", "first", "last", "cover"), s)) for s in row["spans"]])):
                        column.append(value)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), _SPANS)
                yield pa.RecordBatch.from_arrays(
                    [part["id"], pa.array(words.counts), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                    ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])

    source = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    span = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("first", T.LongType()),
                                     T.StructField("last", T.LongType()), T.StructField("cover", T.DoubleType())]))
    fields = [("id", T.LongType()), ("n_words", T.LongType()), ("n_base", T.LongType()), ("first_word", T.LongType()),
              ("last_word", T.LongType()), ("base_labels", T.StringType()), ("labels", T.StringType()), ("score", T.DoubleType()), ("spans", span)]
    return source.mapInArrow(run, T.StructType([T.StructField(n, t) for n, t in fields]))


_SPANS = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("cover", pa.float64())]))
