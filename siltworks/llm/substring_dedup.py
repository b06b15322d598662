"""Removal of word passages that also start earlier in the corpus (repeated-phrase automata).

A *window* is 20 consecutive words of one document; its *anchor* is the 10-word phrase in it with the
least hash, so equal windows have equal anchors.  Three passes over documents dealt into buckets:

1. Each bucket names its anchors; those that come more than once are answered to their buckets.
2. Each bucket names its distinct windows around repeated anchors, by 128-bit digests.  One group per
   anchor range confirms recurring windows and finds the first place of each.
3. Each bucket is a shard: the anchors of its confirmed windows are compiled into an Aho-Corasick
   automaton over word numbers, all its documents are streamed through it, and around each hit the
   windows are compared with the confirmed ones.  Words of windows that start earlier elsewhere go.

The repeated phrases of a shard are bounded by its text, and a phrase that a third of all documents
hold is named once per bucket.  Everything is one lazy plan over one shuffle of the documents.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.llm import dealing
from siltworks.llm.words import U64, Words, grams, mix, sliding

WINDOW = 20
ANCHOR = 10
NONE = np.iinfo(np.int64).min
TOP = U64(0xFFFFFFFFFFFFFFFF)
SECOND_BASE = 0xA0761D6478BD642F
LETTERS = 64


class Anchored:
    """Words of a bucket with the anchor hash of each window."""

    def __init__(self, table: pa.Table, window: int, anchor: int):
        self.ids = table["id"].to_pandas().fillna(NONE).to_numpy(np.int64)
        self.words = Words(table["text"])
        self.window, self.span = window, window - anchor + 1
        self.phrase = grams(self.words.hashes, anchor)
        self.anchor = sliding(self.phrase, self.span)
        self.valid = self.words.whole(window)[:len(self.anchor)]

    def around(self, values: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Windows whose own anchor stands at one of the marked phrase places."""
        marked = np.where(at, values, TOP)
        return self.valid & (sliding(marked, self.span) == self.anchor) & sliding(at, self.span, np.logical_or)

    def anchors(self) -> np.ndarray:
        """Places of phrases that are the anchor of some window."""
        if not len(self.anchor):
            return np.zeros(0, np.int64)
        edge = np.zeros(self.span - 1, U64)
        best = sliding(np.concatenate([edge, np.where(self.valid, self.anchor, U64(0)), edge]), self.span, np.maximum)
        covered = sliding(np.concatenate([edge > 0, self.valid, edge > 0]), self.span, np.logical_or)
        return np.flatnonzero(covered & (best == self.phrase))

    def digests(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """128-bit digests of the windows that start at the given words."""
        h = self.words.hashes
        a, b = np.zeros(len(at), U64), np.zeros(len(at), U64)
        for j in range(self.window):
            a = a * U64(0x2545F4914F6CDD1D) + h[at + j]
            b = b * U64(SECOND_BASE) + h[at + j]
        return mix(a), mix(b)


def _runs(*steady: np.ndarray) -> np.ndarray:
    """Where a run begins: a value of some array is not that of the entry before."""
    new = np.ones(len(steady[0]), bool)
    if len(new):
        new[1:] = np.any([s[1:] != s[:-1] for s in steady], axis=0)
    return np.flatnonzero(new)


def remove_repeated(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                    anchor: int = ANCHOR) -> DataFrame:
    """Columns ``id``, ``n_words``, ``n_removed``, ``kept`` (kept words joined by one space) and ``row``.

    ``row`` is the whole input row, so columns of any name pass through.  Words are runs without ASCII
    white space.  "Earlier" is a smaller key, or an earlier start in the same document; a null key
    comes before all others.  Null, empty and short texts (fewer words than a window) lose nothing.
    Rows that share a key count as one document: at equal starts neither removes the other.
    """
    ranges = dealing.key_ranges(docs)
    dealt = dealing.deal(docs, key, text, keep=True)
    plain = dealt.select("bucket", "id", "text", "row")

    def name_anchors(table: pa.Table) -> pa.Table:
        a = Anchored(table, window, anchor)
        keys, counts = np.unique(mix(a.phrase[a.anchors()]), return_counts=True)
        parts = list(dealing.cut(keys, ranges))
        return pa.table({
            "part": pa.array([p for p, _ in parts], pa.int32()),
            "bucket": pa.array([table["bucket"][0].as_py()] * len(parts), pa.int32()),
            "keys": dealing.lists([keys[s] for _, s in parts], pa.int64()),
            "again": dealing.lists([(counts[s] > 1).astype(np.int8) for _, s in parts], pa.int8())})

    named = plain.groupBy("bucket").applyInArrow(name_anchors, "part int, bucket int, keys array<bigint>, again array<tinyint>")
    repeated = dealing.shared_keys(named)

    def name_windows(left: pa.Table, right: pa.Table) -> pa.Table:
        fields = ("doc", "start", "length", "first", "second", "again")
        empty = pa.table({"part": pa.array([], pa.int32()), "bucket": pa.array([], pa.int32()),
                          **{f: dealing.lists([], pa.int8() if f == "again" else pa.int64()) for f in fields}})
        if not len(left) or not len(right):
            return empty
        a = Anchored(left, window, anchor)
        keys = np.sort(dealing.flat(right["keys"])[0].view(U64))
        owner = mix(a.anchor)
        at = np.flatnonzero(a.valid & dealing.member(owner, keys))
        doc = a.ids[a.words.text_of()[at]]
        start = at - a.words.first[a.words.text_of()[at]]
        one, two = a.digests(at)
        order = np.lexsort((start, doc, two, one))  # each distinct window once, at its first place here
        lead = _runs(one[order], two[order])
        sizes = np.diff(np.append(lead, len(order)))
        pick = order[lead]
        back = np.argsort(at[pick], kind="stable")
        pick, again = pick[back], (sizes[back] > 1).astype(np.int8)
        part = (owner[at[pick]] >> U64(65 - ranges.bit_length())).astype(np.int64) if ranges > 1 else np.zeros(len(pick), np.int64)
        line = np.lexsort((at[pick], part))
        pick, again, part = pick[line], again[line], part[line]
        run = _runs(part, doc[pick], start[pick] - np.arange(len(pick)))
        ends = np.append(run, len(pick))
        cuts = _runs(part[run]) if len(run) else np.zeros(0, np.int64)
        rows = [(int(c), int(d)) for c, d in zip(cuts, [*cuts[1:], len(run)])]
        span = [slice(int(ends[c]), int(ends[d])) for c, d in rows]
        return pa.table({
            "part": pa.array([int(part[s.start]) for s in span], pa.int32()),
            "bucket": pa.array([left["bucket"][0].as_py()] * len(rows), pa.int32()),
            "doc": dealing.lists([doc[pick[run[c:d]]] for c, d in rows], pa.int64()),
            "start": dealing.lists([start[pick[run[c:d]]] for c, d in rows], pa.int64()),
            "length": dealing.lists([np.diff(ends)[c:d] for c, d in rows], pa.int64()),
            "first": dealing.lists([one[pick[s]] for s in span], pa.int64()),
            "second": dealing.lists([two[pick[s]] for s in span], pa.int64()),
            "again": dealing.lists([again[s] for s in span], pa.int8())})

    windows = plain.groupBy("bucket").cogroup(repeated.groupBy("bucket")).applyInArrow(
        name_windows, "part int, bucket int, doc array<bigint>, start array<bigint>, length array<bigint>, "
                      "first array<bigint>, second array<bigint>, again array<tinyint>")

    def confirm(table: pa.Table) -> pa.Table:
        run_doc, n_runs = dealing.flat(table["doc"])
        run_start, length = dealing.flat(table["start"])[0], dealing.flat(table["length"])[0]
        one, two = (dealing.flat(table[c])[0].view(U64) for c in ("first", "second"))
        again = dealing.flat(table["again"])[0]
        bucket = np.repeat(np.repeat(table["bucket"].to_numpy(), n_runs), length)
        doc = np.repeat(run_doc, length)
        start = np.repeat(run_start - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(len(doc))
        order = np.lexsort((start, doc, two, one))
        lead = _runs(one[order], two[order])
        sizes = np.diff(np.append(lead, len(order)))
        recurs = (sizes > 1) | (np.maximum.reduceat(again[order], lead) > 0 if len(lead) else np.zeros(0, bool))
        source = np.repeat(order[lead], sizes)
        home, where = np.empty(len(doc), np.int64), np.empty(len(doc), np.int64)
        home[order], where[order] = doc[source], start[source]
        kept = np.zeros(len(doc), bool)
        kept[order] = np.repeat(recurs, sizes)
        at = np.flatnonzero(kept)
        run = _runs(bucket[at], doc[at], start[at] - at, home[at], where[at] - at)
        lengths = np.diff(np.append(run, len(at)))
        pick = at[run]
        line = np.argsort(bucket[pick], kind="stable")
        pick, lengths = pick[line], lengths[line]
        return dealing.by_bucket(bucket[pick], {n: (v, pa.int64()) for n, v in (
            ("doc", doc[pick]), ("start", start[pick]), ("length", lengths), ("home", home[pick]), ("place", where[pick]))})

    confirmed = windows.groupBy("part").applyInArrow(
        confirm, "bucket int, doc array<bigint>, start array<bigint>, length array<bigint>, home array<bigint>, place array<bigint>")

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return pa.table({f.name: pa.array([], f.type) for f in _out_schema(left)})
        a = Anchored(left, window, anchor)
        n = len(a.words)
        gone = np.zeros(n, bool)
        if len(right):
            starts = _repeated_starts(a, right)
            change = np.zeros(n + 1, np.int64)
            np.add.at(change, starts, 1)
            np.add.at(change, starts + window, -1)
            gone = np.cumsum(change)[:n] > 0
        lost = np.concatenate([[0], np.cumsum(gone)])[a.words.first]
        n_removed = np.diff(lost)
        kept, data, at = [], a.words.data, a.words.text_at
        for i in range(len(left)):
            found = data[at[i]:at[i + 1]].tobytes().split()
            if n_removed[i]:
                stay = ~gone[a.words.first[i]:a.words.first[i + 1]]
                found = [found[j] for j in np.flatnonzero(stay)]
            kept.append(b" ".join(found))
        out = {"id": left["id"], "n_words": pa.array(a.words.counts), "n_removed": pa.array(n_removed),
               "kept": pa.array(kept, pa.binary()).cast(pa.string()), "row": left["row"]}
        return pa.table(out)

    schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("kept", T.StringType()), T.StructField("row", dealt.schema["row"].dataType)])
    return plain.groupBy("bucket").cogroup(confirmed.groupBy("bucket")).applyInArrow(remove, schema)


def _out_schema(left: pa.Table) -> list[pa.Field]:
    return [pa.field("id", pa.int64()), pa.field("n_words", pa.int64()), pa.field("n_removed", pa.int64()),
            pa.field("kept", pa.string()), left.schema.field("row")]


def _repeated_starts(a: Anchored, right: pa.Table) -> np.ndarray:
    """Start words of all windows of a shard whose confirmed first place is elsewhere and earlier."""
    texts = a.words.text_of()
    place = np.arange(len(a.words)) - a.words.first[texts]
    run_doc, run_start, length, home, first = (dealing.flat(right[c])[0] for c in ("doc", "start", "length", "home", "place"))
    rank = np.argsort(a.ids, kind="stable")
    lo, hi = np.searchsorted(a.ids[rank], run_doc, "left"), np.searchsorted(a.ids[rank], run_doc, "right")
    if (hi - lo > 1).any():  # several rows with one key: any of them may hold the run
        times = hi - lo
        run_start, length, home, first = (np.repeat(x, times) for x in (run_start, length, home, first))
        lo = np.repeat(lo, times) + np.arange(times.sum()) - np.repeat(np.concatenate([[0], np.cumsum(times)[:-1]]), times)
    begin = a.words.first[rank[lo]] + run_start
    at = np.repeat(begin - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
    home = np.repeat(home, length)
    first = np.repeat(first - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(len(at))
    inside = at < len(a.valid)
    at, home, first = at[inside], home[inside], first[inside]
    inside = a.valid[at]
    at, home, first = at[inside], home[inside], first[inside]
    if not len(at):
        return at

    hit = _hits(a, at)

    # Windows around hits, by the digests of the confirmed ones.
    found = np.flatnonzero(a.around(a.phrase, hit))
    one, two = a.digests(at)
    order = np.lexsort((two, one))
    known = np.empty(len(order), [("a", U64), ("b", U64)])
    known["a"], known["b"] = one[order], two[order]
    mine, mine_two = a.digests(found)
    spot = np.searchsorted(known["a"], mine)
    spot[spot == len(known)] = 0
    same = (known["a"][spot] == mine) & (known["b"][spot] == mine_two)
    found, spot = found[same], order[spot[same]]
    here = a.ids[texts[found]]
    return found[(home[spot] != here) | (first[spot] != place[found])]


def _hits(a: Anchored, windows: np.ndarray) -> np.ndarray:
    """Marks every place where the anchor phrase of one of the windows stands.

    A word of a phrase is written as letters of a small alphabet, a range of its own for each letter of
    a word, so that automaton nodes have few branches; a run of words that no phrase has is one blank.
    """
    length = a.window - a.span + 1
    sample = windows[np.unique(a.anchor[windows], return_index=True)[1]]
    near = sample[:, None] + np.arange(a.span)
    places = sample + (a.phrase[near] == a.anchor[sample][:, None]).argmax(1)
    phrases = a.words.hashes[places[:, None] + np.arange(length)]
    known = np.unique(phrases)
    letters = 1
    while LETTERS ** letters <= len(known):
        letters += 1
    shift = LETTERS ** np.arange(letters)

    def spell(numbers: np.ndarray) -> str:
        marks = numbers[:, None] // shift % LETTERS + LETTERS * np.arange(letters)
        return marks.astype("<u4").tobytes().decode("utf-32-le")

    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    spelled = spell(1 + np.searchsorted(known, phrases.ravel()))
    size = length * letters
    for i in range(0, len(spelled), size):
        automaton.add_word(spelled[i:i + size])
    automaton.make_automaton()
    numbers = np.searchsorted(known, a.words.hashes)
    numbers[numbers == len(known)] = 0
    numbers = np.where(known[numbers] == a.words.hashes, numbers + 1, 0)
    streamed = np.flatnonzero((numbers > 0) | np.concatenate([[False], numbers[:-1] > 0]))
    ends = np.fromiter((end for end, _ in automaton.iter(spell(numbers[streamed]))), np.int64) // letters
    hit = np.zeros(len(a.phrase), bool)
    hit[streamed[ends] - length + 1] = True
    return hit
