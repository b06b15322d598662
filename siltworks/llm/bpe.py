"""Byte-level byte-pair encoding with a hierarchical-bitmap rank queue, and decoding.

Parts of a piece are a doubly linked list over its bytes.  A bucket per merge rank holds the places
whose pair has that rank; a two-level bitmap of non-empty ranks gives the least one by find-first-set.
A place whose pair has changed since it was queued is stale and skipped.  Each merge costs a constant
number of steps (and the logarithm of its bucket), so a piece of a million bytes takes no longer per
byte than a word.  Distinct pieces are encoded once per task, in a memory of bounded size.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REMEMBERED = 1_000_000
LONGEST_REMEMBERED = 64
#: The bitmap's lower level has words of 256 ranks; the upper one has a bit for each of these words.
WORD, MASK = 8, 255


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks from a file of base64 tokens and numbers."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one piece: again and again the pair of least rank, the leftmost first, is merged."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    get = ranks.get
    after = list(range(1, n + 1))  # where each part ends, which is where the next one begins
    back = list(range(-1, n))
    current = [-1] * (n + 1)  # rank of the pair that begins here
    places: dict[int, list[int]] = {}  # rank -> heap of places
    words: dict[int, int] = {}  # bitmap of ranks with places, in words
    top = 0  # bitmap of words that are not zero
    for i in range(n - 1):
        rank = get(piece[i:i + 2])
        if rank is not None:
            current[i] = rank
            bucket = places.get(rank)
            if bucket is None:
                places[rank] = [i]
                word = rank >> WORD
                words[word] = words.get(word, 0) | 1 << (rank & MASK)
                top |= 1 << word
            else:
                bucket.append(i)  # rising places are a heap
    while top:
        word = (top & -top).bit_length() - 1
        bits = words[word]
        rank = word << WORD | (bits & -bits).bit_length() - 1
        bucket = places[rank]
        i = heappop(bucket)
        if not bucket:
            del places[rank]
            words[word] = bits = bits & bits - 1
            if not bits:
                top &= top - 1
        if current[i] != rank:
            continue  # stale
        j = after[i]
        end = after[j]
        current[j] = -1
        after[i] = end
        back[end] = i
        for h, stop in ((i, after[end] if end < n else 0), (back[i], end)):
            if h < 0:
                continue
            rank = get(piece[h:stop]) if stop else None
            if rank is None:
                current[h] = -1
            elif current[h] != rank:
                current[h] = rank
                bucket = places.get(rank)
                if bucket is None:
                    places[rank] = [h]
                    word = rank >> WORD
                    words[word] = words.get(word, 0) | 1 << (rank & MASK)
                    top |= 1 << word
                else:
                    heappush(bucket, h)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:after[i]]])
        i = after[i]
    return out


class Encoder(dict):
    """Ids of pieces as little-endian bytes; a dictionary that fills itself, up to a bound."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.find = regex.compile(pattern).findall

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(merge(piece.encode(), self.ranks), "<u4").tobytes()
        if len(piece) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                for old in list(islice(self, REMEMBERED // 4)):
                    del self[old]
            self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.find(text)))


_last: list = [None, None]


def _encoder(sent, pattern: str) -> Encoder:
    """The encoder of this Python worker: what one task has learned, the next one uses."""
    name = (len(sent), hash(frozenset(sent.items())), pattern)
    if _last[0] != name:
        _last[:] = [name, Encoder(sent, pattern)]
    return _last[1]


def encode_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None,
                 pattern: str | None = None) -> DataFrame:
    """Columns ``id``, ``ids`` (unsigned 32-bit, little-endian, as binary), ``decoded`` (binary) and ``row``.

    ``path`` names a file of ranks and ``pattern`` what splits a text into pieces; by default those of
    the 50k byte-level vocabulary.  A null text counts as empty and gives no ids.  ``row`` is the whole
    input row without the text.  The driver reads the file and sends it along, so executors need not have it; it is as
    large as the vocabulary, about a megabyte.
    """
    ranks = read_ranks(path or public_tokenizers.path("byte_bpe_50k.tiktoken"))
    pattern = pattern or public_tokenizers.PATTERN
    sent = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(sent.value, pattern)
        token = [b""] * (1 + max(sent.value.values()))
        for word, rank in sent.value.items():
            token[rank] = word
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                ids = [encoder.encode(t or "") for t in part["text"].to_pylist()]
                decoded = [b"".join(map(token.__getitem__, np.frombuffer(x, "<u4").tolist())) for x in ids]
                yield pa.RecordBatch.from_arrays([part["id"], pa.array(ids, pa.binary()), pa.array(decoded, pa.binary()), part["row"]],
                                                 ["id", "ids", "decoded", "row"])

    source = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"),
                         F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text or c == key]).alias("row"))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ids", T.BinaryType()),
                           T.StructField("decoded", T.BinaryType()), T.StructField("row", source.schema["row"].dataType)])
    return source.mapInArrow(run, schema)
