"""Packing of tokenised documents into sequences (bounded-space online packing).

Every task keeps a fixed number of open windows.  What is left of a document after whole windows goes
where it fits best; where it fits nowhere, the fullest window is filled up with its beginning and
emitted.  At the end of a task the open windows are merged: the emptiest is cut to fill the fullest.
One part window per task remains; these meet, a bounded number of tasks at a time, and are merged
again.  So each group of tasks pads one sequence, whatever the size of the input.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.config import keep, shared_dir

WINDOW = 1024
OPEN_WINDOWS = 64
TASKS_PER_MERGE = 256
END_ID = 0
PIECES = ("id", "start", "ids", "doc_tokens", "sequence_id", "offset", "row")


def encoding(path: str) -> tiktoken.Encoding:
    """The vocabulary of a byte-level BPE file of the ``tokenizers`` library in a faster encoder; ids are
    the same, and its special tokens are read in texts as that library does."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes written as themselves
    letters = {chr(b): b for b in plain}
    letters.update({chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))})
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("from-file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


class Packer:
    """Open windows of one task; a window is a list of pieces (document, start, ids)."""

    def __init__(self, size: int, open_windows: int):
        self.size, self.limit = size, open_windows
        self.windows: list[list] = []
        self.filled: list[int] = []
        self.done: list[list] = []

    def add(self, doc, start: int, ids: np.ndarray) -> None:
        at = 0
        while len(ids) - at >= self.size:  # whole windows of a long document
            self.done.append([(doc, start + at, ids[at:at + self.size])])
            at += self.size
        if at < len(ids):
            self.place(doc, start + at, ids[at:])

    def place(self, doc, start: int, ids: np.ndarray) -> None:
        fit = [(self.size - f - len(ids), i) for i, f in enumerate(self.filled) if f + len(ids) <= self.size]
        if fit and (min(fit)[0] == 0 or len(self.windows) >= self.limit):
            best = min(fit)[1]
        elif len(self.windows) < self.limit:
            self.windows.append([])
            self.filled.append(0)
            best = len(self.windows) - 1
        else:
            best = int(np.argmax(self.filled))
            room = self.size - self.filled[best]
            self.put(best, doc, start, ids[:room])
            return self.place(doc, start + room, ids[room:])
        self.put(best, doc, start, ids)

    def put(self, i: int, doc, start: int, ids: np.ndarray) -> None:
        self.windows[i].append((doc, start, ids))
        self.filled[i] += len(ids)
        if self.filled[i] == self.size:
            self.done.append(self.windows.pop(i))
            self.filled.pop(i)

    def merge(self) -> None:
        """Fill the fullest windows with the pieces of the emptiest, until one is left."""
        order = sorted(range(len(self.windows)), key=lambda i: -self.filled[i])
        pieces = [p for i in order for p in self.windows[i]]
        self.windows, self.filled = [], []
        for doc, start, ids in pieces:
            while len(ids):
                if not self.windows:
                    self.windows, self.filled = [[]], [0]
                room = self.size - self.filled[0]
                piece, ids = ids[:room], ids[room:]
                self.put(0, doc, start, piece)
                start += len(piece)


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, window: int = WINDOW,
         open_windows: int = OPEN_WINDOWS, end_id: int = END_ID, tasks_per_merge: int = TASKS_PER_MERGE) -> DataFrame:
    """One row per piece: ``id``, ``start``, ``ids`` (binary, little-endian unsigned 32-bit),
    ``doc_tokens``, ``sequence_id``, ``offset`` and ``row`` (the input row without
    the text).

    Each document's ids are followed by ``end_id``; every id lies in exactly one piece, and the pieces
    of a sequence leave no gap from 0.  A null text counts as empty: one piece with the end id.  A null
    key stays null; rows that repeat a key are packed each on its own.  Shorter sequences than
    ``window`` (one per group of tasks) are for the reader to pad.
    """
    spark = docs.sparkSession
    folder = shared_dir(spark)
    where = path or public_tokenizers.path("byte_bpe_50k.json")

    source = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"),
                         F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text or c == key]).alias("row"), F.spark_partition_id().alias("task"))
    row = source.schema["row"].dataType
    schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()), T.StructField("row", row), T.StructField("open", T.BooleanType())])

    def rows_of(packer: Packer, sequence: int, opened: bool, names) -> tuple[list, int]:
        out = []
        for pieces in packer.windows if opened else packer.done:
            offset = 0
            for doc, start, ids in pieces:
                out.append((doc, start, ids, sequence, offset, opened))
                offset += len(ids)
            sequence += 1
        return out, sequence

    def batch_of(out: list, kind: pa.DataType) -> pa.RecordBatch:
        docs_ = [o[0] for o in out]
        return pa.RecordBatch.from_arrays([
            pa.array([d[0] for d in docs_], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
            pa.array([o[2].astype("<u4").tobytes() for o in out], pa.binary()), pa.array([d[1] for d in docs_], pa.int64()),
            pa.array([o[3] for o in out], pa.int64()), pa.array([o[4] for o in out], pa.int64()),
            pa.array([d[2] for d in docs_], kind), pa.array([o[5] for o in out], pa.bool_())], [*PIECES, "open"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, packer, sequence, kind = encoding(where), Packer(window, open_windows), None, None
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                kind = part["row"].type
                if sequence is None and part.num_rows:
                    sequence = part["task"][0].as_py() << 33
                for doc_id, text_, row_ in zip(part["id"].to_pylist(), part["text"].to_pylist(), part["row"].to_pylist()):
                    ids = np.append(coder.encode_to_numpy(text_ or "", allowed_special="all"), np.uint32(end_id))
                    packer.add((doc_id, len(ids), row_), 0, ids)
                out, sequence = rows_of(packer, sequence, False, part)
                packer.done = []
                if out:
                    yield batch_of(out, kind)
        if sequence is not None:
            packer.merge()
            out, sequence = rows_of(packer, sequence, False, None)
            last, _ = rows_of(packer, sequence, True, None)
            if out or last:
                yield batch_of(out + last, kind)

    def second(table: pa.Table) -> pa.Table:
        packer, kind = Packer(window, 1), table.schema.field("row").type
        table = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        for doc_id, start, ids, n, row_ in zip(*(table[c].to_pylist() for c in ("id", "start", "ids", "doc_tokens", "row"))):
            packer.windows, packer.filled = packer.windows or [[]], packer.filled or [0]
            ids = np.frombuffer(ids, "<u4")
            while len(ids):
                packer.windows, packer.filled = packer.windows or [[]], packer.filled or [0]
                room = window - packer.filled[0]
                packer.put(0, (doc_id, n, row_), start, ids[:room])
                start, ids = start + len(ids[:room]), ids[room:]
        sequence = (1 << 62) + (table["group"][0].as_py() << 33)
        out, sequence = rows_of(packer, sequence, False, None)
        last, _ = rows_of(packer, sequence, True, None)
        return pa.Table.from_batches([batch_of(out + last, kind)]).drop_columns(["open"])

    packed = keep(source.mapInArrow(first, schema), f"{folder}/packed")
    left = packed.where("open").withColumn("group", (F.shiftright("sequence_id", 33) / tasks_per_merge).cast("long")).drop("open")
    merged = left.groupBy("group").applyInArrow(second, T.StructType(schema.fields[:-1]))
    return packed.where("not open").drop("open").unionByName(merged)
