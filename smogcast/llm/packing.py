"""Packing token ids into sequences: bounded-space online best fit.

Each partition keeps ``WINDOWS`` open windows. A document's full-length parts
become sequences of their own; the rest goes to the open window it fits best.
When none fits and no window may be opened, the fullest is topped up with a cut
of the rest and emitted. At the end a partition joins its open windows; what is
left (under one sequence) is merged with that of up to ``MERGE`` partitions, and
the last tokens of a merge are cut into sequences whose lengths are powers of
two. So no sequence needs padding and no task holds more than its windows.

Edge cases: a null or empty text is the end id alone; repeated rows are packed
each; an empty table gives no rows; a very long text is cut; other columns are
not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smogcast.llm import common, text, tokens

SIZE, WINDOWS, MERGE, END = 2048, 32, 64, 1
_FIELDS = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


class Packer:
    """Open windows of one partition; ``rows`` are finished pieces."""

    def __init__(self, size: int, windows: int, first_id: int):
        self.size, self.windows, self.next_id = size, windows, first_id
        self.open: list[tuple[int, list]] = []  # (room, pieces); few, so a scan finds the best
        self.rows: list[tuple] = []

    def emit(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, self.next_id, offset, None))
            offset += len(ids)
        self.next_id += 1

    def add(self, doc, ids: np.ndarray) -> None:
        n, at = len(ids), 0
        while n - at >= self.size:
            self.emit([(doc, at, ids[at:at + self.size], n)])
            at += self.size
        while at < n:
            fits = [w for w in self.open if w[0] >= n - at]
            if fits:
                room, pieces = w = min(fits, key=lambda w: w[0])
                self.open.remove(w)
            elif len(self.open) < self.windows:
                room, pieces = self.size, []
            else:
                room, pieces = w = min(self.open, key=lambda w: w[0])
                self.open.remove(w)
            cut = min(room, n - at)
            pieces.append((doc, at, ids[at:at + cut], n))
            at += cut
            if cut == room:
                self.emit(pieces)
            else:
                self.open.append((room - cut, pieces))

    def join(self) -> list:
        """Emit what fills sequences among the open windows; return the pieces left."""
        window, room = [], self.size
        for _, pieces in sorted(self.open, key=lambda w: w[0]):
            for doc, start, ids, total in pieces:
                while len(ids):
                    cut = min(room, len(ids))
                    window.append((doc, start, ids[:cut], total))
                    start, ids, room = start + cut, ids[cut:], room - cut
                    if not room:
                        self.emit(window)
                        window, room = [], self.size
        self.open = []
        return window

    def cut_to_powers(self, pieces: list) -> None:
        left = sum(len(p[2]) for p in pieces)
        window, room = [], 1 << (left.bit_length() - 1) if left else 0
        for doc, start, ids, total in pieces:
            while len(ids):
                cut = min(room, len(ids))
                window.append((doc, start, ids[:cut], total))
                start, ids, room, left = start + cut, ids[cut:], room - cut, left - cut
                if not room:
                    self.emit(window)
                    window, room = [], 1 << (left.bit_length() - 1) if left else 0

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        cols = list(zip(*self.rows)) if self.rows else [()] * len(schema)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def _pack(size, windows, vocabulary, ranks, schema):
    def run(batches):
        encoder = tokens.Ids(vocabulary, ranks)
        packer = Packer(size, windows, TaskContext.get().partitionId() << 40)
        for rows, raw, at in text.pieces(batches):
            ids, offsets = encoder.encode(raw, at)
            n = rows.num_rows
            every = np.full(len(ids) + n, END, "<u4")
            own = np.ones(len(every), bool)
            own[offsets[1:] + np.arange(n)] = False
            every[own] = ids
            offsets = offsets + np.arange(n + 1)
            for i, doc in enumerate(rows.column("doc_id").to_pylist()):
                packer.add(doc, every[offsets[i]:offsets[i + 1]].copy())
            yield packer.batch(schema)
        left = packer.join()
        packer.rows += [(d, s, len(i), 0, t, packer.next_id, 0, i.tobytes()) for d, s, i, t in left]
        yield packer.batch(schema)
    return run


def _merge(size, schema):
    def run(key, rows):
        packer = Packer(size, 1, (1 << 62) | (key[0].as_py() << 20))
        order = rows.sort_by([("sequence_id", "ascending"), ("doc_id", "ascending"), ("start", "ascending")])
        pieces = [(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"]) for r in order.to_pylist()]
        packer.open = [(0, pieces)]
        packer.cut_to_powers(packer.join())
        return pa.Table.from_batches([packer.batch(schema)])
    return run


def pack(docs: DataFrame, size: int = SIZE, windows: int = WINDOWS, vocabulary: str = tokens.VOCABULARY,
         ranks: str = tokens.RANKS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    d = docs.select("doc_id", "text")
    out = T.StructType([d.schema["doc_id"], *T.StructType.fromDDL(_FIELDS).fields])
    from pyspark.sql.pandas.types import to_arrow_schema
    schema = to_arrow_schema(out)
    packed = common.stored(d.mapInArrow(_pack(size, windows, vocabulary, ranks, schema), out))
    # (sequence ids start with the partition's number)
    left = packed.where("ids is not null").withColumn("_part", F.shiftright("sequence_id", 40))
    merged = left.groupBy(F.expr(f"_part div {MERGE}").alias("_group")).applyInArrow(_merge(size, schema), out)
    return packed.where("ids is null").unionByName(merged).drop("ids")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(common.table(spark, sf_dir, "documents"))
