"""Row filters of a fixed size, which keep joins from moving texts that can't match.

A filter never loses an id. It is 2 ** FILTER_BITS bits whatever the input; where
ids crowd it, more rows pass to the exact join behind it and nothing else changes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogcast.llm import text

FILTER_BITS = 24


class Bloom:
    """A filter of fixed size: ids that were put in are always found."""

    def __init__(self, bits: int):
        self.bits, self.table = bits, np.zeros(1 << (bits - 3), np.uint8)

    def _places(self, ids: np.ndarray):
        h = text.mix(ids.astype(np.int64).view(np.uint64))
        return h >> np.uint64(64 - self.bits), text.mix(h + np.uint64(1)) >> np.uint64(64 - self.bits)

    def put(self, ids: np.ndarray) -> None:
        for p in self._places(ids):
            np.bitwise_or.at(self.table, p >> np.uint64(3), np.uint8(1) << (p & np.uint64(7)).astype(np.uint8))

    def has(self, ids: np.ndarray) -> np.ndarray:
        a, b = (self.table[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8) & 1 for p in self._places(ids))
        return (a & b).astype(bool)


def _bloom(bits):
    def run(batches):
        some, any_row = Bloom(bits), False
        for batch in batches:
            some.put(batch.column("row").to_numpy())
            any_row |= batch.num_rows > 0
        if any_row:
            yield pa.RecordBatch.from_arrays([pa.array([some.table.tobytes()], pa.binary())], ["table"])
    return run


def _union(batches):
    whole = None
    for batch in batches:
        for t in batch.column("table"):
            part = np.frombuffer(t.as_py(), np.uint8)
            whole = part.copy() if whole is None else whole | part
    if whole is not None:
        yield pa.RecordBatch.from_arrays([pa.array([whole.tobytes()], pa.binary())], ["table"])


def gathered(rows: DataFrame, column: str, bits: int = FILTER_BITS) -> Bloom:
    """A filter of all ids in ``column``; eight tables of 2 ** bits bits at most come to the driver."""
    whole = Bloom(bits)
    ids = rows.select(F.col(column).alias("row"))
    parts = ids.mapInArrow(_bloom(bits), "table binary").repartition(8).mapInArrow(_union, "table binary")
    for r in parts.collect():
        whole.table |= np.frombuffer(r["table"], np.uint8)
    return whole


def matching(docs: DataFrame, column: str, held: Bloom, hit: bool = True) -> DataFrame:
    """Rows whose id may be in the filter, or (``hit`` false) those whose id is surely not."""
    def keep(batches):
        for batch in batches:
            has = held.has(batch.column(batch.schema.get_field_index(column)).to_numpy())
            yield batch.filter(pa.array(has if hit else ~has))
    return docs.mapInArrow(keep, docs.schema)


def likely(docs: DataFrame, rows: DataFrame, column: str = "row") -> DataFrame:
    """``docs`` without most of those that aren't in ``rows``, so that a join moves fewer texts."""
    return matching(docs, column, gathered(rows, column))


def without(docs: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """``docs`` whose id isn't in ``rows``: only rows that the filter can't clear go through the anti-join."""
    held = gathered(rows, column)
    return matching(docs, column, held, False).unionByName(
        matching(docs, column, held).join(rows.select(column), column, "left_anti").select(*docs.columns))
