"""Suffix-array dedup: remove every byte covered by a ``SIZE``-byte string that also starts elsewhere.

Suffix sorting the whole corpus in one place doesn't scale, so shards of it are
sorted, each holding all strings that could be equal:

1. Anchors. Of the ``GRAM``-byte grams inside a ``SIZE``-byte string the one with the
   smallest hash (the leftmost of equals) is its anchor. Equal strings have equal
   anchors at equal places. Strings with one anchor form a segment of under
   ``2 * SIZE`` bytes; equal segments are counted, never copied.
2. Segments whose anchor occurs once are done: nothing in them is repeated. A
   segment that occurs twice is repeated whole. Anchors with several different
   segments remain, and their bytes are cut out of the documents once.
3. Anchors with at most ``GROUP`` different segments are dealt to shards of about
   ``SHARD`` bytes by hash. A shard's suffix array is induced, and adjacent suffixes
   with a permuted common prefix of ``SIZE`` or more mark the repeated strings.
4. An anchor with more (a passage shared by very many documents) is split by what
   stands around it: its segments are cut into blocks of ``BLOCK`` string starts,
   keyed by the bytes that all strings of the block share, and take steps 2 and 3
   again; a block key that is still too frequent is split into single strings,
   whose equal copies are counted. No string leaves the way of its equals.
5. Marked starts go back to all occurrences, and each document drops their union.

Segments and strings are compared by two 64-bit hashes together.

Edge cases: a null or empty text has 0 bytes and nothing removed, texts under
``SIZE`` bytes have no such string; a repetition inside one text counts; repeated
rows repeat each other; an empty table gives no rows; other columns are not read.
Kept bytes of a text need not be valid UTF-8, so they are binary.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from smogcast.llm import common, text
from smogcast.llm.suffix_array import repeated

SIZE, GRAM = 400, 128
GROUP, SHARD, BLOCK = 400, 1 << 20, 16
FILTER_BITS = 24
MARK = 0xFF  # never a byte of UTF-8


def _numbered(batches):
    row = TaskContext.get().partitionId() << 33
    for batch in batches:
        yield batch.add_column(0, "row", pa.array(row + np.arange(batch.num_rows)))
        row += batch.num_rows


def _low(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive hashes."""
    n = len(h)
    pad = np.concatenate([h, np.full(-n % w, np.uint64(2**64 - 1))]).reshape(-1, w)
    ahead = np.minimum.accumulate(pad, 1).ravel()
    back = np.minimum.accumulate(pad[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:n - w + 1], ahead[w - 1:n])


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    at = np.arange(max(0, len(raw) - gram + 1))
    return text.span_hashes(raw, at, at + gram)


def segments(raw: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, segment hash, first start, number of starts) of one text."""
    if len(raw) < size:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    h = gram_hashes(raw, gram)
    low = _low(h, size - gram + 1)
    # The anchor moves on when a smaller hash comes in, or when the start leaves it behind.
    moved = (low[1:] != low[:-1]) | (h[:len(low) - 1] == low[:-1])
    start = np.concatenate([[0], np.flatnonzero(moved) + 1])
    count = np.diff(np.append(start, len(low)))
    return low[start], text.span_hashes(raw, start, start + count - 1 + size), start, count


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()],
                                      list(columns))


def _occurrences(size, gram):
    def run(batches):
        for rows, raw, at in text.pieces(batches):
            parts = [segments(raw[at[i]:at[i + 1]], size, gram) for i in range(rows.num_rows)]
            key, seg, start, count = (np.concatenate(c) for c in zip(*parts))
            owner = np.repeat(rows.column("row").to_numpy(), [len(p[0]) for p in parts])
            yield _batch(key=key.view(np.int64), seg=seg.view(np.int64), row=owner, start=start.astype(np.int32),
                         starts=count.astype(np.int32))
    return run


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
            yield _batch(table=pa.array([some.table.tobytes()], pa.binary()))
    return run


def _union(batches):
    whole = None
    for batch in batches:
        for t in batch.column("table"):
            part = np.frombuffer(t.as_py(), np.uint8)
            whole = part.copy() if whole is None else whole | part
    if whole is not None:
        yield _batch(table=pa.array([whole.tobytes()], pa.binary()))


def _likely(docs: DataFrame, rows: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """``docs`` without most of those whose ``row`` isn't in ``rows``, so that a join moves fewer texts."""
    whole = Bloom(bits)
    parts = rows.select("row").mapInArrow(_bloom(bits), "table binary").repartition(8).mapInArrow(_union, "table binary")
    for r in parts.collect():  # eight tables of 2 ** bits bits at most
        whole.table |= np.frombuffer(r["table"], np.uint8)

    def keep(batches):
        for batch in batches:
            yield batch.filter(pa.array(whole.has(batch.column("row").to_numpy())))
    return docs.mapInArrow(keep, docs.schema)


def _cut(size):
    """The bytes of the segments wanted from each text."""
    def run(batches):
        for batch in batches:
            for value, want in zip(batch.column("text"), batch.column("want")):
                data, want = (value.as_py() or "").encode(), want.as_py()
                yield _batch(
                    **{c: pa.array([w[c] for w in want], k) for c, k in (
                        ("key", pa.int64()), ("seg", pa.int64()), ("starts", pa.int32()), ("n", pa.int64()),
                        ("different", pa.int64()))},
                    data=pa.array([data[w["start"]:w["start"] + w["starts"] - 1 + size] for w in want], pa.binary()))
    return run


def _runs(flags: np.ndarray):
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())


def _sort_shard(size):
    """Marked starts of a shard's segments: (key, seg, low, high) offsets."""
    def run(_, rows):
        order = rows.sort_by([("key", "ascending"), ("seg", "ascending")])
        parts = [d.as_py() for d in order.column("data")]
        hit = repeated(np.frombuffer(bytes([MARK]).join(parts) + bytes([MARK]), np.uint8), size)
        at = np.cumsum([0, *[len(p) + 1 for p in parts]])
        out = [(k, s, a, z) for i, (k, s, n) in enumerate(zip(*(order.column(c).to_pylist() for c in ("key", "seg", "starts"))))
               for a, z in _runs(hit[at[i]:at[i] + n])]
        cols = list(zip(*out)) if out else ((),) * 4
        return pa.table([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
                        ["key", "seg", "low", "high"])
    return run


def _blocks(size, gram, block):
    """Blocks of a segment's string starts, counted back from its anchor, keyed by what their strings share."""
    def run(batches):
        for batch in batches:
            for key, seg, starts, n, data in zip(*(batch.column(c).to_pylist() for c in ("key", "seg", "starts", "n", "data"))):
                raw = np.frombuffer(data, np.uint8)
                lead = int(np.flatnonzero(gram_hashes(raw, gram).view(np.int64) == key)[0])
                place = (lead - np.arange(starts)) // block
                first = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
                count = np.diff(np.append(first, starts))
                last = lead - place[first] * block  # the last start a whole block has
                core = text.span_hashes(raw, last, last - block + 1 + size)
                name = text.mix(core + text.mix(place[first].astype(np.uint64)) + np.array([key], np.int64).view(np.uint64))
                whole = text.span_hashes(raw, first, first + count - 1 + size)
                m = len(first)
                yield _batch(key2=name.view(np.int64), seg2=whole.view(np.int64), key=np.full(m, key), seg=np.full(m, seg),
                             first=first.astype(np.int32), starts=count.astype(np.int32), n=np.full(m, n),
                             data=pa.array([data[a:a + c - 1 + size] for a, c in zip(first.tolist(), count.tolist())], pa.binary()))
    return run


def _strings(size):
    """Every single string of the blocks, by hash."""
    def run(batches):
        for batch in batches:
            for key2, key, seg, first, starts, n, data in zip(*(batch.column(c).to_pylist() for c in (
                    "key2", "key", "seg", "first", "starts", "n", "data"))):
                at = np.arange(starts)
                h = text.span_hashes(np.frombuffer(data, np.uint8), at, at + size)
                yield _batch(string=h.view(np.int64), key2=np.full(starts, key2), key=np.full(starts, key), seg=np.full(starts, seg),
                             low=(first + at).astype(np.int32), n=np.full(starts, n))
    return run


_MARKS = "key long, seg long, low int, high int"


def _sorted_marks(parts: DataFrame, size: int, shard: int) -> DataFrame:
    """Marks of the segments (key, seg, starts, data) of ``parts`` by suffix arrays of its shards."""
    total = parts.agg(F.sum(F.length("data"))).first()[0] or 0
    shards = max(1, -(-total // shard))
    return parts.select("key", "seg", "starts", "data", F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard")).groupBy(
        "shard").applyInArrow(_sort_shard(size), _MARKS)


def _grouped(segs: DataFrame) -> DataFrame:
    """Different segments (key, seg, n, ...) whose key occurs twice or more, with how many the key has."""
    keys = segs.groupBy("key").agg(F.count(F.lit(1)).alias("different"), F.sum("n").alias("_total")).where("_total > 1")
    return common.stored(segs.join(keys.drop("_total"), "key"))


def _whole(t: DataFrame) -> DataFrame:
    return t.where("n > 1").select("key", "seg", F.lit(0).alias("low"), F.col("starts").alias("high"))


def marks(docs: DataFrame, size: int = SIZE, gram: int = GRAM, group: int = GROUP, shard: int = SHARD,
          block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Occurrences of segments in numbered ``docs`` (row, text), and (key, seg, low, high) of repeated starts in them."""
    occ = common.stored(docs.select("row", "text").mapInArrow(
        _occurrences(size, gram), "key long, seg long, row long, start int, starts int"))
    t = _grouped(occ.groupBy("key", "seg").agg(F.count(F.lit(1)).alias("n"), F.first("row").alias("row"),
                                               F.first("start").alias("start"), F.first("starts").alias("starts")))
    want = common.stored(t.where("different > 1").groupBy("row").agg(
        F.collect_list(F.struct("key", "seg", "start", "starts", "n", "different")).alias("want")))
    parts = common.stored(_likely(docs.select("row", "text"), want).join(want, "row").mapInArrow(
        _cut(size), "key long, seg long, starts int, n long, different long, data binary"))
    out = _whole(t).union(_sorted_marks(parts.where(F.col("different") <= group), size, shard))
    b = common.stored(parts.where(F.col("different") > group).mapInArrow(
        _blocks(size, gram, block), "key2 long, seg2 long, key long, seg long, first int, starts int, n long, data binary"))
    t2 = _grouped(b.groupBy(F.col("key2").alias("key"), F.col("seg2").alias("seg")).agg(
        F.sum("n").alias("n"), F.first("starts").alias("starts"), F.first("data").alias("data")))
    found = _whole(t2).union(_sorted_marks(t2.where(F.col("different").between(2, group)), size, shard))
    found = found.withColumnsRenamed({"key": "key2", "seg": "seg2"})
    out = out.union(b.drop("starts", "n", "data").join(found, ["key2", "seg2"]).select(
        "key", "seg", (F.col("first") + F.col("low")).alias("low"), (F.col("first") + F.col("high")).alias("high")))
    often = t2.where(F.col("different") > group).select(F.col("key").alias("key2")).distinct()
    s = common.stored(b.join(often, "key2").mapInArrow(
        _strings(size), "string long, key2 long, key long, seg long, low int, n long"))
    twice = s.groupBy("string", "key2").agg(F.sum("n").alias("n")).where("n > 1").drop("n")
    return occ, out.union(s.join(twice, ["string", "key2"]).select("key", "seg", "low", F.col("low") + 1))


def _removed(size, schema):
    def run(batches):
        for batch in batches:
            out = []
            for value, found in zip(batch.column("text"), batch.column("found")):
                data = (value.as_py() or "").encode()
                turn = np.zeros(len(data) + 1, np.int64)
                for f in found.as_py() or ():
                    for r in f["runs"]:
                        turn[f["start"] + r["low"]] += 1
                        turn[f["start"] + r["high"] - 1 + size] -= 1
                gone = np.cumsum(turn[:-1]) > 0
                spans = list(_runs(gone))
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                out.append((len(data), int(gone.sum()), [list(s) for s in spans], kept))
            cols = list(zip(*out)) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id")] + [
                pa.array(c, f.type) for c, f in zip(cols, list(schema)[2:])], schema=schema)
    return run


def _numbered_and_found(docs: DataFrame, size: int, gram: int, **options) -> tuple[DataFrame, DataFrame]:
    if not 0 < gram <= size:
        raise ValueError("an anchor must fit into a string")
    d = docs.select("doc_id", "text")
    kind = d.schema["doc_id"].dataType.simpleString()
    d = common.stored(d.mapInArrow(_numbered, f"row long, doc_id {kind}, text string"))
    occ, found = marks(d, size, gram, **options)
    runs = found.groupBy("key", "seg").agg(F.collect_list(F.struct("low", "high")).alias("runs"))
    return d, common.stored(occ.drop("starts").join(runs, ["key", "seg"]).groupBy("row").agg(
        F.collect_list(F.struct("start", "runs")).alias("found")))


def _kept(d: DataFrame, size: int) -> DataFrame:
    out = T.StructType([d.schema["row"], d.schema["doc_id"], *T.StructType.fromDDL(
        "n_bytes long, n_removed long, spans array<array<bigint>>, kept binary").fields])
    return d.mapInArrow(_removed(size, to_arrow_schema(out)), out)


def deduplicated(docs: DataFrame, size: int = SIZE, gram: int = GRAM, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, removed byte spans and kept bytes of every row."""
    d, found = _numbered_and_found(docs, size, gram, **options)
    return _kept(d.join(found, "row", "left"), size).drop("row")


def digests(docs: DataFrame, size: int = SIZE, gram: int = GRAM, **options) -> DataFrame:
    """The same with the kept bytes' SHA-256 in their place; only texts with something removed are moved."""
    d, found = _numbered_and_found(docs, size, gram, **options)
    hit = _kept(_likely(d, found).join(found, "row"), size).select(
        F.col("row").alias("_row"), "n_removed", "spans", F.sha2("kept", 256).alias("_kept"))
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    every = d.select("row", "doc_id", F.length(raw).cast("long").alias("n_bytes"), F.sha2(raw, 256).alias("_all"))
    return every.join(hit, F.col("row") == F.col("_row"), "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("spans", F.array().cast("array<array<bigint>>")).alias("spans"),
        F.coalesce("_kept", "_all").alias("kept_sha256"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(common.table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
