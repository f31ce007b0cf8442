"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits (the last padded
with zeros). With two differing bits at most, by pigeonhole one segment is equal
and the next one (in the circle A, B, C) differs in one bit at most: all six
ways of dealing two errors to three segments are covered by the three pairs
(A equal, B near), (B equal, C near), (C equal, A near).

"Near" is a lookup in the perfect binary Golay code: each 23-bit word is within
three bits of one codeword only. A word is filed under its codeword. It is looked
up under its codeword and, if three bits away, also under the five codewords four
bits away; a neighbour one bit off is filed under one of these. So a fingerprint
has three index rows and about sixteen lookups, and every link shares a key.

Candidates of small keys are joined and verified by bit distance. A key with more
than ``HOT`` indexed fingerprints would give a square of pairs; its members are
linked by midpoints instead: two words differ in two bits at most exactly if some
word is within one bit of both, so each member goes to its 65 words at distance
0 or 1 and is tied to the smallest member met there (verified by distance too).
That gives the same connected components with 65 rows a member.

Edge cases: null and empty texts have fingerprint zero and link like others;
repeated rows share a fingerprint and are linked; an empty table gives no rows;
other columns are not read. Component ids are smallest doc_ids; a null doc_id
gets its group's smallest id (null if it has none).
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smogcast.llm import common
from smogcast.llm.bloom import without

SHINGLE, BITS, SEED = 3, 2, 42
HOT = 64
WIDTHS = ((0, 23), (23, 23), (46, 18))
GENERATOR = 0b101011100011  # x^11+x^9+x^7+x^6+x^5+x+1, the Golay code's polynomial


def fingerprint(value: str | None, shingle: int = SHINGLE) -> int:
    tokens = (value or "").encode().lower().split()
    if not tokens:
        return 0
    joined, ends, at = b" ".join(tokens), [], -1
    for t in tokens:
        at += len(t) + 1
        ends.append(at)
    k = min(shingle, len(tokens))
    starts = [0, *[e + 1 for e in ends[:len(ends) - k]]]
    h = xxhash.xxh64_intdigest
    values = np.array([h(joined[a:z], SEED) for a, z in zip(starts, ends[k - 1:])], dtype="<u8")
    ones = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(values), bitorder="little").tobytes(), "little")


def _fingerprints(shingle):
    def run(batches):
        for batch in batches:
            out = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("text")], np.uint64)
            yield batch.drop_columns(["text"]).append_column("fp", pa.array(out.view(np.int64)))
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, *keep: str) -> DataFrame:
    """doc_id, ``keep`` and the fingerprint of every row, its bits read as a signed number."""
    d = docs.select("doc_id", *keep, "text")
    return d.mapInArrow(_fingerprints(shingle), T.StructType(
        [f for f in d.schema if f.name != "text"] + [T.StructField("fp", T.LongType())]))


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words modulo GENERATOR."""
    r = words.astype(np.int64)
    for bit in range(22, 10, -1):
        r = np.where((r >> bit) & 1 == 1, r ^ (GENERATOR << (bit - 11)), r)
    return r


@cache
def golay() -> tuple[np.ndarray, np.ndarray]:
    """Error pattern of each of the 2048 syndromes, and the weight-4 patterns of each (-1 where fewer than 5).

    A word at distance three from its codeword has five codewords at distance
    four: one for each weight-4 pattern with the word's syndrome.
    """
    bits = 1 << np.arange(23)
    error, fours = np.zeros(2048, np.int64), [[] for _ in range(2048)]
    for k in range(1, 5):
        masks = np.array([sum(c) for c in combinations(bits.tolist(), k)])
        for m, s in zip(masks.tolist(), _syndromes(masks).tolist()):
            if k < 4:
                error[s] = m
            else:
                fours[s].append(m)
    return error, np.array([(f + [-1] * 5)[:5] if len(f) == 5 else [-1] * 5 for f in fours])


def _segment(fp: np.ndarray, i: int) -> np.ndarray:
    low, width = WIDTHS[i]
    return ((fp >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64)


def keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, position in ``fp``, filed) rows: three filed rows each, and the lookups."""
    error, fours = golay()
    out = []
    here = np.arange(len(fp))
    for i in range(3):
        equal, near = _segment(fp, i), _segment(fp, (i + 1) % 3)
        s = _syndromes(near)
        head = (np.int64(i) << 46) | (equal << 23)
        # A codeword is named by its bits; those of a padded segment may leave the segment, which does no harm.
        own = head | (near ^ error[s])
        out += [(own, here, True), (own, here, False)]
        for j in range(5):
            ok = fours[s, j] >= 0
            out.append((head[ok] | (near[ok] ^ fours[s, j][ok]), here[ok], False))
    return (np.concatenate([k for k, _, _ in out]), np.concatenate([p for _, p, _ in out]),
            np.concatenate([np.full(len(k), f) for k, _, f in out]))


def _keys(batches):
    for batch in batches:
        fp = batch.column("fp").to_numpy()
        key, at, filed = keys(fp.view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[at]), pa.array(filed)], ["key", "fp", "filed"])


def _midpoints(batches):
    flips = np.concatenate([[np.uint64(0)], np.uint64(1) << np.arange(64, dtype=np.uint64)])
    for batch in batches:
        fp = batch.column("fp").to_numpy()
        for a in range(0, len(fp), 4096):
            part = fp[a:a + 4096]
            mid = (part.view(np.uint64)[:, None] ^ flips[None, :]).ravel().view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(mid), pa.array(np.repeat(part, 65))], ["mid", "fp"])


def links(fps: DataFrame, bits: int = BITS, hot: int = HOT) -> DataFrame:
    """Verified links (src, dst) that connect all distinct fingerprints ``fp`` at ``bits`` (0 to 2) or fewer bits."""
    if not 0 <= bits <= 2:
        raise ValueError("the segments cover two differing bits")
    k = common.stored(fps.select("fp").mapInArrow(_keys, "key long, fp long, filed boolean"))
    filed = k.where("filed").select("key", F.col("fp").alias("src"))
    looked = k.where("not filed").select("key", F.col("fp").alias("dst"))
    n = filed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    big = common.stored(n.where(F.col("n") > hot).select("key"))
    small = filed.join(big, "key", "left_anti").join(looked, "key")
    near = F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= bits
    pairs = small.where((F.col("src") < F.col("dst")) & near).select("src", "dst")
    members = k.join(big, "key", "left_semi").select("fp").distinct()
    mids = common.stored(members.mapInArrow(_midpoints, "mid long, fp long"))
    least = mids.groupBy("mid").agg(F.min("fp").alias("src"), F.max("fp").alias("_top")).where("src < _top").drop("_top")
    ties = mids.join(least, "mid").select("src", F.col("fp").alias("dst")).where("src <> dst").where(near)
    if bits < 2:  # midpoints stand for two bits: fewer are compared at word and flip
        ties = mids.join(fps.select(F.col("fp").alias("mid")), "mid", "left_semi").select(
            F.col("mid").alias("src"), F.col("fp").alias("dst")).where("src <> dst").where(near)
    return pairs.union(ties).distinct()


def _groups(each: DataFrame, bits: int) -> DataFrame:
    """(fp, group, component_id) for (fp, first): linked fingerprints and the smallest id among them."""
    comp = common.components(links(each, bits))
    low = common.stored(each.join(comp.withColumnRenamed("id", "fp"), "fp", "left").select(
        "fp", F.coalesce("component_id", "fp").alias("group"), "first"))
    names = low.groupBy("group").agg(F.min("first").alias("component_id"))
    return common.stored(low.drop("first").join(names, "group"))


def grouped(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """doc_id, fp and component_id of every row."""
    d = common.stored(fingerprints(docs, shingle))
    each = common.stored(d.groupBy("fp").agg(F.min("doc_id").alias("first")))
    return d.join(_groups(each, bits).drop("group"), "fp")


def representatives(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """One row of each group of linked rows: one of its smallest doc_id."""
    d = common.numbered(docs, "doc_id", "text")
    f = common.stored(fingerprints(d, shingle, "_row"))
    each = common.stored(f.groupBy("fp").agg(F.min("doc_id").alias("first")))
    member = common.stored(f.join(_groups(each, bits), "fp").select(
        "_row", "group", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("least")))
    one = member.where("least").groupBy("group").agg(F.min("_row").alias("_row"))
    others = common.stored(member.join(one.select("_row"), "_row", "left_anti").select("_row"))
    return without(d, others, "_row").drop("_row").toDF(*docs.columns)


def op7_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = grouped(common.table(spark, sf_dir, "documents"))
    return g.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
