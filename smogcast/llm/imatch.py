"""I-Match document fingerprints over randomised lexicon subsets.

A term is a word (run of bytes other than space and 0x09-0x0D) in lower case
(A-Z), named by a 64-bit hash. The lexicon holds the terms whose inverse
document frequency lies within a band: found in at least one text of ``RARE``
and in at most one text of ``COMMON``. A text keeps its distinct lexicon terms,
sorted; they are hashed once as a whole and once for each of several random
subsets of the lexicon, so that a changed text still shares the hashes of the
subsets which hold none of the changed terms.

Subsets come in rungs. A rung of ``q`` slots deals every term to one slot by its
hash, and each of the rung's first slots is a subset: it holds 1/q of the
lexicon. Short and long texts so both find subsets that hold about one of their
terms. The likeness of two fingerprints is 1 if the whole hashes agree;
otherwise it is the share of agreeing subsets among those that hold a term of
either text, taken from the finest rungs that together give ``SEEN`` of them
(all rungs, if fewer do).

How the work is split:

* Document frequencies: one pass over the texts, each counted map-side over
  about a million (text, term) pairs before the shuffle.
* Lexicon on the driver and in every task: at most ``MOST`` terms (8 MB). The
  terms found in a share f of the texts are at most (distinct terms of an average
  text) / f, whatever the number of texts; f is 1/RARE, or more where texts are so
  long that the bound would be above ``MOST``.
* Neighbours: one range sort by doc_id moves each text once. Every task streams
  its sorted texts; the first and last text of a partition are written down and
  meet the neighbouring partitions' by a join (two texts a partition).
* Very long texts are read in pieces that end between words.

Edge cases: a null text is empty; an empty text has a fingerprint of zeros, alike
only to another text without words; a text without a lexicon term is
fingerprinted by all its terms; a null doc_id comes first; rows with the same
doc_id are ordered by a hash of their texts (repeated rows are alike); the only
row of a table is its own next document; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogcast.llm import common
from smogcast.llm.text import CHUNK_BYTES, IS_SPACE, buffers, lower, mix, pieces, span_hashes, words

RARE, COMMON = 2000, 5
MOST = 1 << 20
SEEN = 16
#: (slots of a rung, as bits; subsets taken of them), coarse to fine.
RUNGS = ((2, 4), (4, 16), (6, 16), (8, 16), (10, 16), (12, 16))
SUBSETS = sum(s for _, s in RUNGS)
PAIRS = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _slices(raw: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pieces of about ``CHUNK_BYTES`` that end at a row's end or a space."""
    a = 0
    while a < len(raw):
        z = min(a + CHUNK_BYTES, len(raw))
        end = int(at[np.searchsorted(at, z)])
        while z < end and not IS_SPACE[raw[z]]:
            space = np.flatnonzero(IS_SPACE[raw[z:min(end, z + 65536)]])
            z = z + int(space[0]) if len(space) else min(end, z + 65536)
        yield a, z
        a = z


def terms(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct terms of each row, sorted."""
    rows, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for a, z in _slices(raw, at):
        piece = lower(raw[a:z])
        starts, ends, row = words(piece, np.clip(at, a, z) - a)
        rows.append(row)
        hashes.append(span_hashes(piece, starts, ends))
        if len(rows) > 2:  # a long text: its distinct terms so far
            rows[:], hashes[:] = ([x] for x in _distinct(np.concatenate(rows), np.concatenate(hashes)))
    return _distinct(np.concatenate(rows), np.concatenate(hashes))


def _distinct(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, number of texts it is in), each over many texts; term 0 counts the texts."""
    held, n, texts = [], 0, 0

    def counted():
        term, count = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(np.append(term.view(np.int64), 0)), pa.array(np.append(count, texts))],
                                          ["term", "n"])

    for batch, raw, at in pieces(batches):
        held.append(terms(raw, at)[1])
        n, texts = n + len(held[-1]), texts + batch.num_rows
        if n >= PAIRS:
            yield counted()
            held, n, texts = [], 0, 0
    yield counted()


def lexicon(docs: DataFrame, rare: float = RARE, common_share: float = COMMON, most: int = MOST) -> np.ndarray:
    """Sorted hashes of the terms within the band; ``most`` of them at most."""
    df = common.stored(docs.select("text").mapInArrow(_count_terms, "term long, n long")
                       .groupBy("term").agg(F.sum("n").alias("n")))
    texts, pairs = df.agg(F.coalesce(F.sum(F.when(F.col("term") == 0, F.col("n"))), F.lit(0)),
                          F.coalesce(F.sum(F.when(F.col("term") != 0, F.col("n"))), F.lit(0))).first()
    least = max(texts / rare, pairs / most)
    kept = df.where((F.col("term") != 0) & (F.col("n") >= least) & (F.col("n") <= texts / common_share))
    return np.sort(kept.select("term").toPandas()["term"].to_numpy(np.int64).view(np.uint64))


def fingerprints(texts: list[str], lex: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the whole sorted term list, hashes of its part in each subset) per text; zero where there is no term."""
    n = len(texts)
    rows, h = terms(*buffers(pa.array(texts, pa.large_string())))
    inside = lex[np.minimum(np.searchsorted(lex, h), len(lex) - 1)] == h if len(lex) else np.zeros(len(h), bool)
    none = np.bincount(rows[inside], minlength=n) == 0
    keep = inside | none[rows]
    rows, h = rows[keep], h[keep]
    whole, parts = _list_hashes(rows, h, n), np.zeros((n, SUBSETS), np.uint16)
    dealt, shift, first = mix(h + _STEP), 0, 0
    for bits, subsets in RUNGS:
        slot = (dealt >> np.uint64(shift)).astype(np.int64) & ((1 << bits) - 1)
        mine = np.flatnonzero(slot < subsets)
        group = rows[mine] * subsets + slot[mine]
        order = np.argsort(group, kind="stable")  # terms stay sorted inside a group
        part = _list_hashes(group[order], h[mine[order]], n * subsets)
        parts[:, first:first + subsets] = np.where(part > 0, np.maximum(part >> np.uint64(48), 1), 0).reshape(n, subsets)
        shift, first = shift + bits, first + subsets
    return whole, parts


def _list_hashes(group: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of the list of terms of each group (sorted by group); zero for an empty one."""
    out = np.zeros(n, np.uint64)
    if len(group):
        starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        sizes = np.diff(np.append(starts, len(group)))
        place = (np.arange(len(group)) - np.repeat(starts, sizes)).astype(np.uint64)
        sums = np.add.reduceat(mix(h + place * _STEP), starts)
        out[group[starts]] = np.maximum(mix(sums + sizes.astype(np.uint64)), np.uint64(1))
    return out


def written(whole: np.ndarray, parts: np.ndarray) -> list[str]:
    """Fingerprints as text: 16 hex digits of the whole, then four for each subset."""
    both = np.concatenate([whole.astype(">u8").view(np.uint8).reshape(-1, 8), parts.astype(">u2").view(np.uint8).reshape(len(parts), -1)], axis=1)
    return [row.tobytes().hex() for row in both]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], seen: int = SEEN) -> np.ndarray:
    """0 to 1 for each pair of fingerprints."""
    (whole_a, parts_a), (whole_b, parts_b) = a, b
    filled = (parts_a != 0) | (parts_b != 0)
    agree, held, last = np.zeros(len(whole_a)), np.zeros(len(whole_a)), SUBSETS
    for _, subsets in reversed(RUNGS):
        more = held < seen
        rung = slice(last - subsets, last)
        held += more * filled[:, rung].sum(axis=1)
        agree += more * ((parts_a[:, rung] == parts_b[:, rung]) & filled[:, rung]).sum(axis=1)
        last -= subsets
    return np.where(whole_a == whole_b, 1.0, agree / np.maximum(held, 1))


def edited(text: str, after: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of ``after`` (or all of it)."""
    k = len(text) // 2
    return text[:len(text) - k] + after[:k]


FINGERPRINT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
               "near_edited double, near_next double")
_ROW = f"{FINGERPRINT}, part int, head string, tail string"


def _compared(ids: list, texts: list[str], afters: list[str], lex: np.ndarray) -> list[list]:
    """Columns of ``FINGERPRINT``; ``afters`` are the next documents' texts."""
    same = len(texts) > 1 and afters[:-1] == texts[1:]
    own = fingerprints([*texts, afters[-1]] if same else [*texts, *afters], lex)
    n = len(texts)
    mine, following = [x[:n] for x in own], [x[1:] if same else x[n:] for x in own]
    changed = [edited(t, a) for t, a in zip(texts, afters)]
    other = fingerprints(changed, lex)
    return [ids, [len(t) for t in texts], [sha256(t.encode()).hexdigest() for t in changed], written(*mine), written(*other),
            likeness(mine, other).tolist(), likeness(mine, following).tolist()]


def _sorted_rows(lex):
    """Each row against the next of its sorted partition; the last one only leaves its text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lex.value
        schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), *[(c, pa.string()) for c in (
            "edited_sha256", "fingerprint", "edited_fingerprint")], ("near_edited", pa.float64()), ("near_next", pa.float64()),
            ("part", pa.int32()), ("head", pa.string()), ("tail", pa.string())])

        def out(columns, part, head=None, tail=None):
            n = len(columns[0])
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(
                [*columns, [part] * n, [head] + [None] * (n - 1), [None] * (n - 1) + [tail]], schema)], schema=schema)

        ids, texts, size, first, part = [], [], 0, None, None
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text or ""
                if part is None:
                    first, part = text, batch.column(2)[0].as_py()
                ids.append(doc)
                texts.append(text)
                size += len(text)
                if size >= CHUNK_BYTES and len(texts) > 1:
                    yield out(_compared(ids[:-1], texts[:-1], texts[1:], known), part, first)
                    ids, texts, size, first = ids[-1:], texts[-1:], len(text), None
        if len(texts) > 1:
            yield out(_compared(ids[:-1], texts[:-1], texts[1:], known), part, first)
            first = None
        if texts:
            yield out([ids[-1:], *[[None]] * 6], part, first, texts[-1])
    return run


def _ends(lex):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                columns = _compared([row["doc_id"]], [row["tail"]], [row["after"]], lex.value)
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, (
                    pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()))],
                    FINGERPRINT.replace(" long", "").replace(" string", "").replace(" double", "").split(", "))
    return run


def fingerprinted(docs: DataFrame, lex: np.ndarray) -> DataFrame:
    """``FINGERPRINT`` of every row of ``docs`` (doc_id, text), each against its edited text and the next document."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(lex)
    keys = [F.col("doc_id").asc_nulls_first(), F.col("tie"), F.col("row")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"),
                       F.monotonically_increasing_id().alias("row"))
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text", F.spark_partition_id().alias("part"))
    done = common.stored(rows.mapInArrow(_sorted_rows(shared), _ROW))
    parts = sorted(r["part"] for r in done.where("head IS NOT NULL").select("part").collect())  # ids of partitions
    after = spark.createDataFrame([(p, q) for p, q in zip(parts, parts[1:] + parts[:1])], "part int, following int")
    heads = done.where("head IS NOT NULL").select(F.col("part").alias("following"), F.col("head").alias("after"))
    ends = done.where("tail IS NOT NULL").select("doc_id", "part", "tail").join(after, "part").join(heads, "following").select(
        "doc_id", "tail", "after").mapInArrow(_ends(shared), FINGERPRINT)
    return done.where("tail IS NULL").drop("part", "head", "tail").union(ends)


def op12_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, with their likeness and that to the next document."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return fingerprinted(docs, lexicon(docs))
