"""Merkle dataset manifest with octopus multiproofs.

Every row is a leaf: SHA-256 over its fields, each written with its length. The
leaves of a source, ascending by doc_id, form a tree of fan-out ``FAN`` (every
run of three becomes one node, the last run may be shorter); the roots of the
sources, in order of the source, form one more tree, whose root is the
manifest's. Digests enter as lowercase hex text.

How the work is split:

* Texts never move: digests of the row as it is, and of the row it is to be
  checked against, are taken where the table is read.
* Positions come from one range sort of the narrow rows over (source, doc_id),
  counted inside each partition and shifted by the totals of the partitions
  before. So a source of any size lies in many partitions.
* Trees grow by blocks of ``FAN ** LEVELS`` neighbouring nodes: a block is one
  subtree, and its top node goes on. Small sources share a group, a large one
  has many. Only nodes above the blocks are stored.
* Leaf partitions hold whole blocks. Each works out the minimal union of node
  coordinates that its leaves' proofs lack (the octopus algorithm), fetches
  them by one join, derives all shared interior nodes once and reads every
  single proof off them. Memory is bounded by the blocks that meet in a group
  (one on average), whatever the size of the source. Nodes near the root are
  asked for by every leaf partition; that join may be split like any other.

Edge cases: a null field counts as ``-``; a null source is a source of its own,
the first; a null doc_id comes before all others and is never tampered with;
rows with the same doc_id are ordered by their digests, so repeated rows have
equal leaves and proofs of neighbouring places; a source of one row has that
leaf as its root, a table of one source that source's root; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from smogcast.llm import common

FAN = 3
LEVELS = 6
BLOCK = FAN ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = "t"  # the tree over the sources; theirs begin with s, or are n for the null source
_NODE = "tree string, level int, idx long, width long, digest string"


def leaf(fields: dict[str, Column]) -> Column:
    """SHA-256 over the fields in order, each with its length in bytes; ``-`` for a null."""
    shown = [c.cast("string") for c in fields.values()]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
                             for c in shown]), 256)


def tampered(docs: DataFrame) -> Column:
    """The text without line breaks where 2 divides the CRC-32 of the decimal doc_id."""
    hit = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return F.when(hit, F.translate("text", "\n", "")).otherwise(F.col("text"))


def _positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Position of each row among those of its tree in this sorted partition."""
    last, seen = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        trees = batch.column(batch.schema.get_field_index("tree")).to_numpy(zero_copy_only=False)
        new = np.append(True, trees[1:] != trees[:-1])
        starts = np.flatnonzero(new)
        at = np.arange(len(trees)) - starts[np.cumsum(new) - 1]
        if trees[0] == last:
            at[:starts[1] if len(starts) > 1 else len(at)] += seen
        last, seen = trees[-1], int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64())], [*batch.schema.names, "at"])


def ranked(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` (tree, ...) with their position ``idx`` in the tree by ``order`` and the tree's ``size``."""
    keys = [F.col("tree"), *[F.col(c).asc_nulls_first() for c in order]]
    placed = (rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
              .withColumn("part", F.spark_partition_id()))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema.fields)
    placed = common.stored(placed.mapInArrow(_positions, f"{kinds}, at long"))
    tally = placed.groupBy("tree", "part").agg((F.max("at") + 1).alias("n"))
    tree = Window.partitionBy("tree")
    tally = tally.select("tree", "part", F.sum("n").over(tree).alias("size"), F.coalesce(F.sum("n").over(
        tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return placed.join(tally, ["tree", "part"]).withColumn("idx", F.col("at") + F.col("before")).drop("at", "part", "before")


def _hash(nodes: list[bytes]) -> bytes:
    return sha256(b"".join(nodes)).hexdigest().encode()


def _runs(table: pa.Table, *keys: str) -> Iterator[tuple[tuple, pa.Table]]:
    """Parts of ``table`` with equal keys, each sorted by idx."""
    table = table.sort_by([*[(k, "ascending") for k in keys], ("idx", "ascending")])
    cols = [table.column(k).to_numpy() for k in keys]
    new = np.ones(table.num_rows, bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
    cuts = [*np.flatnonzero(new).tolist(), table.num_rows]
    for a, z in zip(cuts, cuts[1:]):
        yield tuple(c[a] for c in cols), table.slice(a, z - a)


def _parents(level: dict[int, bytes], width: int, others: dict | None = None) -> dict[int, bytes]:
    """The nodes above ``level`` (idx -> digest); children that are not in it come from ``others``."""
    out = {}
    for p in dict.fromkeys(i // FAN for i in level):
        kids = range(p * FAN, min(p * FAN + FAN, width))
        out[p] = _hash([level[i] if i in level else others[i] for i in kids])
    return out


def _subtrees(least: int):
    def grow(table: pa.Table) -> pa.Table:
        out = {c: [] for c in ("tree", "level", "idx", "width", "digest")}
        table = table.append_column("block", pa.array(table.column("idx").to_numpy() // BLOCK))
        for (tree, _), run in _runs(table, "tree", "block"):
            low, width = run.column("level")[0].as_py(), run.column("width")[0].as_py()
            level = {i: d.encode() for i, d in zip(run.column("idx").to_pylist(), run.column("digest").to_pylist())}
            for step in range(LEVELS + 1):
                if (low + step >= least and (step or not low)) or width == 1:
                    for i, d in level.items():
                        for c, v in zip(out, (tree, low + step, i, width, d.decode())):
                            out[c].append(v)
                if width == 1 or step == LEVELS:
                    break
                level, width = _parents(level, width), -(-width // FAN)
        return pa.table({"tree": pa.array(out["tree"], pa.string()), "level": pa.array(out["level"], pa.int32()),
                         "idx": pa.array(out["idx"], pa.int64()), "width": pa.array(out["width"], pa.int64()),
                         "digest": pa.array(out["digest"], pa.string())})
    return grow


def _group(n: int) -> Column:
    """Number of the group that holds a block; ``n`` nodes in all, a block a group on average."""
    return F.pmod(F.xxhash64("tree", F.expr(f"idx div {BLOCK}")), F.lit(max(1, -(-n // BLOCK))))


def nodes(leaves: DataFrame, least: int) -> DataFrame:
    """(tree, level, idx, width, digest): the roots and all nodes from level ``least`` up, over (tree, size, idx, digest).

    ``width`` is the number of nodes of that level, 1 at a root.
    """
    cur = leaves.select("tree", F.lit(0).alias("level"), "idx", F.col("size").alias("width"), "digest")
    out, level = None, 0
    while True:
        n, widest = cur.agg(F.count(F.lit(1)), F.max("width")).first()
        made = common.stored(cur.withColumn("g", _group(n)).groupBy("g").applyInArrow(_subtrees(least), _NODE))
        out = made if out is None else out.union(made)
        level += LEVELS
        if not n or widest <= FAN ** LEVELS:
            return out
        cur = made.where((F.col("level") == level) & (F.col("width") > 1))


def missing(known: np.ndarray, level: int, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Octopus: the least set of nodes (level, indices) that the ``known`` ones of a level lack up to the root."""
    known = np.unique(known)
    while width > 1:
        parents = np.unique(known // FAN)
        kids = (parents[:, None] * FAN + np.arange(FAN)).ravel()
        yield level, np.setdiff1d(kids[kids < width], known, assume_unique=True)
        known, level, width = parents, level + 1, -(-width // FAN)


def _requests(table: pa.Table) -> pa.Table:
    """Coordinates that a leaf partition's whole blocks lack, in their trees and in the top one."""
    g, trees, levels, places = table.column("g")[0].as_py(), [], [], []
    asked = [(tree, part.column("idx").to_numpy(), LEVELS, -(-part.column("size")[0].as_py() // BLOCK))
             for (tree,), part in _runs(table, "tree")]
    asked.append((TOP, table.column("rank").to_numpy(), 0, table.column("trees")[0].as_py()))
    for tree, known, level, width in asked:
        for at, idx in missing(known, level, width):
            trees += [tree] * len(idx)
            levels += [at] * len(idx)
            places.append(idx)
    return pa.table({"g": pa.array([g] * len(trees), pa.int64()), "tree": pa.array(trees, pa.string()),
                     "level": pa.array(levels, pa.int32()),
                     "idx": pa.array(np.concatenate(places) if places else [], pa.int64())})


def _derived(level: dict[int, bytes], width: int, fetched: dict[int, dict[int, bytes]]) -> tuple[list, bytes]:
    """([(known and fetched nodes, width) of each level below the root], root)."""
    levels, at = [], 0
    while width > 1:
        whole = {**fetched.get(at, {}), **level}
        levels.append((whole, width))
        level, width, at = _parents(level, width, whole), -(-width // FAN), at + 1
    return levels, level[0]


def _siblings(levels: list, idx: int) -> list[tuple[bytes, bytes]]:
    """(those to the left, those to the right), level by level, of the path from ``idx``."""
    out = []
    for whole, width in levels:
        first = idx - idx % FAN
        out.append((b"".join(whole[i] for i in range(first, idx)),
                    b"".join(whole[i] for i in range(idx + 1, min(first + FAN, width)))))
        idx //= FAN
    return out


def fold(digest: bytes, siblings: list[tuple[bytes, bytes]]) -> bytes:
    """The root that ``digest`` leads to with these siblings."""
    for before, after in siblings:
        digest = _hash([before, digest, after])
    return digest


def _prove(leaves: pa.Table, nodes: pa.Table) -> pa.Table:
    """Single proofs of a leaf partition's rows, read off the tree nodes derived from them and the fetched ones."""
    fetched: dict[str, dict[int, dict[int, bytes]]] = {}
    for tree, level, idx, digest in zip(*[nodes.column(c).to_pylist() for c in ("tree", "level", "idx", "digest")]):
        fetched.setdefault(tree, {}).setdefault(level, {})[idx] = digest.encode()
    runs, tops = [], {}
    for (tree,), run in _runs(leaves, "tree"):
        own = dict(zip(run.column("idx").to_pylist(), (d.encode() for d in run.column("leaf").to_pylist())))
        levels, subroot = _derived(own, run.column("size")[0].as_py(), fetched.get(tree, {}))
        rank = run.column("rank")[0].as_py()
        tops[rank] = subroot
        runs.append((run, levels, subroot, rank))
    top, root = _derived(tops, leaves.column("trees")[0].as_py(), fetched.get(TOP, {}))
    out = {c: [] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")}
    for run, levels, subroot, rank in runs:
        crown = _siblings(top, rank)
        upper: dict[int, list] = {}  # paths above a leaf's run, shared by its leaves
        for doc, idx, own, other in zip(*[run.column(c).to_pylist() for c in ("doc_id", "idx", "leaf", "other")]):
            p = idx // FAN
            if levels and p not in upper:
                upper = {p: _siblings(levels[1:], p) + crown}
            path = _siblings(levels[:1], idx) + upper[p] if levels else crown
            folded = fold(other.encode(), path)
            for c, v in zip(out, (doc, own, subroot.decode(), root.decode(),
                                  sha256(b"".join(x for pair in path for x in pair)).hexdigest(),
                                  folded.decode(), folded == root)):
                out[c].append(v)
    return pa.table({c: pa.array(v, pa.int64() if c == "doc_id" else pa.bool_() if c == "verified" else pa.string())
                     for c, v in out.items()})


@dataclass
class Manifest:
    """``leaves``: doc_id, leaf, other, tree, idx, size, rank, trees, g; ``nodes``: as of :func:`nodes`, above the blocks."""
    leaves: DataFrame
    nodes: DataFrame

    def root(self) -> str | None:
        """The manifest's root; null for an empty table."""
        row = self.nodes.where(f"tree = '{TOP}' AND width = 1").first()
        return row["digest"] if row else None


def manifest(docs: DataFrame, other: Column | None = None) -> Manifest:
    """Trees over ``docs``; ``other`` is the text that each row is to be checked against (the row's own by default)."""
    fields = {c: F.col(c) for c in FIELDS}
    source = F.col("source")
    rows = common.stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source)).alias("tree"),
        leaf(fields).alias("leaf"), leaf({**fields, "text": fields["text"] if other is None else other}).alias("other"),
        F.monotonically_increasing_id().alias("row")))
    placed = ranked(rows, "doc_id", "leaf", "row").drop("row")
    trees = ranked(rows.select(F.lit(TOP).alias("tree"), F.col("tree").alias("name")).distinct(), "name").select(
        F.col("name").alias("tree"), F.col("idx").alias("rank"), F.col("size").alias("trees"))
    n = rows.count()
    leaves = common.stored(placed.join(trees, "tree").withColumn("g", _group(n)))
    own = nodes(leaves.withColumn("digest", F.col("leaf")), LEVELS)
    tops = own.where("width = 1").join(trees, "tree").select(
        F.lit(TOP).alias("tree"), F.col("rank").alias("idx"), F.col("trees").alias("size"), "digest")
    return Manifest(leaves, own.union(nodes(tops, 0)))


def proofs(made: Manifest) -> DataFrame:
    """One row per leaf: its proof's digest, and the root that its ``other`` leaf folds to with the same siblings."""
    blocks = made.leaves.groupBy("g", "tree", F.expr(f"idx div {BLOCK}").alias("idx")).agg(
        *[F.first(c).alias(c) for c in ("size", "rank", "trees")])
    asked = blocks.groupBy("g").applyInArrow(_requests, "g long, tree string, level int, idx long")
    fetched = asked.join(made.nodes.drop("width"), ["tree", "level", "idx"])
    return made.leaves.groupBy("g").cogroup(fetched.groupBy("g")).applyInArrow(
        _prove, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof, and whether its tampered form still folds to the root."""
    docs = common.table(spark, sf_dir, "documents")
    return proofs(manifest(docs, tampered(docs)))
