"""The Merkle manifest against trees built node by node in plain Python."""

import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from smogcast.llm import common, merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, idx long, g long"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(doc, text):
    shown = [None if v is None else str(v) for v in (doc[0], doc[3], doc[2], doc[4], text)]
    return h(*["-" if v is None else f"{len(v.encode())}:{v}" for v in shown])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def path(tree, i):
    for level in tree[:-1]:
        first = i - i % 3
        yield level[first:i], level[i + 1:first + 3]
        i //= 3


def plain(rows):
    sources = {}
    for r in rows:
        sources.setdefault("" if r[3] is None else "s" + r[3], []).append(r)
    trees = {}
    for s in sorted(sources, key=str.encode):
        own = sorted(sources[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[s] = own, levels([leaf(r, r[1]) for r in own])
    top = levels([t[-1][0] for _, t in trees.values()])
    out = Counter()
    for rank, (own, tree) in enumerate(trees.values()):
        for i, r in enumerate(own):
            text = r[1]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            pairs = [*path(tree, i), *path(top, rank)]
            folded = leaf(r, text)
            for before, after in pairs:
                folded = h(*before, folded, *after)
            proof = h(*[x for before, after in pairs for x in [*before, *after]])
            out[(r[0], tree[0][i], tree[-1][0], top[-1][0], proof, folded, folded == top[-1][0])] += 1
    return out


def run(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return Counter(tuple(r) for r in merkle.proofs(merkle.manifest(docs, merkle.tampered(docs))).collect())


def row(i, text, source):
    return (i, text, "en" if i is None or i % 3 else None, source, i, "x", 0, 0)


@pytest.fixture(scope="module")
def rows():
    big = [row(i, f"text {i}\nß\n{i % 7}", "hot") for i in range(2300)]      # four blocks, an incomplete last run
    many = [row(5000 + i, f"line\n{i}", f"é{i}") for i in range(900)]        # more sources than one block of the top tree
    odd = [row(None, "no id\n", "hot"), row(None, None, None), row(7, "", None), row(9, "\n", None), big[3], big[3],
           row(-4, "y" * 300_000, "long"), row(-6, "\n\n", "hot"), row(11, "same id", "hot"), row(12, None, "long")]
    return big + many + odd


def test_every_proof_of_a_large_and_of_many_small_sources(spark, rows):
    assert run(spark, rows) == plain(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 10])
def test_small_trees(spark, n):
    rows = [row(i, f"a\n{i}", "s") for i in range(n)]
    assert run(spark, rows) == plain(rows)


def test_one_row_sources_and_an_empty_table(spark):
    rows = [row(i, "a", f"s{i}") for i in range(4)]
    got = run(spark, rows)
    assert got == plain(rows) and all(r[1] == r[2] and r[6] for r in got)
    empty = merkle.manifest(spark.createDataFrame([], SCHEMA))
    assert empty.root() is None and merkle.proofs(empty).count() == 0


def test_requests_are_the_least_that_rebuild_the_root():
    rng = np.random.default_rng(3)
    for width in (2, 5, 27, 100):
        tree = levels([h(str(i)) for i in range(width)])
        known = np.flatnonzero(rng.random(width) < 0.2)
        if not len(known):
            known = np.array([width - 1])
        asked = {(level, int(i)) for level, idx in merkle.missing(known, 0, width) for i in idx}
        fetched = {}
        for level, i in asked:
            fetched.setdefault(level, {})[i] = tree[level][i].encode()
        below = {int(i): tree[0][i].encode() for i in known}
        assert merkle._derived(below, width, fetched)[1].decode() == tree[-1][0]
        for gone in asked:  # without any of them it can't be done
            less = {lv: {i: d for i, d in own.items() if (lv, i) != gone} for lv, own in fetched.items()}
            with pytest.raises((KeyError, TypeError)):
                merkle._derived(below, width, less)


def test_a_changed_row_folds_to_another_root(spark):
    docs = spark.createDataFrame([row(i, f"t{i}", "s") for i in range(20)], SCHEMA)
    made = merkle.manifest(docs, F.when(F.col("doc_id") == 5, F.lit("forged")).otherwise(F.col("text")))
    got = {r["doc_id"]: r["verified"] for r in merkle.proofs(made).collect()}
    assert got == {i: i != 5 for i in range(20)}
    same = merkle.manifest(common.stored(docs.repartition(7)))
    assert same.root() == made.root()
