"""Embedding near-duplicates by a robust-pruned flat graph.

Equal vectors of a label are one node. The nodes of a (label, dimension) are a
shard; a shard above ``LARGEST`` nodes draws pivots from them, about one per
``SHARD`` and ``PIVOTS`` in all at a time, and a node goes to the shards of its
``overlap`` nearest pivots, again and again until shards are small. No two pivots
of a shard are linked, so a group of near-equal vectors keeps one pivot and stays
together. A shard that no longer shrinks above ``WHOLE`` nodes is dealt into blocks by hash, and every
two blocks are compared exactly in a task of their own, which gives counts of
links and a spanning forest, never the links. Each other shard
builds a flat graph with robust pruning, the adjacency lists of a node's shards
are united, and in every shard all members are searched greedily from the medoid
over the united lists; nodes in range are expanded until no new one is found.
Links are verified in double precision; one met in several shards counts once.
Components are taken over a spanning
forest of each shard's links, which grows with its nodes, not with its links.

The recall of every run is audited: ``AUDIT`` nodes or so, chosen by hash, are
compared with all rows in blocks; below ``LEAST_RECALL`` the build is repeated
with twice the overlap, and past ``MOST_OVERLAP`` all rows of a label are compared
in blocks, which finds every link at a cost that grows with the square of a label.

Edge cases: vectors that are null, empty, zero or hold a null or non-finite
component, and rows with a null label, link with nothing and are their own
component; vectors of different lengths don't link; repeated rows and copies link
with each other and share their links; an empty table gives no rows; other
columns are not read. A null vec_id is kept as null.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogcast.llm import common

COSINE = 0.93
SHARD, LARGEST, OVERLAP, PIVOTS, WIDTH = 80, 600, 3, 20_000, 8
WHOLE = 8 * LARGEST
DEGREE, POOL, ALPHA, BEAM = 20, 64, 1.2, 16
AUDIT, LEAST_RECALL, MOST_OVERLAP, SEED = 256, 0.95, 24, 5


def _matrix(column) -> np.ndarray:
    """Unit rows in double precision."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(1))[:, None]


def nodes(vectors: DataFrame) -> DataFrame:
    """(node, label, dim, vec, first, copies) of all vectors that can link; ``_row`` columns are the caller's."""
    ok = vectors.where("label is not null and embedding is not null and size(embedding) > 0").where(
        F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists("embedding", lambda x: x != 0))
    same = ok.groupBy("label", "embedding").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    return same.select(F.xxhash64("label", "embedding").alias("node"), "label", F.size("embedding").alias("dim"),
                       F.col("embedding").alias("vec"), "first", "copies")


def _nearest(pivots, overlap):
    """Deal every row of a shard to its ``overlap`` nearest pivots; pivots: {shard: [(number, unit vector)]}."""
    def run(batches):
        for batch in batches:
            shards = np.array(batch.column("shard").to_pylist(), object)
            keep, to = [], []
            for s in dict.fromkeys(shards.tolist()):
                at = np.flatnonzero(shards == s)
                names, p = pivots[s]
                if len(names) == 1:
                    keep.append(at)
                    to += [names[0]] * len(at)
                    continue
                near = _matrix(batch.column("vec").take(pa.array(at))) @ p.T
                k = min(overlap, len(names))
                best = np.argpartition(-near, k - 1, axis=1)[:, :k]
                keep.append(np.repeat(at, k))
                to += [names[j] for j in best.ravel()]
            if keep:
                rows = batch.take(pa.array(np.concatenate(keep)))
                yield rows.set_column(rows.schema.get_field_index("shard"), "shard", pa.array(to, pa.string()))
    return run


def unlinked(p: np.ndarray, cosine: float) -> np.ndarray:
    """Rows of ``p`` in their order, without those linked to an earlier row that stays."""
    kept = p[:0]
    for a in range(0, len(p), 512):
        new = p[a:a + 512]
        if len(kept):
            new = new[(new @ kept.T).max(1) < cosine]
        near, alive = new @ new.T >= cosine, np.ones(len(new), bool)
        for i in range(len(new)):
            if alive[i]:
                alive[i + 1:] &= ~near[i, i + 1:]
        kept = np.concatenate([kept, new[alive]])
    return kept


def _pivots(drawn: list, overlap: int, cosine: float) -> np.ndarray | None:
    """Pivots of a shard; None if it stays whole, being one group of near-equal vectors or two."""
    if not drawn:
        return None
    apart = unlinked(_matrix(pa.array(drawn)), cosine)
    return apart if len(apart) > overlap else None


def _deal(rows: DataFrame, sizes: dict[str, int], overlap: int, level: int, cosine: float) -> DataFrame:
    """Split the shards named in ``sizes`` by pivots of their own, about ``PIVOTS`` in all."""
    most = PIVOTS // len(sizes)
    share = F.create_map(*[F.lit(x) for s, n in sizes.items()
                           for x in (s, min(1.0, 1.2 * min(most, max(4 * overlap, -(-n // SHARD))) / n))])
    chance = F.pmod(F.xxhash64("node", F.lit(SEED + level)), F.lit(1 << 40)) / float(1 << 40)
    drawn = rows.where(chance < share[F.col("shard")]).select("shard", "node", "vec").collect()
    by_shard: dict = {}
    for r in sorted(drawn, key=lambda r: (r["shard"], r["node"])):
        by_shard.setdefault(r["shard"], []).append(r["vec"])
    pivots = {s: _pivots(by_shard.get(s, []), overlap, cosine) for s in sizes}
    table = {s: ([f"{s}/{j}" for j in range(1 if p is None else len(p))], p) for s, p in pivots.items()}
    return rows.mapInArrow(_nearest(table, overlap), rows.schema)


def _dealt(rows: DataFrame, overlap: int, cosine: float) -> DataFrame:
    """``rows`` in shards of at most about ``LARGEST`` nodes; one is split while its parts are clearly smaller."""
    parts, parents, level, before = [], {}, 0, rows
    while True:
        sizes = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > LARGEST)
        big, stuck = {}, set()
        for shard, m in sizes.toLocalIterator():
            parent = shard.rpartition("/")[0]
            if m < 0.75 * parents.get(parent, float("inf")):
                big[shard] = m
            elif m > WHOLE:
                stuck.add(parent)
        if stuck:  # compared in blocks once, as the parent, not once for each part that holds nearly all of it
            parts.append(before.where(F.col("shard").isin(list(stuck))))
            rows = rows.where(~F.regexp_replace("shard", "/[^/]*$", "").isin(list(stuck)))
            big = {s: m for s, m in big.items() if s.rpartition("/")[0] not in stuck}
        if not big:
            break
        parts.append(rows.where(~F.col("shard").isin(list(big))))
        names, step, dealt = sorted(big), max(1, PIVOTS // (4 * overlap)), []
        for a in range(0, len(names), step):
            some = {s: big[s] for s in names[a:a + step]}
            dealt.append(_deal(rows.where(F.col("shard").isin(list(some))), some, overlap, level, cosine))
        before, rows = rows, common.stored(reduce(DataFrame.union, dealt))
        parents, level = big, level + 1
    return common.stored(reduce(DataFrame.union, parts, rows))


def shards(n: DataFrame, overlap: int = OVERLAP, cosine: float = COSINE, exact: bool = False) -> DataFrame:
    """(shard, node, vec, copies, block, home, dense): overlapping shards of at most about ``WHOLE`` nodes.

    A larger one, or with ``exact`` every (label, dim), comes as a shard for every two of its blocks of about
    ``WHOLE`` / 4 nodes. There ``block`` is the node's and ``home`` names the whole; both are null elsewhere.
    ``dense`` are the homes of a node.
    """
    rows = n.select(F.concat_ws("/", F.col("label").cast("string"), "dim").alias("shard"), "node", "vec", "copies")
    rows = rows if exact else _dealt(rows, overlap, cosine)
    sizes = common.stored(rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > (0 if exact else WHOLE)))
    if sizes.isEmpty():
        return rows.select("*", F.lit(None).cast("long").alias("block"), F.lit(None).cast("long").alias("home"),
                           F.lit(None).cast("array<long>").alias("dense"))
    rows = rows.join(sizes, "shard", "left").withColumn("home", F.when(F.col("n").isNotNull(), F.xxhash64("shard")))
    homes = rows.where("home is not null").groupBy("node").agg(F.collect_set("home").alias("dense"))
    blocks = F.ceil(F.col("n") / F.lit(max(1, WHOLE // 4)))
    rows = common.stored(rows.withColumn("block", F.pmod(F.xxhash64("node", F.lit(SEED + 50)), blocks))
                         .withColumn("blocks", blocks).join(homes, "node", "left"))
    columns = ["shard", "node", "vec", "copies", "block", "home", "dense"]
    paired = rows.where("home is not null").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    paired = paired.withColumn("shard", F.concat_ws("|", "shard", F.least("block", "other").cast("string"),
                                                    F.greatest("block", "other").cast("string")))
    return rows.where("home is null").select(columns).union(paired.select(columns))


def prune(x: np.ndarray, i: int, pool: np.ndarray, near: np.ndarray) -> list[int]:
    """Robust pruning: take the nearest of ``pool``, drop what it is closer to by ``ALPHA`` than ``i`` is, go on."""
    gap = np.sqrt(np.maximum(0.0, 2 - 2 * near))
    order = np.argsort(gap, kind="stable")
    pool, gap = pool[order], gap[order]
    among = np.sqrt(np.maximum(0.0, 2 - 2 * (x[pool] @ x[pool].T)))
    alive, out = np.ones(len(pool), bool), []
    for j in range(len(pool)):
        if alive[j]:
            out.append(int(pool[j]))
            if len(out) == DEGREE:
                break
            alive &= ALPHA * among[j] > gap
    return out


def build(x: np.ndarray) -> list[list[int]]:
    """Adjacency lists of a shard: pruned nearest and far candidates, with edges both ways."""
    m = len(x)
    k = min(POOL, m - 1)
    rng = np.random.default_rng(SEED)
    far = rng.integers(0, m, (m, 16))
    out: list[set] = [set() for _ in range(m)]
    for a in range(0, m, 512):
        near = x[a:a + 512] @ x.T
        near[np.arange(len(near)), np.arange(a, a + len(near))] = -2
        if k:
            pool = np.argpartition(-near, k - 1, axis=1)[:, :k]
            for r in range(len(near)):
                c = np.unique(np.concatenate([pool[r], far[a + r]]))
                c = c[c != a + r]
                out[a + r].update(prune(x, a + r, c, near[r, c]))
    for i in range(m):
        for j in list(out[i]):
            out[j].add(i)
    lists = []
    for i, near_by in enumerate(out):
        c = np.fromiter(near_by, np.int64, len(near_by))
        lists.append(prune(x, i, c, x[c] @ x[i]) if len(c) > 2 * DEGREE else c.tolist())
    return lists


def _build(key, rows):
    names = rows.column("node").to_numpy()
    lists = build(_matrix(rows.column("vec")))
    return pa.table({"node": names, "near": pa.array([names[c].tolist() for c in lists], pa.list_(pa.int64()))})


def search(x: np.ndarray, near: np.ndarray, queries: np.ndarray, start: int, cosine: float) -> list[tuple]:
    """(query, found) arrays. ``near``: adjacency rows, -1 padded. Greedy beam, then every node in range is expanded."""
    q, m = len(queries), len(x)
    dots = np.full((q, m), -2.0)
    closed = np.zeros((q, m), bool)
    dots[:, start] = x[queries] @ x[start]
    slack = cosine - 0.02
    live = np.arange(q)
    while len(live):
        open_dots = np.where(closed[live], -3.0, dots[live])
        width = min(WIDTH, m)
        best = np.argpartition(-open_dots, width - 1, axis=1)[:, :width]
        value = np.take_along_axis(open_dots, best, 1)
        beam = min(BEAM, m)
        floor = np.partition(dots[live], m - beam, axis=1)[:, m - beam]
        # the beam is expanded from its best node on, nodes in range all at once
        go = (value > -2) & ((value >= slack) | ((value >= floor[:, None]) & (value == value.max(1, keepdims=True))))
        on = go.any(1)
        live, best, go = live[on], best[on], go[on]
        if not len(live):
            break
        r, c = np.nonzero(go)
        closed[live[r], best[r, c]] = True
        to = np.where(go[:, :, None], near[best], -1).reshape(len(live), -1)
        r, c = np.nonzero((to >= 0) & (dots[live[:, None], np.maximum(to, 0)] == -2))
        t = to[r, c]
        dots[live[r], t] = np.einsum("ij,ij->i", x[queries[live[r]]], x[t])
    r, c = np.nonzero(dots >= cosine)
    return queries[r], c, dots[r, c]


def forest(src: np.ndarray, dst: np.ndarray, m: int) -> np.ndarray:
    """Mask of the distinct links (src, dst) among ``m`` nodes that form a spanning forest of them."""
    ends, others = np.concatenate([src, dst]), np.concatenate([dst, src])
    order = np.argsort(ends, kind="stable")
    others, link = others[order], order % max(1, len(src))
    first = np.searchsorted(ends[order], np.arange(m + 1))
    seen, mask = np.zeros(m, bool), np.zeros(len(src), bool)
    for root in range(m):
        if seen[root]:
            continue
        seen[root] = True
        todo = [root]
        while todo:
            i = todo.pop()
            at = np.arange(first[i], first[i + 1])
            at = at[~seen[others[at]]]
            seen[others[at]] = True
            mask[link[at]] = True
            todo += others[at].tolist()
    return mask


def _search(cosine):
    def run(key, rows):
        names, x = rows.column("node").to_numpy(), _matrix(rows.column("vec"))
        place = {n: i for i, n in enumerate(names.tolist())}
        lists = [[place[t] for t in near if t in place] for near in rows.column("near").to_pylist()]
        near = np.full((len(x), max(1, max(map(len, lists)))), -1)
        for i, c in enumerate(lists):
            near[i, :len(c)] = c
        centre = x.mean(0)
        start = int((x @ centre).argmax())
        src, dst = [], []
        for a in range(0, len(x), 128):
            q, found, _ = search(x, near, np.arange(a, min(a + 128, len(x))), start, cosine)
            ok = q != found
            src.append(q[ok])
            dst.append(found[ok])
        s, d = np.concatenate(src), np.concatenate(dst)
        s, d = np.divmod(np.unique(np.minimum(s, d) * len(x) + np.maximum(s, d)), len(x))
        a, b = names[s], names[d]
        dense = [set(h or ()) for h in rows.column("dense").to_pylist()]
        counts = np.fromiter((dense[i].isdisjoint(dense[j]) for i, j in zip(s.tolist(), d.tolist())), bool, len(s))
        return pa.table({"src": np.minimum(a, b), "dst": np.maximum(a, b), "tree": forest(s, d, len(x)), "counts": counts})
    return run


def block_forest(near: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the links of ``near`` that form a spanning forest; ``same``: rows and columns are the same nodes."""
    p, q = near.shape
    shift = 0 if same else p
    seen, src, dst = np.zeros(p if same else p + q, bool), [], []
    for root in range(p):
        if seen[root]:
            continue
        seen[root] = True
        todo = [root]
        while todo:
            i = todo.pop()
            if i < p:
                to = np.flatnonzero(near[i] & ~seen[shift:])
                src.append(np.full(len(to), i))
                dst.append(to)
                to = to + shift
            else:
                to = np.flatnonzero(near[:, i - p] & ~seen[:p])
                src.append(to)
                dst.append(np.full(len(to), i - p))
            seen[to] = True
            todo += to.tolist()
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *src]), np.concatenate([none, *dst])


def _blocks(cosine):
    """Two blocks of a large shard: counts of links by node (``dst`` null) and a spanning forest of them."""
    def run(key, rows):
        names, x, copies = rows.column("node").to_numpy(), _matrix(rows.column("vec")), rows.column("copies").to_numpy()
        a, b = (int(i) for i in key[0].as_py().split("|")[-2:])
        block, home = rows.column("block").to_numpy(), rows.column("home")[0].as_py()
        left, right = np.flatnonzero(block == a), np.flatnonzero(block == b)
        near = x[left] @ x[right].T >= cosine
        if a == b:
            np.fill_diagonal(near, False)
        # two nodes that meet in several large shards count in the one of the lowest name
        dense = rows.column("dense").to_pylist()
        for h in {h for own in dense for h in own if h < home}:
            there = np.array([h in own for own in dense])
            near &= ~np.outer(there[left], there[right])
        s, d = block_forest(near, a == b)
        sums = [(names[left], near.sum(1), near @ copies[right])]
        if a != b:
            sums.append((names[right], near.sum(0), copies[left] @ near))
        node, links, others = (np.concatenate(c).astype(np.int64) for c in zip(*sums))
        return pa.table({"src": np.concatenate([node, names[left[s]]]),
                         "dst": pa.concat_arrays([pa.nulls(len(node), pa.int64()), pa.array(names[right[d]], pa.int64())]),
                         "links": np.concatenate([links, np.zeros(len(s), np.int64)]),
                         "others": np.concatenate([others, np.zeros(len(s), np.int64)])})
    return run


def found_links(n: DataFrame, cosine: float = COSINE, overlap: int = OVERLAP, exact: bool = False) -> tuple[DataFrame, DataFrame]:
    """(node, links, others): distinct verified links of a node and the rows at their other ends;
    (src, dst): links that connect the same nodes as all."""
    every = shards(n, overlap, cosine, exact)
    parts = every.where("home is null")
    lists = parts.groupBy("shard").applyInArrow(_build, "node long, near array<long>")
    united = lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    ready = common.stored(parts.join(united, "node").select("shard", "node", "vec", "near", "dense"))
    found = ready.groupBy("shard").applyInArrow(_search(cosine), "src long, dst long, tree boolean, counts boolean")
    links = common.stored(found.groupBy("src", "dst").agg(F.max("tree").alias("tree"), F.max("counts").alias("counts")))
    far = common.stored(every.where("home is not null").groupBy("shard").applyInArrow(
        _blocks(cosine), "src long, dst long, links long, others long"))
    own = links.where("counts")
    both = own.select("src", "dst").union(own.select("dst", "src"))
    sums = both.join(n.select(F.col("node").alias("dst"), "copies"), "dst").groupBy(F.col("src").alias("node")).agg(
        F.count(F.lit(1)).alias("links"), F.sum("copies").alias("others"))
    sums = sums.union(far.where("dst is null").select(F.col("src").alias("node"), "links", "others"))
    return (common.stored(sums.groupBy("node").agg(F.sum("links").alias("links"), F.sum("others").alias("others"))),
            links.where("tree").select("src", "dst").union(far.where("dst is not null").select("src", "dst")))


def _compare(queries, cosine):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column("node").to_numpy()
            shard = np.array(batch.column("shard").to_pylist(), object)
            for s in dict.fromkeys(shard.tolist()):
                if s in queries:
                    at = np.flatnonzero(shard == s)
                    ids, q = queries[s]
                    near = _matrix(batch.column("vec").take(pa.array(at))) @ q.T >= cosine
                    near &= names[at][:, None] != ids
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(near.sum(0))], ["node", "true"])
    return run


def audit(n: DataFrame, counts: DataFrame, cosine: float = COSINE, sample: int = AUDIT) -> float:
    """Share of the links of about ``sample`` nodes, compared with all rows in blocks, that ``counts`` holds."""
    total = max(1, n.count())
    own = n.select("node", "vec", F.concat_ws("/", F.col("label").cast("string"), "dim").alias("shard"))
    chance = F.pmod(F.xxhash64("node", F.lit(SEED + 99)), F.lit(1 << 40)) / float(1 << 40)
    queries: dict = {}
    for r in own.where(chance < min(1.0, sample / total)).collect():
        queries.setdefault(r["shard"], []).append((r["node"], r["vec"]))
    queries = {s: (np.array([i for i, _ in q]), _matrix(pa.array([v for _, v in q]))) for s, q in queries.items()}
    true = own.mapInArrow(_compare(queries, cosine), "node long, true long").groupBy("node").agg(F.sum("true").alias("true"))
    there, got = true.join(counts, "node", "left").agg(F.sum("true"), F.sum("links")).first()
    return (got or 0) / there if there else 1.0


def linked(vectors: DataFrame, cosine: float = COSINE, overlap: int = OVERLAP) -> DataFrame:
    """vec_id, n_links, component_id, kept and the audited ``recall`` of every row."""
    v = vectors.select("vec_id", "label", "embedding")
    n = common.stored(nodes(v))
    while True:
        exact = overlap > MOST_OVERLAP
        sums, tree = found_links(n, cosine, overlap, exact)
        recall = audit(n, sums, cosine)
        if recall >= LEAST_RECALL:
            break
        if exact:
            raise RuntimeError(f"links lost in an exact comparison: recall {recall}")
        overlap *= 2
    comp = common.components(tree).withColumnRenamed("id", "node").withColumnRenamed("component_id", "comp")
    each = common.stored(n.drop("vec").join(sums.drop("links"), "node", "left").join(comp, "node", "left")
                         .withColumn("comp", F.coalesce("comp", "node")))
    low = each.groupBy("comp").agg(F.min("first").alias("component_id"))
    each = each.join(low, "comp").select("node", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                                         "component_id")
    ids = v.select("vec_id", F.when(F.col("label").isNotNull() & F.col("embedding").isNotNull(),
                                    F.xxhash64("label", "embedding")).alias("node"))
    return ids.join(each, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component_id", "vec_id")).alias("kept"), F.lit(recall).alias("recall"))


def op10_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(common.table(spark, sf_dir, "embeddings"))
