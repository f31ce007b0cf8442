"""Histogram gradient boosting (OP-69, OP-70, OP-74): Newton trees grown best-first on binned features.

Every feature is cut once into at most ``bins`` ranges at approximate quantiles (one
mergeable aggregate over all features), and a row then is its codes, target and
weight. A round computes each row's gradient and Hessian of the loss, sums them by
(leaf, feature, bin), and grows a tree best-first to ``leaves`` leaves and ``max_depth``
levels. With T(G) = sign(G) max(|G| - alpha, 0) a leaf is worth -T(G) / (H + lambda),
and a split gains T(GL)^2/(HL+lambda) + T(GR)^2/(HR+lambda) - T(G)^2/(H+lambda).

Losses: squared; asymmetric (gradient -2r / -r and Hessian 2 / 1 for a residual r > 0 /
r <= 0, so that under-prediction costs twice); softmax over k classes, whose k trees of
a round are grown together from one aggregate.

How the work is split. A boosting round needs the sums over all rows before it can go
on, several times a tree; one Spark job for each would cost more than the sums. So a
job is a barrier stage over the binned table, dealt to about ``rows_per_task`` rows a
task, that grows ``rounds_per_job`` rounds: tasks add up their histograms with
``BarrierTaskContext.allGather`` (leaf x feature x bin sums, whatever the number of
rows) and each grows the same tree. Of two children only the smaller one is summed, the
other is the difference. An exchange takes Spark a second, whatever its size (a task looks
for the answer once a second). So a table of one task's size exchanges nothing: it is
one task of a common stage, which grows the classes of a round together. Trees come back
after each job as rows of a node table, and the next job starts from them, so a lost
executor costs the rounds of one job. Sums are in the order of the tasks and gains that
differ by rounding only count as equal, so the trees do not depend on the dealing.

The ensemble is that node table: (round, class, node, feature, threshold, left, right,
value, gain, rows), the root of a tree being node 0. A row goes left where its value is
at most the threshold or null. ``score`` evaluates all trees in one expression (an
Arrow-batched function over the feature columns); the plan is as flat for 1000 trees as
for one.

Edge cases: null features fall into the first bin (left); rows with a null target or
weight are left out; a table without such rows gives the constant 0 (equal
probabilities); a constant feature is never split; a class without rows keeps
probability 0; rows and columns are sampled by a hash of (row key, seed, round), so
neither order nor partitions change a fit. Rows with equal keys are drawn together.
"""

from __future__ import annotations

import base64
import heapq
import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smogcast.session import materialize

NODES = ("round int, class int, node int, feature int, bin int, left int, right int, "
         "value double, gain double, rows long")
_NODE_TYPES = {"int": np.int32, "long": np.int64, "double": np.float64}
_SALT = np.uint64(0x9E3779B97F4A7C15)
SAME = 1e-10  # gains within this share of the best one count as equal; the first feature and bin win


@dataclass(frozen=True)
class BoostConfig:
    rounds: int = 1000
    step: float = 0.01
    max_depth: int = 7
    leaves: int = 31
    min_rows: int = 20
    min_hessian: float = 1e-3
    reg_alpha: float = 1.0
    reg_lambda: float = 2.0
    row_share: float = 0.8
    column_share: float = 0.8
    bins: int = 64
    seed: int = 42
    loss: str = "squared"            # or "asymmetric", "softmax"
    under_weight: float = 2.0        # asymmetric: cost of under-prediction
    classes: int = 1                 # softmax
    rounds_per_job: int = 500
    rows_per_task: int = 1 << 18


# ---- losses -----------------------------------------------------------------
def gradients(cfg: BoostConfig, y: np.ndarray, f: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gradient, Hessian) of each row and class at the scores ``f`` (rows x classes)."""
    if cfg.loss == "softmax":
        p = softmax(f)
        hot = y[:, None] == np.arange(cfg.classes)
        k = cfg.classes / max(cfg.classes - 1, 1)
        return (p - hot) * w[:, None], np.maximum(k * p * (1 - p), 1e-16) * w[:, None]
    r = y[:, None] - f
    cost = np.where(r > 0, cfg.under_weight, 1.0) if cfg.loss == "asymmetric" else 1.0
    return -cost * r * w[:, None], cost * np.ones_like(r) * w[:, None]


def softmax(f: np.ndarray) -> np.ndarray:
    top = f.max(axis=1, keepdims=True)
    e = np.exp(f - np.where(np.isfinite(top), top, 0.0))
    total = e.sum(axis=1, keepdims=True)
    return np.where(total > 0, e / np.where(total > 0, total, 1.0), 1.0 / f.shape[1])


def start_scores(cfg: BoostConfig, binned: DataFrame) -> list[float]:
    """Scores before the first round: the weighted mean, or the logarithm of each class's share of the weight."""
    if cfg.loss != "softmax":
        row = binned.agg(F.sum(F.col("y") * F.col("w")), F.sum("w")).first()
        return [float(row[0] / row[1]) if row[1] else 0.0]
    share = {int(r["y"]): r["s"] for r in binned.groupBy("y").agg(F.sum("w").alias("s")).collect()}  # one row a class
    total = sum(share.values())
    return [float(np.log(share[c] / total)) if share.get(c) else -np.inf for c in range(cfg.classes)]


# ---- trees ------------------------------------------------------------------
def _hashed(key: np.ndarray, *seeds: int) -> np.ndarray:
    """Uniform doubles below 1 from row keys and seeds."""
    h = key.astype(np.uint64)
    with np.errstate(over="ignore"):
        for s in seeds:
            h = (h ^ (np.uint64(s + 1) * _SALT))
            h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            h = h ^ (h >> np.uint64(31))
    return (h >> np.uint64(11)) / float(1 << 53)


def sampled_columns(cfg: BoostConfig, n: int, round_: int, class_: int) -> np.ndarray:
    """Features of a tree, in order."""
    k = max(1, int(np.ceil(cfg.column_share * n)))
    return np.sort(np.argsort(_hashed(np.arange(n), cfg.seed, round_, class_, 1), kind="stable")[:k])


def sampled_rows(cfg: BoostConfig, key: np.ndarray, round_: int) -> np.ndarray:
    return _hashed(key, cfg.seed, round_) < cfg.row_share if cfg.row_share < 1 else np.ones(len(key), bool)


def _shrunk(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def best_splits(sums: np.ndarray, cfg: BoostConfig) -> list[tuple[float, int, int]]:
    """(gain, column, bin) of each node of ``sums`` (3 x nodes x columns x bins: gradient, Hessian, rows)."""
    left = np.cumsum(sums, axis=3)
    total = left[:, :, :, -1:]
    right = total - left

    def worth(s):
        return np.maximum(np.abs(s[0]) - cfg.reg_alpha, 0.0) ** 2 / np.maximum(s[1] + cfg.reg_lambda, 1e-300)

    least, mass = max(cfg.min_rows, 1), cfg.min_hessian
    fits = (np.minimum(left[2], right[2]) >= least) & (np.minimum(left[1], right[1]) >= mass)
    gain = np.where(fits, worth(left) + worth(right) - worth(total), 0.0).reshape(sums.shape[1], -1)
    top = np.maximum(gain.max(axis=1), 0.0)
    at = (gain >= top[:, None] * (1 - SAME)).argmax(axis=1)
    return [(float(t), int(a) // sums.shape[3], int(a) % sums.shape[3]) for t, a in zip(top, at)]


class Grower:
    """The tree of one (round, class), grown node by node; rows of all its nodes are kept by number."""

    def __init__(self, cfg: BoostConfig, columns: np.ndarray, n_rows: int):
        self.cfg, self.columns = cfg, columns
        self.of = np.zeros(n_rows, np.int32)          # the deepest node that each row has reached
        self.sums: list[np.ndarray | None] = [None]   # per node: 3 x columns x bins
        self.depth, self.split, self.kids, self.order = [0], [None], [None], []

    def wanted(self) -> list[int]:
        """Replays best-first growth over what is known; nodes to split next (none: the tree is done)."""
        heap, leaves, self.order = [self._entry(0)], 1, []
        while heap and leaves < self.cfg.leaves:
            gain, node = heapq.heappop(heap)
            if gain >= 0:
                break
            if self.kids[node] is None:  # with it, whatever else may be chosen for the leaves that are left
                open_, more = list(heap), []
                while open_:
                    entry = open_.pop()
                    if self.kids[entry[1]]:
                        open_ += [self._entry(k) for k in self.kids[entry[1]]]
                    elif entry[0] < 0:
                        more.append(entry)
                return [node, *[k for _, k in heapq.nsmallest(self.cfg.leaves - leaves - 1, more)]]
            self.order.append(node)
            leaves += 1
            for kid in self.kids[node]:
                heapq.heappush(heap, self._entry(kid))
        return []

    def _entry(self, node: int) -> tuple[float, int]:
        return -(self.split[node][0] if self.split[node] else 0.0), node

    def open(self, nodes: list[int], codes: np.ndarray) -> None:
        """Splits ``nodes``; the sums of their children are still to come."""
        n = len(self.depth)
        column, cut, kid = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, -1, np.int32)
        for node in nodes:
            _, at, cut[node] = self.split[node]
            column[node], kid[node] = self.columns[at], len(self.depth)
            self.kids[node] = (len(self.depth), len(self.depth) + 1)
            for x in (self.sums, self.split, self.kids):
                x += [None, None]
            self.depth += [self.depth[node] + 1] * 2
        first = kid[self.of]
        own = np.flatnonzero(first >= 0)
        node = self.of[own]
        self.of[own] = first[own] + (codes[own, column[node]] > cut[node])

    def finished(self, round_: int, class_: int) -> tuple[pd.DataFrame, np.ndarray]:
        """(rows of the node table, value of each row's leaf)."""
        cfg, number, rows = self.cfg, {0: 0}, []
        for node in self.order:
            for kid in self.kids[node]:
                number[kid] = len(number)
        inner, value = set(self.order), np.zeros(len(self.depth))
        for node, n in number.items():
            g, h, count = self.sums[node][:, 0].sum(axis=1)
            if node in inner:
                gain, column, cut = self.split[node]
                left, right = (number[k] for k in self.kids[node])
                rows.append((round_, class_, n, int(self.columns[column]), cut, left, right, 0.0, gain, int(round(count))))
            else:
                value[node] = -cfg.step * float(_shrunk(g, cfg.reg_alpha)) / (h + cfg.reg_lambda) if h + cfg.reg_lambda > 0 else 0.0
                rows.append((round_, class_, n, -1, 0, -1, -1, value[node], 0.0, int(round(count))))
                self._pass_on(node, value)
        names = [c.split()[0] for c in NODES.split(", ")]
        return pd.DataFrame(rows, columns=names), value[self.of]

    def _pass_on(self, node: int, value: np.ndarray) -> None:
        """Nodes that were opened below a leaf on trial belong to it."""
        open_ = [node]
        while open_:
            node_ = open_.pop()
            value[node_] = value[node]
            open_ += self.kids[node_] or []


def grow_round(cfg: BoostConfig, codes: np.ndarray, flat: np.ndarray, g: np.ndarray, h: np.ndarray, drawn: np.ndarray,
               round_: int, gather) -> tuple[list[pd.DataFrame], np.ndarray]:
    """Trees of all classes of a round, grown together; (node tables, rows x classes of leaf values).

    ``gather`` adds arrays up over all tasks; it is called once for each step of the growth.
    """
    n, features = codes.shape
    bins, plain = cfg.bins, cfg.loss == "squared" and bool((h == 1.0).all())
    trees = {c: Grower(cfg, sampled_columns(cfg, features, round_, c), n) for c in range(g.shape[1])}
    width = len(sampled_columns(cfg, features, round_, 0))
    own_flat = {}

    def summed(c: int, nodes: list[int]) -> np.ndarray:
        """3 x nodes x columns x bins over this task's drawn rows in ``nodes`` of tree ``c``."""
        tree = trees[c]
        if c not in own_flat:  # codes of the tree's columns, each column with bins of its own
            own_flat[c] = np.take(flat, tree.columns, axis=1) + np.arange(width) * bins
        slot = np.full(len(tree.depth), -1, np.int64)
        slot[nodes] = np.arange(len(nodes))
        at = slot[tree.of]
        rows = np.flatnonzero((at >= 0) & drawn)
        keys = np.take(own_flat[c], rows, axis=0)
        if len(nodes) > 1:
            keys += (at[rows] * (width * bins))[:, None]
        keys = keys.ravel()
        size = len(nodes) * width * bins
        count = np.bincount(keys, minlength=size).astype(float)
        grad = np.bincount(keys, np.repeat(g[rows, c], width), size)
        hess = count if plain else np.bincount(keys, np.repeat(h[rows, c], width), size)
        return np.stack([grad, hess, count]).reshape(3, len(nodes), width, bins)

    def settle(work: list[tuple[int, int]], sums: np.ndarray) -> None:
        for i, (c, node) in enumerate(work):
            trees[c].sums[node] = sums[:, i]
        grows = [i for i, (c, node) in enumerate(work) if trees[c].depth[node] < cfg.max_depth]
        for i, split in zip(grows, best_splits(sums[:, grows], cfg) if grows else []):
            trees[work[i][0]].split[work[i][1]] = split

    roots = [(c, 0) for c in trees]
    settle(roots, gather(np.concatenate([summed(c, [0]) for c, _ in roots], axis=1)))
    while True:
        pairs = []                                       # (class, node, smaller child, larger child)
        for c, tree in trees.items():
            nodes = tree.wanted()
            if nodes:
                tree.open(nodes, codes)
            for node in nodes:
                _, column, cut = tree.split[node]
                rows, (a, z) = tree.sums[node][2, column], tree.kids[node]
                pairs.append((c, node, a, z) if 2 * rows[:cut + 1].sum() <= rows.sum() else (c, node, z, a))
        if not pairs:
            break
        made = gather(np.concatenate([summed(c, [p[2] for p in pairs if p[0] == c])
                                      for c in dict.fromkeys(p[0] for p in pairs)], axis=1))
        whole = np.stack([trees[c].sums[node] for c, node, _, _ in pairs], axis=1)
        settle([(c, a) for c, _, a, _ in pairs], made)
        settle([(c, z) for c, _, _, z in pairs], whole - made)
    done = [tree.finished(round_, c) for c, tree in trees.items()]
    return [d[0] for d in done], np.stack([d[1] for d in done], axis=1)


# ---- the job of some rounds ----------------------------------------------------
def _summing(tasks: int):
    """(adds arrays up over the tasks of the barrier stage, in the tasks' order; this task's number)."""
    if tasks == 1:
        return lambda sums: sums, 0
    from pyspark import BarrierTaskContext
    context = BarrierTaskContext.get()

    def gather(sums: np.ndarray) -> np.ndarray:
        parts = context.allGather(base64.b64encode(np.ascontiguousarray(sums).tobytes()).decode())
        return np.sum([np.frombuffer(base64.b64decode(p)).reshape(sums.shape) for p in parts], axis=0)
    return gather, context.partitionId()


def _codes(column: pa.Array, width: int) -> np.ndarray:
    """Codes of a binary column of ``width`` bytes a row."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def leaf_values(codes: np.ndarray, nodes: dict[str, np.ndarray], classes: int) -> np.ndarray:
    """Sum of the trees' values for each row and class; ``nodes`` are sorted by (round, class, node)."""
    out = np.zeros((len(codes), classes))
    roots = np.flatnonzero(nodes["node"] == 0)
    row = np.arange(len(codes))
    for root in roots:
        at = np.full(len(codes), root)
        while True:
            feature = nodes["feature"][at]
            if (feature < 0).all():
                break
            right = codes[row, np.maximum(feature, 0)] > nodes["bin"][at]
            at = np.where(feature < 0, at, root + np.where(right, nodes["right"][at], nodes["left"][at]))
        out[:, nodes["class"][root]] += nodes["value"][at]
    return out


def _sorted(nodes: pd.DataFrame) -> dict[str, np.ndarray]:
    nodes = nodes.sort_values(["round", "class", "node"])
    return {c: nodes[c].to_numpy() for c in nodes.columns}


def _boost(cfg: BoostConfig, start: list[float], before: dict[str, np.ndarray], first: int, width: int, tasks: int):
    """Rounds from ``first`` on; the first of ``tasks`` returns them as rows of the node table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), pa.schema([("key", pa.int64()), ("y", pa.float64()), ("w", pa.float64()),
                                                                ("codes", pa.binary())]))
        gather, task = _summing(tasks)
        key, y, w = (table.column(c).to_numpy() for c in ("key", "y", "w"))
        codes = _codes(table.column("codes"), width)
        flat = codes.astype(np.int64)
        f = np.array(start)[None, :] + leaf_values(codes, before, len(start))
        made = []
        for round_ in range(first, min(first + cfg.rounds_per_job, cfg.rounds)):
            g, h = gradients(cfg, y, f, w)
            trees, values = grow_round(cfg, codes, flat, g, h, sampled_rows(cfg, key, round_), round_, gather)
            f += values
            made += trees
        if made and task == 0:
            yield from pa.Table.from_pandas(pd.concat(made), pa.schema([(c.split()[0], {
                "int": pa.int32(), "long": pa.int64(), "double": pa.float64()}[c.split()[1]]) for c in NODES.split(", ")]),
                preserve_index=False).to_batches()
    return run


def bin_edges(df: DataFrame, features: list[str], bins: int) -> list[list[float]]:
    """Ascending cut points of each feature: at most ``bins`` - 1 approximate quantiles, from one aggregate."""
    shares = [i / bins for i in range(1, bins)]
    finite = [F.when(~F.isnan(c), F.col(c)) for c in features]
    row = df.agg(*[F.percentile_approx(c, shares, 20_000).alias(f"q{i}") for i, c in enumerate(finite)],
                 *[F.max(c).alias(f"m{i}") for i, c in enumerate(finite)]).first()
    return [sorted({float(v) for v in row[f"q{i}"] or [] if v < row[f"m{i}"]}) for i in range(len(features))]


def _coded(edges: list[list[float]], columns: list[np.ndarray]) -> np.ndarray:
    """Codes: the number of cut points below a value; 0 for a null."""
    out = np.zeros((len(columns[0]) if columns else 0, len(edges)), np.uint8)
    for i, (cuts, x) in enumerate(zip(edges, columns)):
        x = np.asarray(x, float)
        out[:, i] = np.where(np.isnan(x), 0, np.searchsorted(np.array(cuts), x, "left"))
    return out


def binned_table(df: DataFrame, features: list[str], label: str, weight: str | None, key: list[str],
                 edges: list[list[float]]) -> DataFrame:
    """(key, y, w, codes): what the rounds read, written down once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i + 3).to_numpy(zero_copy_only=False) for i in range(len(features))]
            codes = _coded(edges, columns)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([r.tobytes() for r in codes], pa.binary())],
                                             ["key", "y", "w", "codes"])
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.select(F.xxhash64(*key).alias("key"), F.col(label).cast("double").alias("y"), w.alias("w"),
                     *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)]).where("y IS NOT NULL AND w IS NOT NULL")
    return rows.mapInArrow(run, "key long, y double, w double, codes binary")


# ---- the model -----------------------------------------------------------------
@dataclass
class BoostedModel:
    """Node table, cut points and starting scores."""
    features: list[str]
    edges: list[list[float]]
    start: list[float]
    nodes: pd.DataFrame
    config: dict = field(default_factory=dict)

    def table(self, spark: SparkSession) -> DataFrame:
        """The ensemble as rows, with feature names and thresholds."""
        out = self.nodes.copy()
        leaf = out["feature"] < 0
        out["threshold"] = [None if x else self.edges[f][b] for x, f, b in zip(leaf, out["feature"], out["bin"])]
        out["feature"] = [None if x else self.features[f] for x, f in zip(leaf, out["feature"])]
        rows = [(*[int(v) for v in r[:3]], r[3], None if pd.isna(r[4]) else float(r[4]), int(r[5]), int(r[6]), float(r[7]),
                 float(r[8]), int(r[9])) for r in out[["round", "class", "node", "feature", "threshold", "left", "right",
                                                       "value", "gain", "rows"]].itertuples(index=False)]
        return spark.createDataFrame(rows, "round int, class int, node int, feature string, threshold double, left int, "
                                           "right int, value double, gain double, rows long")

    def _evaluated(self, finish):
        nodes, edges, start, k = _sorted(self.nodes), self.edges, np.array(self.start), len(self.start)

        def evaluate(*columns: pd.Series) -> pd.Series:
            codes = _coded(edges, [c.to_numpy(float, na_value=np.nan) for c in columns])
            return finish(start[None, :] + leaf_values(codes, nodes, k))
        return evaluate

    def score(self) -> Column:
        """Sum of all trees, on the scale of the target."""
        total = self._evaluated(lambda f: pd.Series(f[:, 0]))
        return F.pandas_udf(total, "double")(*[F.col(c).cast("double") for c in self.features])

    def probabilities(self) -> Column:
        """Softmax of the classes' scores, as an array."""
        shares = self._evaluated(lambda f: pd.Series(list(softmax(f))))
        return F.pandas_udf(shares, "array<double>")(*[F.col(c).cast("double") for c in self.features])

    def importance(self) -> np.ndarray:
        """Share of the total gain by feature."""
        inner = self.nodes[self.nodes["feature"] >= 0]
        out = np.bincount(inner["feature"], inner["gain"], len(self.features))
        return out / out.sum() if out.sum() else out

    def save(self, path: str, spark: SparkSession) -> None:
        meta = {"features": self.features, "edges": self.edges, "start": [x if np.isfinite(x) else None for x in self.start],
                "config": self.config}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").json(f"{path}/meta")
        spark.createDataFrame([tuple(x.item() for x in r) for r in self.nodes.to_records(index=False)], NODES).write.mode(
            "overwrite").parquet(f"{path}/nodes")

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> "BoostedModel":
        meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
        nodes = spark.read.parquet(f"{path}/nodes").toPandas()  # leaves x rounds x classes rows
        return cls(meta["features"], meta["edges"], [-np.inf if x is None else x for x in meta["start"]], nodes, meta["config"])


def _slots(spark: SparkSession) -> int:
    """Tasks that can run at once: a barrier stage needs all of its own."""
    sc = spark.sparkContext._jsc.sc()
    return max(1, sc.maxNumConcurrentTasks(sc.resourceProfileManager().defaultResourceProfile()))


def fit_boosted(df: DataFrame, features: list[str], label: str, cfg: BoostConfig = BoostConfig(), weight: str | None = None,
                key: tuple[str, ...] = ("series_key", "Date")) -> BoostedModel:
    """Fits ``cfg.rounds`` rounds. ``key`` names the columns that tell rows apart (for sampling and order)."""
    edges = bin_edges(df, features, cfg.bins)
    binned = binned_table(df, features, label, weight, list(key), edges).transform(materialize)
    start, n = start_scores(cfg, binned), binned.count()
    tasks = max(1, min(_slots(df.sparkSession), -(-n // cfg.rows_per_task)))
    dealt = (binned.repartition(tasks, "key") if tasks > 1 else binned.coalesce(1)).sortWithinPartitions("key", "y", "w", "codes")
    nodes = pd.DataFrame({c.split()[0]: np.zeros(0, _NODE_TYPES[c.split()[1]]) for c in NODES.split(", ")})
    for first in range(0, cfg.rounds if n else 0, cfg.rounds_per_job):
        job = _boost(cfg, start, _sorted(nodes), first, len(features), tasks)
        made = dealt.mapInArrow(job, NODES, barrier=tasks > 1).toPandas()   # at most 2 x leaves nodes a tree
        nodes = pd.concat([nodes, made], ignore_index=True)
    return BoostedModel(list(features), edges, start, nodes, asdict(cfg))
