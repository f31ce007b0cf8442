"""Quality classifier: Naive Bayes support vectors.

Features are indicators of the byte bigrams and trigrams of a text, hashed to
``DIMS`` places, and of how often (by powers of two) a word bigram is one word
twice and a line stands again. The indicators are scaled by the log-count ratio of the two
classes and rows are brought to unit length; a linear hinge-loss model is fitted
by dual coordinate descent. A logistic curve fitted to rows kept back from the
descent turns margins into probabilities.

The fit uses labelled rows of the training fold (crc32(doc_id as text) mod 5 is
not 0): all of them up to ``SAMPLE``, beyond that about ``SAMPLE`` chosen by a
hash of the id. Every text is scored whole, in one pass without a shuffle.

Edge cases: a null or empty text has no features and scores the intercept's
probability; a null doc_id counts as empty text in the fold; repeated rows score
alike; labels without a text or with a null are left out, repeated labels of a
document count once (the smallest); with one class or no labels the score is the
smoothed share of label 1; an empty table gives no rows; other columns and clashing names
in ``labels`` are not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smogcast.llm import common, text

FOLDS, SAMPLE, LIMIT = 5, 10_000, 0.3
HASHED = (1 << 16) - 64
DIMS, SMOOTH, COST, ROUNDS, SEED = 1 << 16, 1.0, 1.0, 20, 11


def fold(doc_id: str | Column = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % FOLDS


def repeats(data: bytes) -> list[int]:
    """Places, past those of the n-grams, of the two counts of repeats of one text."""
    w = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    pairs, again = sum(map(eq, w, w[1:])), len(lines) - len(set(lines))
    return [HASHED + min(31, pairs.bit_length()), HASHED + 32 + min(31, again.bit_length())]


def features(raw: np.ndarray) -> np.ndarray:
    """Sorted places of the n-grams that occur in one text."""
    if len(raw) < 2:
        return np.zeros(0, np.int64)
    x = raw.astype(np.uint32)
    seen = np.zeros(HASHED, bool)
    # (places are the high half of a product, brought into range)
    two = x[:-1] * np.uint32(257) + x[1:]
    seen[((two * np.uint32(0x9E3779B1)) >> np.uint32(16)) % HASHED] = True
    if len(raw) > 2:
        seen[(((two[:-1] * np.uint32(263) + x[2:] + np.uint32(77)) * np.uint32(0x85EBCA6B)) >> np.uint32(16)) % HASHED] = True
    return np.append(np.flatnonzero(seen), repeats(raw.tobytes()))


@dataclass
class Model:
    """Weights and squared ratios of the places, and the logistic curve of the margin."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, places: np.ndarray) -> float:
        length = np.sqrt(max(1.0, self.squares[places].sum()))
        return float(self.weights[places].sum() / length + self.bias)

    def score(self, places: np.ndarray) -> float:
        z = self.slope * self.margin(places) + self.shift
        return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    count = [np.full(DIMS, SMOOTH), np.full(DIMS, SMOOTH)]
    for places, label in zip(rows, y):
        count[int(label > 0)][places] += 1
    return np.log(count[1] / count[1].sum()) - np.log(count[0] / count[0].sum())


def descend(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: np.ndarray,
            rounds: int = ROUNDS, seed: int = SEED) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss with box ``cost`` per row; the last weight is the bias."""
    w, bias, dual = np.zeros(DIMS), 0.0, np.zeros(len(y))
    square = np.array([float(v @ v) + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(y)):
            slack = y[i] * (w[rows[i]] @ values[i] + bias) - 1
            new = min(max(dual[i] - slack / square[i], 0.0), cost[i])
            step = (new - dual[i]) * y[i]
            if step:
                dual[i] = new
                w[rows[i]] += step * values[i]
                bias += step
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w, bias


def curve(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve by Newton steps with smoothed targets."""
    n1, n0 = (y > 0).sum(), (y <= 0).sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, theta = np.stack([margins, np.ones_like(margins)], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -35, 35)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, x.T @ (t - p) - 1e-3 * theta)
        theta += np.clip(step, -2, 2)
        if abs(step).max() < 1e-8:
            break
    return float(max(theta[0], 1e-3)), float(theta[1])


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    y = np.where(np.asarray(labels) > 0, 1, -1)
    if len(set(y.tolist())) < 2:
        share = ((y > 0).sum() + 1) / (len(y) + 2)
        return Model(np.zeros(DIMS), np.zeros(DIMS), 0.0, 1.0, float(np.log(share / (1 - share))))
    ratio = log_count_ratio(rows, y)
    squares = ratio ** 2
    values = [ratio[r] / np.sqrt(max(1.0, squares[r].sum())) for r in rows]
    back = np.arange(len(y)) % 4 == 3
    if len(set(y[back].tolist())) < 2 or len(set(y[~back].tolist())) < 2:
        back = np.zeros(len(y), bool)
    share = np.where(y > 0, (y > 0).mean(), (y <= 0).mean())
    cost = COST * np.minimum(10.0, 0.5 / share)  # classes count alike
    use = np.flatnonzero(~back)
    w, bias = descend([rows[i] for i in use], [values[i] for i in use], y[use], cost[use])
    check = np.flatnonzero(back) if back.any() else use
    slope, shift = curve(np.array([w[rows[i]] @ values[i] + bias for i in check]), y[check])
    return Model(w * ratio, squares, bias, slope, shift)


def _features(batches):
    for rows, raw, at in text.pieces(batches):
        out = [features(raw[at[i]:at[i + 1]]).astype("<u2").tobytes() for i in range(rows.num_rows)]
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("label"), pa.array(out, pa.binary())],
                                         ["doc_id", "label", "places"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on the training fold of (doc_id, quality) ``labels``."""
    marked = (labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("label")).dropna()
              .groupBy("_id").agg(F.min("label").alias("label")))
    rows = docs.select("doc_id", "text").where("doc_id is not null").where(fold() != 0)
    n = marked.where(fold("_id") != 0).count()
    if n > sample:
        marked = marked.where(F.pmod(F.xxhash64("_id", F.lit(SEED)), F.lit(1 << 30)) < int((1 << 30) * sample / n))
    # (marked holds about ``sample`` rows at most, so it may be broadcast)
    got = rows.join(F.broadcast(marked), F.col("doc_id") == F.col("_id")).select("doc_id", "label", "text").mapInArrow(
        _features, T.StructType([rows.schema["doc_id"], T.StructField("label", T.IntegerType()),
                                 T.StructField("places", T.BinaryType())])).toPandas()
    got = got.assign(k=[zlib.crc32(p) for p in got.places]).sort_values(["k", "doc_id"], kind="stable")
    return fit([np.frombuffer(p, "<u2").astype(np.int64) for p in got.places], got.label.to_numpy())


def _score(model):
    def run(batches):
        for rows, raw, at in text.pieces(batches):
            out = [model.score(features(raw[at[i]:at[i + 1]])) for i in range(rows.num_rows)]
            names = [n for n in rows.schema.names if n != "text"] + ["score"]
            yield pa.RecordBatch.from_arrays([rows.column(n) for n in names[:-1]] + [pa.array(out, pa.float64())], names)
    return run


def scored(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """The ``keep`` columns and the score of every row."""
    d = docs.select(*keep, "text")
    return d.mapInArrow(_score(model), T.StructType([f for f in d.schema if f.name != "text"]
                                                    + [T.StructField("score", T.DoubleType())]))


def accepted(docs: DataFrame, model: Model, limit: float = LIMIT) -> DataFrame:
    """The rows that score ``limit`` or more, with all their columns."""
    def run(batches):
        for rows, raw, at in text.pieces(batches):
            yield rows.filter(pa.array([model.score(features(raw[at[i]:at[i + 1]])) >= limit for i in range(rows.num_rows)]))
    return docs.mapInArrow(run, docs.schema)


def op4_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = train(docs, common.table(spark, sf_dir, "labels"))
    return scored(docs, model, "doc_id").select(
        "doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= LIMIT).cast("int").alias("predicted"))
