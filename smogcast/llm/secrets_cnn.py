"""Secret scans: pattern findings, and a character convolutional network over every other candidate.

Patterns give the base findings. A candidate is a run of key characters of
``LEAST`` or more with a letter and a digit; the network sees ``BODY`` characters
with ``SIDE`` characters of context on each side, of a longer one every half
overlapping window, and takes the highest probability. It is trained
on all labelled findings: the different windows of pattern findings are the positives, those of
candidates that no pattern matches and every different long word without a digit (with
one of its contexts) the negatives; each comes a second time with another's left context.
A quarter is kept back: a logistic curve calibrates the scores on
it; the highest threshold at which ``RECALL`` of its positives are found is taken,
and moved half way down to the next negative. Candidates over the threshold that touch no base finding are added.

Up to ``SHARD`` windows are fitted by one task. More are dealt to shards by hash, at most
``SHARDS``: in each of ``EPOCHS`` jobs a shard's task goes over all its windows from the
same weights, and the next job starts from the average of theirs. The curve's sums, the
threshold's rank and the next negative are aggregates over all windows kept back.

Edge cases: a null or empty text has no findings; repeated rows have the same
findings; very long texts are scanned whole; an empty table gives no rows; with
fewer than ``FEW`` positives or no negatives nothing is added to the base.
Other columns are not read by ``found`` and kept as they are by ``redacted``.
"""

from __future__ import annotations

import hashlib
import pickle
import re
import zlib
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smogcast.llm import common
from smogcast.session import materialize

KINDS = ("assign", "access", "hex", "network")
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
RUN = re.compile(r"[A-Za-z0-9+/_=.-]{12,}")
LEAST, SIDE, BODY = 12, 24, 40
FEW, RECALL = 8, 0.98
SHARD, SHARDS, STEPS = 1 << 14, 256, 300
WIDTH = 2 * SIDE + BODY
EMBED, KERNEL, FILTERS, HIDDEN, EPOCHS, BATCH, SEED = 8, 5, 24, 24, 6, 64, 3


def base(value: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the pattern findings in order."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(value) if m.end(2) - m.start(2) >= 6]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(value)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(value)]
    return sorted(out)


def spelled(spans: list[tuple[int, int, int]], kinds=KINDS) -> str:
    return ",".join(f"{kinds[k]}:{a}:{z}" for a, k, z in spans)


def loose_runs(value: str, spans: list[tuple[int, int, int]]):
    """Runs of key characters that touch no base finding."""
    i, reach = 0, list(accumulate((z for _, _, z in spans), max))
    for m in RUN.finditer(value):
        a, z = m.span()
        while i < len(spans) and reach[i] <= a:
            i += 1
        if i == len(spans) or spans[i][0] >= z:
            yield m


def _is_candidate(part: str) -> bool:
    return any(c.isdigit() for c in part) and any(c.isalpha() for c in part)


def candidates(value: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Runs with a letter and a digit that touch no base finding."""
    return [m.span() for m in loose_runs(value, spans) if _is_candidate(m.group())]


def window(value: str, a: int, z: int) -> str:
    left = value[max(0, a - SIDE):a].rjust(SIDE, "\0")
    return left + value[a:min(z, a + BODY)].ljust(BODY, "\0") + value[z:z + SIDE].ljust(SIDE, "\0")


def windows_of(value: str, a: int, z: int) -> list[str]:
    """Windows of ``BODY`` characters that cover a candidate, half overlapping, the last one at its end."""
    last = max(a, z - BODY)
    return [window(value, s, min(z, s + BODY)) for s in [*range(a, last, BODY // 2), last]]


def codes(windows: list[str]) -> np.ndarray:
    """Characters as 0 to 97: ASCII marks as such, other letters 96, the rest 97."""
    x = np.frombuffer("".join(windows).encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, WIDTH).astype(np.int64)
    return np.where(x == 0, 0, np.where((x >= 32) & (x < 127), x - 31, np.where(x >= 0xC0, 96, 97)))


def _tables(w: dict) -> np.ndarray:
    """(kernel place, character, filter): what a character adds to a response. Looking it up spares the large products."""
    t = w["embed"] @ w["kernel"].reshape(KERNEL, EMBED, FILTERS)
    t[0] += w["kernel_bias"]
    return t


# Pools: the left context, the candidate and the right context each keep their strongest response.
_PARTS = (slice(0, SIDE - KERNEL + 1), slice(SIDE - KERNEL + 1, SIDE + BODY), slice(SIDE + BODY, WIDTH - KERNEL + 1))


@dataclass
class Network:
    weights: dict
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 2.0  # above any probability: nothing is added

    def forward(self, x: np.ndarray, keep: bool = False):
        w = self.weights
        x, table, places = x.astype(np.intp), _tables(w), WIDTH - KERNEL + 1
        conv = table[0].take(x[:, :places], axis=0)
        for k in range(1, KERNEL):
            conv += table[k].take(x[:, k:k + places], axis=0)
        tops = [conv[:, p].argmax(1) + p.start for p in _PARTS]
        pooled = np.concatenate([np.take_along_axis(conv, t[:, None, :], 1)[:, 0] for t in tops], 1)
        act = np.maximum(pooled, 0)
        hidden = np.maximum(act @ w["dense"] + w["dense_bias"], 0)
        logit = hidden @ w["out"] + w["out_bias"]
        return (logit, hidden, act, np.concatenate(tops, 1)) if keep else logit

    def probability(self, windows: list[str]) -> np.ndarray:
        out = [self.forward(codes(windows[a:a + 256])) for a in range(0, len(windows), 256)]
        z = self.slope * np.concatenate(out) + self.shift if out else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _gradients(net: Network, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
    w = net.weights
    logit, hidden, act, tops = net.forward(x, keep=True)
    d = (1 / (1 + np.exp(-np.clip(logit, -35, 35))) - y) * weight / len(y)
    g = {"out": hidden.T @ d, "out_bias": d.sum()}
    dh = np.outer(d, w["out"]) * (hidden > 0)
    g["dense"], g["dense_bias"] = act.T @ dh, dh.sum(0)
    da = (dh @ w["dense"].T) * (act > 0)
    g["kernel_bias"] = da.sum(0).reshape(len(_PARTS), FILTERS).sum(0)
    # by what was looked up: (kernel place, character, filter)
    chars = np.take(x.ravel(), (tops + np.arange(len(x))[:, None] * WIDTH)[None] + np.arange(KERNEL)[:, None, None]).astype(np.intp)
    at = (chars + np.arange(KERNEL)[:, None, None] * 98) * FILTERS + np.tile(np.arange(FILTERS), len(_PARTS))
    dt = np.bincount(at.ravel(), np.broadcast_to(da, at.shape).ravel(), KERNEL * 98 * FILTERS).reshape(KERNEL, 98, FILTERS)
    g["kernel"] = (w["embed"].T @ dt).reshape(KERNEL * EMBED, FILTERS)
    g["embed"] = (dt @ w["kernel"].reshape(KERNEL, EMBED, FILTERS).transpose(0, 2, 1)).sum(0)
    return g


def logistic(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift that calibrate scores, by Newton steps with smoothed targets."""
    n1, n0 = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, theta = np.stack([z, np.ones_like(z)], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -35, 35)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        theta = theta + np.clip(np.linalg.solve(hess, x.T @ (t - p) - 1e-2 * (theta - [1.0, 0.0])), -1, 1)
    return float(max(theta[0], 1e-2)), float(theta[1])


def _start(rng) -> dict:
    shape = {"embed": (98, EMBED), "kernel": (KERNEL * EMBED, FILTERS), "kernel_bias": (FILTERS,),
             "dense": (3 * FILTERS, HIDDEN), "dense_bias": (HIDDEN,), "out": (HIDDEN,), "out_bias": ()}
    return {k: rng.normal(0, 0.5 if k == "embed" else (s[0] ** -0.5 if len(s) and "bias" not in k else 0.0), s)
            for k, s in shape.items()}


def _moments(w: dict) -> tuple[dict, dict]:
    return tuple({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))


def _pass(net: Network, first: dict, second: dict, step: int, x: np.ndarray, y: np.ndarray, weight: np.ndarray,
          order: np.ndarray) -> int:
    """One pass of Adam over the rows ``order``; the number of steps up to now."""
    w = net.weights
    for a in range(0, len(order), BATCH):
        i = order[a:a + BATCH]
        step += 1
        for k, g in _gradients(net, x[i], y[i], weight[i]).items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            w[k] = w[k] - 0.004 * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return step


def _threshold(highest: float, below: float) -> float:
    """Between the two nothing more is found wrongly, so their geometric mean is as precise and surer."""
    return float(np.exp(np.log(np.array([highest, below])).mean()))


def fit(windows: list[str], labels: np.ndarray, recall: float = RECALL) -> Network:
    """Train, calibrate and set the threshold on labelled windows."""
    rng = np.random.default_rng(SEED)
    y = np.asarray(labels, float)
    net = Network(_start(rng))
    if y.sum() < FEW or len(y) - y.sum() < FEW:
        return net
    x = codes(windows)
    back = np.arange(len(y)) % 4 == 3
    if y[back].sum() in (0, back.sum()):
        back[:] = False
        back[np.flatnonzero(y > 0)[::4]] = back[np.flatnonzero(y == 0)[::4]] = True
    use, check = np.flatnonzero(~back), np.flatnonzero(back)
    # Each training row comes twice, once with another row's left context: values must tell by themselves.
    other = x[use].copy()
    other[:, :SIDE] = x[rng.permutation(use), :SIDE]
    x, y = np.concatenate([x, other]), np.concatenate([y, y[use]])
    use = np.concatenate([use, np.arange(len(x) - len(other), len(x))])
    balance = np.where(y > 0, 0.5 / y[use].mean(), 0.5 / (1 - y[use].mean()))
    (first, second), step = _moments(net.weights), 0
    while step < STEPS or step < EPOCHS * len(use) / BATCH:
        step = _pass(net, first, second, step, x, y, balance, rng.permutation(use))
    z = np.concatenate([net.forward(x[check[a:a + 256]]) for a in range(0, len(check), 256)])
    net.slope, net.shift = logistic(z, y[check])
    p = 1 / (1 + np.exp(-np.clip(net.slope * z + net.shift, -35, 35)))
    good = np.sort(p[y[check] > 0])
    highest = good[int(np.floor((1 - recall) * len(good)))]
    below = p[(y[check] == 0) & (p < highest)]
    net.threshold = _threshold(highest, below.max() if len(below) else 1e-3)
    return net


def _examples(batches):
    """Labelled windows: findings 1, other candidates and long words 0; ``word`` is what tells words apart."""
    for batch in batches:
        out, words = {}, {}
        for value in batch.column("text"):
            text = value.as_py() or ""
            spans = base(text)
            # (of a finding, the network sees what the candidate pattern would cut out: its value)
            for a, k, z in spans:
                if k == 0:
                    a = ASSIGN.match(text, a).start(2)
                out |= dict.fromkeys((1, w) for w in windows_of(text, a, z))
            for m in loose_runs(text, spans):
                if _is_candidate(m.group()):
                    out |= dict.fromkeys((0, w) for w in windows_of(text, *m.span()))
                elif not any(c.isdigit() for c in m.group()):
                    for w in windows_of(text, *m.span()):
                        word = w[SIDE:SIDE + BODY]
                        words[word] = min(words.get(word, w), w)
        rows = [(y, None, w) for y, w in out] + [(0, word, w) for word, w in words.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.string(), pa.string()))],
                                         ["label", "word", "win"])


def examples(docs: DataFrame) -> DataFrame:
    """(label, win): the different windows of all findings and candidates, and one of each long word."""
    rows = docs.select("text").mapInArrow(_examples, "label int, word string, win string")
    key = F.when(F.col("word").isNull(), F.col("win"))
    return common.stored(rows.groupBy("label", "word", key.alias("key")).agg(F.min("win").alias("win")).select("label", "win").distinct())


def _crc(win: str) -> int:
    return zlib.crc32(win.encode())


def _fit_all(recall):
    """The network of all rows of the one partition."""
    def run(batches):
        got = [g for b in batches for g in zip(b.column("label").to_pylist(), b.column("win").to_pylist())]
        got.sort(key=lambda g: (_crc(g[1]), g))
        net = fit([w for _, w in got], np.array([y for y, _ in got]), recall)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(net)], pa.binary())], ["net"])
    return run


def _packed(key, rows):
    """A shard in one row: labels and character codes, a byte each."""
    got = sorted(zip(rows.column("label").to_pylist(), rows.column("win").to_pylist()), key=lambda g: (_crc(g[1]), g))
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "y": pa.array([bytes(y for y, _ in got)], pa.binary()),
                     "x": pa.array([codes([w for _, w in got]).astype(np.uint8).tobytes()], pa.binary())})


def _state(*parts: dict) -> np.ndarray:
    return np.concatenate([np.ravel(p[k]) for p in parts for k in sorted(p)])


def _parts(state: np.ndarray, like: dict) -> list[dict]:
    """The inverse of ``_state``."""
    out, at = [], 0
    while at < len(state):
        out.append({})
        for k in sorted(like):
            n = np.size(like[k])
            out[-1][k] = state[at:at + n].reshape(np.shape(like[k])).copy()
            at += n
    return out


def _passes(state: np.ndarray, like: dict, step: int, job: int, passes: int, share: float):
    """(shard, rows, steps, state) after ``passes`` over each shard's windows, and again with other left contexts."""
    def run(batches):
        for batch in batches:
            for shard, y, x in zip(*(batch.column(c) for c in ("shard", "y", "x"))):
                shard, y = shard.as_py(), np.frombuffer(y.as_py(), np.uint8).astype(float)
                x = np.frombuffer(x.as_py(), np.uint8).reshape(-1, WIDTH)
                other = x.copy()
                other[:, :SIDE] = x[np.random.default_rng([SEED, shard]).permutation(len(x)), :SIDE]
                x, y, rng = np.concatenate([x, other]), np.concatenate([y, y]), np.random.default_rng([SEED, shard, job])
                weights, first, second = _parts(state, like)
                net, done = Network(weights), step
                for _ in range(passes):
                    done = _pass(net, first, second, done, x, y, np.where(y > 0, 0.5 / share, 0.5 / (1 - share)), rng.permutation(len(x)))
                yield pa.RecordBatch.from_arrays([
                    pa.array([shard], pa.int32()), pa.array([len(x)], pa.int64()), pa.array([done], pa.int64()),
                    pa.array([_state(net.weights, first, second).astype(np.float32).tobytes()], pa.binary())], ["shard", "n", "step", "state"])
    return run


def _logits(net: Network):
    def run(batches):
        for batch in batches:
            wins = batch.column("win").to_pylist()
            z = [net.forward(codes(wins[a:a + 256])) for a in range(0, len(wins), 256)]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(np.concatenate(z) if z else np.zeros(0))], ["label", "z"])
    return run


def _curve(scores: DataFrame, n1: int, n0: int) -> tuple[float, float]:
    """``logistic`` over the rows of ``scores`` (label, z); its sums are exact, so that reruns agree."""
    t = F.when(F.col("label") > 0, F.lit((n1 + 1) / (n1 + 2))).otherwise(F.lit(1 / (n0 + 2)))
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-35.0), F.least(F.lit(35.0), F.col("z") * float(theta[0]) + float(theta[1])))))
        v, z = p * (1 - p), F.col("z")
        row = scores.agg(*[F.sum(c.cast("decimal(28,12)")) for c in (v * z * z, v * z, v, (t - p) * z, t - p)]).first()
        a, b, c, d, e = (float(x) for x in row)
        move = np.clip(np.linalg.solve(np.array([[a, b], [b, c]]) + 1e-2 * np.eye(2),
                                       np.array([d, e]) - 1e-2 * (theta - [1.0, 0.0])), -1, 1)
        theta = theta + move
        if np.abs(move).max() < 1e-9:
            break
    return float(max(theta[0], 1e-2)), float(theta[1])


def _ranked(values: DataFrame, rank: int) -> float:
    """The ``z`` with ``rank`` smaller ones (equal ones in any order), from histograms narrowed around it."""
    low, high = values.agg(F.min("z"), F.max("z")).first()
    while low < high:
        bin_ = F.floor((F.col("z") - low) / (high - low) * 1024)
        for r in sorted(values.where(F.col("z").between(low, high)).groupBy(bin_.alias("b")).agg(
                F.count(F.lit(1)).alias("n"), F.min("z").alias("lo"), F.max("z").alias("hi")).collect()):
            if rank < r["n"]:
                low, high = r["lo"], r["hi"]
                break
            rank -= r["n"]
    return low


def _fit_shards(rows: DataFrame, n: int, shard: int, recall: float) -> Network:
    """``fit`` of windows that are more than one task's."""
    rows = rows.withColumns({"shard": F.pmod(F.xxhash64("win"), F.lit(min(SHARDS, -(-n // shard)))).cast("int"),
                             "fold": F.pmod(F.xxhash64("win", F.lit(SEED)), F.lit(4))})
    size = {(r["label"], r["fold"]): r["count"] for r in rows.groupBy("label", "fold").count().collect()}
    total = [sum(v for (y, _), v in size.items() if y == label) for label in (0, 1)]
    net = Network(_start(np.random.default_rng(SEED)))
    if min(total) < FEW:
        return net
    # the fold that has some of each label, but of neither all
    back = max(range(4), key=lambda f: (all(0 < size.get((y, f), 0) < total[y] for y in (0, 1)), f))
    if not all(0 < size.get((y, back), 0) < total[y] for y in (0, 1)):
        return net
    n0, n1 = (size[y, back] for y in (0, 1))
    share = (total[1] - n1) / (sum(total) - n0 - n1)
    shards = min(SHARDS, -(-n // shard))
    packed = materialize(rows.where(F.col("fold") != back).select("shard", "label", "win").repartition(shards, "shard").groupBy(
        "shard").applyInArrow(_packed, "shard int, y binary, x binary"))
    like, step = net.weights, 0
    state, steps = _state(net.weights, *_moments(like)), -(-2 * (sum(total) - n0 - n1) // (shards * BATCH))
    passes = -(-STEPS // (EPOCHS * max(1, steps)))
    for job in range(EPOCHS):
        made = packed.mapInArrow(_passes(state, like, step, job, passes, share), "shard int, n long, step long, state binary").collect()
        made.sort(key=lambda r: r["shard"])  # at most ``SHARDS`` rows
        state = np.average([np.frombuffer(r["state"], np.float32).astype(float) for r in made], axis=0, weights=[r["n"] for r in made])
        step = max(r["step"] for r in made)
    net.weights = _parts(state, like)[0]
    scores = common.stored(rows.where(F.col("fold") == back).select("label", "win").mapInArrow(_logits(net), "label int, z double"))
    net.slope, net.shift = _curve(scores, n1, n0)
    highest = _ranked(scores.where("label = 1"), int(np.floor((1 - recall) * n1)))
    below = scores.where("label = 0").where(F.col("z") < highest).agg(F.max("z")).first()[0]
    shown = [1 / (1 + np.exp(-np.clip(net.slope * z + net.shift, -35, 35))) for z in (highest, below) if z is not None]
    net.threshold = _threshold(shown[0], shown[1] if len(shown) > 1 else 1e-3)
    return net


def train(docs: DataFrame, sample: int | None = None, recall: float = RECALL, shard: int = SHARD) -> Network:
    """The network of all of ``docs``' own labelled findings; with ``sample``, for trials, of that many windows of each label."""
    rows = examples(docs)
    if sample is None:
        n = rows.count()
        if n > shard:
            return _fit_shards(rows, n, shard, recall)
        if n == 0:
            return Network({})
        return pickle.loads(rows.coalesce(1).mapInArrow(_fit_all(recall), "net binary").first()["net"])
    got = []
    for y in (0, 1):
        n = rows.where(F.col("label") == y).agg(F.count(F.lit(1))).first()[0]
        some = rows.where(F.col("label") == y).where(
            F.pmod(F.xxhash64("win"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, 3 * sample / max(1, n))))
        got += [(y, r["win"]) for r in some.select("win", F.xxhash64("win", F.lit(SEED)).alias("h"))
                .orderBy("h", "win").limit(sample).collect()]
    got.sort(key=lambda g: (_crc(g[1]), g))
    return fit([w for _, w in got], np.array([y for y, _ in got]), recall)


def spans_of(value: str | None, net: Network) -> tuple[list, list]:
    """(base findings, all findings) of one text."""
    text = value or ""
    spans = base(text)
    more = candidates(text, spans) if net.threshold <= 1 else []
    if not more:
        return spans, spans
    each = [windows_of(text, a, z) for a, z in more]
    starts = np.cumsum([0] + [len(w) for w in each[:-1]])
    p = np.maximum.reduceat(net.probability([w for ws in each for w in ws]), starts)
    return spans, sorted(spans + [(a, 3, z) for (a, z), q in zip(more, p) if q >= net.threshold])


def _found(net):
    def run(batches):
        for batch in batches:
            out = []
            for value in batch.column("text"):
                own, every = spans_of(value.as_py(), net)
                n = [sum(k == j for _, k, _ in own) for j in range(3)]
                out.append((*n, hashlib.sha256(spelled(own).encode()).hexdigest(), spelled(every)))
            rest = batch.drop_columns(["text"])
            cols = list(zip(*out)) if out else [()] * 5
            for name, kind, col in zip(("n_assign", "n_access", "n_hex", "base_sha256", "spans"),
                                       (pa.int64(),) * 3 + (pa.string(),) * 2, cols):
                rest = rest.append_column(name, pa.array(col, kind))
            yield rest
    return run


def found(docs: DataFrame, net: Network, *keep: str) -> DataFrame:
    """The ``keep`` columns, counts of base findings, their digest and all spans."""
    d = docs.select(*keep, "text")
    return d.mapInArrow(_found(net), T.StructType(
        [f for f in d.schema if f.name != "text"]
        + [T.StructField(n, T.LongType()) for n in ("n_assign", "n_access", "n_hex")]
        + [T.StructField(n, T.StringType()) for n in ("base_sha256", "spans")]))


def replaced(value: str, spans: list, mark: str) -> str:
    """``value`` with every stretch covered by spans replaced by ``mark``."""
    out, at = [], 0
    for a, _, z in spans:
        if a >= at:
            out += [value[at:a], mark]
        at = max(at, z)
    return "".join(out) + value[at:]


def _redacted(net, mark):
    def run(batches):
        for batch in batches:
            i = batch.schema.get_field_index("text")
            out = [None if v.as_py() is None else replaced(v.as_py(), spans_of(v.as_py(), net)[1], mark)
                   for v in batch.column(i)]
            yield batch.set_column(i, batch.schema.field(i), pa.array(out, batch.schema.field(i).type))
    return run


def redacted(docs: DataFrame, net: Network, mark: str = "<secret>") -> DataFrame:
    """``docs`` with all findings replaced in the text."""
    return docs.mapInArrow(_redacted(net, mark), docs.schema)


def op1_secrets_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return found(docs, train(docs), "doc_id")
