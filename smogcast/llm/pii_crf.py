"""Personal data: pattern findings, and a character BiLSTM with CRF transitions for the rest.

Patterns give the base findings of the four kinds. All of them hold a digit or an
at sign, so the network reads every stretch of ``REACH`` characters around such a
sign (joined where they overlap) and nothing else. A stretch is covered by windows
of ``LENGTH`` characters, half overlapping; the windows' emissions are averaged,
weighted towards their middles, and one Viterbi pass over the whole stretch
reconciles them. Decoded spans that touch no base finding are added under the
kinds of ``ADDED``.

The network is trained in numpy on windows labelled by the base findings, at most
``SAMPLE`` different ones with and without findings, chosen by hash, by maximum
CRF likelihood with Adam.

Edge cases: a null or empty text has no findings; repeated rows have the same;
very long texts are read whole; an empty table gives no rows; with fewer than
``FEW`` labelled windows of either sort nothing is added to the base. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smogcast.llm import common

KINDS = ("email", "ip", "card", "phone")
ADDED = tuple(f"crf_{k}" for k in KINDS)
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SIGN = re.compile(r"[0-9@]")
REACH, LENGTH, SHORTEST = 16, 64, 6
SAMPLE, FEW = 900, 8
CODES, EMBED, HIDDEN, TAGS = 98, 12, 16, 9
EPOCHS, BATCH, RATE, SEED = 8, 32, 0.01, 7


def emails(value: str) -> list[tuple[int, int]]:
    """The e-mail pattern's matches, found from their at signs so that long runs cost linear time."""
    out, last, at = [], 0, value.find("@")
    while at >= 0:
        a = at
        while a > last and value[a - 1] in LOCAL:
            a -= 1
        m = DOMAIN.match(value, at + 1) if a < at else None
        last = m.end() if m else at + 1
        if m:
            out.append((a, last))
        at = value.find("@", last)
    return out


def luhn(digits: str) -> bool:
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def base(value: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the pattern findings in order."""
    out = [(a, 0, z) for a, z in emails(value)]
    for m in IP.finditer(value):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(value):
        if 14 <= m.end() - m.start() <= 37:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(value):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{(KINDS + ADDED)[k]}:{a}:{z}" for a, k, z in spans)


def stretches(value: str) -> list[tuple[int, int]]:
    """Joined surroundings of all digits and at signs."""
    out: list[list[int]] = []
    for m in SIGN.finditer(value):
        a, z = max(0, m.start() - REACH), min(len(value), m.end() + REACH)
        if out and a <= out[-1][1]:
            out[-1][1] = z
        else:
            out.append([a, z])
    return [(a, z) for a, z in out]


def tiles(n: int) -> list[int]:
    """Window starts that cover a stretch of ``n`` characters, half overlapping."""
    return list(range(0, max(1, n - LENGTH // 2), LENGTH // 2))


def codes(text: str) -> np.ndarray:
    """Characters as 1 to 97: ASCII marks as such, letters beyond 96, the rest 97."""
    x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return np.where((x >= 32) & (x < 127), x - 31, np.where(x >= 0xC0, 96, 97))


def tags_of(n: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """0 outside, 1 + 2k where a finding of kind k starts, 2 + 2k inside it; of overlapping findings the first."""
    out = np.zeros(n, np.uint8)
    for a, k, z in spans:
        if not out[a:z].any():
            out[a:z] = 2 + 2 * k
            out[a] = 1 + 2 * k
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lstm(w: dict, d: str, x: np.ndarray, keep: bool):
    """Hidden states of one direction; ``x`` in reading order of that direction."""
    table = w["embed"] @ w[d + "in"] + w[d + "bias"]
    n, length = x.shape
    h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
    out, past = np.empty((n, length, HIDDEN)), []
    for t in range(length):
        z = table[x[:, t]] + h @ w[d + "rec"]
        gates = _sigmoid(z[:, :3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
        g = np.tanh(z[:, 3 * HIDDEN:])
        new = f * c + i * g
        tc = np.tanh(new)
        if keep:
            past.append((h, c, i, f, o, g, tc))
        h, c = o * tc, new
        out[:, t] = h
    return out, past


def _lstm_back(w: dict, d: str, x: np.ndarray, past: list, dout: np.ndarray, grads: dict) -> None:
    n, length = x.shape
    dtable = np.zeros((CODES, 4 * HIDDEN))
    drec = np.zeros_like(w[d + "rec"])
    dh, dc = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
    for t in range(length - 1, -1, -1):
        h, c, i, f, o, g, tc = past[t]
        dh = dh + dout[:, t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
        np.add.at(dtable, x[:, t], dz)
        drec += h.T @ dz
        dh, dc = dz @ w[d + "rec"].T, dc * f
    grads[d + "rec"] = drec
    grads[d + "in"] = w["embed"].T @ dtable
    grads[d + "bias"] = dtable.sum(0)
    grads["embed"] = grads.get("embed", 0) + dtable @ w[d + "in"].T


def _lse(x, axis):
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def crf_gradient(emit: np.ndarray, step: np.ndarray, tags: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log likelihood of ``tags`` and its gradients by emissions and transitions."""
    n, length, k = emit.shape
    forward, back = np.empty_like(emit), np.zeros_like(emit)
    forward[:, 0] = emit[:, 0]
    for t in range(1, length):
        forward[:, t] = _lse(forward[:, t - 1, :, None] + step, 1) + emit[:, t]
    for t in range(length - 2, -1, -1):
        back[:, t] = _lse(step + (emit[:, t + 1] + back[:, t + 1])[:, None, :], 2)
    z = _lse(forward[:, -1], 1)
    demit = np.exp(forward + back - z[:, None, None])
    pair = np.exp(forward[:, :-1, :, None] + step + (emit + back)[:, 1:, None, :] - z[:, None, None, None]).sum((0, 1))
    rows, places = np.arange(n)[:, None], np.arange(length)
    gold = emit[rows, places, tags].sum() + step[tags[:, :-1], tags[:, 1:]].sum()
    demit[rows, places, tags] -= 1
    np.add.at(pair, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), -1)
    return float((z.sum() - gold) / n), demit / n, pair / n


@dataclass
class Tagger:
    weights: dict
    fitted: bool = False

    def states(self, x: np.ndarray, keep: bool = False):
        ahead, p1 = _lstm(self.weights, "f_", x, keep)
        behind, p2 = _lstm(self.weights, "b_", x[:, ::-1], keep)
        return np.concatenate([ahead, behind[:, ::-1]], 2), p1, p2

    def emissions(self, x: np.ndarray) -> np.ndarray:
        return self.states(x)[0] @ self.weights["out"] + self.weights["out_bias"]

    def stretch_emissions(self, parts: list[np.ndarray]) -> list[np.ndarray]:
        """Emissions of whole stretches: windows run together, averaged where they overlap."""
        rows = [(p, s) for p, x in enumerate(parts) for s in tiles(len(x))]
        out = [np.zeros((len(x), TAGS)) for x in parts]
        mass = [np.zeros((len(x), 1)) for x in parts]
        ramp = 1.0 + np.minimum(np.arange(LENGTH), np.arange(LENGTH)[::-1])[:, None]
        for a in range(0, len(rows), 512):
            some = rows[a:a + 512]
            x = np.zeros((len(some), LENGTH), np.int64)
            for i, (p, s) in enumerate(some):
                cut = parts[p][s:s + LENGTH]
                x[i, :len(cut)] = cut
            for (p, s), e in zip(some, self.emissions(x)):
                n = min(LENGTH, len(parts[p]) - s)
                out[p][s:s + n] += (e * ramp)[:n]
                mass[p][s:s + n] += ramp[:n]
        return [o / m for o, m in zip(out, mass)]

    def decode(self, emit: np.ndarray) -> np.ndarray:
        """The best tags of one stretch."""
        step = self.weights["step"]
        score, back = emit[0], np.empty((len(emit), TAGS), np.int8)
        for t in range(1, len(emit)):
            every = score[:, None] + step
            back[t] = every.argmax(0)
            score = every.max(0) + emit[t]
        tags = np.empty(len(emit), np.int64)
        tags[-1] = score.argmax()
        for t in range(len(emit) - 1, 0, -1):
            tags[t - 1] = back[t, tags[t]]
        return tags


def spans_in(tags: np.ndarray, offset: int) -> list[tuple[int, int, int]]:
    """(start, kind, end) of runs of one kind; a start tag opens a new run."""
    out, kind = [], (tags + 1) // 2
    cut = np.flatnonzero((kind[1:] != kind[:-1]) | ((tags[1:] % 2 == 1) & (tags[1:] != tags[:-1]))) + 1
    for a, z in zip([0, *cut.tolist()], [*cut.tolist(), len(tags)]):
        if kind[a]:
            out.append((a + offset, int(kind[a]) - 1, z + offset))
    return out


def fit(windows: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS) -> Tagger:
    """Train on (codes, tags) windows of LENGTH."""
    rng = np.random.default_rng(SEED)
    shape = {"embed": (CODES, EMBED), "out": (2 * HIDDEN, TAGS), "out_bias": (TAGS,), "step": (TAGS, TAGS)}
    for d in ("f_", "b_"):
        shape |= {d + "in": (EMBED, 4 * HIDDEN), d + "rec": (HIDDEN, 4 * HIDDEN), d + "bias": (4 * HIDDEN,)}
    w = {k: rng.normal(0, 0.3, s) if "bias" not in k and k != "step" else np.zeros(s) for k, s in shape.items()}
    tagger = Tagger(w)
    with_span = sum(bool(t.any()) for _, t in windows)
    if with_span < FEW or len(windows) - with_span < FEW:
        return tagger
    x, y = np.stack([c for c, _ in windows]), np.stack([t for _, t in windows])
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    n = 0
    while n < 80 or n < epochs * len(x) / BATCH:
        order = rng.permutation(len(x))
        for a in range(0, len(order), BATCH):
            i = order[a:a + BATCH]
            n += 1
            h, p1, p2 = tagger.states(x[i], keep=True)
            _, demit, dstep = crf_gradient(h @ w["out"] + w["out_bias"], w["step"], y[i])
            g = {"out": np.einsum("ntk,ntj->kj", h, demit), "out_bias": demit.sum((0, 1)), "step": dstep}
            dh = demit @ w["out"].T
            _lstm_back(w, "f_", x[i], p1, dh[:, :, :HIDDEN], g)
            _lstm_back(w, "b_", x[i][:, ::-1], p2, dh[:, ::-1, HIDDEN:], g)
            norm = np.sqrt(sum((v * v).sum() for v in g.values()))
            for k, v in g.items():
                v = v * min(1.0, 5 / max(norm, 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * v
                second[k] = 0.999 * second[k] + 0.001 * v * v
                w[k] = w[k] - RATE * (first[k] / (1 - 0.9 ** n)) / (np.sqrt(second[k] / (1 - 0.999 ** n)) + 1e-8)
    tagger.fitted = True
    return tagger


def _windows(value: str) -> list[tuple[int, str, bytes]]:
    """(has a finding, text, tags) of the windows of one text."""
    every, out = tags_of(len(value), base(value)), []
    for a, z in stretches(value):
        for s in tiles(z - a):
            low, high = a + s, min(z, a + s + LENGTH)
            out.append((int(every[low:high].any()), value[low:high], every[low:high].tobytes()))
    return out


def _examples(batches):
    for batch in batches:
        out = [w for v in batch.column("text") for w in _windows(v.as_py() or "")]
        yield pa.RecordBatch.from_arrays([pa.array([h for h, _, _ in out], pa.int32()), pa.array([t for _, t, _ in out], pa.string()),
                                          pa.array([y for _, _, y in out], pa.binary())], ["has", "win", "tags"])


def train(docs: DataFrame, sample: int = SAMPLE) -> Tagger:
    """A tagger of ``docs``' own labelled windows, at most ``sample`` different ones with and without findings."""
    rows = common.stored(docs.select("text").mapInArrow(_examples, "has int, win string, tags binary")
                         .groupBy("has", "win").agg(F.min("tags").alias("tags")))
    got = []
    for has in (0, 1):
        n = rows.where(F.col("has") == has).agg(F.count(F.lit(1))).first()[0]
        some = rows.where(F.col("has") == has).where(
            F.pmod(F.xxhash64("win"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, 3 * sample / max(1, n))))
        got += [(r["win"], bytes(r["tags"])) for r in some.select(
            "win", "tags", F.xxhash64("win", F.lit(SEED)).alias("h")).orderBy("h", "win").limit(sample).collect()]
    got.sort(key=lambda g: (zlib.crc32(g[0].encode()), g))
    windows = []
    for win, tags in got:
        x, y = np.zeros(LENGTH, np.int64), np.zeros(LENGTH, np.int64)
        x[:len(win)], y[:len(win)] = codes(win), np.frombuffer(tags, np.uint8)
        windows.append((x, y))
    return fit(windows)


def spans_of(values: list[str], tagger: Tagger) -> list[tuple[list, list]]:
    """(base findings, all findings) of every text; the stretches of all texts run together."""
    own = [base(v) for v in values]
    if not tagger.fitted:
        return [(s, s) for s in own]
    every = [list(s) for s in own]
    places = [(i, a, z) for i, v in enumerate(values) for a, z in stretches(v)]
    emit = tagger.stretch_emissions([codes(values[i][a:z]) for i, a, z in places])
    taken = [tags_of(len(v), s) > 0 for v, s in zip(values, own)]
    for (i, a, _), e in zip(places, emit):
        for s, k, t in spans_in(tagger.decode(e), a):
            if t - s >= SHORTEST and SIGN.search(values[i], s, t) and not taken[i][s:t].any():
                every[i].append((s, k + len(KINDS), t))
    return [(s, sorted(e)) for s, e in zip(own, every)]


def _found(tagger):
    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                out = []
                for own, every in spans_of([v.as_py() or "" for v in part.column("text")], tagger):
                    n = [sum(k == j for _, k, _ in own) for j in range(4)]
                    out.append((*n, hashlib.sha256(spelled(own).encode()).hexdigest(), spelled(every)))
                rest = part.drop_columns(["text"])
                for name, kind, col in zip((*(f"n_{k}" for k in KINDS), "base_sha256", "spans"),
                                           (pa.int64(),) * 4 + (pa.string(),) * 2, zip(*out)):
                    rest = rest.append_column(name, pa.array(col, kind))
                yield rest
    return run


def found(docs: DataFrame, tagger: Tagger, *keep: str) -> DataFrame:
    """The ``keep`` columns, counts of base findings, their digest and all spans."""
    d = docs.select(*keep, "text")
    return d.mapInArrow(_found(tagger), T.StructType(
        [f for f in d.schema if f.name != "text"] + [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
        + [T.StructField(n, T.StringType()) for n in ("base_sha256", "spans")]))


def op2_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return found(docs, train(docs), "doc_id")
