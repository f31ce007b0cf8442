"""LM scoring by Brown class-based n-grams.

Counts of all training tokens are a distributed table of (64-bit word hash,
count). The most frequent words (``HEAD`` at most, chosen by a count threshold)
are broadcast as two arrays, 16 bytes a word; the counts of all other words are
joined to the tokens that need them, so the vocabulary may grow without limit.

Classes: exchange clustering moves each of the ``EXCHANGED`` most frequent words
to the class that most raises the likelihood of the class bigrams, until a
round moves none. Every other head word seen ``LEAST`` times or more then goes to the
class that most raises it, judged by the neighbour classes of all its places, which
are counted and compared in Spark; this stands if the likelihood rises with each token left
out of its own counts. Rarer words, which fewer than 2 ``LEAST`` neighbours would place by chance,
keep the class of the power of two of their count; the lowest of these also holds
the words beyond the head and unseen ones; the end is a class. Bigram
counts between these symbols are summed over the whole training fold in Spark;
what reaches the driver is bounded by the number of symbols squared.

Model: P(word | previous) = P(class | previous class) P(word | class); transitions
are interpolated with class frequencies, emissions get half a count for every
word of the class and one unseen word. ``score`` is the log10 probability of all
tokens of a text, ``perplexity`` 10 ** (-score / n_tokens).

Edge cases: a null or empty text is the end alone; a null doc_id counts as empty
text in the fold; repeated rows each count and are each scored; an empty table
gives no rows; with no training rows all counts are 0; other columns are not
read. Two words of equal hash would share a count (odds below V * V / 2 ** 65).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smogcast.llm import common, text

FOLDS, HELD_OUT = 5, 1
HEAD, EXCHANGED, CLASSES, ROUNDS = 1 << 20, 512, 32, 12
END_KEY = np.uint64(1)
LEAST = 4
BACKOFF = 20.0


def fold() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS


def token_hashes(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all rows, and their rows (the ends are left to the caller)."""
    starts, ends, doc = text.words(raw, at)
    return text.span_hashes(text.lower(raw), starts, ends), doc


def _count(batches):
    for batch in batches:
        keys, counts = [], []
        for rows, raw, at in text.pieces([batch]):
            k, c = np.unique(token_hashes(raw, at)[0], return_counts=True)
            keys.append(k)
            counts.append(c)
        if not batch.num_rows:
            continue
        k, back = np.unique(np.concatenate([*keys, [END_KEY]]).astype(np.uint64), return_inverse=True)
        c = np.bincount(back, weights=np.concatenate([*counts, [batch.num_rows]])).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c)], ["key", "c"])


def word_counts(training: DataFrame) -> DataFrame:
    """(key, c) of every distinct token of ``training``."""
    parts = training.select("text").mapInArrow(_count, "key long, c long")
    return common.stored(parts.groupBy("key").agg(F.sum("c").alias("c")))


class Head:
    """Positions of keys among the head words, by their leading bits."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys  # sorted, unsigned
        self.bits = max(1, int(len(keys)).bit_length())
        edges = np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)
        self.first = np.append(np.searchsorted(keys, edges), len(keys)).astype(np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Position of each hash, -1 if it isn't in the head."""
        out = np.full(len(hashes), -1, np.int64)
        slot = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        at, end = self.first[slot], self.first[slot + 1]
        left = np.flatnonzero(at < end)
        at = at[left]
        while len(left):
            hit = self.keys[at] == hashes[left]
            out[left[hit]] = at[hit]
            at = at + 1
            on = ~hit & (at < end[left])
            left, at = left[on], at[on]
        return out


def head_words(counts: DataFrame, most: int = HEAD) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and counts of the most frequent words, ``most`` at most, never part of a tie."""
    by_count = counts.groupBy("c").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("c")).limit(most)
    least, total = None, 0
    for row in by_count.toLocalIterator():
        total += row.n
        if total > most:
            break
        least = row.c
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    got = counts.where(F.col("c") >= least).toArrow()
    keys, c = got.column("key").to_numpy().view(np.uint64), got.column("c").to_numpy()
    order = np.argsort(keys)
    return keys[order], c[order]


def _symbol_pairs(keys, symbols, n_symbols, tail, end):
    def run(batches):
        head = Head(keys)
        seen = np.zeros(n_symbols * n_symbols, np.int64)
        for rows, raw, at in text.pieces(batches):
            h, doc = token_hashes(raw, at)
            where = head.find(h)
            s = np.where(where >= 0, symbols[where] if len(symbols) else tail, tail)
            last = np.searchsorted(doc, np.arange(rows.num_rows), "right")
            s = np.insert(s, last, end)  # each row's tokens, then its end
            left = np.concatenate([[end], s[:-1]])
            np.add.at(seen, left * n_symbols + s, 1) if len(s) < 1000 else np.add(
                seen, np.bincount(left * n_symbols + s, minlength=len(seen)), out=seen)
        code = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(seen[code])], ["code", "n"])
    return run


def _xlogx(x):
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def exchange(pairs: np.ndarray, movable: int, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Class of every symbol: the first ``movable`` (by falling frequency) are exchanged among ``classes``,
    every later symbol keeps a class of its own."""
    n = len(pairs)
    classes = min(classes, max(1, movable))
    of = np.concatenate([np.arange(movable) % classes, classes + np.arange(n - movable)]).astype(np.int64)
    k = classes + n - movable
    member = np.zeros((n, k))
    member[np.arange(n), of] = 1
    grid = member.T @ pairs @ member
    right, left = pairs @ member, pairs.T @ member  # kept in step with every move
    for _ in range(rounds):
        moved = False
        for w in range(movable):
            old, own = of[w], pairs[w, w]
            row, col = right[w].copy(), left[w].copy()
            row[old] -= own
            col[old] -= own
            grid[old, :] -= row
            grid[:, old] -= col
            grid[old, old] -= own
            gains = np.empty(classes)
            out, inn, each = grid[:classes].sum(1) + col[:classes], grid[:, :classes].sum(0) + row[:classes], np.arange(classes)
            a, b = grid[:classes], grid[:, :classes]
            new_a, new_b = a + row, b + col[:, None]
            corner = a[each, each]
            new_a[each, each] += col[:classes] + own
            gains = ((_xlogx(new_a) - _xlogx(a)).sum(1) + (_xlogx(new_b) - _xlogx(b)).sum(0)
                     - _xlogx(new_b[each, each]) + _xlogx(corner)
                     - _xlogx(out + row.sum() + own) + _xlogx(out) - _xlogx(inn + col.sum() + own) + _xlogx(inn))
            new = int(np.argmax(gains)) if gains.max() > gains[old] + 1e-9 else int(old)
            grid[new, :] += row
            grid[:, new] += col
            grid[new, new] += own
            if new != old:
                moved = True
                of[w] = new
                right[:, old] -= pairs[:, w]
                right[:, new] += pairs[:, w]
                left[:, old] -= pairs[w]
                left[:, new] += pairs[w]
        if not moved:
            break
    return of


def likelihood(grid: np.ndarray) -> float:
    """Log likelihood of class bigrams, without the part that no exchange changes."""
    return float(_xlogx(grid).sum() - _xlogx(grid.sum(0)).sum() - _xlogx(grid.sum(1)).sum())


def move_gains(grid: np.ndarray, right: np.ndarray, left: np.ndarray, own: np.ndarray, old: np.ndarray) -> np.ndarray:
    """(words, classes): likelihood of each word in each class, less that without the word. ``right`` and ``left``:
    counts of its neighbour classes, ``own``: of the word after itself, which they leave out; ``old``: its class."""
    w = np.arange(len(old))
    g = np.repeat(grid[None], len(old), 0)
    g[w, old] -= right
    g[w, :, old] -= left
    g[w, old, old] -= own
    out, inn, d = g.sum(2) + left, g.sum(1) + right, np.einsum("wkk->wk", g)
    logs = _xlogx(g)
    gains = (_xlogx(g + right[:, None, :]) - logs).sum(2) + (_xlogx(g + left[:, :, None]) - logs).sum(1)
    gains += _xlogx(d + right + left + own[:, None]) + _xlogx(d) - _xlogx(d + right) - _xlogx(d + left)
    n_out, n_in = (right.sum(1) + own)[:, None], (left.sum(1) + own)[:, None]
    return gains - _xlogx(out + n_out) + _xlogx(out) - _xlogx(inn + n_in) + _xlogx(inn)


def _contexts(keys, kinds, k, tail, end, rest):
    """Counts of the neighbour classes of the words of ``rest``: code c after the word, k + c before it, 2k itself."""
    width, free = 2 * k + 1, np.append(rest, False)

    def merged(cells, counts):
        cell, back = np.unique(np.concatenate(cells), return_inverse=True)
        return cell, np.bincount(back, weights=np.concatenate(counts)).astype(np.int64)

    def batch(cell, n):
        return pa.RecordBatch.from_arrays([pa.array(cell // width), pa.array(cell % width), pa.array(n)], ["pos", "code", "n"])

    def run(batches):
        head, cells, counts, size = Head(keys), [], [], 0
        for rows, raw, at in text.pieces(batches):
            h, doc = token_hashes(raw, at)
            word = head.find(h)
            last = np.searchsorted(doc, np.arange(rows.num_rows), "right")
            kind = np.insert(np.where(word >= 0, kinds[word], tail), last, end)
            word = np.insert(word, last, -1)
            kind_before, word_before = np.concatenate([[end], kind[:-1]]), np.concatenate([[-1], word[:-1]])
            same = word == word_before
            a, b, c = free[word_before] & ~same, free[word] & ~same, free[word] & same
            cell, n = np.unique(np.concatenate([word_before[a] * width + kind[a], word[b] * width + k + kind_before[b],
                                                word[c] * width + 2 * k]), return_counts=True)
            cells.append(cell)
            counts.append(n)
            size += len(cell)
            if size > 1 << 21:
                cell, n = merged(cells, counts)
                cells, counts, size = [cell], [n], len(cell)
                if size > 1 << 20:
                    yield batch(cell, n)
                    cells, counts, size = [], [], 0
        if size:
            yield batch(*merged(cells, counts))
    return run


def _choices(grid, kinds, classes):
    """The class of the highest gain for each word, where it is not its own: one of ``classes`` exchanged ones."""
    k = len(grid)

    def run(batches):
        table = pa.Table.from_batches(list(batches), pa.schema([("pos", pa.int64()), ("code", pa.int64()), ("n", pa.int64())]))
        pos, code, n = (table.column(c).to_numpy() for c in ("pos", "code", "n"))
        order = np.argsort(pos, kind="stable")
        pos, code, n = pos[order], code[order], n[order]
        words, first = np.unique(pos, return_index=True)
        first = np.append(first, len(pos))
        for a in range(0, len(words), 128):
            some = words[a:a + 128]
            at = slice(first[a], first[min(a + 128, len(words))])
            seen = np.zeros((len(some), 2 * k + 1))
            seen[np.searchsorted(some, pos[at]), code[at]] = n[at]
            old, each = kinds[some], np.arange(len(some))
            gains = move_gains(grid, seen[:, :k], seen[:, k:2 * k], seen[:, 2 * k], old)
            new = gains[:, :classes].argmax(1)
            moves = gains[each, new] > gains[each, old] + 1e-6
            yield pa.RecordBatch.from_arrays([pa.array(some[moves]), pa.array(new[moves])], ["pos", "kind"])
    return run


def _grid(training: DataFrame, keys, symbols, n: int, tail: int, end: int) -> np.ndarray:
    """Bigram counts between symbols over all of ``training``."""
    cells = (training.select("text").mapInArrow(_symbol_pairs(keys, symbols, n, tail, end), "code long, n long")
             .groupBy("code").agg(F.sum("n").alias("n")).toArrow())
    pairs = np.zeros(n * n)
    pairs[cells.column("code").to_numpy()] = cells.column("n").to_numpy()
    return pairs.reshape(n, n)


def left_out(grid: np.ndarray, words: np.ndarray) -> float:
    """Log likelihood of the model when every token is judged by the counts of all others (but for the words' own counts,
    which no choice of classes changes). ``words``: the number of words of each class."""
    mass, out = grid.sum(0), grid.sum(1, keepdims=True)
    alone = (mass + 0.5) / (mass.sum() + 0.5 * len(grid))
    step = (np.maximum(grid - 1, 0) + BACKOFF * alone[None, :]) / (np.maximum(out - 1, 0) + BACKOFF)
    return float((grid * np.log(step)).sum() - (mass * np.log(np.maximum(mass - 1, 0) + 0.5 * (words + 1))).sum())


def spread(training: DataFrame, keys, kinds, rest, grid, classes: int, tail: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the head words, and bigram counts of classes, after the words of ``rest`` chose theirs.

    The choice stands if it raises the likelihood with each token left out of its own counts.
    """
    k = len(grid)
    if not classes or not rest.any():
        return kinds, grid
    counts = training.select("text").mapInArrow(_contexts(keys, kinds, k, tail, end, rest), "pos long, code long, n long")
    got = (counts.repartition("pos").groupBy("pos", "code").agg(F.sum("n").alias("n"))
           .mapInArrow(_choices(grid, kinds, classes), "pos long, kind long").toArrow())
    tried = kinds.copy()
    tried[got.column("pos").to_numpy()] = got.column("kind").to_numpy()
    table = _grid(training, keys, tried, k, tail, end)
    before, after = (left_out(g, np.bincount(x, minlength=k)) for g, x in ((grid, kinds), (table, tried)))
    return (tried, table) if after > before else (kinds, grid)


@dataclass
class Model:
    """Everything a scoring task needs; arrays over head words and classes only."""

    total: int
    distinct: int
    end_count: int
    keys: np.ndarray
    counts: np.ndarray
    word_class: np.ndarray
    tail_class: int
    end_class: int
    steps: np.ndarray  # log10 P(class | previous class)
    held: np.ndarray  # log10 denominators of the emissions, by class

    def base_less(self) -> float:
        return float(np.log10(self.total + 0.5 * (self.distinct + 1)))


def train(training: DataFrame, head: int = HEAD, exchanged: int = EXCHANGED, classes: int = CLASSES) -> tuple[Model, DataFrame]:
    """The model and the table of all counts."""
    counts = word_counts(training)
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    keys, c = head_words(counts, head)
    end_rows = counts.where(F.col("key") == int(END_KEY)).collect()
    end_count = end_rows[0].c if end_rows else 0
    words = keys != END_KEY
    keys, c = keys[words], c[words]
    rank = np.empty(len(c), np.int64)
    rank[np.lexsort((keys, -c))] = np.arange(len(c))
    movable = min(exchanged, len(c))
    band = np.floor(np.log2(np.maximum(c, 1))).astype(np.int64)
    rest = rank >= movable
    bands = np.unique(band[rest])
    symbols = np.where(rest, movable + np.searchsorted(bands, band), rank)
    tail, end = movable, movable + max(1, len(bands))
    n = end + 1
    pairs = _grid(training, keys, symbols, n, tail, end)
    of = exchange(pairs, movable, classes)
    k = int(of.max()) + 1
    member = np.zeros((n, k))
    member[np.arange(n), of] = 1
    kind, grid = spread(training, keys, of[symbols], rest & (c >= LEAST), member.T @ pairs @ member,
                        min(classes, movable), int(of[tail]), int(of[end]))
    mass = grid.sum(0)
    alone = (mass + 0.5) / (mass.sum() + 0.5 * k)
    out = grid.sum(1, keepdims=True)
    steps = np.log10((grid + BACKOFF * alone[None, :]) / (out + BACKOFF))
    kinds = np.bincount(kind, minlength=k).astype(float)
    kinds[of[tail]] += distinct - len(keys) - (end_count > 0)
    kinds[of[end]] = 1
    held = np.log10(mass + 0.5 * (kinds + 1))
    return Model(int(total), int(distinct), int(end_count), keys, c, kind, int(of[tail]), int(of[end]),
                 steps, held), counts


def _score(model):
    def run(batches):
        head, less = Head(model.keys), model.base_less()
        logs = np.log10(model.counts + 0.5)
        own = logs - model.held[model.word_class]
        end_log = float(np.log10(model.end_count + 0.5))
        row = TaskContext.get().partitionId() << 33
        for rows, raw, at in text.pieces(batches):
            n = rows.num_rows
            h, doc = token_hashes(raw, at)
            where = head.find(h)
            known = where >= 0
            kind = np.full(len(h), model.tail_class)
            kind[known] = model.word_class[where[known]]
            emitted = np.full(len(h), -model.held[model.tail_class])  # the joined counts are added later
            emitted[known] = own[where[known]]
            plain = np.full(len(h), -less)
            plain[known] += logs[where[known]]
            last = np.searchsorted(doc, np.arange(n), "right")
            path = np.insert(kind, last, model.end_class)
            step = model.steps[np.concatenate([[model.end_class], path[:-1]]), path]
            path_doc = np.insert(doc, last, np.arange(n))
            base = text.row_sums(plain, doc, n) + end_log - less
            score = (text.row_sums(step, path_doc, n) + text.row_sums(emitted, doc, n)
                     + end_log - model.held[model.end_class])
            far = h[~known].view(np.int64)
            bounds = np.concatenate([[0], np.cumsum(np.bincount(doc[~known], minlength=n))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(row + np.arange(n)), pa.array(np.bincount(doc, minlength=n) + 1),
                 pa.array(np.bincount(doc[known], minlength=n) + int(model.end_count > 0)), pa.array(base), pa.array(score),
                 pa.ListArray.from_arrays(pa.array(bounds), pa.array(far))],
                ["doc_id", "row", "n_tokens", "head_known", "base", "class_score", "far"])
            row += n
    return run


def scored(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score and perplexity of every row."""
    d = docs.select("doc_id", "text")
    kind = d.schema["doc_id"].dataType.simpleString()
    near = common.stored(d.mapInArrow(_score(model), f"doc_id {kind}, row long, n_tokens long, head_known long, "
                                                     "base double, class_score double, far array<long>"))
    far = near.where(F.size("far") > 0).select("row", F.explode("far").alias("key"))
    head = counts.where(F.col("c") < int(model.counts.min())) if len(model.counts) else counts
    extra = far.join(head, "key", "left").groupBy("row").agg(
        F.sum(F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.5))).alias("logs"), F.count("c").alias("more"))
    logs = F.coalesce("logs", F.lit(0.0))
    return near.drop("far").join(extra, "row", "left").select(
        "doc_id", "n_tokens", (F.col("head_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        (F.col("base") + logs).alias("base_score"), (F.col("class_score") + logs).alias("score")).withColumn(
        "perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def op8_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model, counts = train(docs.where(fold() != HELD_OUT))
    return scored(docs, model, counts).select(
        "doc_id", (fold() == HELD_OUT).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")
