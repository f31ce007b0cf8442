"""Quality rules with host-level verdicts.

Every text gets word and line counts and a set of rule failures. Failures are
counted per host (``source`` in ``documents``); an empirical beta prior, fitted
by the method of moments to the hosts' failure rates, shrinks each rate towards
the corpus, so a host with few documents is not judged by them alone. A host is
bad if the shrunk rate less ``z`` posterior standard deviations is above
``limit``; its verdict is joined back to its documents.

Edge cases: a null or empty text has no words and fails the base rule; a null
host is a host of its own; an empty table gives no rows; repeated rows each
count; with fewer than two hosts the prior is the corpus rate with ``LEAST``
pseudo-counts. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smogcast.llm import common, text

LIMIT, Z, LEAST = 0.5, 2.0, 2.0
MIN_WORDS = 50
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOLS = b"#*$%&|<>"


def repeat_words(tokens: list) -> int:
    """Words inside a 3-word window that occurs twice or more."""
    n = len(tokens)
    if n < 4:
        return 0
    ids: dict = {}
    w = np.fromiter((ids.setdefault(t, len(ids)) for t in tokens), np.int64, n)
    if len(ids) < 1 << 21:
        grams = (w[:-2] << 42) | (w[1:-1] << 21) | w[2:]
    else:  # three numbers don't fit: pairs are numbered first
        pairs = np.unique((w[:-1] << 32) | w[1:], return_inverse=True)[1]
        grams = (pairs[:-1] << 32) | w[2:]
    order = np.argsort(grams, kind="stable")
    same = grams[order][1:] == grams[order][:-1]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    inside = np.zeros(n, bool)
    for k in range(3):
        inside[k:n - 2 + k] |= twice
    return int(inside.sum())


def stats(value: str | None) -> tuple[int, int, int, int, int]:
    """COUNTS of one text."""
    raw = (value or "").encode()
    tokens = raw.split()
    n_space = len(raw) - len(raw.translate(None, text.SPACES))
    lines = Counter(x for x in raw.split(b"\n") if x.strip())
    return (len(tokens), len(value or "") - n_space, len(raw) - len(raw.translate(None, _SYMBOLS)),
            sum(lines.values()) - len(lines), repeat_words(tokens))


def _stats(batches):
    for batch in batches:
        rows = batch.drop_columns(["text"])
        found = [stats(t.as_py()) for t in batch.column("text")]
        cols = zip(*found) if found else ((),) * len(COUNTS)
        for name, col in zip(COUNTS, cols):
            rows = rows.append_column(name, pa.array(col, pa.int64()))
        yield rows


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, host, COUNTS and the failed rules of every text."""
    d = docs.select("doc_id", F.col("source").alias("host"), "text")
    schema = T.StructType([f for f in d.schema if f.name != "text"] + [T.StructField(c, T.LongType()) for c in COUNTS])
    m = d.mapInArrow(_stats, schema)
    n = F.col("n_words")
    return m.withColumn("base_failed", (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * n)).withColumn(
        "failed", F.col("base_failed") | (10 * F.col("n_symbols") > n) | (10 * F.col("n_dup_lines") > 3 * n))


def hosts(m: DataFrame, limit: float = LIMIT, z: float = Z) -> DataFrame:
    """host, n_docs, n_failed, shrunk rate, its deviation and ``bad`` for every host."""
    h = common.stored(m.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"),
                                            F.sum(F.col("failed").cast("long")).alias("n_failed")))
    k, n, s, ss, inv = h.withColumn("r", F.col("n_failed") / F.col("n_docs")).agg(
        F.count(F.lit(1)), F.sum("n_docs"), F.sum("n_failed"), F.var_samp("r"), F.avg(1 / F.col("n_docs"))).first()
    mean = (s + 0.5) / (n + 1.0) if n else 0.5
    # Between-host variance: the rates' variance less what sampling alone would give.
    between = max(0.0, (ss or 0.0) - mean * (1 - mean) * (inv or 0.0)) if k and k > 1 else 0.0
    strength = max(LEAST, mean * (1 - mean) / between - 1) if between > 0 else LEAST * 1000 if k and k > 1 else LEAST
    a, b = mean * strength + F.col("n_failed"), (1 - mean) * strength + F.col("n_docs") - F.col("n_failed")
    rate = a / (a + b)
    return h.withColumn("rate", rate).withColumn("spread", F.sqrt(rate * (1 - rate) / (a + b + 1))).withColumn(
        "bad", F.col("rate") - z * F.col("spread") > limit)


def judged(docs: DataFrame, limit: float = LIMIT, z: float = Z) -> DataFrame:
    """Every document with its counts, base rule, host's shrunk rate and ``kept``."""
    m = common.stored(measured(docs))
    h = hosts(m, limit, z).select(F.col("host").alias("_h"), "rate", "bad")
    d = m.join(h, F.col("host").eqNullSafe(F.col("_h")), "left").drop("_h")
    return d.withColumn("kept", ~F.col("base_failed") & ~F.col("bad")).withColumnRenamed("rate", "host_rate")


def op5_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(common.table(spark, sf_dir, "documents")).select(
        "doc_id", *COUNTS, "base_failed", "kept",
        (F.floor(F.col("host_rate") * 1048576.0 + 0.5) / 1048576.0).alias("host_rate"))
