"""Isotonic calibration (OP-75): pool-adjacent-violators as a merge of blocks.

A block is a range of scores with one fitted value: (lowest score, highest score,
sum of targets, weight). Pooling neighbours whose means do not rise is associative:
pooling parts of the range first and their blocks after gives the blocks of the
whole. So scores are grouped (equal scores are one row), range-partitioned by
(class, score) and pooled where they lie, streaming; then the blocks of ``FANIN``
neighbouring partitions are pooled together, level by level, until one list a class
is left. Targets are indicators, so a list is short: its means are rising fractions
of whole numbers that add up to the n rows, of which there are fewer than 2 n^(2/3)
(and about n^(1/3) where scores are noisy). Only that list reaches the driver.

Between blocks the fit is linear, beyond the first and last it is constant. All
classes are fitted together, one against the rest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

N_CLASSES = 6
FANIN = 16
BLOCKS = "class int, part int, lo double, hi double, s double, w double"
_NAMES = ["class", "part", "lo", "hi", "s", "w"]


class Pool:
    """Blocks of ascending scores met one by one."""

    def __init__(self):
        self.blocks: list[list[float]] = []

    def add(self, lo: float, hi: float, s: float, w: float) -> None:
        blocks = self.blocks
        while blocks and blocks[-1][2] * w >= s * blocks[-1][3]:
            lo, s, w = blocks[-1][0], blocks[-1][2] + s, blocks[-1][3] + w
            blocks.pop()
        blocks.append([lo, hi, s, w])

    def rows(self, class_: int, part: int) -> pa.RecordBatch:
        columns = list(zip(*self.blocks)) or [()] * 4
        n = len(self.blocks)
        return pa.RecordBatch.from_arrays([pa.array([class_] * n, pa.int32()), pa.array([part] * n, pa.int32()),
                                           *[pa.array(c, pa.float64()) for c in columns]], _NAMES)


def _pool_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the classes in a partition sorted by (class, lo)."""
    now, pool, part = None, Pool(), 0
    for batch in batches:
        for class_, part_, lo, hi, s, w in zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in _NAMES]):
            if class_ != now:
                if now is not None:
                    yield pool.rows(now, part)
                now, pool, part = class_, Pool(), part_
            pool.add(lo, hi, s, w)
    if now is not None:
        yield pool.rows(now, part)


def _merge(table: pa.Table) -> pa.Table:
    return pa.Table.from_batches(_pool_partition(iter(table.sort_by("lo").combine_chunks().to_batches())))


def fit_blocks(scores: DataFrame) -> DataFrame:
    """Final blocks (class, part, lo, hi, s, w) of ``scores`` (class, x, s, w): sums of targets and weights by score."""
    once = scores.groupBy("class", "x").agg(F.sum("s").alias("s"), F.sum("w").alias("w"))
    keys = ["class", "x"]
    ranged = once.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        F.col("class").cast("int").alias("class"), F.spark_partition_id().alias("part"), F.col("x").alias("lo"),
        F.col("x").alias("hi"), "s", "w")
    blocks = ranged.mapInArrow(_pool_partition, BLOCKS)
    parts = int(scores.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for _ in range(max(1, math.ceil(math.log(max(parts, 2), FANIN)))):
        blocks = blocks.withColumn("part", F.expr(f"part div {FANIN}").cast("int")).groupBy("class", "part").applyInArrow(_merge, BLOCKS)
    return blocks


def normalised(p: np.ndarray) -> np.ndarray:
    """Rows that add up to 1; a row of zeros becomes uniform."""
    total = p.sum(axis=1, keepdims=True)
    return np.where(total > 0, p / np.where(total > 0, total, 1.0), 1.0 / p.shape[1])


@dataclass
class IsotonicCalibrator:
    """Blocks (class, lo, hi, s, w) of one isotonic fit per class, and their application with renormalisation.

    A class absent from the fitted labels calibrates to 0, one without scores too.
    """
    blocks: pd.DataFrame
    classes: int = N_CLASSES

    @classmethod
    def fit(cls, df: DataFrame, probs: str, label: str, n: int = N_CLASSES) -> "IsotonicCalibrator":
        long = df.select(F.col(label).cast("int").alias("y"), F.posexplode(F.slice(probs, 1, n)).alias("class", "x")).where(
            "x IS NOT NULL AND y IS NOT NULL")
        scores = long.select("class", "x", (F.col("y") == F.col("class")).cast("double").alias("s"), F.lit(1.0).alias("w"))
        return cls(fit_blocks(scores).drop("part").toPandas().sort_values(["class", "lo"], ignore_index=True), n)

    def points(self, class_: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and fitted values at the ends of the class's blocks."""
        own = self.blocks[self.blocks["class"] == class_]
        if own.empty:
            return np.zeros(1), np.zeros(1)
        x, value = own[["lo", "hi"]].to_numpy().ravel(), np.repeat((own["s"] / own["w"]).to_numpy(), 2)
        keep = np.append(True, x[1:] > x[:-1])
        return x[keep], value[keep]

    def transform(self, df: DataFrame, probs: str, out: str = "cal_probs") -> DataFrame:
        points = [self.points(c) for c in range(self.classes)]

        def calibrated(column: pd.Series) -> pd.Series:
            p = np.stack(column.to_numpy()) if len(column) else np.zeros((0, len(points)))
            return pd.Series(list(normalised(np.stack([np.interp(p[:, c], *points[c]) for c in range(len(points))], axis=1))))
        return df.withColumn(out, F.pandas_udf(calibrated, "array<double>")(F.col(probs)))

    def save(self, path: str, spark: SparkSession) -> None:
        rows = [(int(r[0]), *map(float, r[1:])) for r in self.blocks.itertuples(index=False)]
        spark.createDataFrame(rows, "class int, lo double, hi double, s double, w double").write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, path: str, spark: SparkSession, n: int = N_CLASSES) -> "IsotonicCalibrator":
        return cls(spark.read.parquet(path).toPandas().sort_values(["class", "lo"], ignore_index=True), n)
