"""Class and sample weights (OP-60, OP-61)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Base cost per category 0..5.
CATEGORY_BASE_WEIGHT = [1.0, 1.5, 2.0, 4.0, 5.0, 8.0]
# Extra emphasis of the earlier job: Moderate x1.5, Poor x1.5, Severe x1.2.
BOOSTS = {2: 1.5, 3: 1.5, 5: 1.2}
UNDER_PREDICTION_FACTOR = 2.0
# --- end of fixed values ----------------------------------------------------


def _base(code) -> F.Column:
    return F.element_at(F.array(*[F.lit(w) for w in CATEGORY_BASE_WEIGHT]), code + 1)


def _boost(code) -> F.Column:
    expr = F.lit(1.0)
    for c, b in BOOSTS.items():
        expr = F.when(code == c, F.lit(b)).otherwise(expr)
    return expr


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """OP-60: balanced weights n / (k * n_c) over the classes present, with the
    base-cost and boosted variants. Output has one row per present class
    (at most six), so joining it back is a broadcast of a bounded table."""
    counts = df.groupBy(F.col(label).cast("int").alias("class")).agg(F.count(F.lit(1)).alias("n_class"))
    # n and k as totals over the (<= 6 row) count table; the single-partition
    # window here only ever sees that bounded table.
    wall = Window.partitionBy()
    counts = counts.withColumns({
        "n": F.sum("n_class").over(wall),
        "k": F.count(F.lit(1)).over(wall),
    })
    balanced = counts["n"].cast("double") / (counts["k"].cast("double") * counts["n_class"].cast("double"))
    return counts.select(
        "class", "n_class",
        balanced.alias("balanced"),
        (balanced * _base(F.col("class"))).alias("weight_scaled"),
        (balanced * _boost(F.col("class"))).alias("weight_boosted"))


def attach_class_weight(df: DataFrame, label: str, weights: DataFrame,
                        which: str = "weight_scaled", out: str = "weight") -> DataFrame:
    w = weights.select(F.col("class").alias("__class"), F.col(which).alias(out))
    return (df.join(F.broadcast(w), F.col(label).cast("int") == F.col("__class"), "left")
              .drop("__class").withColumn(out, F.coalesce(F.col(out), F.lit(1.0))))


def sample_weight(actual: str, predicted: str) -> F.Column:
    """OP-61: base cost of the true class, doubled where the prediction is a
    lower category than the truth (under-prediction)."""
    a, p = F.col(actual).cast("int"), F.col(predicted).cast("int")
    return _base(a) * F.when(p < a, F.lit(UNDER_PREDICTION_FACTOR)).otherwise(F.lit(1.0))
