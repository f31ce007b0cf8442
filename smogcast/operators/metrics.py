"""Distributed evaluation metrics (OP-56 .. OP-59).

Each metric is one aggregate (partial aggregation on every map task); the
confusion counts are the only intermediate, bounded by classes squared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

N_CLASSES = 6


def regression_metrics(df: DataFrame, actual: str, predicted: str,
                       group: list[str] | None = None) -> DataFrame:
    """OP-56: n, MAE, RMSE, R^2, MAPE (%), SMAPE (%).

    Zero denominators give NULL (``try_divide``) where numpy would give inf.
    SST is n * var_pop(y), the numerically stable form.
    """
    y, p = F.col(actual), F.col(predicted)
    e = y - p
    n = F.count(F.lit(1))
    sse = F.sum(e * e)
    sst = F.var_pop(y) * n.cast("double")
    aggs = [
        n.alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.lit(1.0) - F.try_divide(sse, sst)).alias("r2"),
        (F.avg(F.abs(F.try_divide(e, y))) * F.lit(100.0)).alias("mape"),
        (F.avg(F.try_divide(F.lit(2.0) * F.abs(p - y), F.abs(y) + F.abs(p))) * F.lit(100.0)).alias("smape"),
    ]
    return df.groupBy(*(group or [])).agg(*aggs)


def label_grid(spark: SparkSession, n_classes: int = N_CLASSES) -> DataFrame:
    """All (actual, predicted) cells of a fixed label set (n^2 rows)."""
    return spark.range(n_classes * n_classes).select(
        (F.col("id") / n_classes).cast("int").alias("actual"),
        (F.col("id") % n_classes).cast("int").alias("predicted"))


def confusion_matrix(df: DataFrame, actual: str, predicted: str,
                     n_classes: int = N_CLASSES) -> DataFrame:
    """OP-57: long-form confusion counts with a fixed label order; cells with
    no rows are kept as 0."""
    counts = (df.groupBy(F.col(actual).cast("int").alias("actual"),
                         F.col(predicted).cast("int").alias("predicted"))
                .agg(F.count(F.lit(1)).alias("n")))
    grid = label_grid(df.sparkSession, n_classes)
    # counts has one row per (actual, predicted) pair of category codes:
    # at most n_classes^2 rows whatever the input size, so broadcasting is safe.
    return (grid.join(F.broadcast(counts), ["actual", "predicted"], "left")
                .select("actual", "predicted", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def _per_class(cm: DataFrame) -> DataFrame:
    """tp, predicted count and support per class from long-form counts."""
    tp = cm.where(F.col("actual") == F.col("predicted")).select(F.col("actual").alias("label"),
                                                                 F.col("n").alias("tp"))
    sup = cm.groupBy(F.col("actual").alias("label")).agg(F.sum("n").alias("support"))
    pred = cm.groupBy(F.col("predicted").alias("label")).agg(F.sum("n").alias("n_pred"))
    return tp.join(sup, "label").join(pred, "label")


def _safe(num, den):
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def classification_report(df: DataFrame, actual: str, predicted: str,
                          names: list[str] | None = None) -> DataFrame:
    """OP-58: precision, recall, F1 and support for every class present in the
    truth, then accuracy, micro, macro and weighted averages over those
    classes (0 on zero division)."""
    cm = confusion_matrix(df, actual, predicted)
    pc = _per_class(cm).where(F.col("support") > 0)
    pc = pc.select(
        "label", "tp", "n_pred", "support",
        _safe(F.col("tp"), F.col("n_pred")).alias("precision"),
        _safe(F.col("tp"), F.col("support")).alias("recall"),
        _safe(F.lit(2) * F.col("tp"), F.col("n_pred") + F.col("support")).alias("f1"))
    if names:
        label_txt = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("label") + 1)
    else:
        label_txt = F.col("label").cast("string")
    rows = pc.select(label_txt.alias("label"), "precision", "recall", "f1",
                     F.col("support").cast("long").alias("support"))
    tot = pc.agg(
        F.sum("tp").alias("tp"), F.sum("n_pred").alias("n_pred"), F.sum("support").alias("support"),
        F.avg("precision").alias("macro_p"), F.avg("recall").alias("macro_r"), F.avg("f1").alias("macro_f"),
        F.try_divide(F.sum(F.col("precision") * F.col("support")), F.sum("support")).alias("w_p"),
        F.try_divide(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("w_r"),
        F.try_divide(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("w_f"))
    micro_p = _safe(F.col("tp"), F.col("n_pred"))
    micro_r = _safe(F.col("tp"), F.col("support"))
    summary = tot.select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), micro_r.alias("f1"),
                 F.col("support").cast("long").alias("support")),
        F.struct(F.lit("micro avg").alias("label"), micro_p.alias("precision"), micro_r.alias("recall"),
                 _safe(F.lit(2.0) * micro_p * micro_r, micro_p + micro_r).alias("f1"),
                 F.col("support").cast("long").alias("support")),
        F.struct(F.lit("macro avg").alias("label"), F.col("macro_p").alias("precision"),
                 F.col("macro_r").alias("recall"), F.col("macro_f").alias("f1"),
                 F.col("support").cast("long").alias("support")),
        F.struct(F.lit("weighted avg").alias("label"), F.col("w_p").alias("precision"),
                 F.col("w_r").alias("recall"), F.col("w_f").alias("f1"),
                 F.col("support").cast("long").alias("support")),
    )).alias("r")).select("r.*")
    return rows.unionByName(summary)


def f1_summary(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """OP-59: accuracy, macro-F1 and weighted-F1 over the union of true and
    predicted labels (one row)."""
    cm = confusion_matrix(df, actual, predicted)
    pc = _per_class(cm).where((F.col("support") > 0) | (F.col("n_pred") > 0))
    pc = pc.withColumn("f1", _safe(F.lit(2) * F.col("tp"), F.col("n_pred") + F.col("support")))
    return pc.agg(
        _safe(F.sum("tp"), F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("f1_macro"),
        _safe(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("f1_weighted"),
        F.sum("support").cast("long").alias("n"))
