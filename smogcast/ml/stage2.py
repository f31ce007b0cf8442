"""Stage 2: stacked features, weighted multiclass trees and feature importance
(OP-73, OP-74, OP-68); calibration (OP-75) is in :mod:`smogcast.ml.isotonic`."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smogcast.functions.scalars import alarm
from smogcast.ml.boosting import BoostConfig
from smogcast.ml.isotonic import N_CLASSES, IsotonicCalibrator  # noqa: F401
from smogcast.ml.stage1 import assembler

STAGE2_EXTRA = ["Predicted_AQI", "alarm_predicted_poor", "alarm_lag_poor"]


def add_stage2_features(df: DataFrame, predicted: str = "Predicted_AQI", lag1: str = "AQI_lag_1") -> DataFrame:
    """OP-73 (+OP-35): the stage-1 prediction and two alarm flags become features."""
    return df.withColumns({"alarm_predicted_poor": alarm(predicted), "alarm_lag_poor": alarm(lag1)})


def padded_probs(col: str = "probability", n: int = N_CLASSES) -> Column:
    """MLlib sizes the probability vector by the largest label seen; pad to
    the fixed class count so absent classes read as probability 0."""
    arr = vector_to_array(F.col(col))
    pad = F.array_repeat(F.lit(0.0), F.greatest(F.lit(n) - F.size(arr), F.lit(0)))
    return F.slice(F.concat(arr, pad), 1, n)


def fit_forest(df: DataFrame, features: list[str], label: str, weight: str | None = "weight",
               trees: int = 30, depth: int = 6, seed: int = 42) -> PipelineModel:
    """OP-74: weighted random forest with class probabilities."""
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, weightCol=weight, numTrees=trees,
                                maxDepth=depth, seed=seed, maxBins=64, subsamplingRate=0.8,
                                featureSubsetStrategy="sqrt")
    return Pipeline(stages=[assembler(features), rf]).fit(df.withColumn(label, F.col(label).cast("double")))


#: Published sizes of the boosted classifier (fixed values) and of the earlier job's.
BOOSTED = BoostConfig(rounds=500, step=0.02, max_depth=6, leaves=31, min_rows=15, row_share=0.8, column_share=0.8, reg_alpha=1.0,
                      reg_lambda=2.0, loss="softmax", classes=N_CLASSES)
BOOSTED_STRATIFIED = replace(BOOSTED, rounds=300, step=0.03, max_depth=5, leaves=20, min_rows=20)
BOOSTED_ENSEMBLE = replace(BOOSTED, min_rows=20, row_share=1.0, column_share=1.0, reg_alpha=0.0, reg_lambda=0.0)


def feature_importance(spark: SparkSession, importances, names: list[str], top: int = 10,
                       subset: list[str] | None = None) -> DataFrame:
    """OP-68: (Feature, Importance) sorted descending, top-k (the limit is the
    feature: a top-k report), optionally restricted to a subset of names."""
    rows = [(n, float(v)) for n, v in zip(names, importances)]
    df = spark.createDataFrame(rows, "Feature string, Importance double")
    if subset is not None:
        return df.where(F.col("Feature").isin(subset)).orderBy(F.col("Importance").desc(), "Feature")
    return df.orderBy(F.col("Importance").desc(), "Feature").limit(top)
