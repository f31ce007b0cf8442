"""Stage 1: regression members and their voting ensemble (OP-69 .. OP-72).

* boosted trees, squared and asymmetric loss - :mod:`smogcast.ml.boosting`
* ridge - ``LinearRegression`` with the penalty rescaled to the closed form
* voting - unweighted mean of the members on the log scale
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogcast.ml.boosting import BoostConfig

#: Published sizes of the boosted members (fixed values): rounds, step, depth, leaves, rows and columns drawn, L1 and L2.
GBT = BoostConfig(rounds=1000, step=0.01, max_depth=7, leaves=31, row_share=0.8, column_share=0.8, reg_alpha=1.0, reg_lambda=2.0)
#: Levels of 2^6 leaves; a child needs a Hessian of 1 instead of a number of rows.
DEPTHWISE = BoostConfig(rounds=1000, step=0.01, max_depth=6, leaves=64, row_share=0.8, column_share=0.8, reg_alpha=1.0,
                        reg_lambda=2.0, min_rows=1, min_hessian=1.0)
ASYMMETRIC = replace(DEPTHWISE, loss="asymmetric")
#: The earlier job's only member.
GBT_STRATIFIED = BoostConfig(rounds=600, step=0.015, max_depth=5, leaves=18, min_rows=25, row_share=0.7, column_share=0.7,
                             reg_alpha=1.0, reg_lambda=3.0)


def voting_column(members: list[Column]) -> Column:
    """OP-72: unweighted mean of member predictions."""
    s = members[0]
    for m in members[1:]:
        s = s + m
    return s / F.lit(float(len(members)))


def assembler(features: list[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="keep")


def ridge_reg_param(df: DataFrame, label: str, alpha: float) -> float:
    """MLlib minimises (1/2n)||r||^2 + (lambda/2)||b||^2 on a label it scales
    by its std; the closed-form ridge ||r||^2 + alpha ||b||^2 therefore needs
    lambda = alpha * std_pop(y) / n. Two scalars from one aggregate."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("sd")).collect()[0]
    n, sd = int(row["n"]), float(row["sd"] or 0.0)
    return alpha * sd / n if n and sd > 0 else 0.0


def fit_ridge(df: DataFrame, features: list[str], label: str, alpha: float = 10.0,
              pred: str = "pred_ridge") -> PipelineModel:
    """OP-71: ridge regression with intercept on unscaled features."""
    from pyspark.ml import Pipeline
    lr = LinearRegression(featuresCol="features", labelCol=label, predictionCol=pred,
                          elasticNetParam=0.0, standardization=False, solver="normal",
                          regParam=ridge_reg_param(df, label, alpha), fitIntercept=True)
    return Pipeline(stages=[assembler(features), lr]).fit(df)
