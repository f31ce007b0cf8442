"""Sinks (OP-03 forecast CSV, OP-05 nested responses)."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogcast.session import materialize

FORECAST_COLUMNS = ["ds", "yhat", "yhat_lower", "yhat_upper", "trend", "aqi_category"]


def in_order(df: DataFrame, by: list[str]) -> DataFrame:
    """OP-67: a total order over many files. Ranges of ``by`` go to numbered partitions, each sorted: the rows
    of the written files, file after file, are in order, and no task sorts more than its range."""
    return df.repartitionByRange(*by).sortWithinPartitions(*by)


def with_position(df: DataFrame, by: list[str], out: str = "position") -> DataFrame:
    """OP-67: adds each row's 1-based place in the order of ``by`` (rows that tie are numbered in some order).

    The rows of each range are numbered where they were sorted and written down;
    the ranges are shifted by the numbers of rows before them, one row a range.
    """
    ranged = materialize(in_order(df, by).withColumns({
        "__part": F.spark_partition_id(), "__row": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}))
    sizes = {r["__part"]: r["n"] for r in ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).collect()}  # one a range
    parts = sorted(sizes)
    before = df.sparkSession.createDataFrame(list(zip(parts, accumulate([0, *(sizes[p] for p in parts)]))),
                                             "__part int, __before long")
    return ranged.join(before, "__part").withColumn(out, F.col("__before") + F.col("__row") + 1).drop("__part", "__row", "__before")


def write_forecast_csv(forecast: DataFrame, path: str, key: str | None = "series_key") -> None:
    """OP-03: the forecast's selected columns as CSV with a header, one folder
    per series, in order of date (OP-67)."""
    order = ([key] if key else []) + ["ds"]
    w = in_order(forecast.select(*order, *[c for c in FORECAST_COLUMNS if c != "ds"]), order).write.mode("overwrite").option("header", True)
    if key:
        w = w.partitionBy(key)
    w.csv(path)


def read_forecast_csv(spark: SparkSession, path: str, key: str = "series_key") -> DataFrame:
    """What :func:`write_forecast_csv` wrote."""
    schema = f"ds date, yhat double, yhat_lower double, yhat_upper double, trend double, aqi_category string, {key} string"
    return spark.read.schema(schema).option("header", True).csv(path)


def write_responses_json(responses: DataFrame, path: str) -> None:
    """OP-05: nested response records as JSON lines."""
    responses.write.mode("overwrite").json(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet sink; partition by a coarse date part for later pruning."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def with_year(df: DataFrame, date: str = "Date") -> DataFrame:
    return df.withColumn("year", F.year(date))
