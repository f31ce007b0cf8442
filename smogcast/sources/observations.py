"""Observation sources (OP-01, OP-02) with explicit schemas, no inference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WEATHER_COLS = ["temp", "humidity", "precip", "windspeed", "sealevelpressure"]

OBSERVATION_SCHEMA = T.StructType(
    [T.StructField("series_key", T.StringType(), False),
     T.StructField("Date", T.StringType(), True),
     T.StructField("AQI", T.DoubleType(), True)]
    + [T.StructField(c, T.DoubleType(), True) for c in WEATHER_COLS]
)

# The forecast input of the seasonal model: date, value, two regressors and a flag.
FORECAST_INPUT_SCHEMA = T.StructType([
    T.StructField("series_key", T.StringType(), False),
    T.StructField("date", T.StringType(), True),
    T.StructField("aqi", T.DoubleType(), True),
    T.StructField("temperature", T.DoubleType(), True),
    T.StructField("wind_speed", T.DoubleType(), True),
    T.StructField("is_stubble_burning", T.IntegerType(), True),
])


def to_date_col(c: Column | str, fmt: str | None = None) -> Column:
    """OP-02: parse text to a date; malformed text becomes NULL, not an error.

    ``try_to_timestamp`` is the ANSI-safe parser; a timestamp input is cast.
    """
    col = F.col(c) if isinstance(c, str) else c
    if fmt:
        return F.try_to_timestamp(col.cast("string"), F.lit(fmt)).cast("date")
    return F.try_to_timestamp(col.cast("string")).cast("date")


def sanitize_doubles(df: DataFrame, cols: list[str]) -> DataFrame:
    """Turn NaN into NULL so Spark aggregates and comparisons follow the
    missing-value semantics (a NaN in an avg poisons it; NaN > x is true)."""
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in cols})


def read_observations(spark: SparkSession, path: str, fmt: str = "csv",
                      schema: T.StructType = OBSERVATION_SCHEMA,
                      date_col: str = "Date", date_format: str | None = None) -> DataFrame:
    """OP-01: scan a daily observation table (CSV with header, or parquet).

    The schema is explicit; the date column is parsed with :func:`to_date_col`
    and NaN doubles are sanitised to NULL at the source.
    """
    if fmt == "csv":
        df = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
    else:
        df = spark.read.format(fmt).load(path)
    if date_col in df.columns:
        df = df.withColumn(date_col, to_date_col(date_col, date_format))
    dbl = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return sanitize_doubles(df, dbl)


def duplicate_days(df: DataFrame, key: str = "series_key", date: str = "Date") -> DataFrame:
    """(key, date) pairs that occur more than once. Sources must be unique on
    them: the reference silently takes the first of duplicates; we reject."""
    return df.groupBy(key, date).count().where(F.col("count") > 1)


def assert_unique_days(df: DataFrame, key: str = "series_key", date: str = "Date") -> DataFrame:
    """Raise if any (key, date) repeats or the date is unparseable: row-based
    windows assume one row per series and day. One aggregate; at most five
    offending keys are brought back for the message."""
    bad = duplicate_days(df, key, date).limit(5).collect()
    if bad:
        raise ValueError(f"duplicate ({key}, {date}) rows, e.g. {[tuple(r)[:2] for r in bad]}")
    if df.where(F.col(date).isNull()).limit(1).count():
        raise ValueError(f"rows with a missing or unparseable {date}")
    return df
