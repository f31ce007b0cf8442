"""Binding of the driver's star-schema tables to daily keyed observations.

No air-quality data ships with the task, so a daily series is derived from the
given tables (all of their rows):

* series key  = ``o_orderpriority``; date = ``cast(o_orderdate as date)``;
  value ``AQI = avg(o_totalprice) / 1000`` and ``n_readings = count(*)``.
* weather per ship date from ``lineitem``: windspeed, humidity, temp, precip,
  sealevelpressure (arithmetic of daily averages).

Both are hash aggregates with map-side partial aggregation, so a key holding a
third of all rows is collapsed to at most one row per (key, day) in every map
task before the shuffle. Their output is bounded by keys x calendar days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogcast.sources.observations import WEATHER_COLS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """series_key, Date, AQI, n_readings: unique on (series_key, Date)."""
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_orderpriority").alias("series_key"),
                      F.col("o_orderdate").cast("date").alias("Date"))
             .agg((F.avg("o_totalprice") / F.lit(1000.0)).alias("AQI"),
                  F.count(F.lit(1)).alias("n_readings")))


def daily_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date + the five weather columns, one row per ship date."""
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(F.col("l_shipdate").cast("date").alias("Date"))
              .agg(F.avg("l_quantity").alias("windspeed"),
                   (F.avg("l_discount") * F.lit(1000.0)).alias("humidity"),
                   (F.avg("l_tax") * F.lit(500.0)).alias("temp"),
                   F.stddev_pop("l_quantity").alias("precip"),
                   (F.lit(1000.0) + F.avg("l_discount") * F.lit(200.0)).alias("sealevelpressure")))


def observations(spark: SparkSession, sf_dir: str, with_readings: bool = False) -> DataFrame:
    """Daily observations with weather (left join on Date: days without
    shipments keep NULL weather, the natural missing values)."""
    s = daily_series(spark, sf_dir)
    if not with_readings:
        s = s.drop("n_readings")
    w = daily_weather(spark, sf_dir)
    return s.join(w, on="Date", how="left").select(
        "series_key", "Date", "AQI", *([c for c in ["n_readings"] if with_readings]), *WEATHER_COLS)


def sparse_readings_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations whose AQI is treated as missing where the day has a single
    reading (low-confidence day): a natural, data-derived source of gaps for
    the interpolation and fill operators. No row is removed."""
    o = observations(spark, sf_dir, with_readings=True)
    return o.withColumn("AQI", F.when(F.col("n_readings") >= 2, F.col("AQI"))).drop("n_readings")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date requests derived from ``events``: request_id = event_id, date text
    = the event's day, series = the priority of the user's most recent order
    (latest order date, then highest order key).

    The latest order per customer is one groupBy with map-side partial
    aggregation (a customer holding a third of all orders costs one partial
    row per map task); events attach to it by an equality join that AQE can
    broadcast or split when skewed.
    """
    ev = table(spark, sf_dir, "events")
    o = table(spark, sf_dir, "orders")
    latest = o.groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("series_key"))
    return ev.join(latest, "user_id", "left").select(
        F.col("event_id").alias("request_id"), "series_key",
        F.date_format(F.col("ts"), "yyyy-MM-dd").alias("date"))


def forecast_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forecaster's input shape (series_key, date, aqi, temperature,
    wind_speed, is_stubble_burning) bound to the observations."""
    from smogcast.functions.calendar import season_flag
    o = observations(spark, sf_dir)
    return o.select(
        "series_key",
        F.col("Date").alias("date"),
        F.col("AQI").alias("aqi"),
        F.col("temp").alias("temperature"),
        F.col("windspeed").alias("wind_speed"),
        season_flag("Date").alias("is_stubble_burning"),
    )


def history_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests for dates present in the data: one per order (request_id =
    order key, series = its priority, date = its order date)."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("request_id"), F.col("o_orderpriority").alias("series_key"),
                    F.date_format(F.col("o_orderdate"), "yyyy-MM-dd").alias("date"))


def all_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History requests plus event-derived requests (dates absent from the
    data); event ids are mapped to negative ids so the two never collide."""
    ev = requests(spark, sf_dir).withColumn("request_id", -(F.col("request_id") + 1))
    return history_requests(spark, sf_dir).unionByName(ev)
