"""Joins, unions and horizons (OP-44, OP-45, OP-47, OP-49)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
EVENT_RADIUS_DAYS = 1
HORIZON_DAYS = 30
# --- end of fixed values ----------------------------------------------------


def semi_filter(df: DataFrame, keys_df: DataFrame, on: list[str]) -> DataFrame:
    """OP-44: rows of ``df`` whose keys occur in ``keys_df`` (left semi join)."""
    return df.join(keys_df.select(*on), on, "left_semi")


def inner_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """OP-45: equi join; AQE picks broadcast or sort-merge from runtime sizes."""
    return left.join(right, on, "inner")


def future_horizon(df: DataFrame, periods: int = HORIZON_DAYS, key="series_key", date="ds",
                   include_history: bool = True) -> DataFrame:
    """OP-47: history dates plus ``periods`` days after each series' last date
    (``explode(sequence(...))`` of a per-series max: no calendar table)."""
    last = df.groupBy(key).agg(F.max(date).alias("__last"))
    fut = last.select(key, F.explode(F.sequence(F.date_add("__last", 1),
                                                F.date_add("__last", periods))).alias(date))
    if not include_history:
        return fut
    hist = df.select(key, date).distinct()
    return hist.unionByName(fut)


def event_days(events: DataFrame, date: str = "event_date", radius: int = EVENT_RADIUS_DAYS) -> DataFrame:
    """The set of days within ``radius`` of any event: a range condition turned
    into an equi-join key. Output is distinct days, bounded by the calendar."""
    return (events.select(F.explode(F.sequence(F.date_sub(date, radius), F.date_add(date, radius)))
                          .alias("__day")).distinct())


def flag_near_events(df: DataFrame, events: DataFrame, date: str = "Date", event_date: str = "event_date",
                     radius: int = EVENT_RADIUS_DAYS, out: str = "near_event") -> DataFrame:
    """OP-49: 1 where the row's date lies within ``radius`` days of an event."""
    days = event_days(events, event_date, radius).withColumn("__hit", F.lit(1))
    joined = df.join(days, df[date] == days["__day"], "left")
    return joined.withColumn(out, F.coalesce(F.col("__hit"), F.lit(0)).cast("int")).drop("__day", "__hit")


def peak_day_events(df: DataFrame, value: str = "AQI", key="series_key", date="Date") -> DataFrame:
    """Events derived from data: the day of each series' yearly maximum
    (earliest date on ties). Global and distinct, so bounded by the calendar."""
    from pyspark.sql import Window
    w = Window.partitionBy(key, F.year(date)).orderBy(F.col(value).desc(), F.col(date).asc())
    return (df.where(F.col(value).isNotNull()).withColumn("__rn", F.row_number().over(w))
              .where(F.col("__rn") == 1).select(F.col(date).alias("event_date")).distinct())
