"""OP-79: the whole feature pipeline as one projection over one window spec."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogcast.functions.calendar import add_cyclic_encodings
from smogcast.functions.categories import aqi_category
from smogcast.operators.timeseries import (EWM_SPAN, chunk_with_halo, chunked_window, ewm, feature_columns, lag_col,
                                          max_lookback, series_window)
from smogcast.sources.observations import WEATHER_COLS

# Feature list in model order: the input table's own columns first (observed
# weather, calendar encodings and the derived "precomputed" columns), then the
# engineered ones in creation order.
FEATURES = (
    ["AQI_lag_1", "AQI_roll_mean_7", "AQI_ewma_7", "AQI_diff_1"]
    + WEATHER_COLS
    + ["Month_sin", "Month_cos", "DayOfYear_sin", "DayOfYear_cos",
       "AQI_lag_2", "AQI_lag_3", "AQI_lag_7", "AQI_lag_14",
       "AQI_roll_mean_3", "AQI_roll_std_3", "AQI_roll_max_3",
       "AQI_roll_std_7", "AQI_roll_max_7",
       "AQI_roll_mean_14", "AQI_roll_std_14", "AQI_roll_max_14",
       "ventilation", "ventilation_lag1", "windspeed_lag1", "humidity_lag1", "temp_lag1",
       "AQI_delta_1", "is_spike"]
)
LABEL = "AQI_Category"
# Columns never used as features (OP-08 deny-list).
NOT_FEATURES = {"series_key", "Date", "index", "AQI", LABEL}


def select_features(df: DataFrame, deny: set[str] = NOT_FEATURES) -> list[str]:
    """OP-08: every column except the deny-list, in table order."""
    return [c for c in df.columns if c not in deny]


def engineer_features(obs: DataFrame, training: bool = True, key: str = "series_key",
                      date: str = "Date", value: str = "AQI", chunk_rows: int | None = None) -> DataFrame:
    """Observations -> feature table.

    ``training=True`` drops every row with a NULL anywhere (OP-09) and adds the
    category label; the serving variant keeps all rows.

    With ``chunk_rows`` the windows run per (series, chunk of that many rows)
    with a halo of the longest lookback copied from the previous chunk, and the
    EWM carries one row a chunk, so a series of any length is spread over many
    tasks; results are identical.
    """
    name = f"{value}_ewma_{EWM_SPAN}"
    obs = ewm(obs, value, name, EWM_SPAN, key, date, chunk="year" if chunk_rows else None)
    if chunk_rows:
        halo = max_lookback()
        src = chunk_with_halo(obs, chunk_rows, halo, key, date)
        w = chunked_window(key, date)
        cols = {**feature_columns(value, w), name: lag_col(name, 1, w)}
        df = add_cyclic_encodings(src, date).withColumns(cols)
        df = df.where(F.col("__chunk") == F.col("__home")).drop("__chunk", "__home")
    else:
        w = series_window(key, date)
        cols = {**feature_columns(value, w), name: lag_col(name, 1, w)}
        df = add_cyclic_encodings(obs, date).withColumns(cols)
    out = df.select(key, date, value, *FEATURES)
    if training:
        out = out.na.drop("any")
    return out.withColumn(LABEL, aqi_category(F.col(value)))
