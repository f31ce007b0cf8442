"""Shared SQL fragments for the independent DuckDB oracle.

The oracle recomputes every SQL-expressible query from the raw parquet
tables in plain SQL; nothing here is used by the Spark plans.
"""

from __future__ import annotations

import math

from smogcast.operators.timeseries import EWM_SPAN


def r6(expr: str) -> str:
    """Same arithmetic as ``quantize(x)`` (2^-20 grid) on the Spark side."""
    return f"(floor(({expr}) * 1048576.0::DOUBLE + 0.5::DOUBLE) / 1048576.0::DOUBLE)"


def d(x: float) -> str:
    return f"{x!r}::DOUBLE"


OBS_CTE = """
series AS (
  SELECT o_orderpriority AS series_key, CAST(o_orderdate AS DATE) AS "Date",
         avg(o_totalprice) / 1000.0::DOUBLE AS AQI, count(*) AS n_readings
  FROM orders GROUP BY 1, 2),
weather AS (
  SELECT CAST(l_shipdate AS DATE) AS "Date",
         avg(l_quantity) AS windspeed,
         avg(l_discount) * 1000.0::DOUBLE AS humidity,
         avg(l_tax) * 500.0::DOUBLE AS temp,
         stddev_pop(l_quantity) AS precip,
         1000.0::DOUBLE + avg(l_discount) * 200.0::DOUBLE AS sealevelpressure
  FROM lineitem GROUP BY 1),
obs AS (
  SELECT s.series_key, s."Date", s.AQI, w.temp, w.humidity, w.precip, w.windspeed, w.sealevelpressure
  FROM series s LEFT JOIN weather w ON s."Date" = w."Date"),
masked AS (
  SELECT s.series_key, s."Date", CASE WHEN s.n_readings >= 2 THEN s.AQI END AS AQI,
         w.temp, w.humidity, w.precip, w.windspeed, w.sealevelpressure
  FROM series s LEFT JOIN weather w ON s."Date" = w."Date")
"""

# the recursion over so many rows equals the unbounded one to double precision: (1 - a)^K < 1e-16
K = math.ceil(math.log(1e-16) / math.log(1 - 2 / (EWM_SPAN + 1)))
ALPHA = 2.0 / (EWM_SPAN + 1.0)


def win(name: str, lo: int | None, hi: int | None) -> str:
    """Named row frame over the series order. lo/hi: negative = preceding,
    0 = current row, None = unbounded."""
    def b(x, side):
        if x is None:
            return "UNBOUNDED PRECEDING" if side == "lo" else "UNBOUNDED FOLLOWING"
        if x == 0:
            return "CURRENT ROW"
        return f"{-x} PRECEDING" if x < 0 else f"{x} FOLLOWING"
    return f'{name} AS (PARTITION BY series_key ORDER BY "Date" ROWS BETWEEN {b(lo, "lo")} AND {b(hi, "hi")})'


def ewm_sql(col: str, window: str) -> str:
    lst = f"list_filter(list({col}) OVER {window}, lambda v: v IS NOT NULL)"
    return (f"CASE WHEN len({lst}) > 0 THEN list_reduce({lst}, "
            f"lambda acc, v: acc * {d(1.0 - ALPHA)} + v * {d(ALPHA)}) END")


def guarded(stat: str, col: str, window: str, n: int) -> str:
    return f"CASE WHEN count({col}) OVER {window} = {n} THEN {stat}({col}) OVER {window} END"


FEATURE_WINDOWS = ", ".join([
    'ws AS (PARTITION BY series_key ORDER BY "Date")',
    win("w3", -3, -1), win("w7", -7, -1), win("w14", -14, -1),
    win("wex", -K, -1),
])


def feature_select(src: str = "obs") -> str:
    """The full engineered feature set over ``src`` (columns named as the
    Spark FEATURES list)."""
    two_pi = "6.283185307179586::DOUBLE"
    parts = [
        "series_key", '"Date"', "AQI",
        "lag(AQI, 1) OVER ws AS AQI_lag_1",
        guarded("avg", "AQI", "w7", 7) + " AS AQI_roll_mean_7",
        ewm_sql("AQI", "wex") + " AS AQI_ewma_7",
        "lag(AQI, 1) OVER ws - lag(AQI, 2) OVER ws AS AQI_diff_1",
        "temp", "humidity", "precip", "windspeed", "sealevelpressure",
        f'sin({two_pi} * CAST(month("Date") AS DOUBLE) / 12.0::DOUBLE) AS Month_sin',
        f'cos({two_pi} * CAST(month("Date") AS DOUBLE) / 12.0::DOUBLE) AS Month_cos',
        f'sin({two_pi} * CAST(dayofyear("Date") AS DOUBLE) / 365.25::DOUBLE) AS DayOfYear_sin',
        f'cos({two_pi} * CAST(dayofyear("Date") AS DOUBLE) / 365.25::DOUBLE) AS DayOfYear_cos',
        "lag(AQI, 2) OVER ws AS AQI_lag_2", "lag(AQI, 3) OVER ws AS AQI_lag_3",
        "lag(AQI, 7) OVER ws AS AQI_lag_7", "lag(AQI, 14) OVER ws AS AQI_lag_14",
        guarded("avg", "AQI", "w3", 3) + " AS AQI_roll_mean_3",
        guarded("stddev_samp", "AQI", "w3", 3) + " AS AQI_roll_std_3",
        guarded("max", "AQI", "w3", 3) + " AS AQI_roll_max_3",
        guarded("stddev_samp", "AQI", "w7", 7) + " AS AQI_roll_std_7",
        guarded("max", "AQI", "w7", 7) + " AS AQI_roll_max_7",
        guarded("avg", "AQI", "w14", 14) + " AS AQI_roll_mean_14",
        guarded("stddev_samp", "AQI", "w14", 14) + " AS AQI_roll_std_14",
        guarded("max", "AQI", "w14", 14) + " AS AQI_roll_max_14",
        "CASE WHEN humidity + 1.0::DOUBLE <> 0 THEN windspeed / (humidity + 1.0::DOUBLE) END AS ventilation",
        "lag(CASE WHEN humidity + 1.0::DOUBLE <> 0 THEN windspeed / (humidity + 1.0::DOUBLE) END, 1) OVER ws"
        " AS ventilation_lag1",
        "lag(windspeed, 1) OVER ws AS windspeed_lag1",
        "lag(humidity, 1) OVER ws AS humidity_lag1",
        "lag(temp, 1) OVER ws AS temp_lag1",
        "lag(AQI, 1) OVER ws - lag(AQI, 2) OVER ws AS AQI_delta_1",
        "CAST(coalesce(abs(lag(AQI, 1) OVER ws - lag(AQI, 2) OVER ws) > 50.0::DOUBLE, false) AS INTEGER)"
        " AS is_spike",
    ]
    return f"SELECT {', '.join(parts)} FROM {src} WINDOW {FEATURE_WINDOWS}"


FEATURE_NAMES = [
    "AQI_lag_1", "AQI_roll_mean_7", "AQI_ewma_7", "AQI_diff_1",
    "temp", "humidity", "precip", "windspeed", "sealevelpressure",
    "Month_sin", "Month_cos", "DayOfYear_sin", "DayOfYear_cos",
    "AQI_lag_2", "AQI_lag_3", "AQI_lag_7", "AQI_lag_14",
    "AQI_roll_mean_3", "AQI_roll_std_3", "AQI_roll_max_3",
    "AQI_roll_std_7", "AQI_roll_max_7",
    "AQI_roll_mean_14", "AQI_roll_std_14", "AQI_roll_max_14",
    "ventilation", "ventilation_lag1", "windspeed_lag1", "humidity_lag1", "temp_lag1",
    "AQI_delta_1", "is_spike",
]


def category_sql(x: str) -> str:
    return (f"CAST(CASE WHEN {x} <= 50.0::DOUBLE THEN 0 WHEN {x} <= 100.0::DOUBLE THEN 1 "
            f"WHEN {x} <= 200.0::DOUBLE THEN 2 WHEN {x} <= 300.0::DOUBLE THEN 3 "
            f"WHEN {x} <= 400.0::DOUBLE THEN 4 ELSE 5 END AS INTEGER)")


def train_cte() -> str:
    """The training feature table (rows with any NULL dropped) + label."""
    cond = " AND ".join(f"{c} IS NOT NULL" for c in ["AQI"] + FEATURE_NAMES)
    return (f"feat AS ({feature_select('obs')}),\n"
            f"train AS (SELECT *, {category_sql('AQI')} AS AQI_Category FROM feat WHERE {cond})")


def split_cte(src: str = "train") -> str:
    """Chronological 70/15/15 split per series (1-based positions)."""
    return f"""split AS (
  SELECT *, CASE WHEN rn <= floor(CAST(n AS DOUBLE) * 0.7::DOUBLE) THEN 'train'
                 WHEN rn <= floor(CAST(n AS DOUBLE) * 0.85::DOUBLE) THEN 'val'
                 ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY "Date") AS rn,
               count(*) OVER (PARTITION BY series_key) AS n FROM {src}))"""
