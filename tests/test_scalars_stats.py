"""Scalar functions, statistics and climatology fallbacks."""

import datetime as dt

from pyspark.sql import functions as F

from smogcast.functions.categories import aqi_category, category_dim
from smogcast.functions.scalars import argmax_index, clip, safe_number
from smogcast.operators import climatology, distribution
from tests.conftest import days


def test_breakpoints(spark):
    vals = [50.0, 50.01, 100.0, 200.0, 300.0, 400.0, 400.01, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(aqi_category("x")).collect()]
    assert got == [0, 1, 1, 2, 3, 4, 5, 5, 5]
    assert category_dim(spark).count() == 6


def test_argmax_first_max_wins(spark):
    df = spark.createDataFrame([([0.2, 0.4, 0.4],)], "p array<double>")
    assert df.select(argmax_index("p")).first()[0] == 1


def test_safe_number_and_clip(spark):
    df = spark.createDataFrame([("1.5",), ("abc",), (None,), ("NaN",), ("Infinity",)], "s string")
    assert [r[0] for r in df.select(safe_number("s", 7.0)).collect()] == [1.5, 7.0, 7.0, 7.0, 7.0]
    df2 = spark.createDataFrame([(None,), (600.0,), (-5.0,)], "x double")
    assert [r[0] for r in df2.select(clip("x", 0.0, 500.0)).collect()] == [None, 500.0, 0.0]


def test_trend_label_and_signed_text(spark):
    from smogcast.functions.scalars import signed_text, trend_label
    df = spark.createDataFrame([(-1.25,), (0.0,), (2.5,)], "s double")
    got = [(r[0], r[1]) for r in df.select(trend_label("s"), signed_text("s")).collect()]
    assert got == [("Improving Trend", "-1.25"), ("Worsening Trend", "0.0"), ("Worsening Trend", "+2.5")]


def test_mode_lowest_tie_and_slope_one_year(spark):
    d = days(4, start=dt.date(2020, 3, 1))
    df = spark.createDataFrame([("A", x, v) for x, v in zip(d, [3.0, 1.0, 3.0, 1.0])],
                               "series_key string, Date date, AQI double")
    st = distribution.month_stats(df).first()
    assert st["mode"] == 1.0 and st["median"] == 2.0 and st["n"] == 4
    assert distribution.month_trend_slope(df).first()["trend_slope"] == 0.0


def test_series_level_stats_fallback(spark):
    d = days(4, start=dt.date(2020, 3, 30))
    df = spark.createDataFrame([("A", x, v) for x, v in zip(d, [5.0, 1.0, 5.0, 2.0])],
                               "series_key string, Date date, AQI double")
    st = distribution.month_stats(df, by_month=False).collect()
    assert len(st) == 1 and st[0]["month"] is None and st[0]["mode"] == 5.0 and st[0]["n"] == 4


def test_slope_matches_least_squares(spark):
    rows = []
    for y, v in [(2015, 10.0), (2016, 14.0), (2017, 15.0), (2018, 21.0)]:
        rows.append(("A", dt.date(y, 5, 1), v))
    df = spark.createDataFrame(rows, "series_key string, Date date, AQI double")
    import numpy as np
    exp = np.polyfit([2015, 2016, 2017, 2018], [10, 14, 15, 21], 1)[0]
    assert abs(distribution.month_trend_slope(df).first()["trend_slope"] - exp) < 1e-9


def test_pdf_points(spark):
    df = spark.createDataFrame([("A", 1, 100.0, 10.0)], "series_key string, month int, mean double, std_dev double")
    pts = distribution.normal_pdf_points(df).orderBy("i").collect()
    assert len(pts) == 40 and pts[0]["x"] == 70.0 and pts[-1]["x"] == 130.0
    import math
    assert abs(pts[0]["y"] - math.exp(-4.5) / (10 * math.sqrt(2 * math.pi))) < 1e-12


def test_absent_leap_day_falls_back_to_month(spark):
    d = [dt.date(2019, 2, 27), dt.date(2019, 2, 28), dt.date(2021, 2, 28), dt.date(2021, 3, 1)]
    obs = spark.createDataFrame([("A", x, v) for x, v in zip(d, [10.0, 20.0, 30.0, 100.0])],
                                "series_key string, Date date, AQI double")
    calendar = climatology.closed_calendar(obs, ["AQI"])
    req = spark.createDataFrame([(1, "A", dt.date(2024, 2, 29)), (2, "A", dt.date(2024, 2, 28))],
                                "request_id int, series_key string, date date")
    out = {r.request_id: r for r in calendar.lookup(req).collect()}
    assert out[1]["clim_level"] == "month" and out[1]["AQI"] == 20.0
    assert out[2]["clim_level"] == "month_day" and out[2]["AQI"] == 25.0
