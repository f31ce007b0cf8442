"""Chunked forms of the series operators and the refined median against pandas and numpy."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from smogcast.operators import distribution
from smogcast.operators import timeseries as ts

START = dt.date(2001, 11, 20)


def series(seed, n, null_rate, long_gap=0):
    rng = np.random.default_rng(seed)
    v = rng.uniform(1, 500, n)
    v[rng.random(n) < null_rate] = np.nan
    if long_gap:
        v[n // 3:n // 3 + long_gap] = np.nan
    return v


@pytest.fixture(scope="module")
def data():
    out = {"A": series(1, 700, 0.0), "B": series(2, 700, 0.4), "C": series(3, 900, 0.1, 400), "D": np.full(50, np.nan),
           None: series(5, 60, 0.3), "F": np.append(np.full(40, np.nan), series(6, 300, 0.7, 100))}
    return out


@pytest.fixture(scope="module")
def df(spark, data):
    rows = [(k, START + dt.timedelta(days=2 * i), None if np.isnan(x) else float(x)) for k, v in data.items() for i, x in enumerate(v)]
    return spark.createDataFrame(rows, "series_key string, Date date, AQI double").repartition(5)


def columns(frame, *names):
    out = {}
    for r in frame.orderBy("Date").collect():
        out.setdefault(r["series_key"], []).append([np.nan if r[n] is None else r[n] for n in names])
    return {k: np.array(v) for k, v in out.items()}


@pytest.mark.parametrize("chunk", [None, "year", "month", "week"])
def test_ewm_equals_pandas(df, data, chunk):
    got = columns(ts.ewm(df, "AQI", "e", chunk=chunk), "e")
    for k, v in data.items():
        want = pd.Series(v).ewm(span=7, adjust=False, ignore_na=False).mean().to_numpy()
        assert np.allclose(got[k][:, 0], want, rtol=1e-12, atol=0, equal_nan=True), k


@pytest.mark.parametrize("span", [2, 40])
def test_ewm_of_other_spans(df, data, span):
    got = columns(ts.ewm(df, "AQI", "e", span=span, chunk="month"), "e")
    for k, v in data.items():
        assert np.allclose(got[k][:, 0], pd.Series(v).ewm(span=span, adjust=False).mean(), rtol=1e-12, equal_nan=True), k


@pytest.mark.parametrize("chunk", [None, "year", "week"])
def test_interpolation_and_fills_equal_pandas(df, data, chunk):
    got = columns(ts.interpolate_linear(df, "AQI", out="x", chunk=chunk), "x")
    filled = columns(ts.fill_forward_backward(df.withColumn("y", F.col("AQI")), ["AQI", "y"], chunk=chunk), "AQI", "y")
    for k, v in data.items():
        s = pd.Series(v)
        assert np.allclose(got[k][:, 0], s.interpolate(limit_direction="forward"), equal_nan=True), k
        for i in range(2):
            assert np.allclose(filled[k][:, i], s.ffill().bfill(), equal_nan=True), k


def plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_chunked_windows_never_hold_a_whole_series_of_rows(df):
    """Windows over a series alone read tables of one row a chunk or stretch."""
    for frame in (ts.ewm(df, "AQI", "e", chunk="year"), ts.interpolate_linear(df, "AQI", chunk="year")):
        for line in plan(frame).split("\n"):
            if "Window [" in line and line.count("], [") and "], [series_key" in line:
                keys = line[line.index("], [series_key") + 4:].split("]")[0]
                if keys.count(",") == 0:
                    assert "AQI#" not in line.split("], [series_key")[0].replace("__p0", ""), line


@pytest.mark.parametrize("refine", [0, 1, 2])
def test_month_statistics_by_refined_histograms(spark, refine):
    rng = np.random.default_rng(4)
    rows, start = [], dt.date(2010, 1, 1)
    kinds = {"skewed": lambda n: np.exp(rng.normal(size=n) * 4), "ties": lambda n: rng.integers(0, 4, n).astype(float),
             "one": lambda n: np.full(n, 7.5), "far": lambda n: np.where(rng.random(n) < 0.5, 1.0, 1e9) + rng.random(n)}
    for key, make in kinds.items():
        for i, v in enumerate(make(800)):
            rows.append((key, start + dt.timedelta(days=i), float(v)))
    rows += [("single", start, 3.0), ("nulls", start, None), (None, start, 1.0), (None, start + dt.timedelta(days=1), 2.0)]
    df = spark.createDataFrame(rows, "series_key string, Date date, AQI double")
    pdf = pd.DataFrame(rows, columns=["k", "d", "v"])
    pdf["k"] = pdf["k"].fillna("<null>")
    pdf["m"] = pd.to_datetime(pdf["d"]).dt.month
    for by_month in (True, False):
        frame = distribution.month_stats(df, by_month=by_month, refine=refine)
        text = frame._jdf.queryExecution().optimizedPlan().toString().lower()
        assert "collect" not in text and "percentile" not in text
        got = {(r["series_key"], r["month"]): r for r in frame.collect()}
        groups = pdf.dropna(subset=["v"]).groupby(["k", "m"] if by_month else ["k"])
        assert len(got) == len(groups)
        for g, part in groups:
            k = None if g[0] == "<null>" else g[0]
            r, v = got[(k, g[1] if by_month else None)], part["v"]
            assert r["n"] == len(v) and r["median"] == v.median()
            assert r["mode"] == v.mode().min() and r["mean"] == pytest.approx(v.mean(), rel=1e-12)
            assert r["variance"] == pytest.approx(v.var() if len(v) > 1 else 0.0, rel=1e-9)


def test_a_missing_neighbour_has_no_category(spark):
    rows = [("A", dt.date(2020, 1, 1), None), ("A", dt.date(2020, 1, 2), 120.0), ("A", dt.date(2020, 1, 3), 1.0)]
    out = ts.preceding_context(spark.createDataFrame(rows, "series_key string, Date date, AQI double")).orderBy("Date").collect()
    first, second = out[2]["trend"]
    assert first["aqi"] is None and first["category"] is None and first["color"] is None
    assert second["category"] == "Moderate"
