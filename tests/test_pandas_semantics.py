"""Window operators against pandas' own semantics (rolling/shift/ewm/diff/
interpolate/ffill/bfill) on random series with gaps, several keys at once."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from smogcast.operators import timeseries as ts
from tests.conftest import days


def _frame(spark, seed, n=120, keys=("A", "B", "C"), null_rate=0.0):
    rng = np.random.default_rng(seed)
    rows, expected = [], {}
    for k in keys:
        v = rng.uniform(10, 480, size=n).round(3)
        if null_rate:
            v[rng.uniform(size=n) < null_rate] = np.nan
        d = days(n)
        expected[k] = pd.Series(v)
        rows += [(k, d[i], None if np.isnan(v[i]) else float(v[i])) for i in range(n)]
    return spark.createDataFrame(rows, "series_key string, Date date, AQI double"), expected


def _got(df, col, key):
    return [r[0] for r in df.where(F.col("series_key") == key).orderBy("Date").select(col).collect()]


def _same(got, exp, tol=1e-9):
    assert len(got) == len(exp)
    for g, e in zip(got, exp):
        if e is None or (isinstance(e, float) and np.isnan(e)):
            assert g is None
        else:
            assert g is not None and abs(g - e) <= tol * max(1.0, abs(e)), (g, e)


@pytest.mark.parametrize("seed", [1, 2])
def test_rolling_shift_diff_match_pandas(spark, seed):
    df, exp = _frame(spark, seed, null_rate=0.1)
    w = ts.series_window()
    out = df.withColumns({**ts.rolling_columns("AQI", [3, 7, 14], w), **ts.diff_columns("AQI", w),
                          "lag2": ts.lag_col("AQI", 2, w)}).cache()
    for k, s in exp.items():
        for n in (3, 7, 14):
            _same(_got(out, f"AQI_roll_mean_{n}", k), s.rolling(n).mean().shift(1).tolist())
            _same(_got(out, f"AQI_roll_std_{n}", k), s.rolling(n).std().shift(1).tolist(), 1e-7)
            _same(_got(out, f"AQI_roll_max_{n}", k), s.rolling(n).max().shift(1).tolist())
        _same(_got(out, "AQI_delta_1", k), s.diff().shift(1).tolist())
        spike = (s.diff().shift(1).abs() > 50).astype(int).tolist()
        assert _got(out, "is_spike", k) == spike
        _same(_got(out, "lag2", k), s.shift(2).tolist())


@pytest.mark.parametrize("seed", [3, 4])
def test_ewm_matches_pandas(spark, seed):
    df, exp = _frame(spark, seed, n=300)
    out = ts.add_ewm(df, "AQI", {"inc": True, "exc": False}).cache()
    for k, s in exp.items():
        e = s.ewm(span=7, adjust=False).mean()
        _same(_got(out, "inc", k), e.tolist(), 1e-12)
        _same(_got(out, "exc", k), e.shift(1).tolist(), 1e-12)


@pytest.mark.parametrize("share", [0.1, 0.6, 0.97])
def test_ewm_decays_across_nulls_as_pandas_does(spark, share):
    rng = np.random.default_rng(int(share * 100))
    rows, exp = [], {}
    for k in ("A", "B"):
        v = pd.Series(np.where(rng.uniform(size=400) < share, np.nan, rng.uniform(20, 400, 400).round(2)))
        exp[k] = v
        rows += [(k, d, None if np.isnan(x) else float(x)) for d, x in zip(pd.date_range("2020-01-01", periods=400).date, v)]
    rows += [("C", d, None) for d in pd.date_range("2020-01-01", periods=5).date]
    exp["C"] = pd.Series([np.nan] * 5)
    out = ts.add_ewm(spark.createDataFrame(rows, "series_key string, Date date, AQI double"), "AQI",
                     {"inc": True, "exc": False}).cache()
    for k, s in exp.items():
        e = s.ewm(span=7, adjust=False).mean()
        _same(_got(out, "inc", k), e.tolist(), 1e-9)
        _same(_got(out, "exc", k), e.shift(1).tolist(), 1e-9)


def test_month_stats_and_slope_match_pandas(spark):
    from smogcast.operators import distribution
    from smogcast.sources import binding
    obs = binding.observations(spark, "/root/testdata/sf0.001")
    pdf = obs.select("series_key", "Date", "AQI").toPandas()
    pdf["Date"] = pd.to_datetime(pdf["Date"])
    pdf["month"] = pdf["Date"].dt.month
    got = {(r.series_key, r.month): r for r in distribution.month_stats(obs).collect()}
    slopes = {(r.series_key, r.month): r.trend_slope for r in distribution.month_trend_slope(obs).collect()}
    for (k, m), g in pdf.groupby(["series_key", "month"]):
        v = g["AQI"].dropna()
        r = got[(k, m)]
        assert r.n == len(v)
        assert r.mean == pytest.approx(v.mean(), rel=1e-12)
        assert r.median == pytest.approx(v.median(), rel=1e-12)
        assert r.mode == pytest.approx(float(v.mode().values[0]), rel=1e-12)
        assert r.variance == pytest.approx(v.var() if len(v) > 1 else 0.0, rel=1e-9, abs=1e-9)
        ym = g.groupby(g["Date"].dt.year)["AQI"].mean().dropna()
        exp = np.polyfit(ym.index.values.astype(float), ym.values, 1)[0] if len(ym) > 1 else 0.0
        assert slopes[(k, m)] == pytest.approx(exp, rel=1e-6, abs=1e-9)


def test_climatology_requests_match_per_request_loop(spark):
    """One series: the per-request pandas loop (filter month+day, else month,
    else everything; mean; NULL -> global mean -> 0; trend offsets 7..1 with
    month+day, else month, else 150, rounded to 2) against the join-based plan."""
    import datetime as dt
    from smogcast.operators import climatology
    from smogcast.plans.features import engineer_features
    from smogcast.sources import binding
    cols = ["AQI_lag_1", "AQI_roll_std_14", "temp", "is_spike"]
    obs = binding.observations(spark, "/root/testdata/sf0.001").where(F.col("series_key") == "1-URGENT")
    feat = engineer_features(obs, training=False).select("series_key", "Date", "AQI", *cols)
    pdf = feat.toPandas()
    pdf["Date"] = pd.to_datetime(pdf["Date"])
    reqs = [dt.date(2030, 2, 29 - 1), dt.date(2032, 2, 29), dt.date(2031, 7, 4), dt.date(1996, 1, 1),
            dt.date(2040, 12, 31), dt.date(2035, 3, 1)]
    rq = spark.createDataFrame([(i, "1-URGENT", d) for i, d in enumerate(reqs)],
                               "request_id int, series_key string, date date")
    calendar = climatology.closed_calendar(feat, cols, trend="AQI")
    got = {r.request_id: r for r in calendar.lookup(rq).collect()}
    trend = {}
    for r in climatology.climatology_trend(rq, calendar).collect():
        trend.setdefault(r.request_id, {})[r.offset] = r.trend_aqi
    gmean = pdf[cols].mean()
    for i, d in enumerate(reqs):
        ts_ = pd.Timestamp(d)
        h = pdf[(pdf.Date.dt.month == ts_.month) & (pdf.Date.dt.day == ts_.day)]
        if h.empty:
            h = pdf[pdf.Date.dt.month == ts_.month]
        if h.empty:
            h = pdf
        x = h[cols].mean().fillna(gmean).fillna(0.0)
        for c in cols:
            assert got[i][c] == pytest.approx(float(x[c]), rel=1e-12, abs=1e-12), (d, c)
        for off in range(7, 0, -1):
            p = ts_ - pd.Timedelta(days=off)
            ph = pdf[(pdf.Date.dt.month == p.month) & (pdf.Date.dt.day == p.day)]
            if ph.empty:
                ph = pdf[pdf.Date.dt.month == p.month]
            v = ph["AQI"].mean() if not ph.empty else 150.0
            v = 150.0 if pd.isna(v) else v
            assert trend[i][off] == pytest.approx(round(v, 2), abs=1e-9), (d, off)


@pytest.mark.parametrize("seed", [5, 6])
def test_interpolate_and_fills_match_pandas(spark, seed):
    df, exp = _frame(spark, seed, n=80, null_rate=0.35)
    interp = ts.interpolate_linear(df, "AQI", out="i")
    filled = ts.fill_forward_backward(df.withColumn("f", F.col("AQI")), ["f"])
    for k, s in exp.items():
        _same(_got(interp, "i", k), s.interpolate(method="linear").tolist(), 1e-9)
        _same(_got(filled, "f", k), s.ffill().bfill().tolist())
