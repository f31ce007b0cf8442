"""Model operators: properties against closed forms and fixtures."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import days


def test_ridge_equals_closed_form(spark):
    from smogcast.ml.stage1 import fit_ridge
    rng = np.random.default_rng(3)
    X = rng.normal(size=(200, 3)) * [1.0, 5.0, 0.2]
    y = X @ [0.5, -0.2, 3.0] + 2.0 + rng.normal(scale=0.3, size=200)
    df = spark.createDataFrame([(*map(float, X[i]), float(y[i])) for i in range(200)], "a double, b double, c double, y double")
    m = fit_ridge(df, ["a", "b", "c"], "y", alpha=10.0)
    lr = m.stages[-1]
    Xc = X - X.mean(axis=0)
    beta = np.linalg.solve(Xc.T @ Xc + 10.0 * np.eye(3), Xc.T @ (y - y.mean()))
    assert np.allclose(lr.coefficients.toArray(), beta, atol=1e-8)
    assert lr.intercept == pytest.approx(y.mean() - X.mean(axis=0) @ beta, abs=1e-8)


def test_forecaster_recovers_seasonal_signal(spark):
    from smogcast.ml.forecast import SeasonalForecaster
    d = days(3 * 365, start=dt.date(2015, 1, 1))
    rows = []
    for i, x in enumerate(d):
        doy = x.timetuple().tm_yday
        rows.append(("A", x, math.exp(5.0 + 0.4 * math.sin(2 * math.pi * doy / 365.25) + 0.0002 * i),
                     20.0 + (i % 7), 8.0, 0))
    df = spark.createDataFrame(rows, "series_key string, ds date, y double, temperature double, "
                                     "wind_speed double, is_stubble_burning int").withColumn("near_event", F.lit(0))
    model = SeasonalForecaster(ridge=1e-6).fit(df)
    out = model.transform(df).select("y", "yhat", "yhat_lower", "yhat_upper").toPandas()
    rel = np.abs(out["yhat"] - out["y"]) / out["y"]
    assert rel.mean() < 0.02
    assert (out["yhat_lower"] <= out["yhat"]).all() and (out["yhat"] <= out["yhat_upper"]).all()


def test_minmax_constant_column(spark):
    from smogcast.ml.scaling import fit_minmax, transform_minmax
    df = spark.createDataFrame([("A", 5.0, 1.0), ("A", 5.0, 3.0)], "series_key string, c double, v double")
    st = fit_minmax(df, ["c", "v"], key="series_key")
    out = transform_minmax(df, st, ["c", "v"], key="series_key").orderBy("v").collect()
    assert [r.c_scaled for r in out] == [0.0, 0.0] and [r.v_scaled for r in out] == [0.0, 1.0]
