"""The forecaster's trend changes and intervals; sinks in order."""

import csv
import datetime as dt
import glob
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from smogcast.ml.forecast import SeasonalForecaster, fit_changes
from smogcast.sources.sinks import FORECAST_COLUMNS, in_order, write_forecast_csv

START = dt.date(2012, 1, 1)
SCHEMA = "series_key string, ds date, y double, temperature double, wind_speed double, is_stubble_burning int, near_event int"


def rows(key, n, level, seed, noise=0.05):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        d = START + dt.timedelta(days=i)
        v = level(i / n) + 0.3 * math.sin(2 * math.pi * d.timetuple().tm_yday / 365.25) + rng.normal() * noise
        out.append((key, d, math.expm1(v), 20.0 + i % 5, 5.0 + i % 3, 0, 0))
    return out


def test_slope_changes_are_recovered_and_the_others_are_zero(spark):
    spec = SeasonalForecaster(n_changepoints=10, changepoint_range=0.8)    # changes may lie at 0.08, 0.16, ...

    def bent(t):
        return 4.0 + 0.5 * t + 2.0 * max(0.0, t - 0.32) - 3.5 * max(0.0, t - 0.64)
    df = spark.createDataFrame(rows("bent", 1500, bent, 1) + rows("straight", 1500, lambda t: 4.0 + 0.5 * t, 2), SCHEMA).repartition(4)
    beta = {r["__kstr"]: np.array(r["beta"]) for r in spec.fit(df).coef.collect()}
    changes = beta["bent"][2:12]
    assert np.argmax(changes) == 3 and np.argmin(changes) == 7               # the largest ones, where the bends are
    assert changes[2:5].sum() == pytest.approx(2.0, abs=0.4) and changes[6:9].sum() == pytest.approx(-3.5, abs=0.5)
    assert np.abs(np.delete(changes, [2, 3, 4, 6, 7, 8])).max() < 0.3 and (changes == 0).sum() >= 2
    assert np.abs(beta["straight"][2:12]).max() < 0.2 and (beta["straight"][2:12] == 0).sum() >= 5


def test_changes_solve_the_penalised_problem():
    """Conditions of the optimum: the gradient is the penalty where a change is not 0, below it where it is."""
    rng = np.random.default_rng(3)
    t = np.linspace(0, 1, 400)
    x = np.column_stack([np.ones(400), t] + [np.maximum(0, t - c) for c in np.arange(1, 11) / 12] + [np.sin(9 * t)])
    y = 1 + t + 3 * np.maximum(0, t - 0.5) + np.sin(9 * t) + rng.normal(size=400) * 0.1
    changes = np.arange(2, 12)
    beta, sigma = fit_changes(x.T @ x, x.T @ y, y @ y, 400, changes, 1.0, 0.1)
    grad = x.T @ (y - x @ beta)
    least = sigma ** 2 / 0.1
    assert sigma == pytest.approx(0.1, rel=0.1)
    assert abs(grad[0]) < 1e-5 and abs(grad[1]) < 1e-5 and grad[12] == pytest.approx(beta[12], abs=1e-5)
    for j in changes:
        assert grad[j] == pytest.approx(np.sign(beta[j]) * least, abs=1e-3) if beta[j] else abs(grad[j]) <= least + 1e-3


def test_intervals_widen_with_the_horizon_and_cover(spark):
    rng = np.random.default_rng(8)
    n, every, table, held = 1600, 90, [], 0
    bends = {f"s{k}": [(i / n, rng.laplace() * 0.6) for i in range(every, n, 160)] for k in range(12)}
    for k, own in bends.items():
        def level(t, own=own):
            return 4.5 + sum(c * max(0.0, t - at) for at, c in own)
        table += rows(k, n, level, len(table), 0.1)
    df = spark.createDataFrame(table, SCHEMA)
    cut = START + dt.timedelta(days=n - 90)
    model = SeasonalForecaster().fit(df.where(F.col("ds") < F.lit(cut)))
    out = model.transform(df, clip_range=(-1e9, 1e9)).select("series_key", "ds", "y", "yhat", "yhat_lower", "yhat_upper").toPandas()
    width = np.log1p(out["yhat_upper"]) - np.log1p(out["yhat_lower"])
    test = out["ds"] >= cut
    for _, own in out.assign(width=width)[test].sort_values("ds").groupby("series_key"):
        assert (np.diff(own["width"]) > 0).all()                     # grows day by day
    inside = (out["y"] >= out["yhat_lower"]) & (out["y"] <= out["yhat_upper"])
    held = inside[test].mean()
    assert 0.85 <= held <= 1.0 and 0.93 <= inside[~test].mean() <= 0.975


def test_ordered_files(spark, tmp_path):
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(500)]
    df = spark.createDataFrame([("s", d, float(i), 0.0, 1.0, 2.0, "Good") for i, d in enumerate(days)],
                               "series_key string, ds date, yhat double, yhat_lower double, yhat_upper double, trend double, "
                               "aqi_category string").repartition(9, F.rand(1))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_forecast_csv(df.unionByName(df.withColumn("series_key", F.lit("b"))), f"file://{tmp_path}/out")
        in_order(df, ["yhat"]).write.parquet(f"file://{tmp_path}/table")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for key in ("s", "b"):
        files, got = sorted(glob.glob(f"{tmp_path}/out/series_key={key}/part-*.csv")), []
        assert len(files) > 1
        for f in files:
            with open(f, newline="") as lines:
                table = list(csv.DictReader(lines))
            assert list(table[0]) == FORECAST_COLUMNS
            got += [r["ds"] for r in table]
        assert got == [d.isoformat() for d in days]
    import pyarrow.parquet as pq
    parts = sorted(glob.glob(f"{tmp_path}/table/part-*.parquet"))
    assert len(parts) > 1 and [v for f in parts for v in pq.read_table(f)["yhat"].to_pylist()] == [float(i) for i in range(500)]
