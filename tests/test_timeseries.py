"""Window operators against hand-checked values (FIXTURES.md F6 and cases)."""

import math

from pyspark.sql import functions as F

from smogcast.operators import timeseries as ts
from tests.conftest import days


def col(df, name, order="Date"):
    return [r[0] for r in df.orderBy(order).select(name).collect()]


def close(a, b, tol=1e-5):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        if y is None:
            assert x is None
        else:
            assert x is not None and abs(x - y) <= tol, (a, b)


def test_f6_lag_roll_diff_spike(series_df):
    w = ts.series_window()
    df = series_df.withColumns({
        "lag2": ts.lag_col("AQI", 2, w),
        **ts.rolling_columns("AQI", [3], w),
        **ts.diff_columns("AQI", w),
    })
    df = ts.add_ewm(df, "AQI", {"ewm": True})
    close(col(df, "lag2"), [None, None, 40, 60, 120, 180, 250, 350])
    close(col(df, "AQI_roll_mean_3"), [None, None, None, 73.333333, 120, 183.333333, 260, 350])
    close(col(df, "AQI_roll_std_3"), [None, None, None, 41.633320, 60, 65.064071, 85.440037, 100])
    close(col(df, "AQI_roll_max_3"), [None, None, None, 120, 180, 250, 350, 450])
    close(col(df, "AQI_delta_1"), [None, None, 20, 60, 60, 70, 100, 100])
    assert col(df, "is_spike") == [0, 0, 0, 1, 1, 1, 1, 1]
    close(col(df, "ewm"), [40, 45, 63.75, 92.8125, 132.109375, 186.582031, 252.436523, 211.827393])


def test_ewm_exclusive_is_previous_inclusive(series_df):
    df = ts.add_ewm(series_df, "AQI", {"inc": True, "exc": False})
    inc, exc = col(df, "inc"), col(df, "exc")
    assert exc[0] is None
    close(exc[1:], inc[:-1], 1e-12)


def test_ewm_bounded_frame_equals_recursion(spark):
    vals = [float((i * 37) % 101) for i in range(400)]
    df = spark.createDataFrame([("A", d, v) for d, v in zip(days(400), vals)], "series_key string, Date date, AQI double")
    got = col(ts.add_ewm(df, "AQI", {"e": True}), "e")
    y, exp = None, []
    for v in vals:
        y = v if y is None else 0.75 * y + 0.25 * v
        exp.append(y)
    close(got, exp, 1e-9)


def test_keys_do_not_mix_and_lag_is_by_row(spark):
    d = days(6)
    rows = [("A", d[0], 1.0), ("B", d[0], 100.0), ("A", d[1], 2.0), ("B", d[2], 200.0),
            ("A", d[4], 5.0), ("B", d[5], 300.0)]
    df = spark.createDataFrame(rows, "series_key string, Date date, AQI double")
    out = ts.add_lags(df, "AQI", [1])
    got = {(r.series_key, r.Date): r.AQI_lag_1 for r in out.collect()}
    assert got[("A", d[4])] == 2.0          # calendar gap: previous row, not previous day
    assert got[("B", d[2])] == 100.0
    assert got[("A", d[0])] is None and got[("B", d[0])] is None


def test_interpolation_case(spark):
    vals = [None, 1.0, None, None, 4.0, None, 7.0, None]
    df = spark.createDataFrame([("A", d, v) for d, v in zip(days(8), vals)], "series_key string, Date date, AQI double")
    close(col(ts.interpolate_linear(df, "AQI"), "AQI"), [None, 1, 2, 3, 4, 5.5, 7, 7])


def test_backward_fill_case(spark):
    vals = [None, 2.0, None, None, 5.0, None]
    df = spark.createDataFrame([("A", d, v) for d, v in zip(days(6), vals)], "series_key string, Date date, x double")
    close(col(df.withColumn("b", ts.backward_fill("x")), "b"), [2, 2, 5, 5, 5, None])
    close(col(ts.fill_forward_backward(df, ["x"]), "x"), [2, 2, 2, 2, 5, 5])


def test_features_are_leak_free(spark):
    """No engineered feature at t changes when the value at t (or later) changes."""
    from smogcast.plans.features import FEATURES, engineer_features
    n = 40
    d = days(n)
    base = [(d[i], 100.0 + 10 * math.sin(i), 20.0 + i % 5, 50.0, 1.0, 10.0 + i % 3, 1010.0) for i in range(n)]
    schema = "Date date, AQI double, temp double, humidity double, precip double, windspeed double, sealevelpressure double"
    a = spark.createDataFrame(base, schema).withColumn("series_key", F.lit("A"))
    changed = [r if i < 30 else (r[0], r[1] + 999.0) + r[2:] for i, r in enumerate(base)]
    b = spark.createDataFrame(changed, schema).withColumn("series_key", F.lit("A"))
    fa = engineer_features(a, training=False).where(F.col("Date") == d[30]).select(*FEATURES).first()
    fb = engineer_features(b, training=False).where(F.col("Date") == d[30]).select(*FEATURES).first()
    assert fa == fb


def test_preceding_context_and_sequences(series_df):
    ctx = ts.preceding_context(series_df)
    last = ctx.orderBy(F.col("Date").desc()).first()["trend"]
    assert [t["aqi"] for t in last] == [40.0, 60.0, 120.0, 180.0, 250.0, 350.0, 450.0]
    assert last[-1]["category"] == "Severe" and last[0]["color"] == "#4ade80"
    seq = ts.sequence_windows(series_df, ["AQI"], "AQI", steps=7).collect()
    assert len(seq) == 1 and seq[0]["target"] == 90.0 and seq[0]["sequence"][0] == [40.0]


def test_feature_table_invariant_under_repartitioning(spark):
    from smogcast.plans.features import engineer_features
    from smogcast.sources import binding
    obs = binding.observations(spark, "/root/testdata/sf0.001")
    a = engineer_features(obs, training=True)
    b = engineer_features(obs.repartition(13, "Date"), training=True)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_chunked_path_exact(spark):
    from smogcast.plans import features as fx
    from smogcast.sources import binding
    obs = binding.observations(spark, "/root/testdata/sf0.001")
    plain = fx.engineer_features(obs, training=False)
    chunked = fx.engineer_features(obs, training=False, chunk_rows=140)
    assert plain.exceptAll(chunked).count() == 0 and chunked.exceptAll(plain).count() == 0
