"""Calibration by merged blocks against plain pool-adjacent-violators and MLlib; its application against SQL."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from smogcast.ml.isotonic import IsotonicCalibrator, Pool, fit_blocks


def plain(x, t, w=None):
    """(lo, hi, mean, weight) blocks over distinct scores, pooled one after the other."""
    xs, at = np.unique(x, return_inverse=True)
    w = np.ones(len(x)) if w is None else w
    s, w = np.bincount(at, t * w), np.bincount(at, w)
    blocks = []
    for v, a, b in zip(xs.tolist(), s.tolist(), w.tolist()):
        blocks.append([v, v, a, b])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0], last[1], blocks[-1][2] + last[2], blocks[-1][3] + last[3]]
    return [(a, b, s / n, n) for a, b, s, n in blocks]


def calibrator(spark, p, y):
    return IsotonicCalibrator.fit(spark.createDataFrame([([float(v) for v in r], int(c)) for r, c in zip(p, y)],
                                                        "probs array<double>, y int").repartition(6), "probs", "y")


def test_fixture(spark):
    x, y = [0.1, 0.2, 0.3, 0.6], [0, 1, 0, 1]
    cal = calibrator(spark, [[v, 1 - v, 0, 0, 0, 0] for v in x], [1 - v for v in y])   # label 0 stands for class 0
    xs, ys = cal.points(0)
    assert np.interp([0.0, 0.45, 0.9], xs, ys) == pytest.approx([0.0, 0.75, 1.0])


def test_ties_and_all_classes_equal_the_plain_fit(spark):
    rng = np.random.default_rng(2)
    p = np.round(rng.dirichlet(np.ones(6), size=900), 2)
    y = np.array([rng.choice(6, p=r / r.sum()) for r in p])
    y[y == 4] = 5                                                              # class 4 is absent
    cal = calibrator(spark, p, y)
    for c in range(6):
        got = cal.blocks[cal.blocks["class"] == c]
        want = plain(p[:, c], (y == c).astype(float))
        assert np.allclose(got[["lo", "hi"]], [w[:2] for w in want]) and np.allclose(got["s"] / got["w"], [w[2] for w in want])
        assert (np.diff(cal.points(c)[1]) >= 0).all()
    assert (cal.points(4)[1] == 0).all()


def test_equals_mllib_on_ties(spark):
    from pyspark.ml.regression import IsotonicRegression
    rng = np.random.default_rng(4)
    x = rng.integers(0, 21, size=400) / 20.0
    y = (rng.uniform(size=400) < x).astype(int)
    cal = calibrator(spark, [[v, 1 - v, 0, 0, 0, 0] for v in x], 1 - y)
    flat = spark.createDataFrame([(float(v), float(t)) for v, t in zip(x, y)], "x double, t double")
    every = IsotonicRegression(featuresCol="x", labelCol="t").fit(flat)
    xs, ys = cal.points(0)
    for v in np.linspace(0, 1, 41):
        assert abs(np.interp(v, xs, ys) - every.predict(float(v))) < 1e-12


def test_a_million_distinct_scores(spark):
    n = 1_000_000
    df = spark.range(n, numPartitions=8).select(
        F.lit(0).alias("class"), ((F.col("id") * 7919) % n / F.lit(float(n))).alias("x"),
        (F.xxhash64("id") % 1000 / 1000.0 < (F.col("id") * 7919) % n / F.lit(float(n))).cast("double").alias("s"), F.lit(1.0).alias("w"))
    got = fit_blocks(df).orderBy("lo").toPandas()
    rows = df.toPandas()
    want = plain(rows["x"].to_numpy(), rows["s"].to_numpy())
    assert len(got) == len(want) < 2 * n ** (2 / 3)
    assert np.allclose(got[["lo", "hi"]], [w[:2] for w in want]) and np.allclose(got["s"] / got["w"], [w[2] for w in want])


def test_pooling_is_associative():
    rng = np.random.default_rng(0)
    for _ in range(200):
        t = rng.integers(0, 2, 40).astype(float)
        cuts = np.sort(rng.integers(0, 41, 3))
        whole, merged = Pool(), Pool()
        for i, v in enumerate(t):
            whole.add(i, i, v, 1.0)
        for part in np.split(np.arange(40), cuts):
            own = Pool()
            for i in part:
                own.add(i, i, t[i], 1.0)
            for block in own.blocks:
                merged.add(*block)
        assert whole.blocks == merged.blocks


def test_application_equals_sql_and_round_trips(spark, tmp_path):
    rng = np.random.default_rng(3)
    p = rng.dirichlet(np.ones(6), size=300)
    y = np.array([rng.choice(6, p=r) for r in p])
    cal = calibrator(spark, p, y)
    cal.save(f"file://{tmp_path}/cal", spark)
    cal = IsotonicCalibrator.load(f"file://{tmp_path}/cal", spark)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(rng.dirichlet(np.ones(6), size=100))] + [(100, [0.0] * 6), (101, [2.0] * 6)]
    df = spark.createDataFrame(rows, "id long, probs array<double>")
    got = {r["id"]: r["cal_probs"] for r in cal.transform(df, "probs").collect()}
    con = duckdb.connect()
    con.register("blocks", cal.blocks)
    con.execute("CREATE TABLE data (id BIGINT, probs DOUBLE[])")
    con.executemany("INSERT INTO data VALUES (?, ?)", rows)
    want = con.sql("""
        WITH b AS (SELECT class, lo, hi, s / w AS v, lead(lo) OVER k AS next_lo, lead(s / w) OVER k AS next_v, row_number() OVER k AS n
                   FROM blocks WINDOW k AS (PARTITION BY class ORDER BY lo)),
        x AS (SELECT id, unnest(range(0, 6)) AS class, unnest(probs) AS x FROM data),
        c AS (SELECT id, x.class, max(CASE WHEN x <= lo AND n = 1 THEN v WHEN x BETWEEN lo AND hi THEN v
                                           WHEN x > hi AND next_lo IS NULL THEN v
                                           WHEN x > hi AND x < next_lo THEN v + (next_v - v) * (x - hi) / (next_lo - hi) END) AS v
              FROM x JOIN b ON x.class = b.class GROUP BY id, x.class)
        SELECT id, list(CASE WHEN t > 0 THEN v / t ELSE 1 / 6 END ORDER BY class)
        FROM (SELECT *, sum(v) OVER (PARTITION BY id) AS t FROM c) GROUP BY id""").fetchall()
    assert len(want) == 102
    for i, values in want:
        assert np.allclose(got[i], values, atol=1e-12)
    assert got[0] and sum(got[100]) == pytest.approx(1.0)
