"""Splits and weights: disjoint/complete parts, floor semantics, balanced weights."""

from pyspark.sql import functions as F

from smogcast.operators import splits
from smogcast.operators import weights as wts
from tests.conftest import days


def test_chronological_split_floor_in_double(spark):
    # 90 * 0.7 is 62.99... in double: 62 train rows, as the reference's int().
    df = spark.createDataFrame([("A", d, float(i)) for i, d in enumerate(days(90))],
                               "series_key string, Date date, AQI double")
    c = {r.split: r["count"] for r in splits.chronological_split(df).groupBy("split").count().collect()}
    assert c == {"train": 62, "val": 14, "test": 14}


def test_global_split_orders_by_date_then_key(spark):
    d = days(5)
    rows = [(k, x, 1.0) for x in d for k in ("B", "A")]
    df = spark.createDataFrame(rows, "series_key string, Date date, AQI double")
    got = {(r.series_key, r.Date): r.split for r in splits.global_chronological_split(df).collect()}
    order = [(k, x) for x in d for k in ("A", "B")]         # 10 rows: 7 train, 1 val, 2 test
    assert [got[o] for o in order] == ["train"] * 7 + ["val"] + ["test"] * 2


def test_split_parts_disjoint_and_ordered(spark):
    from smogcast.plans import catalog
    t = catalog.split_table(spark, "/root/testdata/sf0.001")
    total = t.count()
    s = t.groupBy("series_key", "split").agg(F.min("Date").alias("lo"), F.max("Date").alias("hi")).collect()
    assert sum(r for r in [t.where(F.col("split") == x).count() for x in ("train", "val", "test")]) == total
    by = {}
    for r in s:
        by.setdefault(r.series_key, {})[r.split] = (r.lo, r.hi)
    for parts in by.values():
        assert parts["train"][1] < parts["val"][0] <= parts["val"][1] < parts["test"][0]


def test_stratified_split_reproducible_under_repartition(spark):
    df = spark.createDataFrame([("A", d, i % 6) for i, d in enumerate(days(600))],
                               "series_key string, Date date, y int")
    a = splits.stratified_split(df, "y").orderBy("Date").select("split").collect()
    b = splits.stratified_split(df.repartition(7), "y").orderBy("Date").select("split").collect()
    assert a == b
    both = splits.stratified_split(df, "y").groupBy("y").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("split") == "test").cast("int")).alias("t")).collect()
    assert all((r.n, r.t) == (100, 15) for r in both)


def test_stratified_split_keeps_rare_and_null_classes(spark):
    rows = [("A", d, 0 if i % 50 else None) for i, d in enumerate(days(500))] + [("B", d, 7) for d in days(3)]
    df = spark.createDataFrame(rows, "series_key string, Date date, y int")
    out = splits.stratified_split(df, "y").groupBy("y").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("split") == "test").cast("int")).alias("t")).collect()
    assert {(r.y, r.n, r.t) for r in out} == {(0, 490, 74), (None, 10, 2), (7, 3, 0)}


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([(c,) for c in [2] * 6 + [3] * 3 + [5] * 1], "y int")
    w = {r["class"]: r for r in wts.class_weights(df, "y").collect()}
    assert abs(w[2].balanced - 10 / (3 * 6)) < 1e-12
    assert abs(w[5].weight_scaled - 10 / 3 * 8.0) < 1e-12
    assert abs(w[3].weight_boosted - 10 / 9 * 1.5) < 1e-12


def test_sample_weight_under_prediction(spark):
    df = spark.createDataFrame([(3, 2), (3, 3), (0, 5)], "a int, p int")
    assert [r[0] for r in df.select(wts.sample_weight("a", "p")).collect()] == [8.0, 4.0, 1.0]
