"""Request scoring (OP-81), bundle round trip (OP-04) and the streaming form
(OP-82 equals OP-81 on the same rows)."""

import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


def small(rounds, **more):
    """A training configuration of a few rounds."""
    from dataclasses import replace

    from smogcast.plans.training import TrainConfig
    cfg = TrainConfig(**more)
    sizes = {m: replace(getattr(cfg, m), rounds=rounds, step=0.2, min_rows=5) for m in ("gbt", "gbt2", "asym", "boosted")}
    return replace(cfg, **sizes)


@pytest.fixture(scope="module")
def trained(spark):
    from smogcast.plans import catalog
    from smogcast.plans.training import train_two_stage
    return train_two_stage(catalog.training_table(spark, SF_SMALL), small(8))


def test_parse_requests_status(spark):
    from smogcast.plans.scoring import parse_requests
    df = spark.createDataFrame([(1, "A", "1999-02-30"), (2, "A", None), (3, "A", "2024-02-29"), (4, "A", " ")],
                               "request_id long, series_key string, date string")
    got = {r.request_id: r.status for r in parse_requests(df).collect()}
    assert got == {1: "invalid_date", 2: "missing_date", 3: "ok", 4: "missing_date"}


def test_training_outputs(trained):
    probs = trained.scored.select("cal_probs").collect()
    for r in probs[:200]:
        assert len(r[0]) == 6 and abs(sum(r[0]) - 1.0) < 1e-9
    assert trained.tuned.count() == 4
    assert trained.confusion.count() == 36


def test_bundle_round_trip(spark, trained):
    from smogcast.plans import catalog
    from smogcast.plans.training import TwoStageModel
    path = tempfile.mkdtemp(prefix="smogcast-bundle-")
    trained.model.save(path, spark)
    m2 = TwoStageModel.load(path, spark)
    feat = catalog.training_table(spark, SF_SMALL)
    a = trained.model.predict(feat).select("series_key", "Date", "predicted", "Predicted_AQI")
    b = m2.predict(feat).select("series_key", "Date", "predicted", "Predicted_AQI")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_score_requests_and_stream_equal(spark, trained):
    from smogcast.plans.scoring import score_requests
    from smogcast.sources import binding
    from smogcast.streaming.requests import start_request_stream
    obs = binding.observations(spark, SF_SMALL)
    req = binding.all_requests(spark, SF_SMALL)
    extra = spark.createDataFrame([(10**12, "1-URGENT", "1999-02-30"), (10**12 + 1, "1-URGENT", None)],
                                  "request_id long, series_key string, date string")
    req = req.unionByName(extra)
    batch = score_requests(req, obs, trained.model)
    rows = {r.request_id: r for r in batch.collect()}
    assert len(rows) == req.count()
    assert rows[10**12].status == "invalid_date" and rows[10**12 + 1].status == "missing_date"
    fut = [r for r in rows.values() if r.status == "ok" and r.is_future]
    hist = [r for r in rows.values() if r.status == "ok" and not r.is_future]
    assert fut and hist
    assert all(len(r.trend) == 7 for r in fut)
    assert all(r.actual_aqi is not None for r in hist)

    src = tempfile.mkdtemp(prefix="smogcast-req-")
    sink = tempfile.mkdtemp(prefix="smogcast-out-")
    ck = tempfile.mkdtemp(prefix="smogcast-sck-")
    req.repartition(3).write.mode("overwrite").json(src + "/in")
    q = start_request_stream(spark, src + "/in", sink + "/out", ck, obs, trained.model)
    q.awaitTermination(600)
    streamed = spark.read.parquet(sink + "/out").drop("batch_id")
    cols = ["request_id", "status", "predicted_aqi", "category", "is_future"]
    assert streamed.select(cols).exceptAll(batch.select(cols)).count() == 0
    assert batch.select(cols).exceptAll(streamed.select(cols)).count() == 0


def test_forest_stage2_variant_round_trip(spark):
    from smogcast.plans import catalog
    from smogcast.plans.training import TwoStageModel, train_two_stage
    feat = catalog.training_table(spark, SF_SMALL)
    res = train_two_stage(feat, small(2, classifier="forest", forest_trees=5))
    path = tempfile.mkdtemp(prefix="smogcast-forest-")
    res.model.save(path, spark)
    m2 = TwoStageModel.load(path, spark)
    a = res.model.predict(feat).select("series_key", "Date", "predicted")
    b = m2.predict(feat).select("series_key", "Date", "predicted")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_restart_processes_only_new_files(spark, trained):
    """A restarted query resumes from its checkpoint: earlier files are not
    scored again and every request appears exactly once in the sink."""
    from smogcast.sources import binding
    from smogcast.streaming.requests import start_request_stream
    obs = binding.observations(spark, SF_SMALL)
    src, sink, ck = (tempfile.mkdtemp(prefix=p) for p in ("smogcast-rs-", "smogcast-ro-", "smogcast-rc-"))
    first = spark.createDataFrame([(1, "1-URGENT", "1996-03-01"), (2, "2-HIGH", "2031-01-05")],
                                  "request_id long, series_key string, date string")
    first.write.json(src + "/in/a")
    start_request_stream(spark, src + "/in/*", sink + "/out", ck, obs, trained.model).awaitTermination(600)
    second = spark.createDataFrame([(3, "3-MEDIUM", "1997-07-07"), (4, "4-NOT SPECIFIED", "bad")],
                                   "request_id long, series_key string, date string")
    second.write.json(src + "/in/b")
    start_request_stream(spark, src + "/in/*", sink + "/out", ck, obs, trained.model).awaitTermination(600)
    out = spark.read.parquet(sink + "/out")
    ids = sorted(r.request_id for r in out.select("request_id").collect())
    assert ids == [1, 2, 3, 4]
    assert out.select("batch_id").distinct().count() == 2


def test_gaps_months_and_series_without_data(spark, trained):
    """Weather defaults, whole-series statistics, filled trend categories and series status."""
    import datetime as dt

    from smogcast.plans.scoring import score_requests
    start, rows = dt.date(2020, 1, 1), []
    for i in range(400):
        d = start + dt.timedelta(days=i)
        if d.month == 6:
            continue
        rows.append(("A", d, None if i in (20, 21) else 60.0 + (i * 7) % 200, None if i == 25 else 10.0, 50.0, 1.0, 5.0, 1000.0))
    obs = spark.createDataFrame(rows, "series_key string, Date date, AQI double, temp double, humidity double, "
                                      "precip double, windspeed double, sealevelpressure double")
    req = spark.createDataFrame([(1, "A", "2020-01-26"), (2, "A", "2020-06-10"), (3, None, "2020-01-26"), (4, "X", "2020-01-26"),
                                 (5, "A", "bad")], "request_id long, series_key string, date string")
    got = {r.request_id: r for r in score_requests(req, obs, trained.model).collect()}
    assert {k: r.status for k, r in got.items()} == {1: "ok", 2: "ok", 3: "missing_series", 4: "unknown_series", 5: "invalid_date"}
    assert got[1].weather.temp == 25.0 and got[1].weather.humidity == 50.0 and got[1].is_future is False
    gap = [t for t in got[1].trend if t.date == "2020-01-21"][0]
    assert (gap.aqi, gap.category) == (150.0, "Moderate")
    assert got[2].is_future and len(got[2].stats.pdf) == 40 and got[2].stats.trend_slope != 0.0
    assert got[3].predicted_aqi is None and got[4].predicted_aqi is None


@pytest.mark.parametrize("members", [("gbt",), ("gbt", "gbt2", "ridge")])
def test_stage1_votes_over_the_configured_members(spark, tmp_path, members):
    from smogcast.plans import catalog
    from smogcast.plans.training import TwoStageModel, train_two_stage
    feat = catalog.training_table(spark, SF_SMALL)
    model = train_two_stage(feat, small(3, members=members, calibrate=False, fixed_thresholds=((2, 3, 0.585),))).model
    assert set(model.members) == set(members)
    path = f"file://{tmp_path}/bundle"
    model.save(path, spark)
    assert set(TwoStageModel.load(path, spark).members) == set(members)
    want = feat
    for m in members:
        own = getattr(model, m)
        want = own.transform(want).drop("features") if m == "ridge" else want.withColumn(f"pred_{m}", own.score())
    want = want.withColumn("want", F.exp(sum(F.col(f"pred_{m}") for m in members) / len(members)) - 1)
    both = model.predict_stage1(want.drop(*[f"pred_{m}" for m in members]))
    assert both.where(F.abs(F.col("want") - F.col("Predicted_AQI")) > 1e-6).count() == 0 < both.count()


def test_responses_read_context_tables_as_written(spark, trained, capsys):
    """The responses' plan joins finished tables: no window or median step of the context is left in it."""
    import datetime as dt

    from smogcast.plans.scoring import context_tables, score_requests
    start = dt.date(2020, 1, 1)
    rows = [("A", start + dt.timedelta(days=i), 60.0 + (i * 7) % 200, 10.0, 50.0, 1.0, 5.0, 1000.0) for i in range(60)]
    obs = spark.createDataFrame(rows, "series_key string, Date date, AQI double, temp double, humidity double, "
                                      "precip double, windspeed double, sealevelpressure double")
    req = spark.createDataFrame([(1, "A", "2020-01-26"), (2, "A", "2021-06-10"), (3, "A", "2020-01-26")],
                                "request_id long, series_key string, date string")
    ctx = context_tables(obs)
    out = score_requests(req, None, trained.model, ctx)
    for table in (ctx["exact"], ctx["stats"], ctx["fallback"], ctx["calendar"].table, out):
        capsys.readouterr()
        table.explain()
        assert "Window" not in capsys.readouterr().out
    got = {r.request_id: r for r in out.collect()}
    assert [got[i].is_future for i in (1, 2, 3)] == [False, True, False] and got[1].predicted_aqi == got[3].predicted_aqi
