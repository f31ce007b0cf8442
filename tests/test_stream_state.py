"""Repeated requests over a restart, refreshed context, compacted sink."""

import datetime as dt

import pytest

from smogcast.streaming.requests import (compact_sink, latest_context, load_context, publish_context, read_sink,
                                         start_request_stream)

OBS = "series_key string, Date date, AQI double, temp double, humidity double, precip double, windspeed double, sealevelpressure double"
REQ = "request_id long, series_key string, date string"


class Constant:
    """A model of one answer."""

    def predict(self, df):
        from pyspark.sql import functions as F
        return df.withColumns({"Predicted_AQI": F.lit(120.0), "predicted": F.lit(2)})


def observations(spark, level):
    start = dt.date(2020, 1, 1)
    return spark.createDataFrame([("A", start + dt.timedelta(days=i), level + i % 7, 20.0, 40.0, 0.0, 5.0, 1000.0)
                                  for i in range(120)], OBS)


def send(spark, folder, name, rows):
    spark.createDataFrame(rows, REQ).coalesce(1).write.json(f"{folder}/in/{name}")


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = f"file://{tmp_path_factory.mktemp('stream')}"
    context = f"{root}/context"

    def go():
        start_request_stream(spark, f"{root}/in/*", f"{root}/out", f"{root}/check", None, Constant(), context_dir=context).awaitTermination(600)
    return root, context, go


def test_requests_are_scored_once_over_a_restart_with_the_newest_context(spark, run):
    root, context, go = run
    assert latest_context(spark, context) is None
    assert publish_context(observations(spark, 100.0), context) == 1
    send(spark, root, "a", [(1, "A", "2020-02-01"), (1, "A", "2020-02-01"), (2, "A", "2031-02-01"), (None, "A", "2020-02-02"),
                            (None, "A", "2020-02-02"), (None, "A", "bad")])
    go()
    first = {r["request_id"]: r for r in read_sink(spark, f"{root}/out").where("request_id IS NOT NULL").collect()}
    assert sorted(first) == [1, 2] and read_sink(spark, f"{root}/out").count() == 4
    assert publish_context(observations(spark, 300.0), context) == 2
    send(spark, root, "b", [(2, "A", "2031-02-01"), (3, "A", "2020-02-01"), (1, "A", "2020-02-01")])   # two were seen before
    go()
    out = read_sink(spark, f"{root}/out")
    assert sorted(r["request_id"] for r in out.where("request_id IS NOT NULL").collect()) == [1, 2, 3]
    got = {r["request_id"]: r for r in out.collect()}
    assert got[1]["actual_aqi"] < 110 and got[3]["actual_aqi"] > 290                                  # each by its context
    assert got[3]["predicted_aqi"] == 120.0 and got[3]["category"] == "Moderate"


def test_an_unfinished_version_is_not_read(spark, run):
    root, context, _ = run
    spark.range(1).write.parquet(f"{context}/9/stats")
    assert latest_context(spark, context) == 2
    ctx = load_context(spark, context, 2)
    assert ctx["calendar"].table.count() == 731 and ctx["calendar"].fills["AQI_lag_1"] > 290


def test_compaction_keeps_every_row_once(spark, run):
    root, _, _ = run
    sink = f"{root}/out"
    before = sorted(map(str, read_sink(spark, sink).drop("batch_id").collect()))
    upto = compact_sink(spark, sink)
    assert sorted(map(str, read_sink(spark, sink).drop("batch_id").collect())) == before
    assert sorted(map(str, spark.read.parquet(sink).drop("batch_id").collect())) == before             # plain readers too
    assert compact_sink(spark, sink, remove=True) == upto
    assert sorted(map(str, read_sink(spark, sink).drop("batch_id").collect())) == before
    assert len(read_sink(spark, sink).inputFiles()) == 1
