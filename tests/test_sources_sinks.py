"""Sources and sinks (OP-01/02/03/05), cleaning helpers (OP-07/10/13/16),
one-vs-rest boosting (OP-74 boosted variant), event proximity (OP-49)."""

import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from smogcast.operators import cleaning, joins
from tests.conftest import days


def test_read_observations_csv(spark):
    d = tempfile.mkdtemp(prefix="smogcast-csv-")
    with open(os.path.join(d, "obs.csv"), "w") as f:
        f.write("series_key,Date,AQI,temp,humidity,precip,windspeed,sealevelpressure\n")
        f.write("A,2020-01-02,55.5,20,50,0,10,1010\n")
        f.write("A,2020-02-30,NaN,,,,,\n")
        f.write("A,2020-01-01,40,21,49,0,9,1011\n")
    from smogcast.sources.observations import duplicate_days, read_observations
    df = read_observations(spark, d)
    rows = {str(r.Date): r for r in df.collect()}
    assert rows["None"].AQI is None                  # NaN sanitised to NULL, bad date -> NULL
    assert rows["2020-01-02"].AQI == 55.5
    assert duplicate_days(df).count() == 0
    import pytest
    from smogcast.sources.observations import assert_unique_days
    with pytest.raises(ValueError, match="unparseable"):
        assert_unique_days(df)
    ok = df.where(F.col("Date").isNotNull())
    assert assert_unique_days(ok) is ok
    with pytest.raises(ValueError, match="duplicate"):
        assert_unique_days(ok.unionByName(ok))


def test_forecast_csv_and_response_json(spark):
    from smogcast.plans.scoring import response_json
    from smogcast.sources.sinks import FORECAST_COLUMNS, write_forecast_csv
    fc = spark.createDataFrame([("A", dt.date(2020, 1, 1), 1.0, 0.5, 2.0, 1.1, "Good")],
                               "series_key string, ds date, yhat double, yhat_lower double, yhat_upper double, "
                               "trend double, aqi_category string")
    out = tempfile.mkdtemp(prefix="smogcast-fc-") + "/f"
    write_forecast_csv(fc, out)
    back = spark.read.option("header", True).csv(out)
    assert set(FORECAST_COLUMNS) <= set(back.columns) and back.count() == 1
    resp = spark.createDataFrame([(1, "2020-01-01", [("2019-12-31", 10.0)])],
                                 "request_id long, date string, trend array<struct<date:string,aqi:double>>")
    doc = json.loads(response_json(resp).first()["json"])
    assert doc["trend"][0]["aqi"] == 10.0


def test_partitioned_sink_prunes_partitions(spark):
    from smogcast.sources import binding
    from smogcast.sources.sinks import with_year, write_table
    out = tempfile.mkdtemp(prefix="smogcast-part-") + "/obs"
    obs = binding.observations(spark, "/root/testdata/sf0.001")
    write_table(with_year(obs), out, ["year"])
    d0 = obs.orderBy("Date").first()["Date"]
    q = spark.read.parquet(out).where((F.col("year") == d0.year) & (F.col("Date") == d0))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(year#" in plan
    assert f"PushedFilters: [IsNotNull(Date), EqualTo(Date,{d0.isoformat()})]" in plan
    assert q.count() >= 1


def test_cleaning_helpers(spark):
    df = spark.createDataFrame([("A", d, float(i) if i % 3 else None) for i, d in enumerate(days(25))],
                               "series_key string, Date date, v double")
    sl = cleaning.row_slice(df, 15, 20).orderBy("Date").collect()
    assert [r.Date for r in sl] == days(25)[15:20]
    assert cleaning.drop_any_null(df, subset=["v"]).count() == 16
    assert cleaning.rename(df, {"v": "y"}).columns == ["series_key", "Date", "y"]
    assert cleaning.where_date(df, month=1, day=3).count() == 1
    filled = cleaning.fill_with_means(df, ["v"], key=None).agg(F.sum(F.col("v").isNull().cast("int"))).first()[0]
    assert filled == 0


def test_event_proximity(spark):
    ev = spark.createDataFrame([(dt.date(2020, 11, 14),), (dt.date(2021, 11, 4),)], "event_date date")
    df = spark.createDataFrame([(dt.date(2020, 11, 13),), (dt.date(2020, 11, 16),), (dt.date(2021, 11, 5),)],
                               "Date date")
    got = [r.near_event for r in joins.flag_near_events(df, ev).orderBy("Date").collect()]
    assert got == [1, 0, 1]
