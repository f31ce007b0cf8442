"""The command-line workflows over a user's own CSV observation file."""

import tempfile

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


def test_cli_workflows(spark):
    from smogcast import cli
    from smogcast.sources import binding
    root = tempfile.mkdtemp(prefix="smogcast-cli-")
    obs = binding.observations(spark, SF_SMALL).withColumn("Date", F.date_format("Date", "yyyy-MM-dd"))
    obs.select("series_key", "Date", "AQI", "temp", "humidity", "precip", "windspeed", "sealevelpressure") \
        .write.option("header", True).csv(f"{root}/obs")
    req = spark.createDataFrame([(1, "1-URGENT", "1996-03-01"), (2, "1-URGENT", "2030-07-04"),
                                 (3, "1-URGENT", "not a date")], "request_id long, series_key string, date string")
    req.write.option("header", True).csv(f"{root}/req")

    cli.main(["features", "--obs", f"{root}/obs", "--out", f"{root}/features"])
    assert spark.read.parquet(f"{root}/features").count() > 0

    cli.main(["train", "--obs", f"{root}/obs", "--model-dir", f"{root}/bundle", "--report", f"{root}/report",
              "--rounds", "2", "--trees", "3"])
    assert spark.read.json(f"{root}/report/thresholds").count() == 4

    cli.main(["score", "--obs", f"{root}/obs", "--model-dir", f"{root}/bundle", "--requests", f"{root}/req",
              "--out", f"{root}/responses"])
    resp = {r.request_id: r for r in spark.read.json(f"{root}/responses").collect()}
    assert resp[3].status == "invalid_date" and resp[2].is_future and resp[2].category is not None

    cli.main(["forecast", "--obs", f"{root}/obs", "--out", f"{root}/forecast", "--horizon", "10"])
    fc = spark.read.option("header", True).csv(f"{root}/forecast")
    assert {"ds", "yhat", "yhat_lower", "yhat_upper", "trend", "aqi_category"} <= set(fc.columns)
    assert fc.count() > 0
