"""Command line: the reference's script workflows as Spark jobs.

    python -m smogcast.cli features --obs obs.csv --out features/
    python -m smogcast.cli train    --obs obs.csv --model-dir bundle/ [--report report/]
    python -m smogcast.cli score    --obs obs.csv --model-dir bundle/ --requests req.csv --out responses/
    python -m smogcast.cli forecast --obs obs.csv --out forecast_csv/ [--horizon 30]

``--obs`` is a daily observation table (CSV with header: series_key, Date,
AQI and the five weather columns; or ``--obs-format parquet``). Requests are
CSV/JSON records (request_id, series_key, date). Outputs are written by Spark
(partitioned folders, no single-file coalesce). On a cluster,
``spark.checkpoint.dir`` must name a shared folder.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from smogcast.session import build_session, ensure_checkpoint_dir


def _obs(spark, args):
    from smogcast.sources.observations import assert_unique_days, read_observations
    return assert_unique_days(read_observations(spark, args.obs, fmt=args.obs_format))


def cmd_features(spark, args):
    from smogcast.plans.features import engineer_features
    f = engineer_features(_obs(spark, args), training=not args.serving)
    f.write.mode("overwrite").parquet(args.out)


def cmd_train(spark, args):
    from dataclasses import replace

    from smogcast.ml.stage1 import ASYMMETRIC, GBT
    from smogcast.ml.stage2 import BOOSTED
    from smogcast.plans.features import engineer_features
    from smogcast.plans.training import TrainConfig, train_two_stage
    cfg = TrainConfig(gbt=replace(GBT, rounds=args.rounds), asym=replace(ASYMMETRIC, rounds=args.rounds),
                      boosted=replace(BOOSTED, rounds=max(1, args.rounds // 2)), classifier=args.classifier,
                      forest_trees=args.trees, refit_on_val=args.refit_on_val)
    res = train_two_stage(engineer_features(_obs(spark, args), training=True), cfg)
    res.model.save(args.model_dir, spark)
    if args.report:
        res.regression.write.mode("overwrite").json(f"{args.report}/regression")
        res.confusion.write.mode("overwrite").json(f"{args.report}/confusion")
        res.report.write.mode("overwrite").json(f"{args.report}/classification")
        res.tuned.write.mode("overwrite").json(f"{args.report}/thresholds")


def cmd_score(spark, args):
    from smogcast.plans.scoring import score_requests
    from smogcast.plans.training import TwoStageModel
    from smogcast.sources.sinks import write_responses_json
    from smogcast.streaming.requests import REQUEST_SCHEMA
    model = TwoStageModel.load(args.model_dir, spark)
    reader = spark.read.schema(REQUEST_SCHEMA)
    req = reader.option("header", True).csv(args.requests) if args.requests_format == "csv" \
        else reader.json(args.requests)
    write_responses_json(score_requests(req, _obs(spark, args), model), args.out)


def cmd_forecast(spark, args):
    from smogcast.functions.calendar import season_flag
    from smogcast.ml.forecast import SeasonalForecaster
    from smogcast.operators import cleaning, climatology, joins
    from smogcast.operators import timeseries as ts
    from smogcast.sources.sinks import write_forecast_csv
    o = _obs(spark, args).select("series_key", F.col("Date").alias("ds"), F.col("AQI").alias("y"),
                                 F.col("temp").alias("temperature"), F.col("windspeed").alias("wind_speed"))
    o = cleaning.drop_any_null(ts.interpolate_linear(o, "y", date="ds"), subset=["ds", "y"])
    o = o.withColumn("is_stubble_burning", season_flag("ds"))
    ev = joins.peak_day_events(o, value="y", date="ds")
    model = SeasonalForecaster().fit(joins.flag_near_events(o, ev, date="ds"))
    hz = joins.future_horizon(o, args.horizon, date="ds")
    clim = climatology.doy_climatology(o.withColumnRenamed("ds", "date"), ["temperature", "wind_speed"], date="date")
    fut = climatology.join_doy_climatology(hz, clim, ["temperature", "wind_speed"], date="ds")
    fut = ts.fill_forward_backward(fut, ["temperature", "wind_speed"], date="ds")
    fut = joins.flag_near_events(fut.withColumn("is_stubble_burning", season_flag("ds")), ev, date="ds")
    write_forecast_csv(model.transform(fut), args.out)


def main(argv=None):
    p = argparse.ArgumentParser(prog="smogcast")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)

    def common(sp):
        sp.add_argument("--obs", required=True)
        sp.add_argument("--obs-format", default="csv")

    f = sub.add_parser("features"); common(f)
    f.add_argument("--out", required=True); f.add_argument("--serving", action="store_true")
    t = sub.add_parser("train"); common(t)
    t.add_argument("--model-dir", required=True); t.add_argument("--report")
    t.add_argument("--rounds", type=int, default=1000); t.add_argument("--trees", type=int, default=300)
    t.add_argument("--classifier", choices=["boosted", "forest"], default="boosted")
    t.add_argument("--refit-on-val", action="store_true")
    s = sub.add_parser("score"); common(s)
    s.add_argument("--model-dir", required=True); s.add_argument("--requests", required=True)
    s.add_argument("--requests-format", default="csv"); s.add_argument("--out", required=True)
    fc = sub.add_parser("forecast"); common(fc)
    fc.add_argument("--out", required=True); fc.add_argument("--horizon", type=int, default=30)
    args = p.parse_args(argv)

    spark = build_session(args.master)
    ensure_checkpoint_dir(spark)
    {"features": cmd_features, "train": cmd_train, "score": cmd_score, "forecast": cmd_forecast}[args.cmd](
        spark, args)


if __name__ == "__main__":
    main()
