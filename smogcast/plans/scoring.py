"""OP-81: batch scoring of a table of requested dates (and OP-05 responses).

A request is (request_id, series_key, date text). Every request becomes one
response row, bad input included (``status`` = missing_date / invalid_date /
missing_series / unknown_series).

All per-date context is precomputed once per series and equi-joined to the
requests, never recomputed per request:

* the serving feature table (exact date present) and its per-series means;
* calendar climatology at (month, day) / month / series levels (absent date);
* the preceding-7-rows context (present) or climatological 7-day trend
  (absent);
* month statistics, multi-year slope and density curve per (series, month).

The lookups are bounded by series x calendar, the request table can be any
size; AQE chooses broadcast or sort-merge per join at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogcast.functions.categories import aqi_category, category_color, category_name
from smogcast.functions.scalars import round_half_up, safe_number
from smogcast.operators import climatology, distribution, splits
from smogcast.operators import timeseries as ts
from smogcast.plans.features import FEATURES, engineer_features
from smogcast.sources.observations import WEATHER_COLS, to_date_col
from smogcast.session import materialize

PREDICTION_TYPES = ("Historical Baseline", "Seasonal Climatology Synthesis")


def parse_requests(requests: DataFrame, date_col: str = "date") -> DataFrame:
    """Validate the date text: NULL/blank -> missing_date, unparseable ->
    invalid_date; the request row is kept either way."""
    txt = F.trim(F.col(date_col).cast("string"))
    parsed = to_date_col(txt)
    status = (F.when(txt.isNull() | (txt == ""), F.lit("missing_date"))
               .when(parsed.isNull(), F.lit("invalid_date")).otherwise(F.lit("ok")))
    return requests.withColumns({"date_text": F.col(date_col).cast("string"), "req_date": parsed,
                                 "status": status})


def with_series_status(requests: DataFrame, obs: DataFrame) -> DataFrame:
    """Valid dates of a NULL series become missing_series, those of a series
    without observations unknown_series."""
    known = obs.select("series_key").distinct().withColumnRenamed("series_key", "__k")
    r = requests.join(known, requests["series_key"] == known["__k"], "left")
    ok = F.col("status") == "ok"
    return r.withColumn("status", F.when(ok & F.col("series_key").isNull(), F.lit("missing_series"))
                        .when(ok & F.col("__k").isNull(), F.lit("unknown_series"))
                        .otherwise(F.col("status"))).drop("__k")


def _distribution(obs: DataFrame, by_month: bool) -> DataFrame:
    """Statistics, slope and density curve per (series, month) or per series."""
    on = ["series_key", "month"] if by_month else ["series_key"]
    stats = distribution.month_stats(obs, by_month=by_month)
    slope = distribution.month_trend_slope(obs, by_month=by_month)
    if not by_month:
        stats, slope = stats.drop("month"), slope.drop("month")
    stats = stats.join(slope.drop("n_years"), on, "left")
    points = (distribution.normal_pdf_points(stats).groupBy(*on)
              .agg(F.array_sort(F.collect_list(F.struct("i", "x", "y"))).alias("__pts"))
              .select(*on, F.transform("__pts", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("pdf")))
    return stats.join(points, on, "left")


def context_tables(obs: DataFrame) -> dict[str, DataFrame]:
    """Everything the responses need, computed once from the observations.

    Feature gaps are filled with means of the training part (the first 70 % of
    each series), as the model saw them; weather is kept unfilled beside them,
    since responses show fixed defaults for missing weather.

    Each table is written down once: all are bounded by series x days, and a plan
    that carried them unresolved to the last join would be the longest part of it."""
    obs = obs.transform(materialize)
    serving = engineer_features(obs, training=False).transform(materialize)
    train = splits.chronological_split(serving).where(F.col("split") == "train")
    own = train.groupBy(F.col("series_key").alias("__k")).agg(*[F.avg(c).alias(f"__m_{c}") for c in FEATURES])
    filled = (serving.withColumns({f"raw_{c}": F.col(c) for c in WEATHER_COLS})
              .join(own, F.col("series_key") == F.col("__k"), "left")
              .withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"__m_{c}"), F.lit(0.0)) for c in FEATURES})
              .drop("__k", *[f"__m_{c}" for c in FEATURES]))
    trend = ts.preceding_context(obs.select("series_key", "Date", "AQI"))
    exact = filled.join(trend.select("series_key", "Date", "trend"), ["series_key", "Date"], "left")
    # 731 rows a series, every fallback and trend resolved
    calendar = climatology.closed_calendar(serving, FEATURES, raw=tuple(WEATHER_COLS), trend="AQI")
    calendar.table = materialize(calendar.table)
    return {"exact": exact.transform(materialize), "calendar": calendar,
            "stats": _distribution(obs, True).transform(materialize),
            # for requested months without data
            "fallback": _distribution(obs, False).transform(materialize), "series": obs}


def score_keys(keys: DataFrame, model, ctx: dict) -> DataFrame:
    """Every response field for each distinct (series_key, req_date).

    All of them (features, weather, trend, model prediction, statistics)
    depend only on the key, so they are computed once per key: the work is
    bounded by series x calendar, not by the number of requests."""
    keys = keys.transform(materialize)  # both branches read them: the requests are gone through once
    ex = ctx["exact"].withColumnRenamed("Date", "req_date")
    hit = keys.join(ex, ["series_key", "req_date"], "inner").withColumns({
        "is_future": F.lit(False),
        "actual_aqi": F.col("AQI"),
        "weather": F.struct(*[safe_number(F.col(f"raw_{c}"), climatology.WEATHER_DEFAULTS[c]).alias(c)
                              for c in WEATHER_COLS]),
        "trend": F.transform("trend", lambda t: F.struct(
            F.date_format(t["date"], "yyyy-MM-dd").alias("date"),
            safe_number(t["aqi"], climatology.TREND_DEFAULT).alias("aqi"),
            category_name(aqi_category(safe_number(t["aqi"], climatology.TREND_DEFAULT))).alias("category"),
            category_color(aqi_category(safe_number(t["aqi"], climatology.TREND_DEFAULT))).alias("color"))),
    })

    miss = keys.join(ex.select("series_key", "req_date"), ["series_key", "req_date"], "left_anti")
    look = ctx["calendar"].lookup(miss, "req_date")
    look = look.withColumns({
        "is_future": F.lit(True),
        "actual_aqi": F.lit(None).cast("double"),
        "weather": F.struct(*[safe_number(F.col(f"raw_{c}"), climatology.WEATHER_DEFAULTS[c]).alias(c)
                              for c in WEATHER_COLS]),
        "trend": F.transform("trend", lambda v, i: F.struct(
            F.date_format(F.date_sub(F.col("req_date"), F.lit(climatology.TREND_DAYS) - i), "yyyy-MM-dd").alias("date"),
            v.alias("aqi"), category_name(aqi_category(v)).alias("category"), category_color(aqi_category(v)).alias("color"))),
    })

    keep = ["series_key", "req_date", "is_future", "actual_aqi", "weather", "trend"] + FEATURES
    # The feature rows are the input of the heaviest stage (six models):
    # materialise them once in the reliable checkpoint folder so the model
    # stage neither re-runs the lookups nor loses them with an executor.
    both = hit.select(*keep).unionByName(look.select(*keep)).transform(materialize)
    pred = model.predict(both)

    pred = pred.withColumn("month", F.month("req_date")).join(ctx["stats"], ["series_key", "month"], "left")
    # month without data -> whole-series statistics, slope and curve (chosen by presence)
    stat_cols = ["mean", "median", "mode", "variance", "std_dev", "trend_slope", "pdf"]
    fb = ctx["fallback"].select("series_key", *[F.col(c).alias(f"__f_{c}") for c in stat_cols])
    pred = pred.join(fb, "series_key", "left").withColumns({
        c: F.when(F.col("n").isNotNull(), F.col(c)).otherwise(F.col(f"__f_{c}")) for c in stat_cols})
    pred = pred.withColumn("trend_slope", F.coalesce(F.col("trend_slope"), F.lit(0.0)))
    code = F.col("predicted")
    return pred.select(
        "series_key", "req_date",
        round_half_up(F.col("Predicted_AQI"), 2).alias("predicted_aqi"),
        category_name(code).alias("category"), category_color(code).alias("color"),
        "actual_aqi", "is_future", F.col("is_future").alias("is_climatology"),
        F.when(F.col("is_future"), F.lit(PREDICTION_TYPES[1])).otherwise(F.lit(PREDICTION_TYPES[0]))
         .alias("prediction_type"),
        "weather", "trend",
        F.struct(round_half_up(F.col("mean"), 2).alias("mean"), round_half_up(F.col("median"), 2).alias("median"),
                 round_half_up(F.col("mode"), 2).alias("mode"), round_half_up(F.col("variance"), 2).alias("variance"),
                 round_half_up(F.col("std_dev"), 2).alias("std_dev"),
                 round_half_up(F.col("trend_slope"), 4).alias("trend_slope"),
                 F.date_format("req_date", "MMMM").alias("month_name"),
                 F.coalesce(F.col("pdf"), F.array().cast("array<struct<x:double,y:double>>")).alias("pdf"))
         .alias("stats"))


def score_requests(requests: DataFrame, obs: DataFrame, model, ctx: dict | None = None) -> DataFrame:
    """One response per request: prediction, category, weather, 7-day trend
    and month statistics, plus ``status``, ``is_future`` (date absent from the
    data) and ``prediction_type``.

    Responses are computed per distinct (series, date) by :func:`score_keys`
    and attached to the requests with one equi-join (AQE broadcasts the
    per-key table when small, or splits a hot key's partition when skewed)."""
    ctx = ctx or context_tables(obs)
    req = with_series_status(parse_requests(requests), ctx["series"])
    ok = req.where(F.col("status") == "ok")
    per_key = score_keys(ok.select("series_key", "req_date").distinct(), model, ctx)
    resp = (ok.select("request_id", "series_key", "req_date", F.col("date_text").alias("date"), "status")
              .join(per_key, ["series_key", "req_date"], "left").drop("req_date"))
    bad = req.where(F.col("status") != "ok").select(
        "request_id", "series_key", F.col("date_text").alias("date"), "status")
    return resp.unionByName(bad, allowMissingColumns=True)


def response_json(responses: DataFrame) -> DataFrame:
    """OP-05: one JSON document per response."""
    return responses.select("request_id", F.to_json(F.struct(*[c for c in responses.columns
                                                                if c != "request_id"])).alias("json"))
