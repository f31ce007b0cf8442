"""Registered queries: one per operator group of the inventory.

Every query reads the driver's tables (all rows) through the binding in
``smogcast.sources.binding``. SQL-checked queries return their double columns
quantized to the 2^-20 grid with :func:`quantize` (the oracle uses the same
arithmetic), so value hashes are comparable across engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smogcast.functions import calendar as cal
from smogcast.functions.categories import aqi_category, with_category_info
from smogcast.functions.scalars import (alarm, argmax_index, clip, exp_target, log_target, quantize,
                                        safe_number, signed_text, trend_label)
from smogcast.operators import cleaning, climatology, distribution, joins, metrics, splits
from smogcast.operators import thresholds as th
from smogcast.operators import timeseries as ts
from smogcast.operators import weights as wts
from smogcast.plans.features import FEATURES, LABEL, engineer_features
from smogcast.sources import binding
from smogcast.sources.observations import WEATHER_COLS, to_date_col
from smogcast.session import materialize


def finish(df: DataFrame) -> DataFrame:
    """Quantize every double column (output presentation only)."""
    return df.select(*[
        quantize(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields])


def obs(spark, sf_dir) -> DataFrame:
    return binding.observations(spark, sf_dir)


def training_table(spark, sf_dir) -> DataFrame:
    return engineer_features(obs(spark, sf_dir), training=True)


def split_table(spark, sf_dir) -> DataFrame:
    return splits.chronological_split(training_table(spark, sf_dir))


# ---- sources / binding -----------------------------------------------------
def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(binding.daily_series(spark, sf_dir))


def weather_join(spark, sf_dir):
    return finish(obs(spark, sf_dir))


# ---- time-series windows -------------------------------------------------------
def lag_features(spark, sf_dir):
    o = ts.add_lags(obs(spark, sf_dir), "AQI", [1] + ts.LAGS)
    return finish(o.select("series_key", "Date", "AQI", *[f"AQI_lag_{k}" for k in [1] + ts.LAGS]))


def leak_shift(spark, sf_dir):
    """The three leaky input columns computed as they arrive (inclusive of
    the current day), then shifted one row later."""
    w = ts.series_window()
    o = ts.add_ewm(obs(spark, sf_dir), "AQI", {"AQI_ewma_7": True}).withColumns({
        "AQI_roll_mean_7": ts.trailing_stat("AQI", "mean", 7, w, include_current=True),
        "AQI_diff_1": F.col("AQI") - F.lag("AQI", 1).over(w),
    })
    raw = o.select("series_key", "Date", *[F.col(c).alias(f"{c}_raw") for c in ts.LEAKY_COLUMNS],
                   *ts.LEAKY_COLUMNS)
    return finish(ts.leak_shift(raw, ts.LEAKY_COLUMNS))


def diff_spike(spark, sf_dir):
    w = ts.series_window()
    o = obs(spark, sf_dir).withColumns(ts.diff_columns("AQI", w))
    return finish(o.select("series_key", "Date", "AQI", "AQI_diff_1", "AQI_delta_1", "is_spike"))


def rolling_features(spark, sf_dir):
    o = ts.add_rolling(obs(spark, sf_dir), "AQI")
    cols = [f"AQI_roll_{s}_{n}" for n in ts.ROLL_WINDOWS for s in ("mean", "std", "max")]
    return finish(o.select("series_key", "Date", "AQI", *cols))


def ewm_feature(spark, sf_dir):
    o = ts.add_ewm(obs(spark, sf_dir), "AQI", {"ewma_inclusive": True, "ewma_exclusive": False})
    return finish(o.select("series_key", "Date", "AQI", "ewma_inclusive", "ewma_exclusive"))


def ewm_masked(spark, sf_dir):
    """OP-23 on the series with missing days: weights decay across NULLs."""
    o = ts.add_ewm(binding.sparse_readings_masked(spark, sf_dir), "AQI", {"ewma_inclusive": True, "ewma_exclusive": False})
    return finish(o.select("series_key", "Date", "AQI", "ewma_inclusive", "ewma_exclusive"))


def leakage_audit(spark, sf_dir):
    """Audit of stored columns of both sorts: the first two series hold the
    leaky (inclusive) rolling mean and EWM, the others the exclusive ones."""
    w = ts.series_window()
    leaky = F.col("series_key") < "3"
    o = ts.add_ewm(obs(spark, sf_dir), "AQI", {"__i": True, "__x": False}).withColumns({
        "stored_roll": F.when(leaky, ts.trailing_stat("AQI", "mean", 7, w, include_current=True))
                        .otherwise(ts.trailing_stat("AQI", "mean", 7, w, include_current=False)),
        "stored_ewm": F.when(leaky, F.col("__i")).otherwise(F.col("__x")),
    }).drop("__i", "__x")
    return finish(ts.leakage_audit(o, stored_roll="stored_roll", stored_ewm="stored_ewm"))


def ventilation_features(spark, sf_dir):
    w = ts.series_window()
    o = obs(spark, sf_dir).withColumn("ventilation", ts.ventilation()).withColumns(ts.weather_lag_columns(w))
    return finish(o.select("series_key", "Date", "ventilation", "ventilation_lag1", "windspeed_lag1",
                           "humidity_lag1", "temp_lag1"))


def calendar_features(spark, sf_dir):
    o = obs(spark, sf_dir).select("series_key", "Date")
    o = cal.add_cyclic_encodings(cal.add_calendar_parts(o, "Date"), "Date")
    return finish(o.withColumn("is_stubble_burning", cal.season_flag("Date")))


def event_flag(spark, sf_dir):
    o = obs(spark, sf_dir)
    ev = joins.peak_day_events(o)
    return finish(joins.flag_near_events(o.select("series_key", "Date", "AQI"), ev))


def interpolate_gaps(spark, sf_dir):
    m = binding.sparse_readings_masked(spark, sf_dir).select("series_key", "Date", "AQI")
    return finish(ts.interpolate_linear(m, "AQI", out="AQI_interp"))


def fill_gaps(spark, sf_dir):
    m = binding.sparse_readings_masked(spark, sf_dir).select("series_key", "Date", "AQI", "temp")
    m = m.withColumns({"AQI_filled": F.col("AQI"), "temp_filled": F.col("temp")})
    return finish(ts.fill_forward_backward(m, ["AQI_filled", "temp_filled"]))


def interpolate_gaps_chunked(spark, sf_dir):
    """OP-27 by calendar years with carried edges (same oracle as the whole-series form)."""
    m = binding.sparse_readings_masked(spark, sf_dir).select("series_key", "Date", "AQI")
    return finish(ts.interpolate_linear(m, "AQI", out="AQI_interp", chunk="year"))


def fill_gaps_chunked(spark, sf_dir):
    """OP-28 by calendar months with carried edges (same oracle as the whole-series form)."""
    m = binding.sparse_readings_masked(spark, sf_dir).select("series_key", "Date", "AQI", "temp")
    m = m.withColumns({"AQI_filled": F.col("AQI"), "temp_filled": F.col("temp")})
    return finish(ts.fill_forward_backward(m, ["AQI_filled", "temp_filled"], chunk="month"))


def preceding_context(spark, sf_dir):
    o = ts.preceding_context(obs(spark, sf_dir).select("series_key", "Date", "AQI"))
    out = o.select("series_key", "Date", F.posexplode("trend").alias("pos", "t"))
    return finish(out.select("series_key", "Date", (F.col("pos") + 1).cast("int").alias("pos"),
                             F.col("t.date").alias("ctx_date"), F.col("t.aqi").alias("ctx_aqi"),
                             F.col("t.category").alias("ctx_category"), F.col("t.color").alias("ctx_color")))


SEQ_FEATURES = ["AQI"] + WEATHER_COLS


def sequence_windows(spark, sf_dir):
    s = ts.sequence_windows(obs(spark, sf_dir), SEQ_FEATURES, "AQI", steps=7)
    out = s.select("series_key", "Date", "target", F.posexplode("sequence").alias("pos", "f"))
    return finish(out.select("series_key", "Date", (F.col("pos") + 1).cast("int").alias("step"), "target",
                             *[F.col("f")[i].alias(f"f_{c}") for i, c in enumerate(SEQ_FEATURES)]))


# ---- cleaning / scalars ---------------------------------------------------------
def feature_table(spark, sf_dir):
    """OP-79 training variant: all features, rows with any NULL dropped, label."""
    return finish(training_table(spark, sf_dir))


def clean_drop_fill(spark, sf_dir):
    """OP-11 on the serving feature table: NULL features -> series mean -> 0."""
    f = engineer_features(obs(spark, sf_dir), training=False)
    return finish(cleaning.fill_with_means(f, FEATURES, key="series_key"))


def safe_number_query(spark, sf_dir):
    ev = binding.table(spark, sf_dir, "events")
    raw = (F.when(F.col("event_type").isin("click", "purchase"), F.get_json_object("props", "$.k"))
            .when(F.col("event_type") == "view", F.lit("NaN"))
            .when(F.col("event_type") == "error", F.lit("Infinity"))
            .otherwise(F.col("event_type")))
    return finish(ev.select("event_id", safe_number(raw, 0.0).alias("safe_value"),
                            safe_number(F.col("value"), -1.0).alias("safe_amount")))


def aqi_category_query(spark, sf_dir):
    o = obs(spark, sf_dir).select("series_key", "Date", "AQI").withColumn("code", aqi_category("AQI"))
    o = with_category_info(o, "code")
    return finish(o.select("series_key", "Date", "code", "category_name", "color", "advice_title"))


def rename_columns(spark, sf_dir):
    """OP-07: the forecaster's names."""
    o = cleaning.rename(binding.forecast_input(spark, sf_dir), {"date": "ds", "aqi": "y"})
    return finish(o.select("series_key", "ds", "y", "is_stubble_burning"))


def selected_features(spark, sf_dir):
    """OP-08: every column of the serving table but the deny-list, with its number of values."""
    from smogcast.plans.features import select_features
    f = engineer_features(obs(spark, sf_dir), training=False)
    names = select_features(f)
    return f.agg(*[F.count(c).alias(c) for c in names]).unpivot([], names, "feature", "n_values")


def drop_missing_days(spark, sf_dir):
    """OP-10: rows with a value, whatever the weather holds."""
    o = cleaning.drop_any_null(binding.sparse_readings_masked(spark, sf_dir), subset=["AQI"])
    return finish(o.select("series_key", "Date", "AQI", "temp"))


def date_filter(spark, sf_dir):
    """OP-13: a month and day in every year before a date."""
    o = cleaning.where_date(obs(spark, sf_dir), before="1997-01-01", month=3, day=15)
    return finish(o.select("series_key", "Date", "AQI"))


def row_slice(spark, sf_dir):
    """OP-16: rows 10 to 24 of each series."""
    return finish(cleaning.row_slice(obs(spark, sf_dir), 10, 25).select("series_key", "Date", "AQI"))


def trend_text(spark, sf_dir):
    """OP-41: the whole part of each month's slope as signed text."""
    s = distribution.month_trend_slope(obs(spark, sf_dir))
    return s.select("series_key", "month", signed_text(F.floor("trend_slope").cast("long")).alias("slope_text"))


def clip_values(spark, sf_dir):
    m = binding.sparse_readings_masked(spark, sf_dir).select("series_key", "Date", "AQI")
    raw = F.col("AQI") * F.lit(1.2) - F.lit(30.0)
    return finish(m.select("series_key", "Date", clip(raw, 0.0, 500.0).alias("clipped"),
                           clip(raw, lo=0.0).alias("clipped_lower"), clip(raw, hi=500.0).alias("clipped_upper")))


def log_transform(spark, sf_dir):
    o = obs(spark, sf_dir)
    return finish(o.select("series_key", "Date", log_target("AQI").alias("aqi_log"),
                           exp_target(F.col("AQI") / F.lit(100.0)).alias("aqi_expm1")))


# ---- climatology, horizon, joins (OP-42 .. OP-52) --------------------------------
def _requests(spark, sf_dir):
    return binding.requests(spark, sf_dir).withColumn("date", to_date_col("date"))


def forecast_horizon(spark, sf_dir):
    """OP-47 + OP-42 + OP-28 + OP-38: history and 30 future days per series,
    day-of-year weather climatology joined on (series, doy), remaining gaps
    forward- then backward-filled, seasonal flag."""
    fi = binding.forecast_input(spark, sf_dir)
    horizon = joins.future_horizon(fi.withColumnRenamed("date", "ds"), 30, date="ds")
    clim = climatology.doy_climatology(fi, ["temperature", "wind_speed"], date="date")
    out = climatology.join_doy_climatology(horizon, clim, ["temperature", "wind_speed"], date="ds")
    out = ts.fill_forward_backward(out, ["temperature", "wind_speed"], date="ds")
    return finish(out.withColumn("is_stubble_burning", cal.season_flag("ds")))


def climatology_fallback(spark, sf_dir):
    """OP-43: weather climatology for requested dates, a day of year absent
    from the series' history falling back to day 365."""
    fi = binding.forecast_input(spark, sf_dir)
    clim = climatology.doy_climatology(fi, ["temperature", "wind_speed"], date="date")
    req = _requests(spark, sf_dir)
    out = climatology.join_doy_climatology(req, clim, ["temperature", "wind_speed"], date="date",
                                           fallback_doy=climatology.FALLBACK_DOY)
    return finish(out.select("request_id", "series_key", "date", "temperature", "wind_speed"))


def climatology_features(spark, sf_dir):
    """OP-50 + OP-51: synthesised feature vector for requested dates from
    (month, day) -> month -> series means by group presence, then the
    all-series mean, then 0; weather made safe with fixed defaults."""
    f = engineer_features(obs(spark, sf_dir), training=False)
    calendar = climatology.closed_calendar(f, FEATURES, raw=tuple(WEATHER_COLS))
    out = calendar.lookup(_requests(spark, sf_dir))
    out = climatology.weather_with_defaults(out)
    return finish(out.select("request_id", "series_key", "date", "clim_level", *FEATURES))


def climatology_trend(spark, sf_dir):
    """OP-52: seven climatological trend points before each requested date."""
    calendar = climatology.closed_calendar(obs(spark, sf_dir), [], trend="AQI")
    out = climatology.climatology_trend(_requests(spark, sf_dir), calendar)
    return finish(out.select("request_id", "offset", "trend_date", "trend_aqi"))


def month_stats(spark, sf_dir):
    return finish(distribution.month_stats(obs(spark, sf_dir)))


def month_trend_slope(spark, sf_dir):
    s = distribution.month_trend_slope(obs(spark, sf_dir))
    return finish(s.withColumn("trend_label", trend_label("trend_slope")))


def month_pdf(spark, sf_dir):
    st = distribution.month_stats(obs(spark, sf_dir))
    pts = distribution.normal_pdf_points(st)
    return finish(pts.select("series_key", "month", F.col("i").cast("int").alias("i"), "x", "y"))


def forecast_eval_join(spark, sf_dir):
    """OP-65 + OP-44 + OP-45: a day-of-year climatology forecast fitted on the
    part before the 90-day cut, kept only on dates present in the test part
    (semi join) and joined to the actual values."""
    fi = binding.forecast_input(spark, sf_dir).withColumnRenamed("date", "ds")
    part = splits.cutoff_split(fi, days=90, date="ds")
    train = part.where(F.col("split") == "train")
    test = part.where(F.col("split") == "test").select("series_key", "ds", F.col("aqi").alias("y"))
    clim = climatology.doy_climatology(train.withColumnRenamed("ds", "date"), ["aqi"], date="date")
    fut = joins.future_horizon(train, 30, date="ds", include_history=False)
    fc = climatology.join_doy_climatology(fut, clim, ["aqi"], date="ds").withColumnRenamed("aqi", "yhat")
    fc = joins.semi_filter(fc, test, ["series_key", "ds"])
    return finish(joins.inner_join(test, fc, ["series_key", "ds"]))


# ---- splits (OP-63 .. OP-66) -------------------------------------------------------
def split_fraction(spark, sf_dir):
    return split_table(spark, sf_dir).select("series_key", "Date", "split")


def split_cutoff(spark, sf_dir):
    return splits.cutoff_split(training_table(spark, sf_dir), days=180).select("series_key", "Date", "split")


def split_summary(spark, sf_dir):
    return splits.split_summary(split_table(spark, sf_dir))


def split_stratified(spark, sf_dir):
    t = training_table(spark, sf_dir)
    return splits.stratified_split(t, LABEL).select("series_key", "Date", LABEL, "split")


# ---- metrics, weights (OP-56 .. OP-61) ----------------------------------------------
def _scored(spark, sf_dir):
    """Split table with a model-free prediction (yesterday's EWM) and its
    category, the stand-in predictor for metric queries."""
    t = split_table(spark, sf_dir)
    return t.withColumns({"predicted": F.col("AQI_ewma_7"),
                          "predicted_cat": aqi_category(F.col("AQI_ewma_7"))})


def regression_metrics(spark, sf_dir):
    return finish(metrics.regression_metrics(_scored(spark, sf_dir), "AQI", "predicted", ["split"]))


def confusion_matrix(spark, sf_dir):
    test = _scored(spark, sf_dir).where(F.col("split") == "test")
    return metrics.confusion_matrix(test, LABEL, "predicted_cat")


def classification_report(spark, sf_dir):
    from smogcast.functions.categories import CATEGORY_NAMES
    test = _scored(spark, sf_dir).where(F.col("split") == "test")
    return finish(metrics.classification_report(test, LABEL, "predicted_cat", CATEGORY_NAMES))


def f1_summary(spark, sf_dir):
    return finish(metrics.f1_summary(_scored(spark, sf_dir).where(F.col("split") == "test"),
                                     LABEL, "predicted_cat"))


def class_weights(spark, sf_dir):
    return finish(wts.class_weights(split_table(spark, sf_dir).where(F.col("split") == "train"), LABEL))


def sample_weights(spark, sf_dir):
    t = _scored(spark, sf_dir).where(F.col("split") == "train")
    return finish(t.select("series_key", "Date", F.col(LABEL).alias("actual"),
                           F.col("predicted_cat").alias("predicted"),
                           wts.sample_weight(LABEL, "predicted_cat").alias("weight")))


# ---- probabilities and thresholds (OP-35, OP-40, OP-48, OP-62) ------------------------
def _prob_table(spark, sf_dir):
    t = split_table(spark, sf_dir)
    return t.withColumn("probs", th.distance_probabilities(F.col("AQI_lag_1")))


def argmax_label(spark, sf_dir):
    t = _prob_table(spark, sf_dir)
    return finish(t.select("series_key", "Date", *[F.col("probs")[i].alias(f"p{i}") for i in range(6)],
                           argmax_index("probs").alias("argmax"),
                           alarm("AQI_lag_1").alias("alarm_lag_poor")))


def _tuned(spark, sf_dir):
    return th.tune_thresholds(_prob_table(spark, sf_dir).where(F.col("split") == "val"), "probs", LABEL)


def threshold_tune(spark, sf_dir):
    return finish(_tuned(spark, sf_dir))


def threshold_tune_single(spark, sf_dir):
    """OP-62, single-boundary form: Moderate/Poor only, grid 0.1..0.9, tuned
    on the training part (the earlier job's variant)."""
    t = _prob_table(spark, sf_dir).where(F.col("split") == "train")
    return finish(th.tune_thresholds(t, "probs", LABEL, boundaries=[(2, 3)], start=0.1, stop=0.9, num=90))


def threshold_apply(spark, sf_dir):
    """Thresholds tuned on the validation part (four rows, collected) applied
    in order to the test part."""
    # tuning and application read the same probability table: compute it once
    probs = _prob_table(spark, sf_dir).transform(materialize)
    tuned = th.collect_thresholds(th.tune_thresholds(probs.where(F.col("split") == "val"), "probs", LABEL))
    test = probs.where(F.col("split") == "test")
    out = th.apply_thresholds(test.withColumn("argmax", argmax_index("probs")), "probs", tuned)
    return out.select("series_key", "Date", "argmax", "predicted")


# ---- scaling, voting (OP-72, OP-73, OP-76) -----------------------------------------
SCALE_COLS = ["AQI", "AQI_lag_1", "temp", "windspeed"]


def minmax_scale(spark, sf_dir):
    from smogcast.ml.scaling import fit_minmax, inverse_minmax, transform_minmax
    t = split_table(spark, sf_dir)
    stats = fit_minmax(t.where(F.col("split") == "train"), SCALE_COLS, key="series_key")
    out = transform_minmax(t, stats, SCALE_COLS, key="series_key")
    out = inverse_minmax(out, stats, "AQI_scaled", "AQI", "AQI_restored", key="series_key")
    return finish(out.select("series_key", "Date", "split", *[f"{c}_scaled" for c in SCALE_COLS],
                             "AQI_restored"))


def voting_mean(spark, sf_dir):
    """Unweighted mean of member predictions on the log scale, back-transformed,
    then the two stage-2 alarm features."""
    from smogcast.ml.stage1 import voting_column
    t = training_table(spark, sf_dir)
    members = ["AQI_lag_1", "AQI_roll_mean_7", "AQI_ewma_7"]
    t = t.withColumn("Predicted_AQI", exp_target(voting_column([log_target(m) for m in members])))
    return finish(t.select("series_key", "Date", "Predicted_AQI",
                           alarm("Predicted_AQI").alias("alarm_predicted_poor"),
                           alarm("AQI_lag_1").alias("alarm_lag_poor")))


# ---- models (rows-only: no SQL oracle) ----------------------------------------------
def _fit_frame(spark, sf_dir):
    """Split feature table with the log target, checkpointed: every model
    query fits several passes over it."""
    from smogcast.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    return split_table(spark, sf_dir).withColumn("__ylog", log_target(F.col("AQI"))).transform(materialize)


def _boosted_output(spark, sf_dir, cfg):
    """A member fitted on the training part at its published size, applied to all rows."""
    from smogcast.ml.boosting import fit_boosted
    f = _fit_frame(spark, sf_dir)
    m = fit_boosted(f.where(F.col("split") == "train"), FEATURES, "__ylog", cfg)
    return f.select("series_key", "Date", "split", "AQI", exp_target(m.score()).alias("predicted"))


def gbt_regression(spark, sf_dir):
    """OP-69: 1000 rounds of squared loss."""
    from smogcast.ml.stage1 import GBT
    return _boosted_output(spark, sf_dir, GBT)


def ridge_regression(spark, sf_dir):
    from smogcast.ml.stage1 import fit_ridge
    f = _fit_frame(spark, sf_dir)
    m = fit_ridge(f.where(F.col("split") == "train"), FEATURES, "__ylog", alpha=10.0)
    return m.transform(f).select("series_key", "Date", "split", "AQI", exp_target(F.col("pred_ridge")).alias("predicted"))


def asymmetric_boost(spark, sf_dir):
    """OP-70: 1000 rounds of the asymmetric loss."""
    from smogcast.ml.stage1 import ASYMMETRIC
    return _boosted_output(spark, sf_dir, ASYMMETRIC)


def _class_probs(spark, sf_dir, kind):
    """Class probabilities of all rows by a classifier fitted on the weighted training part."""
    from smogcast.ml.boosting import fit_boosted
    from smogcast.ml.stage2 import BOOSTED, STAGE2_EXTRA, add_stage2_features, fit_forest
    from smogcast.plans.training import stage2_probs
    f = add_stage2_features(_fit_frame(spark, sf_dir).withColumn("Predicted_AQI", F.col("AQI_ewma_7")))
    tr = f.where(F.col("split") == "train")
    w = wts.attach_class_weight(tr, LABEL, wts.class_weights(tr, LABEL))
    if kind == "boosted":
        m = fit_boosted(w, FEATURES + STAGE2_EXTRA, LABEL, BOOSTED, "weight")
    else:
        m = fit_forest(w, FEATURES + STAGE2_EXTRA, LABEL, "weight", trees=300)
    return stage2_probs(m, f).transform(materialize)


def _test_probs(p):
    return p.where(F.col("split") == "test").select(
        "series_key", "Date", LABEL, *[F.col("probs")[i].alias(f"p{i}") for i in range(6)], argmax_index("probs").alias("argmax"))


def stage2_classifier(spark, sf_dir):
    """OP-74, forest: 300 weighted trees; test-part probabilities and argmax."""
    return _test_probs(_class_probs(spark, sf_dir, "forest"))


def stage2_boosted(spark, sf_dir):
    """OP-74: 500 rounds of weighted softmax boosting over all six classes; test-part probabilities and argmax."""
    return _test_probs(_class_probs(spark, sf_dir, "boosted"))


def isotonic_calibration(spark, sf_dir):
    """OP-75: the boosted classifier's probabilities calibrated on the validation part; test part."""
    from smogcast.ml.isotonic import IsotonicCalibrator
    p = _class_probs(spark, sf_dir, "boosted")
    cal = IsotonicCalibrator.fit(p.where(F.col("split") == "val"), "probs", LABEL)
    out = cal.transform(p.where(F.col("split") == "test"), "probs", "cal_probs")
    return out.select("series_key", "Date", LABEL, *[F.col("cal_probs")[i].alias(f"c{i}") for i in range(6)])


def feature_importance(spark, sf_dir):
    from smogcast.ml.boosting import fit_boosted
    from smogcast.ml.stage1 import GBT
    from smogcast.ml.stage2 import feature_importance as fi
    f = _fit_frame(spark, sf_dir)
    m = fit_boosted(f.where(F.col("split") == "train"), FEATURES, "__ylog", GBT)
    return fi(spark, m.importance(), FEATURES, top=10)


def _train(spark, sf_dir, cfg=None):
    from smogcast.plans.training import TrainConfig, train_two_stage
    return train_two_stage(training_table(spark, sf_dir), cfg or TrainConfig())


def two_stage_train(spark, sf_dir):
    res = _train(spark, sf_dir)
    return res.scored.where(F.col("split") == "test").select(
        "series_key", "Date", "AQI", LABEL, "Predicted_AQI", "alarm_predicted_poor", "alarm_lag_poor",
        "predicted")


def _forecaster_input(spark, sf_dir):
    """The forecaster's rows and events. Preparation: rename to (ds, y) (OP-07), interpolate y
    by position (OP-27), drop rows with NULL ds/y (OP-10), event flag (OP-49)."""
    fi = cleaning.rename(binding.forecast_input(spark, sf_dir), {"date": "ds", "aqi": "y"})
    fi = cleaning.drop_any_null(ts.interpolate_linear(fi, "y", date="ds"), subset=["ds", "y"])
    events = joins.peak_day_events(fi, value="y", date="ds")
    return joins.flag_near_events(fi, events, date="ds"), events


def seasonal_forecast(spark, sf_dir):
    """OP-77: fit on the part before the 90-day cut; forecast history plus 30
    days with day-of-year weather climatology; output the forecast columns."""
    from smogcast.ml.forecast import SeasonalForecaster
    fi, events = _forecaster_input(spark, sf_dir)
    part = splits.cutoff_split(fi, days=90, date="ds")
    train = part.where(F.col("split") == "train").drop("split")
    model = SeasonalForecaster().fit(train)
    horizon = joins.future_horizon(train, 30, date="ds")
    clim = climatology.doy_climatology(train.withColumnRenamed("ds", "date"), ["temperature", "wind_speed"],
                                       date="date")
    fut = climatology.join_doy_climatology(horizon, clim, ["temperature", "wind_speed"], date="ds")
    fut = ts.fill_forward_backward(fut, ["temperature", "wind_speed"], date="ds")
    fut = joins.flag_near_events(fut.withColumn("is_stubble_burning", cal.season_flag("ds")),
                                 events, date="ds")
    out = model.transform(fut)
    return out.select("series_key", "ds", "yhat", "yhat_lower", "yhat_upper", "trend", "aqi_category")


def forecast_dates(spark, sf_dir):
    """OP-78: forecasts for arbitrary requested dates with expected weather
    from the day-of-year climatology (fallback day 365), clipped to [0, 500].
    Every request gets a row; ``status`` tells why one has no forecast."""
    from smogcast.ml.forecast import SeasonalForecaster
    fi, events = _forecaster_input(spark, sf_dir)
    model = SeasonalForecaster().fit(fi)
    clim = climatology.doy_climatology(fi.withColumnRenamed("ds", "date"), ["temperature", "wind_speed"],
                                       date="date")
    req = _requests(spark, sf_dir).withColumnRenamed("date", "ds")
    req = climatology.join_doy_climatology(req, clim, ["temperature", "wind_speed"], date="ds",
                                           fallback_doy=climatology.FALLBACK_DOY)
    req = joins.flag_near_events(req.withColumn("is_stubble_burning", cal.season_flag("ds")),
                                 events, date="ds")
    out = model.transform(req)
    return out.select("request_id", "series_key", "ds", "status", "yhat", "yhat_lower", "yhat_upper", "aqi_category",
                      "temperature", "wind_speed", "is_stubble_burning")


def score_requests(spark, sf_dir):
    """OP-81 (+OP-05): responses for every order date (present in the data)
    and every event date (absent: climatology path)."""
    from smogcast.plans.scoring import score_requests as score
    from smogcast.plans.training import train_two_stage
    o = obs(spark, sf_dir).transform(materialize)  # series x days: for the features and every lookup
    res = train_two_stage(engineer_features(o, training=True))
    return score(binding.all_requests(spark, sf_dir), o, res.model)


def score_lookup(spark, sf_dir):
    """The SQL-checkable lookup part of OP-81: status, whether the date is in
    the data, the actual value and the month statistics of each request."""
    from smogcast.plans.scoring import parse_requests, with_series_status
    req = with_series_status(parse_requests(binding.all_requests(spark, sf_dir)), obs(spark, sf_dir))
    o = obs(spark, sf_dir).select("series_key", F.col("Date").alias("req_date"), F.col("AQI").alias("actual_aqi"),
                                  F.lit(True).alias("__there"))
    out = req.join(o, ["series_key", "req_date"], "left").withColumn("month", F.month("req_date"))
    st = distribution.month_stats(obs(spark, sf_dir)).select("series_key", "month", "mean", "median", "std_dev")
    out = out.join(st, ["series_key", "month"], "left")
    return finish(out.select("request_id", "series_key", F.col("date_text").alias("date"), "status",
                             F.when(F.col("status") == "ok", F.col("__there").isNull()).alias("is_future"), "actual_aqi",
                             "mean", "median", "std_dev"))


def feature_table_chunked(spark, sf_dir):
    """The flagship feature table computed in halo chunks of 200 rows per
    series (exactness check of the long-series path: same oracle)."""
    return finish(engineer_features(obs(spark, sf_dir), training=True, chunk_rows=200))


def two_stage_stratified(spark, sf_dir):
    """The earlier two-stage job: one boosted regressor, stratified 15 % split, boosted class
    weights, no calibration, Moderate/Poor threshold tuned on the training
    part over 0.1..0.9; test predictions."""
    from smogcast.plans.training import TrainConfig, train_two_stage
    from smogcast.ml.stage1 import GBT_STRATIFIED
    from smogcast.ml.stage2 import BOOSTED_STRATIFIED
    cfg = TrainConfig(gbt=GBT_STRATIFIED, members=("gbt",), boosted=BOOSTED_STRATIFIED, split_kind="stratified",
                      weight_kind="weight_boosted", calibrate=False, tune_on="train",
                      tune_boundaries=((2, 3),), tune_start=0.1, tune_stop=0.9)
    res = train_two_stage(training_table(spark, sf_dir), cfg)
    return res.scored.where(F.col("split") == "test").select("series_key", "Date", LABEL, "predicted")


def ensemble_fixed_threshold(spark, sf_dir):
    """The ensemble experiment: two boosted regressors of squared loss and ridge, stratified split, boosted class weights, fixed
    Moderate/Poor threshold 0.585; accuracy, macro-F1 and weighted-F1 over
    the union of true and predicted labels (OP-59) on the test part."""
    from smogcast.plans.training import TrainConfig, train_two_stage
    from smogcast.ml.stage2 import BOOSTED_ENSEMBLE
    cfg = TrainConfig(members=("gbt", "gbt2", "ridge"), boosted=BOOSTED_ENSEMBLE,
                      split_kind="stratified", weight_kind="weight_boosted", calibrate=False,
                      fixed_thresholds=((2, 3, th.FIXED_MODERATE_POOR),))
    res = train_two_stage(training_table(spark, sf_dir), cfg)
    return metrics.f1_summary(res.scored.where(F.col("split") == "test"), LABEL, "predicted")


LSTM_FEATURES = ["AQI_lag_1", "AQI_roll_mean_7", "AQI_ewma_7", "AQI_diff_1"] + WEATHER_COLS


def scaled_sequences(spark, sf_dir):
    """The sequence model's data preparation (OP-65 + OP-76 + OP-30): the
    input columns (leak-shifted), rows with NULLs dropped, last 180 days per
    series as test, min-max scaling of features and target fitted on the
    training part, then 7-step sequences built inside each part separately."""
    from smogcast.ml.scaling import fit_minmax, transform_minmax
    f = engineer_features(obs(spark, sf_dir), training=False).select("series_key", "Date", "AQI", *LSTM_FEATURES)
    f = splits.cutoff_split(cleaning.drop_any_null(f), days=180)
    cols = ["AQI"] + LSTM_FEATURES
    st = fit_minmax(f.where(F.col("split") == "train"), cols, key="series_key")
    scaled = transform_minmax(f, st, cols, key="series_key")
    seq = ts.sequence_windows(scaled, [f"{c}_scaled" for c in LSTM_FEATURES], "AQI_scaled", steps=7,
                              key=["series_key", "split"])
    out = seq.select("series_key", "split", "Date", "target", F.posexplode("sequence").alias("pos", "x"))
    return finish(out.select("series_key", "split", "Date", (F.col("pos") + 1).cast("int").alias("step"),
                             F.col("target").alias("target_scaled"),
                             *[F.col("x")[i].alias(f"f_{c}") for i, c in enumerate(LSTM_FEATURES)]))


def split_global(spark, sf_dir):
    """OP-64 global form: one 70/15/15 cut over all rows ordered by date."""
    t = splits.global_chronological_split(training_table(spark, sf_dir))
    return t.select("series_key", "Date", "split")


def ordered_positions(spark, sf_dir):
    """OP-67: every observation's place in one order by date, then series."""
    from smogcast.sources.sinks import with_position
    o = obs(spark, sf_dir).select("series_key", "Date", "AQI")
    return finish(with_position(o, ["Date", "series_key"]))


def forecast_csv(spark, sf_dir):
    """OP-03: a climatological 30-day forecast (mean, lowest and highest value of each day of year) written as CSV,
    one folder a series in order of date, and read again."""
    import uuid

    from smogcast.session import ensure_checkpoint_dir
    from smogcast.sources.sinks import FORECAST_COLUMNS, read_forecast_csv, write_forecast_csv
    fi = binding.forecast_input(spark, sf_dir)
    clim = fi.groupBy("series_key", F.dayofyear("date").alias("dayofyear")).agg(
        F.avg("aqi").alias("yhat"), F.min("aqi").alias("yhat_lower"), F.max("aqi").alias("yhat_upper"))
    days = joins.future_horizon(fi.withColumnRenamed("date", "ds"), 30, date="ds", include_history=False).select("series_key", "ds")
    fc = climatology.join_doy_climatology(days, clim, ["yhat", "yhat_lower", "yhat_upper"], date="ds")
    slope = distribution.month_trend_slope(obs(spark, sf_dir), by_month=False).select("series_key", F.col("trend_slope").alias("trend"))
    fc = with_category_info(fc.join(slope, "series_key", "left").withColumn("code", aqi_category("yhat")), "code")
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/forecast-{uuid.uuid4().hex}"
    write_forecast_csv(fc.withColumn("aqi_category", F.col("category_name")), path)
    return finish(read_forecast_csv(spark, path).select("series_key", *FORECAST_COLUMNS))
