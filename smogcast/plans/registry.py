"""Name -> query callable (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from smogcast.plans import catalog as c

QUERIES = {
    # sources and binding (OP-01, OP-02)
    "daily_series": c.daily_series,
    "weather_join": c.weather_join,
    # time-series windows (OP-17 .. OP-31)
    "lag_features": c.lag_features,
    "leak_shift": c.leak_shift,
    "diff_spike": c.diff_spike,
    "rolling_features": c.rolling_features,
    "ewm_feature": c.ewm_feature,
    "ewm_masked": c.ewm_masked,
    "leakage_audit": c.leakage_audit,
    "ventilation_features": c.ventilation_features,
    "interpolate_gaps": c.interpolate_gaps,
    "fill_gaps": c.fill_gaps,
    "preceding_context": c.preceding_context,
    "sequence_windows": c.sequence_windows,
    # scalars (OP-32 .. OP-41)
    "calendar_features": c.calendar_features,
    "event_flag": c.event_flag,
    "aqi_category": c.aqi_category_query,
    "clip_values": c.clip_values,
    "log_transform": c.log_transform,
    "safe_number": c.safe_number_query,
    # cleaning, feature pipeline (OP-09 .. OP-11, OP-79)
    "feature_table": c.feature_table,
    "clean_drop_fill": c.clean_drop_fill,
    # small helpers on their own (OP-07, 08, 10, 13, 16, 41)
    "rename_columns": c.rename_columns,
    "selected_features": c.selected_features,
    "drop_missing_days": c.drop_missing_days,
    "date_filter": c.date_filter,
    "row_slice": c.row_slice,
    "trend_text": c.trend_text,
}

QUERIES.update({
    # climatology, horizon, joins (OP-42 .. OP-52)
    "forecast_horizon": c.forecast_horizon,
    "climatology_fallback": c.climatology_fallback,
    "climatology_features": c.climatology_features,
    "climatology_trend": c.climatology_trend,
    "month_stats": c.month_stats,
    "month_trend_slope": c.month_trend_slope,
    "month_pdf": c.month_pdf,
    "forecast_eval_join": c.forecast_eval_join,
    # splits (OP-63 .. OP-66)
    "split_fraction": c.split_fraction,
    "split_cutoff": c.split_cutoff,
    "split_summary": c.split_summary,
    "split_stratified": c.split_stratified,
    # metrics and weights (OP-56 .. OP-61)
    "regression_metrics": c.regression_metrics,
    "confusion_matrix": c.confusion_matrix,
    "classification_report": c.classification_report,
    "f1_summary": c.f1_summary,
    "class_weights": c.class_weights,
    "sample_weights": c.sample_weights,
    # probabilities and thresholds (OP-35, OP-40, OP-48, OP-62)
    "argmax_label": c.argmax_label,
    "threshold_tune": c.threshold_tune,
    "threshold_apply": c.threshold_apply,
    # scaling and voting (OP-72, OP-73, OP-76)
    "minmax_scale": c.minmax_scale,
    "voting_mean": c.voting_mean,
})

QUERIES.update({
    # models (rows-only checks; properties in tests/)
    "gbt_regression": c.gbt_regression,
    "asymmetric_boost": c.asymmetric_boost,
    "ridge_regression": c.ridge_regression,
    "stage2_classifier": c.stage2_classifier,
    "isotonic_calibration": c.isotonic_calibration,
    "feature_importance": c.feature_importance,
    "two_stage_train": c.two_stage_train,
    "seasonal_forecast": c.seasonal_forecast,
    "forecast_dates": c.forecast_dates,
    # request scoring (OP-81, OP-05); the lookup part is SQL-checked
    "score_requests": c.score_requests,
    "score_lookup": c.score_lookup,
})

QUERIES["feature_table_chunked"] = c.feature_table_chunked
QUERIES["ordered_positions"] = c.ordered_positions
QUERIES["forecast_csv"] = c.forecast_csv
QUERIES["interpolate_gaps_chunked"] = c.interpolate_gaps_chunked
QUERIES["fill_gaps_chunked"] = c.fill_gaps_chunked

QUERIES.update({
    "threshold_tune_single": c.threshold_tune_single,
    "two_stage_stratified": c.two_stage_stratified,
    "ensemble_fixed_threshold": c.ensemble_fixed_threshold,
})

QUERIES["scaled_sequences"] = c.scaled_sequences
QUERIES["split_global"] = c.split_global
QUERIES["stage2_boosted"] = c.stage2_boosted
