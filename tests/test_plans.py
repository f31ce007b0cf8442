"""Physical-plan properties: keyed windows, pruned scans, no cartesian products."""

from smogcast.plans import catalog
from tests.conftest import SF_SMALL


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_feature_plan_is_keyed_and_single_window_pass(spark):
    df = catalog.training_table(spark, SF_SMALL)
    p = plan_text(df)
    assert "SinglePartition" not in p
    assert "hashpartitioning(series_key" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_scans_read_only_needed_columns(spark):
    df = catalog.daily_series(spark, SF_SMALL)
    p = plan_text(df)
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>" in p


def test_no_cartesian_products_anywhere(spark):
    from smogcast.plans.registry import QUERIES
    skip = {"gbt_regression", "asymmetric_boost", "ridge_regression", "stage2_classifier", "isotonic_calibration",
            "feature_importance", "two_stage_train", "seasonal_forecast", "forecast_dates", "score_requests",
            "stage2_boosted", "two_stage_stratified", "ensemble_fixed_threshold"}
    for name, fn in QUERIES.items():
        if name in skip:
            continue
        p = plan_text(fn(spark, SF_SMALL))
        assert "CartesianProduct" not in p, name
        assert "BroadcastNestedLoopJoin" not in p, name


def test_threshold_tuning_has_no_grid_product(spark):
    p = optimized(catalog.threshold_tune(spark, SF_SMALL))
    assert "Join Cross" not in p and "CartesianProduct" not in p
