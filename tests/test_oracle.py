"""Registered queries against their DuckDB oracle on the smallest data set."""

import pytest

from conftest import SF_SMALL
from oracle_compare import compare, duck

FAST = [
    "report_rollup", "name_clean_lookup", "name_recode_join", "dense_grid", "panel_lags",
    "persistence_forecast", "score_rows", "confusion_matrix", "class_metrics", "accuracy_by_slice",
    "case_regression_metrics", "daily_panel_lags", "control_flags", "neighbour_lag_sum",
    "ever_before_continent_given_taxa", "prepvar_gdp_per_capita", "nowcast_features",
    "thread_bounds", "thread_month_panel", "endemic_months", "import_pressure",
    "import_pressure_by_origin", "network_features", "scaling_stats", "network_predict",
    "calibration_bins", "variable_importance", "origin_import_risk", "status_predict",
    "impact_summary", "data_checks", "stratified_folds", "fixed_sample", "standardise", "network_covariates",
    "prediction_store", "variable_importance_current", "variable_importance_by_origin_current", "top_origins_current",
    "origin_import_risk_current", "variable_importance_by_origin", "top_origins", "origin_share_lumped", "priority_coefficients", "metric_report", "missing_lag_flags", "cases_filled_down", "lookup_csv_recode", "incomplete_predictions",
]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_SMALL, con, verbose=True)
    assert r["ok"], r.get("msg")


def test_every_query_has_a_docstring_and_runs_lazily():
    from __spark_entry__ import oracle_sql, queries

    q, o = queries(), oracle_sql()
    assert len(q) >= 70
    assert set(o) <= set(q)
    for name, fn in q.items():
        assert fn.__doc__, name


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() > 0
    assert {"slice", "slice_value", "model", "accuracy"} <= set(df.columns)
