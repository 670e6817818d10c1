"""A cross-section of the queries against their SQL; ``tools/check_oracle.py`` runs all of them."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from check_oracle import compare, duck
from ledgerline.registry import queries as registry

SECTION = [
    "monthly_trend", "headline_kpis", "regional_kpis", "category_summary", "sales_heatmap", "feature_table",
    "customer_features", "order_features", "clean_table", "rule_violations", "iqr_outliers", "shape_audit",
    "dim_customers", "order_items", "order_summary_view", "audit_primary_keys", "audit_foreign_keys",
    "correlation_matrix", "histogram", "box_by_category", "bounded_sample", "rfm_scaled", "segment_labels",
    "association_rules", "recommendations", "rules_top10", "weekly_features", "series_trend_forecast", "forecast_metrics",
    "one_pass_cleaning_audit", "dim_customers_by_batches", "quantile_sketch_checks", "distinct_sketch_checks", "cluster_scores",
    "density_curve_binned", "category_profile", "itemsets",
]


@pytest.mark.parametrize("name", SECTION)
def test_query_equals_its_sql(spark, small, name):
    status, note = compare(spark, small, name, entry.queries()[name], entry.oracle_sql()[name], duck(small))
    assert status == "ok", note


def test_every_sql_has_a_query_and_only_models_lack_one():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    without = set(registry.QUERIES) - set(entry.oracle_sql())
    assert without == {
        "k_sweep", "k_sweep_by_summary", "kmeans_segments", "fitted_segment_report", "series_forecasts", "model_comparison",
        "actual_vs_predicted", "fitted_forecast_report",
    }


def test_entry(spark, small):
    assert entry.entry(spark).count() > 0
