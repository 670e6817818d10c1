"""Batch jobs: each stage reads what an earlier one wrote and writes Parquet.

    spark-submit --py-files ledgerline.zip -m ledgerline.plans.jobs all RAW_CSV OUTPUT_DIR

The files between the stages keep a costly result from being computed again by every consumer and
let a stage be repeated after a failure. Running a stage twice gives the same tables.
"""

from __future__ import annotations

import argparse

from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.operators import baskets, cleaning, dimensions, features, forecasting, kpis, normalize, segmentation, timebins
from ledgerline.operators.cleaning_audit import clean_observed
from ledgerline.plans import reports
from ledgerline.session import get_session
from ledgerline.sources.files import read_parquet, read_raw_csv, write_csv, write_parquet


DIMENSIONS = {"customers": dimensions.CUSTOMERS, "products": dimensions.PRODUCTS, "orders": dimensions.ORDERS}


def _path(output: str, *parts: str) -> str:
    return "/".join([output.rstrip("/"), *parts])


def clean(spark: SparkSession, raw_csv: str, output: str) -> None:
    """The raw file is read once: the figures of the reports come from the job that writes the clean table."""
    cleaned, audit = clean_observed(read_raw_csv(spark, raw_csv))
    write_parquet(cleaned, _path(output, "clean"))
    stored = read_parquet(spark, _path(output, "clean"), produced_by="clean")
    write_parquet(reports.observed_cleaning_report(audit, cleaning.iqr_fences(stored, precount=False)), _path(output, "reports", "cleaning"))
    changed = audit.conversions().where("type_before <> type_after")
    write_parquet(changed.select("column_name", "type_before", "type_after"), _path(output, "reports", "conversions"))
    write_parquet(audit.conversions(), _path(output, "reports", "parsing"))


def normalize_tables(spark: SparkSession, output: str) -> None:
    """Parents are replaced before the tables that refer to them."""
    lines = read_parquet(spark, _path(output, "clean"), produced_by="clean")
    write_parquet(normalize.with_load_time(normalize.customers(lines)), _path(output, "tables", "customers"))
    write_parquet(normalize.products(lines), _path(output, "tables", "products"))
    write_parquet(normalize.order_headers(lines), _path(output, "tables", "orders"))
    write_parquet(
        normalize.number_items(normalize.order_items(lines)), _path(output, "tables", "order_items")
    )


def add_lines(spark: SparkSession, lines: DataFrame, output: str) -> None:
    """Merge a batch of clean lines into the stored dimensions; neither earlier lines nor untouched parts are read or written.

    Repeating a batch changes nothing, and batches may come in any order.
    """
    for name, dimension in DIMENSIONS.items():
        dimensions.update(lines, dimension, _path(output, "states", name))


def dimension(spark: SparkSession, output: str, name: str) -> DataFrame:
    """One of the dimensions that ``add_lines`` keeps."""
    state = read_parquet(spark, _path(output, "states", name), produced_by="add_lines")
    return dimensions.rows_of(state, DIMENSIONS[name])


def summary_view(spark: SparkSession, output: str, name: str = "order_summary") -> DataFrame:
    """The joined view over the stored tables, also registered in the session for SQL."""
    tables = {
        t: read_parquet(spark, _path(output, "tables", t), produced_by="normalize")
        for t in ("order_items", "orders", "customers", "products")
    }
    view = normalize.order_summary(
        tables["order_items"], tables["orders"], tables["customers"].drop("created_at"), tables["products"]
    )
    view.createOrReplaceTempView(name)
    return view


def build_features(spark: SparkSession, output: str) -> None:
    table = features.feature_table(summary_view(spark, output))
    write_parquet(table, _path(output, "features"), partition_by=["order_year"])


def _features(spark: SparkSession, output: str) -> DataFrame:
    return read_parquet(spark, _path(output, "features"), produced_by="features")


def report_kpis(spark: SparkSession, output: str) -> None:
    table = _features(spark, output)
    write_csv(timebins.monthly_trend(table).orderBy("order_date"), _path(output, "reports", "monthly_trend"))
    write_csv(kpis.top_products(table), _path(output, "reports", "top_products"))
    write_parquet(kpis.sales_heatmap(table), _path(output, "reports", "sales_heatmap"))
    write_parquet(reports.kpi_report(table), _path(output, "reports", "kpis"))


def explore(spark: SparkSession, output: str) -> None:
    write_parquet(reports.eda_report(_features(spark, output)), _path(output, "reports", "eda"))


def segment(spark: SparkSession, output: str, clusters=segmentation.CLUSTER_RANGE, starts: int = segmentation.STARTS) -> None:
    rows = segmentation.rfm(_features(spark, output))
    write_parquet(segmentation.fit_scaling(rows), _path(output, "models", "scaling"))
    scaling = read_parquet(spark, _path(output, "models", "scaling"), produced_by="segment")
    scaled = segmentation.scale(rows, scaling)
    fits = segmentation.sweep_clusters(scaled, clusters, starts)
    best = max(fits, key=lambda f: f.silhouette)
    labelled = segmentation.label_customers(segmentation.assign_clusters(rows, scaled, best.model))
    write_parquet(labelled, _path(output, "segments"))
    stored = read_parquet(spark, _path(output, "segments"), produced_by="segment")
    report = reports.segment_report(segmentation.segment_sizes(stored), segmentation.sweep_table(scaled, fits))
    write_parquet(report, _path(output, "reports", "segments"))
    best.model.write().overwrite().save(_path(output, "models", "segments"))


def score(spark: SparkSession, output: str, customers: DataFrame) -> DataFrame:
    """Customers (customer_id, recency_days, frequency, monetary) with the cluster the stored scaling and model give them."""
    scaling = read_parquet(spark, _path(output, "models", "scaling"), produced_by="segment")
    return segmentation.score_customers(customers, scaling, KMeansModel.load(_path(output, "models", "segments")))


def recommend(
    spark: SparkSession, output: str, item: str = "product_id",
    min_support: float = baskets.MIN_SUPPORT, min_lift: float = baskets.MIN_LIFT,
) -> None:
    table = _features(spark, output)
    rules = baskets.association_rules(table, item, min_support, min_lift)
    write_parquet(rules, _path(output, "rules"))
    stored = read_parquet(spark, _path(output, "rules"), produced_by="recommend")
    write_csv(baskets.sort_rules(stored), _path(output, "reports", "association_rules"))
    write_parquet(
        baskets.recommendation_lists(baskets.recommendations(stored)), _path(output, "recommendations")
    )
    report = reports.rule_report(stored, baskets.basket_items(table, item), baskets.item_names(table, item))
    write_parquet(report, _path(output, "reports", "rules"))


def forecast(spark: SparkSession, output: str, models=forecasting.MODELS) -> None:
    weekly = timebins.weekly_sales(_features(spark, output))
    write_parquet(timebins.chronological_split(timebins.add_week_features(weekly)), _path(output, "weekly"))
    split = read_parquet(spark, _path(output, "weekly"), produced_by="forecast")
    fitted = forecasting.fit_models(split, models)
    predictions = forecasting.predict(split, fitted)
    write_parquet(
        forecasting.actual_vs_predicted(predictions, list(fitted)), _path(output, "reports", "actual_vs_predicted")
    )
    write_parquet(forecasting.compare_models(forecasting.error_metrics(predictions)), _path(output, "reports", "models"))
    compared = read_parquet(spark, _path(output, "reports", "models"), produced_by="forecast")
    write_parquet(
        reports.forecast_report(compared, timebins.split_bounds(split)), _path(output, "reports", "forecast")
    )
    winner = compared.where(F.col("is_best")).select("model").first()["model"]
    fitted[winner].write().overwrite().save(_path(output, "models", "forecast"))


STAGES = {
    "normalize": normalize_tables, "features": build_features, "kpis": report_kpis, "explore": explore,
    "segment": segment, "recommend": recommend, "forecast": forecast,
}


def run_all(spark: SparkSession, raw_csv: str, output: str) -> None:
    clean(spark, raw_csv, output)
    for stage in STAGES.values():
        stage(spark, output)


def main() -> None:
    parser = argparse.ArgumentParser(description="Run one stage, or all, of the order-line jobs.")
    parser.add_argument("stage", choices=["all", "clean", *STAGES])
    parser.add_argument("paths", nargs="+", help="OUTPUT_DIR, preceded by RAW_CSV for 'all' and 'clean'")
    arguments = parser.parse_args()
    spark = get_session(f"ledgerline-{arguments.stage}")
    if arguments.stage == "all":
        run_all(spark, *arguments.paths)
    elif arguments.stage == "clean":
        clean(spark, *arguments.paths)
    else:
        STAGES[arguments.stage](spark, *arguments.paths)


if __name__ == "__main__":
    main()
