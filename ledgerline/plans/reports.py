"""Report figures as (section, metric, value) rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.functions import calendar as cal
from ledgerline.operators import baskets, cleaning, kpis, statistics, timebins
from ledgerline.operators.cleaning_audit import CleaningAudit
from ledgerline.operators.stored import stored_table


def section(df: DataFrame, name: str, metric: str | Column, value: str | Column) -> DataFrame:
    metric = F.col(metric) if isinstance(metric, str) else metric
    value = F.col(value) if isinstance(value, str) else value
    return df.select(
        F.lit(name).alias("section"), metric.cast("string").alias("metric"), value.cast("double").alias("value")
    )


def one_row_section(row: DataFrame, name: str, columns: list[str]) -> DataFrame:
    typed = row.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return section(typed.unpivot([], columns, "metric", "value"), name, "metric", "value")


def stack(sections: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, sections)


def kpi_report(lines: DataFrame, top: int = 10, months: int = 6) -> DataFrame:
    headline = kpis.headline(lines)
    regional = kpis.regional(lines)
    monthly = timebins.last_bins(timebins.monthly_trend(lines), "order_date", months)
    return stack(
        [
            one_row_section(headline, "headline", [c for c in headline.columns if c != "retention"]),
            section(monthly, "monthly sales", cal.month_label("order_date"), "total_sales"),
            section(regional, "regional sales", "region", "total_sales"),
            section(regional, "regional share", "region", "sales_share_pct"),
            section(kpis.top_products(lines, top), "top products", "product_id", "total_sales"),
        ]
    )


def cleaning_report(raw: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Figures of a cleaning run; outliers are searched in the stored clean table when there is one.

    Copies are removed once: the different rows are stored with their counts, and shape, rules and outliers read these.
    """
    counted = stored_table(cleaning.counted_copies(cleaning.fill_missing(raw)))
    typed = cleaning.convert_types(counted.drop("_copies"))
    if stored is None:
        clean = typed.transform(cleaning.repair_ship_dates).transform(cleaning.drop_invalid_amounts)
        fences = cleaning.iqr_fences(clean)
    else:
        fences = cleaning.iqr_fences(stored, precount=False)
    return stack(
        [
            one_row_section(cleaning.shape_of_counted(counted), "shape", ["rows_before", "copies_removed", "rows_after"]),
            section(cleaning.null_profile(raw), "missing", "column_name", "null_count"),
            section(cleaning.rule_violations(typed), "rules", "rule", "violations"),
            section(fences, "outliers", "metric", "outliers"),
        ]
    )


def observed_cleaning_report(audit: CleaningAudit, fences: DataFrame | None = None) -> DataFrame:
    """As ``cleaning_report``, from the figures that the run itself has taken."""
    found = [
        one_row_section(audit.shape(), "shape", ["rows_before", "copies_removed", "rows_after"]),
        section(audit.nulls(), "missing", "column_name", "null_count"),
        section(audit.rules(), "rules", "rule", "violations"),
    ]
    return stack(found if fences is None else [*found, section(fences, "outliers", "metric", "outliers")])


def eda_report(features: DataFrame) -> DataFrame:
    described = statistics.describe(features, precount=False)
    measures = [c for c in described.columns if c != "metric"]
    moments = statistics.shape_moments(features)
    matrix = statistics.correlation_matrix(features)
    monthly = timebins.monthly_bins(features, {"total_sales": F.sum("sales").cast("double")})
    return stack(
        [
            one_row_section(statistics.shape(features), "shape", ["row_count", "column_count"]),
            *[section(described, f"describe {m}", "metric", m) for m in measures],
            section(moments, "skewness", "metric", "skewness"),
            section(moments, "kurtosis", "metric", "kurtosis"),
            section(statistics.correlation_extremes(matrix), "correlation with sales", F.concat_ws(": ", "kind", "metric"), "value"),
            section(kpis.category_summary(features), "category sales", "category", "total_sales"),
            section(kpis.regional_share(features), "regional sales", "region", "total_sales"),
            section(timebins.peak_and_low(monthly), "extreme months", F.concat_ws(": ", "kind", "month"), "total_sales"),
        ]
    )


def segment_report(sizes: DataFrame, sweep: DataFrame | None = None) -> DataFrame:
    """Sizes and means of the segments, after the scores of the cluster counts where there was a choice."""
    scores = [section(sweep, "silhouette", F.concat(F.lit("k="), F.col("clusters").cast("string")), "silhouette")] if sweep else []
    return stack(
        [
            *scores,
            section(sizes, "customers", "segment", "customers"),
            section(sizes, "recency_days", "segment", "recency_days"),
            section(sizes, "frequency", "segment", "frequency"),
            section(sizes, "monetary", "segment", "monetary"),
        ]
    )


def rule_report(rules: DataFrame, items: DataFrame, names: DataFrame) -> DataFrame:
    evidence = baskets.rule_evidence(rules, items)
    top = baskets.top_rules(rules, names)
    return stack(
        [
            one_row_section(evidence, "evidence", evidence.columns),
            section(top, "lift", F.concat_ws(" + ", "name_a", "name_b"), "lift"),
        ]
    )


def forecast_report(metrics: DataFrame, bounds: DataFrame) -> DataFrame:
    """The split and the errors of every model; of compared models also the winner, with its error."""
    part = F.when(F.col("is_train"), F.lit("train weeks")).otherwise(F.lit("test weeks"))
    return stack(
        [
            section(bounds, "split", part, "weeks"),
            *[section(metrics, m, "model", m) for m in ("mae", "rmse", "r2")],
            *([section(metrics.where("is_best"), "winner by rmse", "model", "rmse")] if "is_best" in metrics.columns else []),
        ]
    )
