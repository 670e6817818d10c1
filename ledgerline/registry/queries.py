"""Named queries over the test tables: each takes (spark, data directory) and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerline.functions import calendar as cal, keys
from ledgerline.functions.numbers import money_sum, ratio
from ledgerline.operators import (
    audits, baskets, cleaning, dimensions, features, forecasting, kpis, micro_clusters, normalize, segmentation, sketches,
    statistics, timebins,
)
from ledgerline.operators.cleaning_audit import clean_observed
from ledgerline.operators.stored import shared_folder, stored, stored_table
from ledgerline.plans import reports
from ledgerline.schemas import DESCRIBED_COLUMNS, ORDER_LINE_COLUMNS
from ledgerline.sources.retail import StarTables, inject_faults, order_lines

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query, name: str | None = None) -> Query:
    QUERIES[name or fn.__name__] = fn
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparison with other engines."""
    return df.select(
        *[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else f.name for f in df.schema]
    )


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def lines(spark: SparkSession, directory: str, columns: Iterable[str] = ORDER_LINE_COLUMNS) -> DataFrame:
    return order_lines(StarTables(spark, directory), columns)


def dirty(spark: SparkSession, directory: str) -> DataFrame:
    return inject_faults(lines(spark, directory))


def explored(spark: SparkSession, directory: str, *columns: str) -> DataFrame:
    """Order lines with repaired ship dates, shipping and money features, and the asked columns only."""
    base = lines(spark, directory, {"order_date", "ship_date", "sales", "quantity", "discount", "profit", *columns})
    return (
        base.transform(cleaning.repair_ship_dates)
        .transform(features.add_shipping_features)
        .transform(features.add_financial_features)
    )


# Headline figures and trends


@query
def monthly_trend(spark, directory):
    return timebins.monthly_trend(lines(spark, directory, ["order_date", "order_id", "sales", "profit"]))


@query
def last_six_months(spark, directory):
    return timebins.last_bins(monthly_trend(spark, directory), "order_date", 6)


@query
def peak_and_low_month(spark, directory):
    base = lines(spark, directory, ["order_date", "sales"])
    return timebins.peak_and_low(timebins.monthly_bins(base, {"total_sales": money_sum("sales")}))


@query
def headline_kpis(spark, directory):
    return kpis.headline(lines(spark, directory, ["order_id", "customer_id", "sales", "profit"]))


@query
def top_products(spark, directory):
    return kpis.top_products(
        lines(spark, directory, ["product_id", "product_name", "category", "sales", "profit", "quantity"])
    )


@query
def top_products_by_name(spark, directory):
    return kpis.top_products_by_name(
        lines(spark, directory, ["product_name", "category", "sales", "order_date", "order_id"])
    )


@query
def regional_kpis(spark, directory):
    return kpis.regional(lines(spark, directory, ["region", "order_id", "sales", "profit"]))


@query
def regional_share(spark, directory):
    return kpis.regional_share(lines(spark, directory, ["region", "sales"]))


@query
def category_summary(spark, directory):
    return kpis.category_summary(explored(spark, directory, "category", "order_id"))


@query
def category_sales(spark, directory):
    return kpis.category_sales(lines(spark, directory, ["category", "sales"]))


@query
def sales_heatmap(spark, directory):
    return kpis.sales_heatmap(lines(spark, directory, ["category", "order_date", "sales"]))


@query
def date_range(spark, directory):
    return kpis.date_range(lines(spark, directory, ["order_date"]))


@query
def kpi_report(spark, directory):
    base = lines(
        spark, directory,
        ["order_id", "customer_id", "order_date", "region", "product_id", "product_name", "category", "sales", "profit", "quantity"],
    )
    return rounded(reports.kpi_report(base), 6, "value")


# Features


@query
def net_amounts(spark, directory):
    return plain(lines(spark, directory, ["order_id", "product_id", "quantity", "discount", "sales", "profit"]))


@query
def time_features(spark, directory):
    dated = features.add_time_features(lines(spark, directory, ["order_id", "product_id", "order_date"]))
    return dated.withColumns({"month_name": cal.month_name("order_date"), "month_label": cal.month_label("order_date")})


@query
def shipping_features(spark, directory):
    return explored(spark, directory, "order_id", "product_id").select(
        "order_id", "product_id", "order_date", "ship_date", "days_to_ship"
    )


@query
def financial_features(spark, directory):
    return explored(spark, directory, "order_id", "product_id").select(
        "order_id", "product_id", "unit_price", "profit_margin_pct", "discount_bucket"
    )


@query
def discount_buckets(spark, directory):
    return explored(spark, directory).groupBy("discount_bucket").agg(
        F.count("*").alias("line_count"), money_sum("sales").alias("total_sales")
    )


@query
def customer_features(spark, directory):
    base = lines(spark, directory, ["order_id", "product_id", "customer_id", "order_date", "sales"])
    return features.add_customer_features(base).drop("sales")


@query
def order_features(spark, directory):
    base = lines(spark, directory, ["order_id", "product_id", "sales", "order_date"])
    return plain(features.add_order_features(base).drop("sales", "order_date"))


def _clean_keyed(spark, directory):
    """Stored, so that the four tables read one clean table instead of computing it four times."""
    return stored_table(normalize.keyed(cleaning.clean(dirty(spark, directory))))


def summary(spark, directory, profiled: bool = False):
    clean = _clean_keyed(spark, directory)
    items, orders, keep = normalize.order_items(clean), normalize.order_headers(clean), None
    if profiled:
        orders, keep = features.profiled_orders(stored_table(orders), items), stored_table
    return normalize.order_summary(
        normalize.number_items(items), orders, normalize.customers(clean), normalize.products(clean), keep
    )


@query
def feature_table(spark, directory):
    """Over the joined view of the four tables, where an order has one customer and one date."""
    return plain(features.feature_table(summary(spark, directory, profiled=True)))


@query
def seasonal_weight(spark, directory):
    daily = lines(spark, directory, ["order_date", "sales"]).groupBy("order_date").agg(money_sum("sales").alias("total_sales"))
    weighted = plain(daily.withColumn("seasonal_weight", cal.seasonal_weight("order_date")))
    return weighted.withColumn("deseasonalized_sales", F.round(ratio("total_sales", "seasonal_weight"), 6))


@query
def business_keys(spark, directory):
    base = lines(spark, directory, ["order_id", "product_id", "customer_id"])
    return base.select(
        keys.business_key(F.col("order_id") + 1, keys.ORDER_KEY).alias("order_key"),
        keys.business_key(F.col("product_id") + 1, keys.PRODUCT_KEY).alias("product_key"),
        keys.business_key(F.col("customer_id") + 1, keys.CUSTOMER_KEY).alias("customer_key"),
    )


@query
def display_names(spark, directory):
    words = F.split("p_name", " ")
    return StarTables(spark, directory).table("part").select(
        F.col("p_partkey").alias("product_id"), keys.display_name(words[0], words[1]).alias("display_name")
    )


# Cleaning


@query
def dirty_lines(spark, directory):
    return plain(dirty(spark, directory))


@query
def null_profile(spark, directory):
    return cleaning.null_profile(dirty(spark, directory))


@query
def fill_missing(spark, directory):
    return plain(cleaning.fill_missing(dirty(spark, directory)))


@query
def fill_decisions(spark, directory):
    return cleaning.fill_decisions(dirty(spark, directory))


@query
def dedup_rows(spark, directory):
    return plain(cleaning.remove_copies(cleaning.fill_missing(dirty(spark, directory))))


@query
def convert_types(spark, directory):
    """From text, as a raw file delivers it."""
    text = dirty(spark, directory).select(*[F.col(c).cast("string").alias(c) for c in ORDER_LINE_COLUMNS])
    return cleaning.convert_types(text)


@query
def category_profile(spark, directory):
    return cleaning.category_profile(dirty(spark, directory))


@query
def conversion_report(spark, directory):
    text = dirty(spark, directory).select(*[F.col(c).cast("string").alias(c) for c in ORDER_LINE_COLUMNS])
    return cleaning.conversion_report(text)


@query
def rule_violations(spark, directory):
    return cleaning.rule_violations(cleaning.remove_copies(cleaning.fill_missing(dirty(spark, directory))))


@query
def repaired_ship_dates(spark, directory):
    base = lines(spark, directory, ["order_id", "product_id", "order_date", "ship_date"])
    return cleaning.repair_ship_dates(base)


@query
def clean_table(spark, directory):
    return plain(cleaning.clean(dirty(spark, directory)))


@query
def iqr_outliers(spark, directory):
    fences = cleaning.iqr_fences(cleaning.clean(dirty(spark, directory)))
    return rounded(fences, 6, "q1", "q3", "lower_bound", "upper_bound")


@query
def outlier_flags(spark, directory):
    flagged = cleaning.outlier_flags(cleaning.clean(dirty(spark, directory)))
    return plain(flagged.select("order_id", "product_id", "sales", "profit", "is_sales_outlier", "is_profit_outlier"))


@query
def shape_audit(spark, directory):
    return cleaning.shape_audit(dirty(spark, directory))


@query
def cleaning_report(spark, directory):
    return reports.cleaning_report(dirty(spark, directory))


@query
def one_pass_cleaning_audit(spark, directory):
    """All figures of a cleaning run over text, observed while its lines are computed once."""
    text = dirty(spark, directory).select(*[F.col(c).cast("string").alias(c) for c in ORDER_LINE_COLUMNS])
    fault = F.col("order_id").cast("long") % 50
    broken = text.withColumns(
        {
            "sales": F.when(fault == 7, F.lit("n/a")).when(fault == 8, F.concat(F.lit("-"), "sales")).otherwise(F.col("sales")),
            "quantity": F.when(fault == 9, F.lit("0")).otherwise(F.col("quantity")),
        }
    )
    cleaned, audit = clean_observed(broken)
    cleaned.write.format("noop").mode("overwrite").save()
    parsed = audit.conversions().select(F.lit("unparsed").alias("section"), F.col("column_name").alias("metric"), F.col("unparsed").cast("double").alias("value"))
    fills = reports.section(audit.fills(), "filled", "column_name", "filled_count")
    return reports.stack([reports.observed_cleaning_report(audit), fills, parsed])


# Normalized tables and audits


@query
def dim_customers(spark, directory):
    return normalize.customers(cleaning.clean(dirty(spark, directory)))


@query
def dim_products(spark, directory):
    return normalize.products(cleaning.clean(dirty(spark, directory)))


@query
def order_headers(spark, directory):
    return normalize.order_headers(cleaning.clean(dirty(spark, directory)))


@query
def order_items(spark, directory):
    return plain(normalize.number_items(normalize.order_items(cleaning.clean(dirty(spark, directory)))))


def _by_batches(spark, directory, dimension):
    """Three batches of months, in no order of time, merged into a stored state one after the other. A state is the same
    with copies of lines, so only the dimension's columns are cleaned and stored."""
    columns = dict.fromkeys([*dimension.needed, "customer_name", "order_date", "ship_date", "sales", "quantity", "discount"])
    faulty = inject_faults(lines(spark, directory, columns))
    clean = stored_table(cleaning.clean(faulty, copies=True).select(*dimension.needed))
    path = f"{shared_folder(spark)}/dimension-{uuid.uuid4().hex}"
    for k in (1, 2, 0):
        dimensions.update(clean.where(F.month("order_date") % 3 == k), dimension, path)
    return dimensions.rows_of(dimensions.read_state(spark, path), dimension)


@query
def dim_customers_by_batches(spark, directory):
    return _by_batches(spark, directory, dimensions.CUSTOMERS)


@query
def dim_products_by_batches(spark, directory):
    return _by_batches(spark, directory, dimensions.PRODUCTS)


@query
def order_headers_by_batches(spark, directory):
    return _by_batches(spark, directory, dimensions.ORDERS)


@query
def order_summary_view(spark, directory):
    return plain(summary(spark, directory))


@query
def audit_primary_keys(spark, directory):
    t = StarTables(spark, directory)
    return audits.primary_key_audit(
        {
            "customers": (t.table("customer"), ["c_custkey"]),
            "products": (t.table("part"), ["p_partkey"]),
            "orders": (t.table("orders"), ["o_orderkey"]),
            "order_items": (t.table("lineitem"), ["l_orderkey", "l_linenumber"]),
        }
    )


@query
def audit_foreign_keys(spark, directory):
    t = StarTables(spark, directory)
    return audits.foreign_key_audit(
        [
            ("orders", t.table("orders"), "o_custkey", "customers", t.table("customer"), "c_custkey"),
            ("order_items", t.table("lineitem"), "l_orderkey", "orders", t.table("orders"), "o_orderkey"),
            ("order_items", t.table("lineitem"), "l_partkey", "products", t.table("part"), "p_partkey"),
        ]
    )


@query
def audit_not_null(spark, directory):
    return audits.not_null_audit(dirty(spark, directory), ORDER_LINE_COLUMNS)


@query
def audit_checks(spark, directory):
    return audits.check_audit(dirty(spark, directory))


@query
def audit_lengths(spark, directory):
    return audits.length_audit(dirty(spark, directory))


def _tables(spark, directory):
    """The four normalized tables with their keys."""
    clean = _clean_keyed(spark, directory)
    return {
        "customers": (normalize.customers(clean), ["customer_id"]),
        "products": (normalize.products(clean), ["product_id"]),
        "orders": (normalize.order_headers(clean), ["order_id"]),
        "order_items": (normalize.number_items(normalize.order_items(clean)), ["order_item_id"]),
    }


@query
def audit_table_keys(spark, directory):
    return audits.primary_key_audit(_tables(spark, directory))


@query
def audit_tables(spark, directory):
    """Nulls in required columns and oversized values of all columns of the four tables."""
    frames = []
    for name, (df, _) in _tables(spark, directory).items():
        frames.append(audits.table_audit(df).select(F.lit(name).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, frames)


# Exploratory statistics


@query
def describe_numeric(spark, directory):
    described = statistics.describe(explored(spark, directory), digits=None)
    return rounded(rounded(described, 7, "mean"), 6, "std", "min", "p25", "p50", "p75", "max")


@query
def skew_kurtosis(spark, directory):
    return statistics.shape_moments(explored(spark, directory), digits=6)


@query
def correlation_matrix(spark, directory):
    return statistics.correlation_matrix(explored(spark, directory), digits=6)


@query
def correlation_extremes(spark, directory):
    return statistics.correlation_extremes(correlation_matrix(spark, directory))


@query
def histogram(spark, directory):
    return rounded(statistics.histogram(explored(spark, directory)), 6, "bin_start")


@query
def density_curve(spark, directory):
    curve = statistics.density(explored(spark, directory))
    return rounded(rounded(curve, 6, "x"), 9, "density")


@query
def density_curve_binned(spark, directory):
    curve = statistics.binned_density(explored(spark, directory))
    return rounded(rounded(curve, 6, "x"), 9, "density", "error_bound")


@query
def box_summary(spark, directory):
    boxes = statistics.box_summary(explored(spark, directory))
    return rounded(boxes, 6, "q1", "median", "q3", "whisker_low", "whisker_high")


@query
def box_by_category(spark, directory):
    boxes = statistics.box_summary(explored(spark, directory, "category"), ["profit_margin_pct"], ["category"])
    return rounded(boxes, 6, "q1", "median", "q3", "whisker_low", "whisker_high")


@query
def quantile_sketch_checks(spark, directory):
    """Sketches per month and column, merged to one per column, and their quartiles against the exact ranks."""
    base = explored(spark, directory)
    monthly = sketches.quantile_states(base.withColumn("month", F.trunc("order_date", "month")), DESCRIBED_COLUMNS, ["month"])
    found = sketches.quantiles_of(sketches.merge_quantile_states(monthly), [0.25, 0.5, 0.75])
    return sketches.rank_checks(base, found, DESCRIBED_COLUMNS)


@query
def distinct_sketch_checks(spark, directory):
    """Distinct orders and customers of everything, of regions and of months, from one sketch per month and region."""
    base = lines(spark, directory, ["order_id", "customer_id", "order_date", "region"]).withColumn("month", F.trunc("order_date", "month"))
    counted = ["order_id", "customer_id"]
    states = stored(sketches.distinct_states(base, counted, ["month", "region"]))
    scopes = {"headline": [], "regions": ["region"], "months": ["month"]}
    return reduce(DataFrame.unionByName, [sketches.distinct_checks(base, states, counted, keys_, scope) for scope, keys_ in scopes.items()])


@query
def bounded_sample(spark, directory):
    key = ["order_id", "product_id", "ship_date", "quantity", "discount", "sales", "profit"]
    base = explored(spark, directory, "order_id", "product_id", "category")
    return plain(statistics.bounded_sample(base, ["discount", "profit_margin_pct", "category"], key))


@query
def loss_share_by_bucket(spark, directory):
    return statistics.loss_share(explored(spark, directory))


@query
def table_shape(spark, directory):
    return statistics.shape(lines(spark, directory))


@query
def eda_report(spark, directory):
    """The features are stored: a dozen readers want different columns of them."""
    return reports.eda_report(stored_table(explored(spark, directory, "order_id", "category", "region")))


# Segmentation


RFM_LINES = ["order_id", "customer_id", "order_date", "sales"]


def _rfm(spark, directory):
    return segmentation.rfm(lines(spark, directory, RFM_LINES))


def _shared_rfm(spark, directory):
    """(the measures, their scaled values), stored: a sweep and what follows it read them many times."""
    rows = segmentation.stored_rfm(lines(spark, directory, RFM_LINES))
    return rows, stored(segmentation.scale(rows))


def _fixed_clusters(spark, directory):
    """A cluster column that follows from the key, so that naming can be compared exactly."""
    return _rfm(spark, directory).withColumn("cluster", F.pmod("customer_id", F.lit(4)).cast("int"))


@query
def rfm(spark, directory):
    return _rfm(spark, directory)


@query
def rfm_scaled(spark, directory):
    return rounded(segmentation.scale(_rfm(spark, directory)), 6, *[f"{c}_z" for c in segmentation.RFM])


@query
def cluster_profile(spark, directory):
    return rounded(segmentation.cluster_profile(_fixed_clusters(spark, directory)), 6, *segmentation.RFM)


@query
def segment_labels(spark, directory):
    return segmentation.label_customers(_fixed_clusters(spark, directory))


@query
def segment_sizes(spark, directory):
    return segmentation.segment_sizes(segmentation.label_customers(_fixed_clusters(spark, directory)))


@query
def segment_points(spark, directory):
    return segmentation.segment_points(segmentation.label_customers(_fixed_clusters(spark, directory)))


@query
def k_sweep(spark, directory):
    _, scaled = _shared_rfm(spark, directory)
    return segmentation.sweep_table(scaled, segmentation.sweep_clusters(scaled))


@query
def k_sweep_by_summary(spark, directory):
    return micro_clusters.sweep_summary(stored(segmentation.scale(_rfm(spark, directory))))


@query
def cluster_scores(spark, directory):
    """Inertia and silhouette of labels that follow from the key, so that they can be compared exactly."""
    scaled = segmentation.scale(_rfm(spark, directory))
    labels = {k: F.pmod(F.col("customer_id") + F.col("customer_id") % 7, F.lit(k)) for k in segmentation.CLUSTER_RANGE}
    return rounded(micro_clusters.cluster_scores(scaled, labels), 6, "inertia", "silhouette")


@query
def kmeans_segments(spark, directory):
    rows, scaled = _shared_rfm(spark, directory)
    best = max(segmentation.sweep_clusters(scaled), key=lambda fit: fit.silhouette)
    return segmentation.label_customers(segmentation.assign_clusters(rows, scaled, best.model))


@query
def k_sweep_checks(spark, directory):
    _, scaled = _shared_rfm(spark, directory)
    return segmentation.fit_checks(scaled, segmentation.sweep_clusters(scaled))


@query
def segment_report(spark, directory):
    labelled = segmentation.label_customers(_fixed_clusters(spark, directory))
    return reports.segment_report(segmentation.segment_sizes(labelled))


@query
def fitted_segment_report(spark, directory):
    """With the clusters that the sweep has chosen and the silhouette of every count."""
    labelled, sweep = micro_clusters.segments_by_summary(_rfm(spark, directory))
    return reports.segment_report(segmentation.segment_sizes(labelled), sweep)


# Market baskets


def _basket_lines(spark, directory, *columns):
    """Lines with brand and type as the item: single parts are too rare to reach the support. Only names ask for more
    columns: an order date joins every line to its header."""
    base = lines(spark, directory, ["order_id", "category", "sub_category", *columns])
    return base.withColumn("item", F.concat_ws("/", "sub_category", "category"))


def _named_lines(spark, directory):
    return _basket_lines(spark, directory, "order_date", "product_name")


def _rules(spark, directory):
    return baskets.association_rules(_basket_lines(spark, directory), "item")


def _items(spark, directory):
    return baskets.basket_items(_basket_lines(spark, directory), "item")


@partial(query, name="baskets")
def basket_lists(spark, directory):
    listed = baskets.baskets(_basket_lines(spark, directory), "item")
    return listed.withColumn("items", F.array_join("items", ","))


@query
def item_names(spark, directory):
    return baskets.item_names(_named_lines(spark, directory), "item")


@query
def item_counts(spark, directory):
    return baskets.item_counts(_items(spark, directory))


@query
def pair_counts(spark, directory):
    return baskets.pair_counts(_items(spark, directory))


@query
def itemsets(spark, directory):
    """Sets of two to four brands: enough of them share orders."""
    base = lines(spark, directory, ["order_id", "sub_category"])
    found = baskets.itemsets(baskets.basket_items(base, "sub_category"))
    return found.withColumn("items", F.array_join("items", ","))


@query
def association_rules(spark, directory):
    return baskets.sort_rules(_rules(spark, directory))


@query
def recommendations(spark, directory):
    return baskets.recommendations(_rules(spark, directory))


@query
def recommendation_lists(spark, directory):
    listed = baskets.recommendation_lists(baskets.recommendations(_rules(spark, directory)))
    return listed.withColumn("recommended", F.array_join("recommended", ","))


@query
def rules_top10(spark, directory):
    names = baskets.item_names(_named_lines(spark, directory), "item")
    return baskets.top_rules(_rules(spark, directory), names)


@query
def rule_evidence(spark, directory):
    return baskets.rule_evidence(_rules(spark, directory), _items(spark, directory))


@query
def rule_report(spark, directory):
    return reports.rule_report(_rules(spark, directory), _items(spark, directory), item_names(spark, directory))


# Forecasting


def _weekly(spark, directory):
    return timebins.weekly_sales(lines(spark, directory, ["order_date", "sales"]))


def _split(spark, directory):
    return timebins.chronological_split(timebins.add_week_features(_weekly(spark, directory)))


def _series_split(spark, directory):
    keys_ = ["region", "category"]
    weekly = timebins.weekly_sales(lines(spark, directory, ["order_date", "sales", *keys_]), keys_)
    return timebins.chronological_split(timebins.add_week_features(weekly, keys_), keys_)


@query
def weekly_sales(spark, directory):
    return _weekly(spark, directory)


@query
def weekly_features(spark, directory):
    return timebins.add_week_features(_weekly(spark, directory))


@query
def chronological_split(spark, directory):
    return _split(spark, directory).select("week_end", "total_sales", "time_index", "is_train")


@query
def split_bounds(spark, directory):
    return timebins.split_bounds(_split(spark, directory))


@query
def series_trend_forecast(spark, directory):
    return rounded(forecasting.trend_lines(_series_split(spark, directory), ["region", "category"]), 4, "slope", "intercept")


@query
def forecast_metrics(spark, directory):
    return forecasting.error_metrics(forecasting.trend_predictions(_split(spark, directory)), keys=[])


@query
def series_forecasts(spark, directory):
    return forecasting.series_forecasts(_series_split(spark, directory), ["region", "category"])


@query
def model_comparison(spark, directory):
    split = _split(spark, directory)
    predictions = forecasting.predict(split, forecasting.fit_models(split))
    return forecasting.compare_models(forecasting.error_metrics(predictions))


@query
def actual_vs_predicted(spark, directory):
    split = _split(spark, directory)
    fitted = forecasting.fit_models(split)
    return forecasting.actual_vs_predicted(forecasting.predict(split, fitted), list(fitted))


@query
def model_checks(spark, directory):
    split = _split(spark, directory)
    return forecasting.model_checks(split, forecasting.fit_models(split))


@query
def forecast_report(spark, directory):
    """Of the trend line, whose fit is a closed form."""
    split = _split(spark, directory)
    metrics = forecasting.error_metrics(forecasting.trend_predictions(split), keys=[]).withColumn("model", F.lit("Trend"))
    return reports.forecast_report(metrics, timebins.split_bounds(split))


@query
def fitted_forecast_report(spark, directory):
    """Of all fitted models, with the winner."""
    split = stored(_split(spark, directory))
    compared = forecasting.compare_models(forecasting.error_metrics(forecasting.predict(split, forecasting.fit_models(split))))
    return reports.forecast_report(stored(compared), timebins.split_bounds(split))
