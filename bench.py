"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR names the data directory, BENCH_CPUS the local cores. A query runs three times, or until its runs have taken
REPEAT_SECONDS, and its median counts.
"""

from __future__ import annotations

import json
import os
import time
from statistics import median

from ledgerline.registry.queries import QUERIES
from ledgerline.session import local_session

HEADLINE = (
    "monthly_trend", "headline_kpis", "top_products", "regional_kpis", "category_summary", "sales_heatmap",
    "feature_table", "customer_features", "clean_table", "iqr_outliers", "order_items", "order_summary_view",
    "describe_numeric", "correlation_matrix", "histogram", "box_by_category", "density_curve", "bounded_sample",
    "rfm", "rfm_scaled", "segment_labels", "association_rules", "recommendations", "weekly_features",
    "series_trend_forecast", "series_forecasts", "model_comparison", "audit_primary_keys", "audit_foreign_keys",
)

REPEATS = 3
REPEAT_SECONDS = 10.0


def consume(df) -> None:
    """Compute every column of every row without moving rows to the driver."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
    spark = local_session("ledgerline-bench", cores=cpus)
    consume(QUERIES["monthly_trend"](spark, directory))  # warm-up, not counted
    seconds = {}
    for name in HEADLINE:
        runs = []
        while len(runs) < REPEATS and sum(runs) < REPEAT_SECONDS:
            start = time.perf_counter()
            consume(QUERIES[name](spark, directory))
            runs.append(time.perf_counter() - start)
        seconds[name] = round(median(runs), 3)
    rows = spark.read.parquet(f"{directory}/lineitem.parquet").count()
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
                "line_rows": rows,
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
