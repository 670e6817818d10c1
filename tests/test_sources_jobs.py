from __future__ import annotations

import pytest
from row_sets import rows
from pyspark.sql import functions as F

from ledgerline.operators import forecasting
from ledgerline.plans import jobs
from ledgerline.schemas import ORDER_LINE_COLUMNS, ORDER_LINE_SCHEMA
from ledgerline.sources import files
from ledgerline.sources.retail import StarTables, inject_faults, order_lines


def test_missing_input_names_the_stage(spark, tmp_path):
    with pytest.raises(files.MissingInputError, match="'features' stage"):
        files.read_parquet(spark, str(tmp_path / "nothing"), produced_by="features")
    with pytest.raises(files.MissingInputError, match="'collect' stage"):
        files.read_raw_csv(spark, str(tmp_path / "nothing.csv"))


def test_csv_round_trip_keeps_declared_types(spark, small, tmp_path):
    lines = order_lines(StarTables(spark, small)).limit(50)
    typed = lines.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ORDER_LINE_SCHEMA]).persist()
    files.write_csv(typed, str(tmp_path / "csv"))
    back = files.read_typed_csv(spark, str(tmp_path / "csv"))
    assert back.schema == ORDER_LINE_SCHEMA and rows(back) == rows(typed)


def test_append_matches_columns_by_name(spark):
    spark.sql("DROP TABLE IF EXISTS append_target")
    spark.sql("CREATE TABLE append_target (a INT, b STRING) USING parquet")
    try:
        frame = spark.createDataFrame([("x", 1)], "b string, a int")
        files.append_table(frame, "append_target")
        files.append_table(frame, "append_target")
        assert rows(files.read_query(spark, "SELECT a, b FROM append_target")) == [(1, "x"), (1, "x")]
    finally:
        spark.sql("DROP TABLE append_target")


def test_reload_empties_children_first_and_can_run_twice(spark):
    spark.sql("CREATE TABLE reload_parent (a INT) USING parquet")
    spark.sql("CREATE TABLE reload_child (b STRING, a INT) USING parquet")
    try:
        parent, child = spark.range(3).selectExpr("int(id) AS a"), spark.range(6).selectExpr("int(id % 3) AS a", "string(id) AS b")
        for _ in range(2):
            files.reload_tables({"reload_parent": parent, "reload_child": child})
            assert rows(spark.table("reload_parent")) == rows(parent)
            assert rows(spark.table("reload_child"), "a", "b") == rows(child, "a", "b")
    finally:
        spark.sql("DROP TABLE reload_parent")
        spark.sql("DROP TABLE reload_child")


def test_a_partitioned_jdbc_read_needs_bounds(spark):
    with pytest.raises(ValueError, match="bounds"):
        files.read_jdbc(spark, "jdbc:none", "t", partition_column="id")
    with pytest.raises(ValueError, match="single task"):
        files.read_jdbc(spark, "jdbc:none", "t")


def test_unused_joins_are_left_out_without_changing_lines(spark, small):
    tables = StarTables(spark, small)
    full, narrow = order_lines(tables), order_lines(tables, ["order_id", "sales"])
    assert rows(full.agg(F.count("*"), F.sum("sales"))) == rows(narrow.agg(F.count("*"), F.sum("sales")))
    assert "customer" not in narrow._jdf.queryExecution().optimizedPlan().toString()


def test_all_jobs_twice_give_the_same_tables(spark, small, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    dirty = inject_faults(order_lines(StarTables(spark, small)))
    files.write_csv(dirty.select(*ORDER_LINE_COLUMNS), raw)

    def run():
        jobs.clean(spark, raw, out)
        jobs.normalize_tables(spark, out)
        jobs.build_features(spark, out)
        names = ["clean", "tables/customers", "tables/products", "tables/orders", "tables/order_items", "features"]
        return {n: spark.read.parquet(f"{out}/{n}").count() for n in names}

    counts = run()
    assert run() == counts
    assert counts["clean"] == counts["features"] == counts["tables/order_items"] == 6000
    assert spark.sql("SELECT count(*) FROM order_summary").first()[0] == 6000
    assert len(spark.read.parquet(f"{out}/features").columns) == 37

    jobs.report_kpis(spark, out)
    jobs.explore(spark, out)
    jobs.recommend(spark, out, item="sub_category", min_lift=1.0)
    jobs.segment(spark, out, clusters=[2, 3], starts=1)
    jobs.forecast(spark, out, models={"Linear Regression": forecasting.fit_linear})
    headline = {r["metric"]: r["value"] for r in spark.read.parquet(f"{out}/reports/kpis").where("section = 'headline'").collect()}
    assert headline["total_customers"] == counts["tables/customers"] and headline["total_orders"] == counts["tables/orders"]
    for report in ("cleaning", "eda", "rules", "segments", "forecast"):
        assert spark.read.parquet(f"{out}/reports/{report}").columns == ["section", "metric", "value"]
    assert spark.read.parquet(f"{out}/segments").count() == counts["tables/customers"]
    stored = spark.read.parquet(f"{out}/segments")
    scored = jobs.score(spark, out, stored.select("customer_id", "recency_days", "frequency", "monetary"))
    assert rows(scored, "customer_id", "cluster") == rows(stored, "customer_id", "cluster")
    assert spark.read.csv(f"{out}/reports/monthly_trend", header=True).columns[0] == "order_date"
