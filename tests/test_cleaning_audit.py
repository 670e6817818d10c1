"""The observed figures of a cleaning run against the queries that compute each of them by a pass of its own."""

from __future__ import annotations

from row_sets import rows
from pyspark.sql import functions as F

from ledgerline.operators import cleaning
from ledgerline.operators.cleaning_audit import clean_observed
from ledgerline.plans import jobs
from ledgerline.schemas import ORDER_LINE_COLUMNS
from ledgerline.sources import files
from ledgerline.sources.retail import StarTables, inject_faults, order_lines


def broken_lines(spark, small):
    text = inject_faults(order_lines(StarTables(spark, small))).select(*[F.col(c).cast("string").alias(c) for c in ORDER_LINE_COLUMNS])
    fault = F.col("order_id").cast("long") % 20
    return text.withColumns(
        {
            "sales": F.when(fault == 1, F.lit("n/a")).when(fault == 2, F.lit("-4")).when(fault == 3, F.lit(None)).otherwise(F.col("sales")),
            "quantity": F.when(fault == 4, F.lit("0")).when(fault == 5, F.lit("2.5")).otherwise(F.col("quantity")),
            "order_date": F.when(fault == 6, F.lit("2024-02-30")).otherwise(F.col("order_date")),
        }
    )


def same_reports(audit, raw):
    typed = cleaning.convert_types(cleaning.remove_copies(cleaning.fill_missing(raw)))
    assert rows(audit.shape()) == rows(cleaning.shape_audit(raw))
    assert rows(audit.nulls()) == rows(cleaning.null_profile(raw))
    assert rows(audit.fills()) == rows(cleaning.fill_decisions(raw))
    assert rows(audit.rules()) == rows(cleaning.rule_violations(typed))
    assert rows(audit.conversions()) == rows(cleaning.conversion_report(raw))


def test_figures_equal_the_separate_passes(spark, small, tmp_path):
    raw = broken_lines(spark, small)
    cleaned, audit = clean_observed(raw)
    files.write_parquet(cleaned, str(tmp_path / "clean"))
    assert rows(spark.read.parquet(str(tmp_path / "clean"))) == rows(cleaning.clean(raw))
    same_reports(audit, raw)
    assert len(rows(audit.rules())) == 3


def test_an_empty_file_has_figures(spark, small):
    raw = broken_lines(spark, small).limit(0)
    cleaned, audit = clean_observed(raw)
    cleaned.write.format("noop").mode("overwrite").save()
    same_reports(audit, raw)


def test_the_job_reads_the_raw_file_once(spark, small, tmp_path, monkeypatch):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    files.write_csv(broken_lines(spark, small), raw)
    lines_read = spark.sparkContext.accumulator(0)
    read = files.read_raw_csv

    def counted(session, path):
        def count(batches):
            for batch in batches:
                lines_read.add(batch.num_rows)
                yield batch

        df = read(session, path)
        return df.mapInArrow(count, df.schema)

    monkeypatch.setattr(jobs, "read_raw_csv", counted)
    jobs.clean(spark, raw, out)
    before = read(spark, raw)
    assert lines_read.value == before.count()
    report = {(r["section"], r["metric"]): r["value"] for r in spark.read.parquet(f"{out}/reports/cleaning").collect()}
    assert report["shape", "rows_before"] == lines_read.value and report["missing", "sales"] > 0 and ("outliers", "sales") in report
    assert rows(spark.read.parquet(f"{out}/reports/parsing")) == rows(cleaning.conversion_report(before))
    typed = cleaning.convert_types(before)
    assert rows(spark.read.parquet(f"{out}/reports/conversions")) == rows(cleaning.conversion_audit(before, typed))
