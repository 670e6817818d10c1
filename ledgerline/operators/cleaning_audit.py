"""Figures of a cleaning run, taken by the job that writes the clean table: no further pass over the raw lines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ledgerline.operators import cleaning

#: The rules in the order in which the report names them, with the condition each counts.
_RULES = {
    "ship_date before order_date": cleaning.shipped_before_ordered,
    "sales <= 0": cleaning.sales_not_positive,
    "quantity <= 0": lambda: ~cleaning.sales_not_positive() & cleaning.quantity_not_positive(),
}


@dataclass(frozen=True)
class CleaningAudit:
    """Reports of one cleaning run. They are there once an action over the clean lines, such as their write, is over."""

    spark: SparkSession
    before: T.StructType
    after: T.StructType
    observation: Observation

    @property
    def figures(self) -> dict[str, int]:
        return {k: v or 0 for k, v in self.observation.get.items()}

    def _frame(self, rows: list[tuple], schema: str) -> DataFrame:
        return self.spark.createDataFrame(rows, schema)

    def shape(self) -> DataFrame:
        """As ``cleaning.shape_audit``."""
        f, width = self.figures, len(self.before)
        row = (f["rows_before"], width, f["rows_before"] - f["rows_unique"], f["rows_after"], width)
        return self._frame([row], "rows_before long, columns_before int, copies_removed long, rows_after long, columns_after int")

    def nulls(self) -> DataFrame:
        """As ``cleaning.null_profile`` of the raw lines."""
        f = self.figures
        rows = [(c.name, f[f"null {c.name}"]) for c in self.before if f[f"null {c.name}"]]
        return self._frame(rows, "column_name string, null_count long")

    def fills(self) -> DataFrame:
        """As ``cleaning.fill_decisions``."""
        f = self.figures
        rows = [(c, f[f"null {c}"], str(v)) for c, v in cleaning.FILL_VALUES.items() if c in self.before.names and f[f"null {c}"]]
        return self._frame(rows, "column_name string, filled_count long, filled_with string")

    def conversions(self) -> DataFrame:
        """As ``cleaning.conversion_report`` of the raw lines."""
        f = self.figures
        rows = [
            (c.name, c.dataType.simpleString(), self.after[c.name].dataType.simpleString(), f["rows_before"] - f[f"null {c.name}"], f[f"unparsed {c.name}"])
            for c in self.before
        ]
        return self._frame(rows, "column_name string, type_before string, type_after string, given long, unparsed long")

    def rules(self) -> DataFrame:
        """As ``cleaning.rule_violations`` of the unique typed lines."""
        f = self.figures
        return self._frame([(r, f[r]) for r in _RULES if f[r]], "rule string, violations long")


def clean_observed(raw: DataFrame, name: str = "cleaning") -> tuple[DataFrame, CleaningAudit]:
    """The clean lines, as ``cleaning.clean`` gives them, and the audit of the run that computes them.

    Copies are collapsed with their number and with what the fills replaced, so all figures are taken behind the only shuffle,
    in the stage that writes: a task that is run again there counts once. In front of the shuffle a lost
    executor would have its rows counted twice.
    """
    filled_columns = [c for c in cleaning.FILL_VALUES if c in raw.columns]
    marked = raw.withColumns({f"_null_{c}": F.col(c).isNull().cast("long") for c in filled_columns})
    sums = [F.sum(f"_null_{c}").alias(f"_null_{c}") for c in filled_columns]
    unique = cleaning.fill_missing(marked).groupBy(*raw.columns).agg(F.count("*").alias("_copies"), *sums)
    given = [F.col(c).isNotNull().alias(f"_given_{c}") for c in raw.columns]
    typed = cleaning.convert_types(unique.select("*", *given))

    def weighted(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("_copies")).otherwise(0))

    kept = ~cleaning.sales_not_positive() & F.coalesce(F.col("quantity") > 0, F.lit(False))
    metrics = [F.sum("_copies").alias("rows_before"), F.count("*").alias("rows_unique"), F.count_if(kept).alias("rows_after")]
    for c in raw.columns:
        was_null = F.sum(f"_null_{c}") if c in filled_columns else weighted(~F.col(f"_given_{c}"))
        lost = F.col(f"_given_{c}") & F.col(c).isNull()
        metrics += [was_null.alias(f"null {c}"), weighted(lost).alias(f"unparsed {c}")]
    metrics += [F.count_if(holds()).alias(rule) for rule, holds in _RULES.items()]

    observation = Observation(name)
    observed = typed.observe(observation, *metrics)
    clean = observed.transform(cleaning.repair_ship_dates).transform(cleaning.drop_invalid_amounts).select(*raw.columns)
    return clean, CleaningAudit(raw.sparkSession, raw.schema, clean.schema, observation)
