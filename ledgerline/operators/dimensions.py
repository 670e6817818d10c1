"""Dimensions that grow with each batch of lines, without reading the lines of earlier batches.

A dimension holds, for each key, the columns of the key's first line in a given order. The smallest (order, columns) of a key is a
state that merges: the minimum over all lines is the minimum over the batches' minima, in whatever order they come and
however often one is repeated.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.operators.normalize import keyed
from ledgerline.operators.stored import stored_table
from ledgerline.schemas import CUSTOMER_COLUMNS, ID_COLUMNS, ORDER_COLUMNS, PRODUCT_COLUMNS


@dataclass(frozen=True)
class Dimension:
    """Which columns a dimension has, its key first, and by what order of the lines the first one is chosen."""

    columns: tuple[str, ...]
    order: tuple[str, ...]

    @property
    def key(self) -> str:
        return self.columns[0]

    @property
    def needed(self) -> list[str]:
        """Columns of the lines that a state is made of: the keys of all tables are required."""
        return list(dict.fromkeys([*self.columns, *self.order, *ID_COLUMNS]))

    @property
    def ranking(self) -> list[str]:
        """Order columns, then the dimension's own as tie breakers."""
        return list(dict.fromkeys([*self.order, *self.columns[1:]]))


#: The dimensions of the normalized tables, as ``normalize`` builds them from all lines at once.
CUSTOMERS = Dimension(CUSTOMER_COLUMNS, ("order_date", "order_id", "product_id"))
PRODUCTS = Dimension(PRODUCT_COLUMNS, ("order_date", "order_id"))
ORDERS = Dimension(ORDER_COLUMNS, ("product_id", "order_date", "ship_date"))

#: Parts of a stored state. A batch rewrites the parts in which one of its keys changes.
PARTS = 64


def state_of(lines: DataFrame, dimension: Dimension) -> DataFrame:
    """(key, first): the state of a batch of clean lines; one row per key leaves each task."""
    usable = keyed(lines)
    if dimension is ORDERS:
        usable = usable.withColumns({c: F.col(c).cast("date") for c in ("order_date", "ship_date")})
    first = F.min(F.struct(*dimension.ranking)).alias("first")
    return usable.groupBy(dimension.key).agg(first)


def merged(states: Sequence[DataFrame], dimension: Dimension) -> DataFrame:
    """The state of all batches together."""
    together = states[0]
    for state in states[1:]:
        together = together.unionByName(state)
    return together.groupBy(dimension.key).agg(F.min("first").alias("first"))


def rows_of(state: DataFrame, dimension: Dimension) -> DataFrame:
    """The dimension that a state stands for."""
    return state.select(dimension.key, *[F.col("first")[c].alias(c) for c in dimension.columns[1:]])


def _part(dimension: Dimension, parts: int):
    return F.pmod(F.xxhash64(dimension.key), F.lit(parts)).cast("int").alias("part")


def read_state(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored state, or none before the first batch."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if (error.getCondition() or "").startswith(("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")):
            return None
        raise


def update(lines: DataFrame, dimension: Dimension, path: str, parts: int = PARTS) -> int:
    """Merge a batch of clean lines into the state stored at ``path``; returns how many parts were written.

    Read are the batch and the parts of the state that hold its keys; written are those parts in which a first line is new or
    has changed, replaced when their files are complete. So a batch that failed can be repeated, one that was merged
    before writes nothing, and batches may come in any order. The number of parts stays what the first batch made it,
    whatever a later call names.
    """
    old = read_state(lines.sparkSession, path)
    known = None if old is None else old.select("parts").first()
    parts = known["parts"] if known else parts
    batch = state_of(lines, dimension).select("*", _part(dimension, parts))
    if old is None:
        changed = batch
    else:
        batch = stored_table(batch)  # two readers: which parts change, and the change itself
        before = old.select(dimension.key, F.col("first").alias("before"), "part")
        found = batch.join(before, [dimension.key, "part"], "left")
        news = found.where(F.col("before").isNull() | (F.col("first") < F.col("before"))).select(batch["part"]).distinct()
        touched = sorted(r["part"] for r in news.collect())  # at most ``parts`` numbers
        if not touched:
            return 0
        both = [s.where(F.col("part").isin(touched)).select(dimension.key, "first") for s in (old, batch)]
        changed = merged(both, dimension).select("*", _part(dimension, parts))
    numbered = changed.withColumn("parts", F.lit(parts)).repartition("part")
    numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)
    return parts if old is None else len(touched)
