"""Joining skewed rows to frames with one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def join_per_key(rows: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join rows, some keys of which may be very frequent, to a frame with one row per key.

    AQE splits a skewed partition only where both sides of the join come fresh from a shuffle. A frame
    that was just aggregated by the keys is already partitioned by them and would be joined as it lies,
    leaving a hot key to one task. A second key, derived from the first, asks for that shuffle of the
    small side; the large side is shuffled once either way. It is 0 for all rows, which the optimizer does not know, and
    so takes no room in the shuffle; the keys alone spread the rows.
    """
    spread = F.pmod(F.hash(*keys), F.lit(1))
    joined = rows.withColumn("_spread", spread).join(per_key.withColumn("_spread", spread), [*keys, "_spread"], how)
    return joined.drop("_spread")
