"""Bounded samples for fitting models: the same rows whatever the partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hashed_sample(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The first ``n`` rows by the hash of ``keys``; no partition sends on much more than its share of them."""
    drawn = rows.withColumn("_draw", F.xxhash64(*keys))
    total = rows.count()
    if total > 4 * n:
        # hashes are even: about 2 n rows lie below this one
        drawn = drawn.filter(F.col("_draw") < F.lit(int(2**64 * (2 * n / total)) - 2**63))
    return drawn.orderBy("_draw", *keys).limit(n).drop("_draw")
