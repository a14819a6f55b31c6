"""Joins that stay even when one key holds a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot when it holds more than one part in HOT of all rows, so there are fewer than HOT hot keys.
HOT = 1000


def join_hot_split(rows: DataFrame, dim: DataFrame, keys: list[str], weight: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``dim``, which has one row per key and in ``weight`` the key's rows.

    Hot keys, of which there are fewer than ``HOT`` whatever the data, are broadcast,
    so that their rows stay where they are; the rest meets by shuffle. Rows with a null
    key match nothing. ``rows`` is read twice and should be materialised.
    """
    hot = dim.filter(F.col(weight) * HOT > F.lit(total))
    cold = dim.filter(F.col(weight) * HOT <= F.lit(total))
    near = rows.join(F.broadcast(hot), keys)
    far = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys)
    return near.unionByName(far)
