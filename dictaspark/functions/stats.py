"""Agreement and significance statistics over rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def kappa(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """One row: n, observed and chance agreement, Cohen's kappa; 0.0 when empty or chance is 1.

    Contingency first, so that only as many rows as there are label pairs go on.
    """
    cells = pairs.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count("*").alias("n"))
    margin = lambda side: cells.groupBy(F.col(side).alias("label")).agg(F.sum("n").alias(f"n_{side}"))
    chance = margin("a").join(margin("b"), "label").agg(F.coalesce(F.sum(F.col("n_a") * F.col("n_b")), F.lit(0)).alias("cross"))
    total = cells.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.when(F.col("a") == F.col("b"), F.col("n"))), F.lit(0)).alias("same"))
    both = total.join(F.broadcast(chance), F.lit(True))  # two one-row tables
    n = F.greatest(F.col("n"), F.lit(1))
    po, pe = F.col("same") / n, F.col("cross") / (n * n)
    return both.select("n", po.alias("observed"), pe.alias("chance"), F.when((F.col("n") == 0) | (pe == 1), F.lit(0.0)).otherwise((po - pe) / (1 - pe)).alias("kappa"))


def sign_z(wins_a: Column, wins_b: Column) -> Column:
    """(a - b) / sqrt(a + b); null without any win."""
    return (wins_a - wins_b) / F.sqrt(F.nullif(wins_a + wins_b, F.lit(0)))


def nearest_rank(values: Column, p: float) -> Column:
    """Element of the sorted array at half-even rounded p * (n - 1)."""
    ordered = F.array_sort(values)
    return F.element_at(ordered, F.bround(p * (F.size(ordered) - 1)).cast("int") + 1)


def step_counts(rows: Column, batch: int, accumulate: int, epochs: float, warm: float = 0.06) -> Column:
    """``struct<batches, steps, warmup>`` of a training run: rounded up per epoch, warm-up rounded down but at least 1."""
    batches = F.ceil(rows / batch)
    steps = F.floor(F.ceil(batches / accumulate) * epochs)
    return F.struct(batches.cast("bigint").alias("batches"), steps.cast("bigint").alias("steps"), F.greatest(F.lit(1), F.floor(F.lit(warm) * steps)).cast("bigint").alias("warmup"))
