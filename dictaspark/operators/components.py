"""Connected components by alternating large and small stars, wholly distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dictaspark.operators.skew import join_hot_split
from dictaspark.session import checkpoint


def _mass(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(u, v)`` of any one orderable type to ``(node, root)``, root the least node reached.

    Self loops keep lone nodes. Null ends are left out. An empty table gives an empty
    table. Every round is checkpointed; only two numbers a round reach the driver. A
    round that would exceed ``max_rounds`` raises instead of giving a wrong result.
    """
    clean = edges.select("u", "v").filter(F.col("u").isNotNull() & F.col("v").isNotNull())
    nodes = checkpoint(clean.select(F.col("u").alias("node")).union(clean.select("v")).distinct())
    current = checkpoint(
        clean.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    mass = _mass(current)
    for _ in range(max_rounds):
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        least = least.select("u", F.least("u", "m").alias("m"), "n")
        large = checkpoint(
            join_hot_split(both, least, ["u"], "n", 2 * mass[0])
            .filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = join_hot_split(large, least, ["u"], "n", max(1, mass[0]))
        step = checkpoint(
            small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))).distinct()
        )
        after = _mass(step)
        current = step
        if after == mass:
            roots = current.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
            return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
        mass = after
    raise RuntimeError(f"no convergence after {max_rounds} rounds")
