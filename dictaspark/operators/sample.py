"""Hash-ranked sampling, hold-outs, splits and batches: the same rows whatever the partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dictaspark.functions.text import hash_draw


def draw(seed: str, *keys: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), *[k.cast("string") for k in keys]))


#: Hexadecimal digits of a draw that make a cell; a group's rows are ranked cell by cell.
CELL = 3


def first_of_groups(rows: DataFrame, group: list[str], key: str, seed: str, take) -> DataFrame:
    """The first ``take(n)`` rows in hash order of every group of n rows; ``take`` may use the group's columns too.

    Counts by the first digits of the hash tell which cells of a group are wanted, so that no
    task sorts a group, however large; only a cell's rows are ranked. Null groups are a group.
    """
    drawn = rows.withColumn("_d", draw(seed, F.col(key))).withColumn("_c", F.substring("_d", 1, CELL))
    part = Window.partitionBy(*group)
    before = part.orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    cells = drawn.groupBy(*group, "_c").agg(F.count("*").alias("_n"))
    cells = cells.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn("_all", F.sum("_n").over(part))
    cells = cells.withColumn("_take", take(F.col("_all"))).filter("_before < _take").select(*[F.col(c).alias(f"_g{k}") for k, c in enumerate([*group, "_c"])], "_before", "_take")
    same = [F.col(c).eqNullSafe(F.col(f"_g{k}")) for k, c in enumerate([*group, "_c"])]
    met = drawn.join(cells, same)
    ranked = met.withColumn("_r", F.row_number().over(Window.partitionBy(*group, "_c").orderBy("_d", key)))
    return ranked.filter(F.col("_before") + F.col("_r") <= F.col("_take")).select(*rows.columns)


def sample_per_group(rows: DataFrame, group: list[str], key: str, seed: str, share: float, least: int = 1) -> DataFrame:
    """``greatest(least, floor(share * n))`` rows of each group in hash order."""
    return first_of_groups(rows, group, key, seed, lambda n: F.greatest(F.lit(least), F.floor(share * n)))


def stratified(rows: DataFrame, stratum: str, key: str, seed: str, n: int) -> DataFrame:
    """The first n of every stratum in hash order."""
    return first_of_groups(rows, [stratum], key, seed, lambda _: F.lit(n))


def first_by_hash(rows: DataFrame, key: str, seed: str, n: int) -> DataFrame:
    """n rows without replacement; a top-n, so no total sort."""
    return rows.orderBy(draw(seed, F.col(key)), key).limit(n)


def held_groups(rows: DataFrame, group: str, seed: str, share: float) -> DataFrame:
    """``(group, held)``: a share of the *groups*, at least one, by rank of their hash."""
    groups = rows.select(group).filter(F.col(group).isNotNull()).distinct()
    n = groups.count()
    ranked = groups.orderBy(draw(seed, F.col(group)), group).limit(max(1, round(share * n)) if n else 0)
    return groups.join(ranked.withColumn("held", F.lit(True)), group, "left").withColumn("held", F.coalesce("held", F.lit(False)))


def train_eval(rows: DataFrame, flag: Column, group: str, seed: str, share: float) -> DataFrame:
    """``part``: by the flag where it is set, else by held-out groups."""
    groups = held_groups(rows.filter(flag.isNull()), group, seed, share)
    joined = rows.withColumn("_flag", flag).join(groups, group, "left")
    return joined.withColumn("part", F.when(F.coalesce(F.col("_flag"), F.col("held"), F.lit(False)), "eval").otherwise("train")).drop("_flag", "held")


def length_batches(rows: DataFrame, length: Column, key: str, size: int, seed: str) -> DataFrame:
    """Batches of ``size`` rows of like length, in hashed order of batches.

    The rank over all lengths comes from per-length counts, so no task sees all rows: a
    histogram of lengths gives each length its offset, and rows are ranked within their
    length and hash bucket only.
    """
    keyed = rows.withColumn("_len", length).withColumn("_b", F.substring(F.md5(F.col(key).cast("string")), 1, 2))
    cells = keyed.groupBy("_len", "_b").agg(F.count("*").alias("_n"))
    run = Window.orderBy("_len", "_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.withColumn("_off", F.coalesce(F.sum("_n").over(run), F.lit(0))).drop("_n")
    ranked = keyed.join(offsets, ["_len", "_b"]).withColumn("_r", F.col("_off") + F.row_number().over(Window.partitionBy("_len", "_b").orderBy(key)) - 1)
    return ranked.withColumn("batch", F.floor(F.col("_r") / size)).withColumn("batch_order", hash_draw(seed, F.col("batch"))).drop("_len", "_b", "_off", "_r")


def weighted_choice(uniform: Column, weights: dict[str, float]) -> Column:
    """Categorical draw from a uniform in [0, 1)."""
    total, at, out = sum(weights.values()), 0.0, None
    for name, w in weights.items():
        at += w / total
        out = F.when(uniform < at, name) if out is None else out.when(uniform < at, name)
    return out.otherwise(list(weights)[-1])
