"""Keep-first deduplication by one key, and the greedy form over two keys."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dictaspark.operators.skew import join_hot_split
from dictaspark.session import checkpoint, ship


def keep_first(rows: DataFrame, key: list[Column], order: list[Column]) -> DataFrame:
    """The first row of every key. Nulls form one key."""
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def keep_last(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Keyed table in which the last row of an id wins; one aggregation, no sort of groups."""
    others = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_r")).select(key, "_r.*")


def _replay(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("seq", kind="stable")
    ids, texts, kept = set(), set(), []
    for a, b in zip(pdf["k1"], pdf["k2"]):
        fresh = a not in ids and b not in texts
        if fresh:
            ids.add(a)
            texts.add(b)
        kept.append(fresh)
    return pd.DataFrame({"seq": pdf["seq"], "kept": kept}, columns=["seq", "kept"])


#: So few undecided rows are replayed in order by one task.
REPLAY_ROWS = 20_000


def keep_first_two_keys(rows: DataFrame, first: Column, second: Column, seq: str) -> DataFrame:
    """Rows in ``seq`` order, skipped when either key was kept before; a skipped row registers neither.

    Independent ranks are wrong here, since a row skipped for one key must not own the
    other. Of rows equal in both keys only the first can be kept, so hot groups of copies
    shrink to one row first. Then, round by round, a row that is the first undecided one of
    both its keys is kept, and rows that share a key with a kept one are skipped; this is
    the sequential result exactly, whatever the size of tied groups. What is left once at
    most ``REPLAY_ROWS`` rows are undecided is replayed in order by one task. Null keys
    equal each other.
    """
    ship(rows.sparkSession)
    keyed = rows.withColumn("k1", F.coalesce(first.cast("string"), F.lit(""))).withColumn("k2", F.coalesce(second.cast("string"), F.lit("")))
    open_ = checkpoint(keyed.groupBy("k1", "k2").agg(F.min(seq).alias("seq")))
    kept, left = [], open_.count()
    while left > REPLAY_ROWS:
        m1, m2 = open_.groupBy("k1").agg(F.min("seq").alias("m1"), F.count("*").alias("n1")), open_.groupBy("k2").agg(F.min("seq").alias("m2"), F.count("*").alias("n2"))
        marked = join_hot_split(open_, m1, ["k1"], "n1", left)
        marked = checkpoint(join_hot_split(checkpoint(marked), m2, ["k2"], "n2", left))
        won = marked.filter("seq = m1 and seq = m2").select("k1", "k2", "seq")
        kept.append(won.select("seq"))
        # a key with a winner is closed: its least undecided row is that winner
        one, two = won.select("k1"), won.select("k2")
        open_ = checkpoint(marked.select("k1", "k2", "seq").join(one, "k1", "left_anti").join(two, "k2", "left_anti"))
        left = open_.count()
    kind = dict(rows.dtypes)[seq]
    rest = open_.groupBy(F.lit(0).alias("all")).applyInPandas(_replay, f"seq {kind}, kept boolean").filter("kept").select("seq")
    for part in kept:
        rest = rest.unionByName(part)
    return rows.join(rest.withColumnRenamed("seq", seq), seq, "left_semi")
