"""Splits that keep related records together: component swap search by parallel annealing.

Method: rows are tied by normalised handle and source; the components of that graph
start from a hashed assignment, then parallel annealing chains move or exchange whole
components to lower the deviation of sizes and of labels, and the best chain is kept.
The search has two levels. Components of more than one part in ``GIANT`` of all rows, of
which there are fewer than ``GIANT`` whatever the data, are placed first, so that none
overfills a split. All others are hashed into shards of about ``SHARD`` components, and
every component of every shard is moved singly, towards what the giants left of each
split; shards and chains run side by side, and their number grows with the data.

Defined results: a null or blank handle or source, and the source ``unknown``, tie
nothing; a row with neither is a component of its own; null labels count as a label;
an empty table gives an empty result; repeated rows go together.
"""

from __future__ import annotations

import math
import random

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dictaspark.operators.components import connected_components
from dictaspark.operators.skew import join_hot_split
from dictaspark.session import checkpoint, ship

HANDLE = r"^(.+?)(?:-\d{14}-[0-9a-f]{6})?-\d{4}-\d{2}-\d+$"
SPLITS = ("train", "validation", "test")
SHARES = (0.8, 0.1, 0.1)
GIANT = 1000
SHARD = 2000
CHAINS = 8
LEAST_STEPS, STEPS_A_UNIT = 4000, 12
PAIR_BLOCK = 256


def handle_of(record_id: Column) -> Column:
    """The handle in ``<handle>[-<stamp>-<hex>]-<YYYY-MM>-<number>``, lower case; null when there is none."""
    return F.nullif(F.regexp_extract(F.lower(F.trim(record_id)), HANDLE, 1), F.lit(""))


def source_of(source: Column) -> Column:
    name = F.lower(F.trim(source))
    return F.when(~name.isin("", "unknown"), name)


def tied(rows: DataFrame, row_id: str, record_id: str, source: str, label: str) -> DataFrame:
    """``(row_id, tie, handle, src, label)``; tie is the node that stands for the row in the graph."""
    out = rows.select(
        F.col(row_id).alias("row_id"), handle_of(F.col(record_id)).alias("handle"),
        source_of(F.col(source)).alias("src"), F.lower(F.trim(F.col(label))).alias("label"),
    )
    return out.withColumn("tie", F.coalesce(
        F.concat(F.lit("h:"), "handle"), F.concat(F.lit("s:"), "src"), F.concat(F.lit("r:"), F.col("row_id").cast("string"))))


def _start(key: str) -> int:
    at, draw = 0, random.Random(f"split|{key}").random()
    while at < len(SHARES) - 1 and draw >= SHARES[at]:
        draw -= SHARES[at]
        at += 1
    return at


Unit = tuple[str, dict[str, float]]


def anneal(units: list[Unit], chain: int, shares: tuple[float, ...] = SHARES, room: list[float] | None = None, steps: int | None = None) -> tuple[float, list[int]]:
    """Best cost and assignment of one chain: deviation of sizes plus, lighter, of labels, in shares of all rows.

    With ``room`` only what exceeds the room of a split costs, as smaller units will fill the rest.
    """
    if not units:
        return 0.0, []
    weight = [sum(x.values()) for _, x in units]
    total = sum(weight) or 1.0
    by_label: dict[str, float] = {}
    for _, x in units:
        for label, n in x.items():
            by_label[label] = by_label.get(label, 0.0) + n
    goal = [share * total for share in shares] if room is None else room
    steps = max(LEAST_STEPS, STEPS_A_UNIT * len(units)) if steps is None else steps
    place = [_start(key) for key, _ in units]
    sizes = [0.0] * len(shares)
    labels: list[dict[str, float]] = [{label: -share * n for label, n in by_label.items()} for share in shares]

    def size_cost(s: int) -> float:
        over = sizes[s] - goal[s]
        return abs(over) if room is None else max(0.0, over)

    def shift(unit: int, to: int) -> float:
        """Moves a unit and gives the change of cost."""
        at = place[unit]
        change = -size_cost(at) - size_cost(to)
        sizes[at] -= weight[unit]
        sizes[to] += weight[unit]
        change += size_cost(at) + size_cost(to)
        a, b = labels[at], labels[to]
        for label, n in units[unit][1].items():
            change += 0.25 * (abs(a[label] - n) - abs(a[label]) + abs(b[label] + n) - abs(b[label]))
            a[label] -= n
            b[label] += n
        place[unit] = to
        return change

    for at, w, (_, x) in zip(place, weight, units):
        sizes[at] += w
        for label, n in x.items():
            labels[at][label] += n
    now = sum(size_cost(s) + 0.25 * sum(map(abs, labels[s].values())) for s in range(len(shares)))
    rng = random.Random(f"chain|{chain}")
    best, kept = now, list(place)
    for step in range(steps):
        heat = 0.02 * total * math.exp(-8.0 * step / steps)
        i = rng.randrange(len(units))
        was = place[i]
        if step % 2 or len(units) < 2:
            to = rng.randrange(len(shares))
            if to == was:
                continue
            change, back = shift(i, to), [(i, was)]
        else:
            j = rng.randrange(len(units))
            if place[j] == was:
                continue
            other = place[j]
            change = shift(i, other) + shift(j, was)
            back = [(j, other), (i, was)]
        if change <= 0 or rng.random() < math.exp(-change / heat):
            now += change
            if now < best - 1e-9 * total:
                best, kept = now, list(place)
        else:
            for unit, home in back:
                shift(unit, home)
    return best / total, kept


def _chain(shares: tuple[float, ...], room: list[float] | None):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("component")
        units = [(u, {str(x["label"]): float(x["n"]) for x in counts}) for u, counts in zip(pdf["component"], pdf["labels"])]
        cost, place = anneal(units, int(pdf["chain"].iloc[0]), shares, room)
        return pd.DataFrame({"shard": pdf["shard"], "chain": pdf["chain"], "component": pdf["component"], "cost": cost, "split": [SPLITS[k] for k in place]})

    return run


def _search(units: DataFrame, shards: int, shares: tuple[float, ...], room: list[float] | None = None) -> DataFrame:
    """``(component, split)`` by the best chain of each shard; a shard and chain is one task's group."""
    tries = units.withColumn("chain", F.explode(F.sequence(F.lit(0), F.lit(CHAINS - 1)))).repartition(CHAINS * shards, "shard", "chain")
    tried = checkpoint(tries.groupBy("shard", "chain").applyInPandas(_chain(shares, room), "shard int, chain int, component string, cost double, split string"))
    best = tried.groupBy("shard").agg(F.min_by("chain", F.struct("cost", "chain")).alias("chain"))
    return tried.join(best, ["shard", "chain"]).select("component", "split")


def place(comps: DataFrame, total: int) -> DataFrame:
    """``(component, split)`` of every component of ``comps(component, n, labels)``."""
    giants = comps.filter(F.col("n") * GIANT > total).withColumn("shard", F.lit(0))
    rest = comps.filter(F.col("n") * GIANT <= total)
    placed = checkpoint(_search(giants, 1, SHARES, [share * total for share in SHARES]))
    taken = {r["split"]: r["n"] for r in placed.join(giants, "component").groupBy("split").agg(F.sum("n").alias("n")).collect()}
    left = [max(0.0, share * total - taken.get(name, 0)) for share, name in zip(SHARES, SPLITS)]
    shares = tuple(x / sum(left) for x in left) if sum(left) else SHARES
    shards = max(1, math.ceil(rest.count() / SHARD))
    small = rest.withColumn("shard", F.pmod(F.xxhash64("component"), F.lit(shards)).cast("int"))
    return placed.unionByName(_search(small, shards, shares))


def assign(rows: DataFrame, row_id: str = "row_id", record_id: str = "id", source: str = "source", label: str = "lang") -> tuple[DataFrame, DataFrame]:
    """``(row_id, component, split)`` of every row, and ``(tie, component, split, n)`` of every node that stands for rows."""
    ship(rows.sparkSession)
    ties = tied(rows, row_id, record_id, source, label)
    counted = checkpoint(ties.groupBy("tie", "src", F.coalesce("label", F.lit("?")).alias("label")).agg(F.count("*").alias("n")))
    edges = counted.select(F.col("tie").alias("u"), F.coalesce(F.concat(F.lit("s:"), "src"), "tie").alias("v")).distinct()
    nodes = checkpoint(connected_components(edges).select(F.col("node").alias("tie"), F.col("root").alias("component")))
    labelled = checkpoint(counted.groupBy("tie", "label").agg(F.sum("n").alias("n")).join(nodes, "tie"))
    parts = labelled.groupBy("component", "label").agg(F.sum("n").alias("n"))
    comps = checkpoint(parts.groupBy("component").agg(F.sum("n").alias("n"), F.collect_list(F.struct("label", "n")).alias("labels")))
    total = comps.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    weights = labelled.groupBy("tie", "component").agg(F.sum("n").alias("n"))
    placed = checkpoint(weights.join(place(comps, total), "component").select("tie", "component", "split", "n"))
    keyed = ties.select("row_id", "tie")
    return join_hot_split(keyed, placed, ["tie"], "n", total).select("row_id", "component", "split"), placed


def tied_handles(placed: DataFrame) -> DataFrame:
    """Pairs of different handles that the search moved together, smaller first.

    The result holds every pair, as its definition asks. One side of a component is dealt
    out in blocks of ``PAIR_BLOCK`` handles, so that no task meets all pairs of a large one.
    """
    handles = placed.filter(F.col("tie").startswith("h:")).select("component", "split", F.substring("tie", 3, 1 << 30).alias("handle"))
    sizes = handles.groupBy("component", "split").agg(F.ceil(F.count("*") / PAIR_BLOCK).cast("int").alias("blocks"), F.count("*").alias("handles")).filter("handles > 1")
    known = handles.join(sizes.drop("handles"), ["component", "split"])
    left = known.select("component", "split", F.pmod(F.xxhash64("handle"), F.col("blocks")).cast("int").alias("block"), F.col("handle").alias("handle_a"))
    right = known.select("component", "split", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("handle").alias("handle_b"))
    return left.join(right, ["component", "split", "block"]).filter("handle_a < handle_b").select("handle_a", "handle_b")
