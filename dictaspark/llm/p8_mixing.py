"""Mixing sources to target weights: temperature mixing with a repetition limit.

Method: natural token shares are exponentiated towards the targets, q(a) in proportion to
natural ** (1 - a) * target ** a, so that a = 0 takes every document once and a = 1 gives
the targets. The exponent is bisected to the largest one at which no source exceeds its
repetition limit (``max_repeats`` times its tokens). A source that meets its limit is held
there, what it cannot give is shared out among the others, and the bisection goes on for
them until the exponent is 1 or no source is left. Each source's last exponent is its own;
a source whose realised weight stays under its target misses its share. With ``entropy``
the exponent is bisected to that entropy of the mix instead, under the same limits; without
``share_out`` all sources stop at the exponent at which the first meets its limit. The
weights are realised as budgeted block permutations: each source's documents are hashed
into blocks, whole passes are repeats, and the last pass takes blocks in order up to the
budget, the boundary block document by document.

Sizes are tokens of a public byte-level tokenizer read from ``tokenizer`` on the workers.
The targets are a configuration table and are read by the driver, with two numbers a
source; they meet the documents by a join whose broadcast Spark decides by its size.

Defined results: source names are compared trimmed and in lower case; null sources and
sources without a target are left out; null text has 0 tokens; every row counts, repeats
too; a target without documents misses its share unless that is 0; null ``max_repeats``
counts as 1; repeated targets of a source raise an error; empty tables give empty results.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dictaspark.session import checkpoint, ship

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ROUNDS = 60
BLOCK_DOCS = 64
MAX_BLOCKS = 65_536
_LOADED: dict = {}


def encoder(path: str):
    """The tokenizer at this path, loaded once a worker."""
    if path not in _LOADED:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _LOADED[path] = tiktoken.Encoding("mix", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def _counter(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path).encode_ordinary
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "source_name": pdf["source_name"], "tokens": [len(encode(t)) if t else 0 for t in pdf["text"]]})

    return run


def sized(documents: DataFrame, targets: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """``(doc_id, source_name, tokens)`` of every document whose source has a target; materialised."""
    ship(documents.sparkSession)
    docs = documents.select("doc_id", F.lower(F.trim("source")).alias("source_name"), "text")
    wanted = targets.select(F.lower(F.trim("source_name")).alias("source_name")).distinct()
    kept = docs.join(wanted, "source_name", "left_semi").select("doc_id", "source_name", "text")
    return checkpoint(kept.mapInPandas(_counter(tokenizer), "doc_id bigint, source_name string, tokens bigint"))


def tempered(natural: np.ndarray, target: np.ndarray, a: float) -> np.ndarray:
    """Normalised weights at exponent ``a``; sources without tokens or target weigh nothing, but at a = 0 the target does not count."""
    live = (natural > 0) & ((target > 0) | (a == 0))
    q = np.zeros(len(natural))
    q[live] = np.exp((1 - a) * np.log(natural[live]) + (a * np.log(target[live]) if a else 0.0))
    return q / q.sum() if live.any() else q


def bisect(fits: Callable[[float], bool], low: float, high: float) -> float:
    """Largest exponent in [low, high] that fits, given that fitting ends once and ``low`` fits."""
    if fits(high):
        return high
    for _ in range(ROUNDS):
        mid = (low + high) / 2
        low, high = (mid, high) if fits(mid) else (low, mid)
    return low


def entropy_of(q: np.ndarray) -> float:
    q = q[q > 0]
    return float(-(q * np.log(q)).sum())


def weights(natural: np.ndarray, target: np.ndarray, limit: np.ndarray, entropy: float | None = None, share_out: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Realised weight and own exponent of every source.

    ``limit`` is the largest weight a source can give, at least its natural one. Weights add
    up to 1 unless all sources are at their limits. Without ``share_out`` the first limit met
    stops all sources at one exponent.
    """
    n = len(natural)
    held, weight, own, at = np.zeros(n, bool), np.zeros(n), np.zeros(n), 0.0
    goal = 1.0
    if entropy is not None:
        # the entropy on the way from the natural shares to the targets may rise or fall: a grid brackets the first crossing
        start = entropy_of(tempered(natural, target, 0.0)) - entropy
        grid = np.linspace(0, 1, 101)
        cross = next((k for k in range(1, 101) if (entropy_of(tempered(natural, target, grid[k])) - entropy) * start <= 0), None)
        if cross is not None:
            goal = bisect(lambda a: (entropy_of(tempered(natural, target, a)) - entropy) * start > 0, grid[cross - 1], grid[cross])
    while True:
        free = ~held
        left = max(0.0, 1.0 - weight[held].sum())
        open_ = np.where(free, natural, 0.0)

        def at_exponent(a: float) -> np.ndarray:
            return left * tempered(open_, target, a)  # noqa: B023

        def fits(a: float) -> bool:
            return bool((at_exponent(a) <= limit * (1 + 1e-9)).all())

        if not fits(at):  # what was shared out already exceeds a limit here
            over = at_exponent(at) > limit * (1 + 1e-9)
        else:
            at = bisect(fits, at, goal)
            q = at_exponent(at)
            own[free], weight[free] = at, q[free]
            if not share_out:
                break
            if at >= goal:
                # a source held on the way is free again where its share at the goal is below its limit; the others' part then only grows
                live = free & (q > 0)
                part = float(q[live].sum() / tempered(natural, target, at)[live].sum()) if live.any() else np.inf
                under = held & np.isfinite(part) & ((part if np.isfinite(part) else 0.0) * tempered(natural, target, at) < limit * (1 - 1e-9))
                if not under.any():
                    break
                held &= ~under
                continue
            step = min(goal, at + 1e-6)
            over = at_exponent(step) > limit * (1 + 1e-9)
            if not over.any():  # rising too slowly to show: the one nearest its limit
                over = (at_exponent(step) / np.maximum(limit, 1e-300) >= 1 - 1e-6) & (at_exponent(step) >= q) & (q > 0)
        if not over.any():
            break
        own[over] = at
        weight[over] = limit[over]
        held |= over
        if not ((natural > 0) & ~held).any():
            break
    return weight, own


def plan(docs: DataFrame, targets: DataFrame, entropy: float | None = None, share_out: bool = True) -> list[dict]:
    """Budget, realised weight and exponent of every source with a target."""
    sums = {r["source_name"]: r for r in docs.groupBy("source_name").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")).collect()}
    wanted = targets.select(F.lower(F.trim("source_name")).alias("s"), "target_share", "max_repeats").filter("s is not null").collect()
    if len({r["s"] for r in wanted}) != len(wanted):
        raise ValueError("a source has several targets")
    total = sum(r["tokens"] for r in sums.values())
    out = []
    for r in sorted(wanted, key=lambda r: r["s"]):
        have = sums.get(r["s"])
        tokens, count = (have["tokens"], have["docs"]) if have else (0, 0)
        times = 1 if r["max_repeats"] is None else r["max_repeats"]
        out.append({"source_name": r["s"], "tokens": tokens, "docs": count, "target_share": r["target_share"] or 0.0, "max_repeats": times})
    column = lambda name: np.array([float(x[name]) for x in out])
    natural = column("tokens") / max(total, 1)
    weight, own = weights(natural, column("target_share"), natural * column("max_repeats"), entropy, share_out)
    for x, w, a in zip(out, weight, own):
        x["weight"], x["exponent"] = float(w), float(a)
        x["budget"] = min(int(round(w * total)), x["tokens"] * x["max_repeats"])
        x["missed"] = bool(w < x["target_share"] * (1 - 1e-6))
    return out


def shortfalls(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """Sources whose realised weight stays under their target because they met their repetition limit."""
    return docs.sparkSession.createDataFrame([(x["source_name"],) for x in plan(docs, targets) if x["missed"]], "source_name string")


def mixture(docs: DataFrame, targets: DataFrame, seed: int = 17, entropy: float | None = None, share_out: bool = True, rows: list[dict] | None = None) -> DataFrame:
    """``(doc_id, source_name, tokens, repeats)`` of the chosen documents."""
    rows = plan(docs, targets, entropy, share_out) if rows is None else rows
    spark = docs.sparkSession
    budget = spark.createDataFrame(
        [(x["source_name"], x["budget"] // x["tokens"], x["budget"] % x["tokens"], max(1, min(MAX_BLOCKS, x["docs"] // BLOCK_DOCS))) for x in rows if x["tokens"]],
        "source_name string, passes bigint, rest bigint, blocks int")
    keyed = docs.join(budget, "source_name").withColumn("draw", F.xxhash64(F.lit(seed), "doc_id")).withColumn("block", F.pmod("draw", "blocks").cast("int"))
    sums = keyed.groupBy("source_name", "block").agg(F.sum("tokens").alias("size"), F.first("rest").alias("rest"))
    run = Window.partitionBy("source_name").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    ends = checkpoint(sums.withColumn("upto", F.sum("size").over(run)).select("source_name", "block", (F.col("upto") - F.col("size")).alias("since"), "upto"))
    placed = keyed.join(ends, ["source_name", "block"])
    whole = placed.filter("upto <= rest").withColumn("repeats", F.col("passes") + 1)
    after = placed.filter("since >= rest").withColumn("repeats", F.col("passes"))
    order = Window.partitionBy("source_name", "block").orderBy("draw", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    edge = placed.filter("since < rest and upto > rest").withColumn("till", F.col("since") + F.sum("tokens").over(order))
    edge = edge.withColumn("repeats", F.col("passes") + F.when(F.col("till") <= F.col("rest"), 1).otherwise(0)).drop("till")
    chosen = whole.unionByName(after).unionByName(edge)
    return chosen.filter("repeats > 0").select("doc_id", "source_name", "tokens", F.col("repeats").cast("int").alias("repeats"))


def shares(docs: DataFrame, targets: DataFrame, entropy: float | None = None, share_out: bool = True) -> DataFrame:
    """Target, planned and reached share of every source of the mix's size, whether it misses its target, and its exponent."""
    rows = plan(docs, targets, entropy, share_out)
    total = sum(x["tokens"] for x in rows)
    spent = mixture(docs, targets, rows=rows).groupBy("source_name").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("spent"))
    base = docs.sparkSession.createDataFrame(
        [(x["source_name"], float(x["target_share"]), x["weight"], x["missed"], x["exponent"]) for x in rows],
        "source_name string, target_share double, weight double, missed boolean, exponent double")
    return base.join(spent, "source_name", "left").select(
        "source_name", "target_share", "weight", (F.coalesce("spent", F.lit(0)) / F.lit(max(total, 1))).alias("reached_share"), "missed", "exponent")
