"""Benches of judges and models: blind comparison of two outputs, agreement of two judges, judging again."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dictaspark.functions import text as t
from dictaspark.operators.pipeline import verdict
from dictaspark.sources.readers import model_replies

SIDES = ("base", "candidate")


def blind(base: DataFrame, candidate: DataFrame, key: str, output: str, seed: str = "ab") -> DataFrame:
    """``(key, swap, a, b)`` of the ids both sides have, one row an id a side; the sides stand swapped for half of the ids by hash."""
    met = base.select(key, F.col(output).alias("_x")).join(candidate.select(key, F.col(output).alias("_y")), key)
    swap = t.hash_draw(seed, F.col(key)) % 2 == 1
    return met.select(key, swap.alias("swap"), F.when(swap, F.col("_y")).otherwise(F.col("_x")).alias("a"), F.when(swap, F.col("_x")).otherwise(F.col("_y")).alias("b"))


def decoded(judged: DataFrame, key: str) -> DataFrame:
    """``(key, winner, faults)`` of judged cases ``(key, swap, winner A/B/egalite, faults_a, faults_b)``: sides by name, each fault with its side."""
    side = lambda shown_a: F.when(F.col("swap") == F.lit(not shown_a), SIDES[0]).otherwise(SIDES[1])
    winner = F.when(F.col("winner") == "A", side(True)).when(F.col("winner") == "B", side(False)).otherwise("egalite")
    named = lambda column, shown_a: F.transform(F.filter(F.coalesce(column, F.array().cast("array<string>")), lambda x: x != "aucune"), lambda x: F.struct(side(shown_a).alias("side"), x.alias("fault")))
    return judged.select(key, winner.alias("winner"), F.concat(named(F.col("faults_a"), True), named(F.col("faults_b"), False)).alias("faults"))


def tally(cases: DataFrame) -> DataFrame:
    """``(what, side, n)``: wins by side, and faults by kind and side."""
    wins = cases.groupBy(F.lit("win").alias("what"), F.col("winner").alias("side")).agg(F.count("*").alias("n"))
    faults = cases.select(F.explode("faults").alias("f")).groupBy(F.col("f.fault").alias("what"), F.col("f.side").alias("side")).agg(F.count("*").alias("n"))
    return wins.unionByName(faults)


def aligned(first: DataFrame, second: DataFrame, key: str = "id") -> DataFrame:
    """``(key, a, b)``: verdicts of two judges on the ids both judged; each side has one row an id."""
    return first.select(key, verdict(F.col("verdict")).alias("a")).join(second.select(key, verdict(F.col("verdict")).alias("b")), key)


def rejudge(rows: DataFrame, reference: DataFrame, key: str, candidate: str, known: str, client: Callable, most: int = 4000) -> DataFrame:
    """Verdicts on rows that have a reference, by a client shown both texts, each cut in the middle to half of ``most`` characters."""
    clip = lambda c: t.clip_middle(F.coalesce(c, F.lit("")), most // 2)
    met = rows.select(key, F.col(candidate).alias("_c")).join(reference.select(key, F.col(known).alias("_k")), key)
    asked = met.select(key, F.format_string("REFERENCE:\n%s\n\nCANDIDATE:\n%s", clip(F.col("_k")), clip(F.col("_c"))).alias("prompt"))
    reply = F.from_json(t.json_salvage(F.col("reply")), "verdict string, causes array<string>")
    return model_replies(asked, key, "prompt", client).withColumn("_r", reply).select(
        key, F.coalesce(verdict(F.col("_r.verdict")), F.lit("?")).alias("verdict"), F.coalesce("_r.causes", F.array().cast("array<string>")).alias("causes"))


def verdict_summary(judged: DataFrame) -> DataFrame:
    """``(what, n)``: rows of each verdict, and of each cause among KO."""
    verdicts = judged.groupBy(F.col("verdict").alias("what")).agg(F.count("*").alias("n"))
    causes = judged.filter("verdict = 'KO'").select(F.explode(F.transform("causes", F.lower)).alias("what")).groupBy("what").agg(F.count("*").alias("n"))
    return verdicts.unionByName(causes)


def wait_for(available: Callable[[], tuple[str | None, str]], poll_s: float = 120.0, say: Callable[[str], None] = print, sleep: Callable[[float], None] = time.sleep) -> str:
    """Name of the first provider that answers; asks again every ``poll_s`` seconds and tells a reason once while it stays."""
    told = None
    while True:
        name, detail = available()
        if name:
            return name
        if detail != told:
            say(f"no provider: {detail}")
            told = detail
        sleep(poll_s)
