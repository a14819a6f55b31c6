"""Segmentation: gap and size cuts, greedy bins, sentence packing, consecutive windows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dictaspark.functions import text as t
from dictaspark.session import ship


def gap_islands(rows: DataFrame, key: str, at: Column, gap_s: float) -> DataFrame:
    """Numbers the runs of a key that are cut where the silence between timestamps is longer than ``gap_s`` seconds."""
    order = Window.partitionBy(key).orderBy(at, *[F.col(c) for c in sorted(rows.columns)])
    micros = F.unix_micros(at.cast("timestamp"))
    jump = micros - F.lag(micros).over(order) > int(gap_s * 1_000_000)
    return rows.withColumn("_new", F.coalesce(jump, F.lit(False)).cast("int")).withColumn(
        "island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def sized_islands(segments: Column, most_words: int = 110, silence_s: float = 3.0, least_words: int = 8) -> Column:
    """Units of one track's ``array<struct<start,end,transcript,n_words>>``: cut on size or silence, short ones dropped."""
    unit = "struct<start:double,end:double,words:int,text:string>"
    empty = F.struct(F.array().cast(f"array<{unit}>").alias("done"), F.lit(None).cast(unit).alias("open"))

    def step(a: Column, s: Column) -> Column:
        alone = F.struct(s["start"].alias("start"), s["end"].alias("end"), s["n_words"].alias("words"), s["transcript"].alias("text"))
        o = a["open"]
        cut = o.isNull() | (o["words"] + s["n_words"] > most_words) | (s["start"] - o["end"] > silence_s)
        grown = F.struct(o["start"].alias("start"), s["end"].alias("end"), (o["words"] + s["n_words"]).alias("words"), F.concat_ws(" ", o["text"], s["transcript"]).alias("text"))
        done = F.when(cut & o.isNotNull(), F.concat(a["done"], F.array(o))).otherwise(a["done"])
        return F.struct(done.alias("done"), F.when(cut, alone).otherwise(grown).alias("open"))

    units = F.aggregate(F.array_sort(segments), empty, step, lambda a: F.concat(a["done"], F.array_compact(F.array(a["open"]))))
    return F.filter(units, lambda u: u["words"] >= least_words)


def _bin(pdf: pd.DataFrame, close_words: int, close_s: float, cap: int, least: int) -> pd.DataFrame:
    pdf = pdf.sort_values("idx", kind="stable")
    number, words, seconds, out = 0, 0, 0.0, []
    for w, s in zip(pdf["words"].fillna(0), pdf["duration_s"].fillna(0.0)):
        if words and words + w > cap:
            number, words, seconds = number + 1, 0, 0.0
        out.append(number)
        words, seconds = words + int(w), seconds + float(s)
        if words >= close_words or seconds >= close_s:
            number, words, seconds = number + 1, 0, 0.0
    pdf = pdf.assign(unit=out)
    tail = pdf[pdf["unit"] == pdf["unit"].max()]
    if int(tail["words"].fillna(0).sum()) < least:
        pdf = pdf[pdf["unit"] != tail["unit"].iloc[0]]
    return pdf[["paragraph_id", "audio_id", "idx", "unit"]]


def utterance_bins(rows: DataFrame, close_words: int = 35, close_s: float = 60.0, cap: int = 100, least: int = 8) -> DataFrame:
    """Greedy units of a paragraph's utterances: closed on words or seconds, capped before adding, short tails dropped."""
    ship(rows.sparkSession)
    flat = rows.select("paragraph_id", "audio_id", "idx", "words", "duration_s")
    return flat.groupBy("paragraph_id").applyInPandas(
        lambda pdf: _bin(pdf, close_words, close_s, cap, least), "paragraph_id string, audio_id string, idx int, unit int")


def pack_sentences(text: Column, target: int = 110, most: int = 260, least: int = 6) -> Column:
    """Greedy pieces of whole sentences of about ``target`` words; pieces under ``least`` words dropped."""
    empty = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("text"), F.lit(0).alias("n"))

    def step(a: Column, s: Column) -> Column:
        w = t.word_count(s)
        flush = (a["n"] > 0) & (a["n"] + w > target)
        done = F.when(flush, F.concat(a["done"], F.array(a["text"]))).otherwise(a["done"])
        text_ = F.when(flush | (a["n"] == 0), s).otherwise(F.concat_ws(" ", a["text"], s))
        n = F.when(flush, w).otherwise(a["n"] + w)
        full = n >= most
        return F.struct(F.when(full, F.concat(done, F.array(text_))).otherwise(done).alias("done"),
                        F.when(full, F.lit("")).otherwise(text_).alias("text"), F.when(full, F.lit(0)).otherwise(n).alias("n"))

    pieces = F.aggregate(t.sentences(F.coalesce(text, F.lit(""))), empty, step, lambda a: F.when(a["n"] > 0, F.concat(a["done"], F.array(a["text"]))).otherwise(a["done"]))
    return F.filter(pieces, lambda p: t.word_count(p) >= least)


def consecutive_windows(rows: DataFrame, key: str, rank: str, words: str, size: int, most: int = 260, tie: str | None = None) -> DataFrame:
    """Starts of ``size`` rows whose ranks follow one another and whose words add up to at most ``most``; ``tie`` orders equal ranks."""
    order = Window.partitionBy(key).orderBy(rank, *([tie] if tie else []))
    total, contiguous = F.col(words), F.lit(True)
    for k in range(1, size):
        total = total + F.lead(words, k).over(order)
        contiguous = contiguous & (F.lead(rank, k).over(order) == F.col(rank) + k)
    return rows.withColumn("total_words", total).withColumn("_ok", contiguous).filter(F.col("_ok") & (F.col("total_words") <= most)).drop("_ok")
