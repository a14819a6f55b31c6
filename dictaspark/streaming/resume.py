"""Incremental processing: what was done is not done again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def pending(rows: DataFrame, done: DataFrame, key: list[str], valid=None) -> DataFrame:
    """Rows without a valid result yet; failures are redone."""
    kept = done if valid is None else done.filter(valid)
    return rows.join(kept.select(*key).distinct(), key, "left_anti")


def file_stream(spark: SparkSession, folder: str, schema, per_trigger: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def run_once(stream: DataFrame, work, out: str, state: str) -> StreamingQuery:
    """Applies ``work`` to what is new since the checkpoint in ``state`` and appends it to ``out``.

    The file sink commits each batch once, so that a restart neither loses nor repeats rows.
    """
    return work(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start()


def windowed(stream: DataFrame, at: str, keys: list[str], size: str, late: str) -> DataFrame:
    """Counts by event-time window; rows later than the watermark are dropped by it."""
    return stream.withWatermark(at, late).groupBy(F.window(at, size).alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *keys, "n")


def sessions(stream: DataFrame, at: str, key: str, gap: str, late: str) -> DataFrame:
    """Gap sessions of a key."""
    return stream.withWatermark(at, late).groupBy(F.session_window(at, gap).alias("w"), key).agg(F.count("*").alias("n")).select(
        key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
