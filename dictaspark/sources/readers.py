"""Scans. Line numbers come from one pass over each file in order; nothing is inferred."""

from __future__ import annotations

import os
import re
import sqlite3
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dictaspark.operators.dedup import keep_last


def strict_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A bad line raises when the rows are read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def lenient_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A bad line is left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def raw_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every line with ``raw``; a bad line keeps its text and has null fields."""
    lines = spark.read.text(path).withColumnRenamed("value", "raw")
    return lines.withColumn("_r", F.from_json("raw", schema)).select("raw", "_r.*")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(path, file_rank, line, raw)`` with lines from 1: each file is read whole by one task, so files set the parallelism."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    rows = whole.select("path", F.posexplode(F.split(F.regexp_replace("value", "\\r?\\n$", ""), "\\r?\\n")).alias("line", "raw"))
    ranks = rows.select("path").distinct().withColumn("file_rank", F.dense_rank().over(_by_path()))
    return rows.join(F.broadcast(ranks), "path").select("path", "file_rank", (F.col("line") + 1).alias("line"), "raw").filter("raw <> ''")


def _by_path():
    from pyspark.sql.window import Window

    return Window.orderBy("path")


def reporting_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Numbered lines with their fields and, for a bad line, ``error``."""
    rows = numbered_lines(spark, path).withColumn("_r", F.from_json("raw", schema)).withColumn("_k", F.json_object_keys("raw"))
    return rows.select("path", "file_rank", "line", "raw", F.when(F.col("_k").isNull(), "not a JSON object").alias("error"), "_r.*")


def keyed_jsonl(spark: SparkSession, path: str, schema: T.StructType, key: str = "id") -> DataFrame:
    """The last row of every key in file and line order."""
    rows = reporting_jsonl(spark, path, schema).filter("error is null").drop("raw", "error", "path")
    return keep_last(rows, key, ["file_rank", "line"]).drop("file_rank", "line")


def parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Projected scan; filters put on the result are pushed into the files."""
    rows = spark.read.parquet(path)
    return rows.select(*columns) if columns else rows


def word_list(spark: SparkSession, path: str) -> DataFrame:
    """Lower-case entries of a list file; blank lines and ``#`` comments left out."""
    return spark.read.text(path).select(F.lower(F.trim("value")).alias("word")).filter("word <> '' and not startswith(word, '#')").distinct()


def json_set(spark: SparkSession, path: str) -> DataFrame:
    """Members of a JSON array file."""
    return spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "array<string>")).alias("member")).distinct()


def selected_files(folder: str, pattern: str) -> list[str]:
    """Sorted .jsonl paths under a folder that match a glob; an error when there are none."""
    import fnmatch

    found = []
    for base, _, names in os.walk(folder):
        for name in names:
            relative = os.path.relpath(os.path.join(base, name), folder).replace(os.sep, "/")
            if name.endswith(".jsonl") and fnmatch.fnmatch(relative, pattern):
                found.append(os.path.join(folder, relative))
    if not found:
        raise FileNotFoundError(f"no .jsonl file matches {pattern}")
    return sorted(found)


def shards(names: list[str], split: str) -> list[str]:
    """Parquet shards of one split, sorted."""
    return sorted(n for n in names if os.path.basename(n).startswith(f"{split}-") and n.endswith(".parquet"))


@dataclass(frozen=True)
class Source:
    """``repository[@revision]:glob``; the revision defaults to main."""

    repository: str
    revision: str
    pattern: str

    @classmethod
    def parse(cls, value: str) -> Source:
        m = re.fullmatch(r"([^@:]+)(?:@([^:]+))?:(.+)", value.strip())
        if not m or not m[3].endswith(".jsonl"):
            raise ValueError(f"not a source: {value}")
        return cls(m[1], m[2] or "main", m[3])


def sqlite_table(spark: SparkSession, path: str, query: str, schema: str, batch: int = 2000) -> DataFrame:
    """Rows of a read-only SQLite query, streamed by one task in batches; JDBC needs a driver jar that may be missing."""
    names = spark.createDataFrame([], schema).columns

    def run(_: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
            cursor = db.execute(query)
            while rows := cursor.fetchmany(batch):
                yield pd.DataFrame(rows, columns=names)

    return spark.range(1, numPartitions=1).mapInPandas(run, schema)


def file_facts(spark: SparkSession, path: str) -> DataFrame:
    """``(path, bytes, modified)`` of files, without reading them."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def audio_seconds(spark: SparkSession, path: str) -> DataFrame:
    """Length of FLAC and WAV files from their headers by bit arithmetic; null for other files.

    FLAC: 20 bits of sample rate and 36 of samples from byte 18; WAV: data bytes over bytes a second.
    """
    head = F.hex(F.substring(F.col("content"), 1, 48))
    num = lambda a, n: F.conv(F.substring(head, 2 * a + 1, 2 * n), 16, 10).cast("bigint")
    little = lambda a: num(a, 1) + num(a + 1, 1) * 256 + num(a + 2, 1) * 65536 + num(a + 3, 1) * 16777216
    packed_rate = F.shiftright(num(18, 3), 4)
    samples = (num(21, 1).bitwiseAND(F.lit(15))) * 4294967296 + num(22, 4)
    magic = F.substring(head, 1, 8)
    seconds = (F.when((magic == "664C6143") & (packed_rate > 0), samples / packed_rate)
               .when((magic == "52494646") & (little(28) > 0), little(40) / little(28)))
    return spark.read.format("binaryFile").load(path).select("path", seconds.alias("seconds"))


def model_replies(rows: DataFrame, key: str, prompt: str, client) -> DataFrame:
    """A model as a row source: ``client(list of prompts) -> list of replies`` once a batch; an exception is a row's error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            try:
                replies, error = client(pdf["prompt"].tolist()), None
            except Exception as e:  # noqa: BLE001
                replies, error = [None] * len(pdf), str(e)
            yield pd.DataFrame({"key": pdf["key"], "reply": replies, "error": error})

    flat = rows.select(F.col(key).cast("string").alias("key"), F.col(prompt).alias("prompt"))
    return flat.mapInPandas(run, "key string, reply string, error string").withColumnRenamed("key", key)


def result_files(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """One row per JSON file of a glob, beside its path; a file that does not parse has null fields and is kept."""
    rows = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(pattern)
    return rows.select(F.col("_metadata.file_path").alias("path"), "*")


def first_lines(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The first n lines in file order."""
    return numbered_lines(spark, path).orderBy("file_rank", "line").limit(n)


def at_lines(rows: DataFrame, report: DataFrame) -> DataFrame:
    """Rows of ``numbered_lines`` that a report names by ``path`` and ``line``, with the report's other columns; a line out of range meets nothing."""
    return rows.join(report, ["path", "line"])


def prompt(folder: str, name: str, lang: str, override: str | None = None) -> str:
    """Text of a prompt file: the override where given, else the variant of the language, else the file itself; a missing one raises."""
    root, ending = os.path.splitext(name)
    local = os.path.join(folder, f"{root}_{lang}{ending}")
    path = override or (local if lang != "fr" and os.path.exists(local) else os.path.join(folder, name))
    with open(path, encoding="utf-8") as f:
        return f.read()
