"""Sinks: JSON lines, kept and rejected splits, resumable appends, manifests, reports."""

from __future__ import annotations

import hashlib
import json
import os
import shutil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def jsonl(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def by_status(rows: DataFrame, kept: Column, path: str) -> None:
    """Kept and rejected rows in one pass, as ``status=kept`` and ``status=rejected`` folders."""
    rows.withColumn("status", F.when(F.coalesce(kept, F.lit(False)), "kept").otherwise("rejected")).write.mode("overwrite").partitionBy("status").json(path)


def append_new(rows: DataFrame, done: DataFrame, key: list[str], path: str) -> None:
    """Appends the rows whose key is not done yet; running it again adds nothing."""
    rows.join(done.select(*key).distinct(), key, "left_anti").write.mode("append").json(path)


def ledger(rows: DataFrame, path: str) -> None:
    rows.withColumn("at", F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")).write.mode("append").json(path)


def report(row: DataFrame, path: str) -> None:
    """A one-row summary as one JSON file."""
    row.coalesce(1).write.mode("overwrite").json(path)


def one_line(row: DataFrame) -> DataFrame:
    return row.select(F.to_json(F.struct("*")).alias("line"))


def markdown(rows: DataFrame, title: str, most: int = 500) -> str:
    """A small aggregate as a Markdown table; more than ``most`` rows raise."""
    got = rows.limit(most + 1).collect()
    if len(got) > most:
        raise ValueError("a report is for small aggregates")
    head = "| " + " | ".join(rows.columns) + " |\n|" + "---|" * len(rows.columns)
    return "\n".join([f"## {title}", "", head, *("| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in got), ""])


def manifest(rows_path: str, spark) -> DataFrame:
    """``(path, bytes, sha256, lines)`` of every file under a path, hashed where it lies."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(rows_path)
    newlines = F.length(F.regexp_replace(F.decode("content", "ISO-8859-1"), "[^\n]", ""))
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), newlines.cast("bigint").alias("lines"))


def verify(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Files whose size or hash differ from the manifest, or that stand on one side only."""
    a, e = actual.select("path", F.col("bytes").alias("bytes"), "sha256"), expected.select("path", F.col("bytes").alias("want_bytes"), F.col("sha256").alias("want_sha256"))
    both = a.join(e, "path", "full")
    return both.filter(~(F.col("bytes").eqNullSafe(F.col("want_bytes")) & F.col("sha256").eqNullSafe(F.col("want_sha256"))))


def merged_jsonl(rows: DataFrame, order: list[str], path: str) -> str:
    """One compact JSON lines file in order, streamed through the driver line by line, and its sha256."""
    digest = hashlib.sha256()
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(f"{path}.part", "wb") as out:
        for r in rows.orderBy(*order).select(F.to_json(F.struct(*[c for c in rows.columns if c not in order]), {"ignoreNullFields": "false"}).alias("j")).toLocalIterator():
            line = (json.dumps(json.loads(r["j"]), ensure_ascii=False, separators=(",", ":")) + "\n").encode()
            digest.update(line)
            out.write(line)
    os.replace(f"{path}.part", path)
    return digest.hexdigest()


def fetch_once(origin: str, target: str) -> bool:
    """Copies a file under a temporary name, then renames; an existing target is left alone."""
    if os.path.exists(target):
        return False
    os.makedirs(os.path.dirname(os.path.abspath(target)), exist_ok=True)
    shutil.copyfile(origin, f"{target}.part")
    os.replace(f"{target}.part", target)
    return True


def two_outputs(rows: DataFrame, first: DataFrame, second: DataFrame, paths: tuple[str, str]) -> None:
    """Two outputs made from ``rows``, which is read once: it is kept until both are written."""
    rows.persist()
    try:
        jsonl(first, paths[0])
        jsonl(second, paths[1])
    finally:
        rows.unpersist()
