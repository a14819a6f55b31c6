"""Session helpers: tables, checkpoints and shipping of the package to executors."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = os.path.dirname(os.path.abspath(__file__))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables; a file or a folder of part files."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows of a scan with fewer partitions than cores, dealt out evenly; other scans stay as they are.

    For CPU-bound work on small files of one row group; large inputs never shuffle here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the session; one of our own only where none is named and all runs on this machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = getattr(context, "_dictaspark_checkpoints", None)
        if named is None:
            named = tempfile.mkdtemp(prefix="dictaspark-")
            context._dictaspark_checkpoints = named
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(named)
    return named


def checkpoint(df: DataFrame) -> DataFrame:
    """Cuts the lineage through files every executor can read."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship(spark: SparkSession) -> None:
    """Sends the package to the Python workers, once per context."""
    context = spark.sparkContext
    if getattr(context, "_dictaspark_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="dictaspark-pkg-")
    path = os.path.join(folder, "dictaspark_pkg.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for base, _, files in os.walk(_PACKAGE):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(base, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(_PACKAGE)))
    context.addPyFile(path)
    context._dictaspark_shipped = True
