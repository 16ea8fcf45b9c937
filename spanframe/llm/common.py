"""Helpers shared by the operators: tables, batches, shared storage, size-checked broadcasts."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of every contract: runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

#: Rows that Python workers get at a time: whole texts can be long, so batches stay small.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lower the rows of an Arrow batch, so that a worker holds few texts at a time; never raises it.

    Spark bounds the bytes of a batch by itself (spark.sql.execution.arrow.maxBytesPerBatch, 64 MB).
    It reads both when a plan runs, so the lower number has to stay for the session.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def lower_ascii(column):
    """Lower-case A-Z and nothing else; texts of ASCII alone take the builtin, which is the same there and faster."""
    return F.when(F.octet_length(column) == F.char_length(column), F.lower(column)).otherwise(F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def without(docs: DataFrame, *names: str) -> DataFrame:
    """Without columns that have the names that an operator uses for its own; results replace them."""
    own = {n.lower() for n in names}
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in own])


def _base(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only where it is unset and all runs on one machine, a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return "file://" + tempfile.mkdtemp(prefix="spanframe-")


def shared_dir(spark: SparkSession) -> str:
    """A new folder name in the storage that the driver and all executors share: in spark.checkpoint.dir."""
    base = _base(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return os.path.join(base, f"spanframe-{uuid.uuid4().hex}")


def cut(df: DataFrame) -> DataFrame:
    """Write to the shared folder and go on from there: lineage ends, lost executors cost nothing."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(_base(spark))
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a side that was just cut if it holds at most so many rows; else leave the join to a shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
