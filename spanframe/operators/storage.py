"""Cutting lineage by way of the storage that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _base(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only where that is unset and all runs on one machine, a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not spark.sparkContext.getCheckpointDir():
        base = base or "file://" + tempfile.mkdtemp(prefix="spanframe-")
        spark.sparkContext.setCheckpointDir(base)
    return base


def shared_dir(spark: SparkSession) -> str:
    """A new folder name in the storage that the driver and all executors share."""
    return f"{_base(spark)}/spanframe-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The same rows, computed once and read back from Parquet in the shared storage.

    For large tables: a checkpoint keeps rows as they lie in memory and reads all their columns. Version 2 of the
    format, without dictionaries, keeps offsets and ids as differences.
    """
    path = shared_dir(df.sparkSession)
    df.write.options(**{"compression": "zstd", "parquet.writer.version": "v2", "parquet.enable.dictionary": "false"}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise(df: DataFrame) -> DataFrame:
    """The same rows, computed once and read back from the session's checkpoint folder."""
    _base(df.sparkSession)
    return df.checkpoint(eager=True)
