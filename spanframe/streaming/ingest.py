"""Incremental ingestion: files that arrived since the last run are ingested once, then the run ends."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import guards
from ..operators.ingest import ingest
from ..operators.storage import materialise
from ..schemas import INGEST
from ..sources import writers
from ..sources.readers import exists

_DONE = INGEST + ", batch long"


def published(spark: SparkSession, sink: str) -> DataFrame:
    """The records of all batches that were published, with their batch."""
    if not exists(spark, sink):
        return spark.createDataFrame([], _DONE)
    return spark.read.schema(_DONE).json(sink)


def rejected(spark: SparkSession, sink: str) -> DataFrame:
    """(pmid, reason, batch) of what was left out."""
    schema = "pmid string, reason string, batch long"
    return spark.read.schema(schema).json(f"{sink}.rejects") if exists(spark, f"{sink}.rejects") else spark.createDataFrame([], schema)


def publish_batch(docs: DataFrame, batch: int, sink: str, *, compose: bool = True) -> None:
    """Ingest and publish one batch of documents (pmid, title, abstract), once, however often it is tried.

    Rows are staged outside the sink, counted and checked, and moved to the batch's folder at last:
    if that folder is there, the batch is done, and a repeat does nothing; if it isn't, nothing of the batch
    is seen, and a repeat does all of it. Rejects and the manifest come before, and are written again.
    Documents whose id an earlier batch published, or that repeat one of the batch, are rejected: of
    equal ids in one batch the one with the smallest text hash stays. Every document that came is either
    published or rejected, or the batch fails.
    """
    spark, path = docs.sparkSession, f"{sink}/batch={batch}"
    if exists(spark, path):
        return
    docs = materialise(docs)
    good, bad = ingest(docs, compose=compose)
    good = materialise(good.withColumn("_key", F.monotonically_increasing_id()))
    first = good.groupBy("pmid").agg(F.min_by("_key", F.struct(F.xxhash64("fulltext"), "_key")).alias("_key"))
    before = published(spark, sink).where(F.col("batch") != batch).select("pmid").distinct()
    known = first.join(before, "pmid", "left_semi").select("_key")
    stays = first.join(known, "_key", "left_anti").select("_key")
    rows = good.join(stays, "_key", "left_semi").drop("_key")
    out = good.join(stays, "_key", "left_anti").join(before.withColumn("_seen", F.lit(True)), "pmid", "left")
    rejects = bad.select("pmid", "reason").unionByName(out.select("pmid", F.when(F.col("_seen"), "published before").otherwise("repeated in its batch").alias("reason")))
    staging = f"{sink}.staging/{batch}"
    n_bad = writers.publish(rejects, f"{sink}.rejects/batch={batch}", staging=f"{staging}-rejects")
    n_in = docs.count()
    writers.write_text(spark, f"{sink}.batches/{batch}.json", writers.batch_manifest("ingest", batch, n_in, n_bad))
    n = writers.publish(rows, path, lambda n: [guards.equal_counts("documents of a batch", n_in, n + n_bad)], staging=staging)
    if n_bad:
        logging.getLogger("spanframe").warning("batch %d: %d documents published, %d rejected", batch, n, n_bad)


def ingest_new(spark: SparkSession, source: str, sink: str, checkpoint: str, *, compose: bool = True, max_files: int | None = None) -> StreamingQuery:
    """Ingest records of JSON-lines documents (pmid, title, abstract) in files that no earlier run has seen.

    Which files are done is kept in the checkpoint folder; each batch, of at most max_files files, is published
    by its number (publish_batch), so a run that dies at any point loses and repeats nothing.
    """
    read = spark.readStream.schema("pmid string, title string, abstract string")
    docs = (read.option("maxFilesPerTrigger", max_files) if max_files else read).json(source)
    return docs.writeStream.foreachBatch(lambda df, k: publish_batch(df, k, sink, compose=compose)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
