"""Exact duplicates by content sort, in DataFrame operations only.

Sampled splitters range-partition the normalised texts, each partition is sorted (spilling as it
must), equal texts become neighbours, and a run of fully equal texts is one group. The range keys
are bounded prefixes, each with a hash that parts the texts of a common prefix, so the sample that the
driver sees stays small; the sort compares whole texts.

A text held by very many rows would make one long run. Digests above a count limit are found
first by a pre-aggregated count; their number is bounded by that limit. Runs of such texts are
split by a salt over several partitions, and what the count found joins the parts: for those texts
alone, the group's size and id go by the SHA-256 digest, not by comparing neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, cut, lower_ascii, table, without

#: A digest is hot above so many rows, and above this share of all rows: at most 1 / HOT_SHARE digests are.
HOT_ROWS, HOT_SHARE = 500, 1e-4
PREFIX = 48


OWN = ("_keep_id", "_group_size", "_kept", "_sha256", "_hot_sha", "_hot_n", "_hot_id", "_salt", "_key", "_hash", "_norm", "_first", "_run_id", "_run_n")


def exact_copies(docs: DataFrame, *, keep: str = "max", id_col: str = "doc_id", text_col: str = "text", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every row with _keep_id, _group_size, _kept and _sha256 (binary) of its group of equal texts.

    Texts are equal if they are identical after lower-casing A-Z. `keep` says which id stays, "max"
    or "min". Null texts count as empty. Null ids never win over others; of rows that share the
    winning id, or of a group without ids, one arbitrary row stays. All columns are kept, but for
    those that have the names of results or of helpers (OWN).
    """
    docs = without(docs, *OWN)
    rows = docs.count()
    limit = max(hot_rows, int(rows * HOT_SHARE))
    norm = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    best = F.max if keep == "max" else F.min
    hashed = docs.withColumn("_sha256", F.unhex(F.sha2(norm, 256)))
    hot = (
        hashed.groupBy(F.col("_sha256").alias("_hot_sha"))
        .agg(F.count(F.lit(1)).alias("_hot_n"), best(id_col).alias("_hot_id"))
        .where(F.col("_hot_n") > limit)
    )
    hot = broadcast_if_small(cut(hot), int(1 / HOT_SHARE))  # no more can be above the limit
    salted = (
        hashed.join(hot, F.col("_sha256") == F.col("_hot_sha"), "left")
        .withColumn("_salt", F.when(F.col("_hot_n").isNotNull(), F.pmod(F.xxhash64(id_col), F.ceil(F.col("_hot_n") / limit))).otherwise(F.lit(0).cast("long")))
        .withColumn("_key", F.substring(norm, 1, PREFIX))
        .withColumn("_hash", F.xxhash64("_sha256"))
        .repartitionByRange("_key", "_hash", "_salt")
        .withColumn("_norm", norm)
    )
    run = Window.partitionBy("_key", "_hash", "_norm", "_salt")
    order = F.col(id_col).desc_nulls_last() if keep == "max" else F.col(id_col).asc_nulls_last()
    return (
        salted.withColumns({"_first": F.row_number().over(run.orderBy(order)), "_run_id": F.first(id_col).over(run.orderBy(order))})
        .withColumn("_run_n", F.count(F.lit(1)).over(run))
        .withColumn("_keep_id", F.when(F.col("_hot_n").isNull(), F.col("_run_id")).otherwise(F.col("_hot_id")))
        .withColumn("_group_size", F.coalesce("_hot_n", "_run_n"))
        .withColumn("_kept", (F.col("_first") == 1) & F.col(id_col).eqNullSafe(F.col("_keep_id")))
        .select(*[F.col(f"`{c}`") for c in docs.columns], "_keep_id", "_group_size", "_kept", "_sha256")
    )


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_copies(docs).select(
        "doc_id",
        F.col("_keep_id").alias("keep_id"),
        F.col("_group_size").alias("group_size"),
        F.col("_kept").alias("kept"),
        F.lower(F.hex("_sha256")).alias("text_sha256"),
    )


ORACLE_OP4 = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""
