"""Mixing sources to target weights, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, broadcast_if_small, cut, table, without

#: Sources, of which there is one row each, are broadcast up to this number.
BROADCAST_ROWS = 50_000


def targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), max_repeat: float = 3.0) -> DataFrame:
    """The target of each source, from one row (source, source_size) for each.

    Sources in code-point order, null last, take the weights in turn. All sizes together are shared
    by weight; a target stops at max_repeat times its source's size, and the excess is shared among
    the others until none is above. That is the level L at which sum(min(cap, weight * L)) is the
    total: with sources ordered by cap / weight, the first whose level, with all before it capped,
    stays under its own ratio gives L. One row for each source goes through one task.
    """
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("_at") - 1, F.lit(len(weights))).cast("int") + 1)
    by_ratio = Window.orderBy("_ratio", "_at")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    return (
        sizes.withColumn("_at", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
        .withColumn("_weight", turn)
        .withColumn("_cap", F.col("source_size") * F.lit(float(max_repeat)))
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
        .withColumns({"_capped": F.coalesce(F.sum("_cap").over(before), F.lit(0.0)), "_used": F.coalesce(F.sum("_weight").over(before), F.lit(0.0))})
        .withColumns({"_total": F.sum("source_size").over(everything), "_weights": F.sum("_weight").over(everything)})
        .withColumn("_level", (F.col("_total") - F.col("_capped")) / (F.col("_weights") - F.col("_used")))
        .withColumn("_open", F.when(F.col("_level") <= F.col("_ratio"), F.col("_level")))
        .withColumn("_final", F.coalesce(F.min_by("_open", F.when(F.col("_open").isNotNull(), F.struct("_ratio", "_at"))).over(everything), F.max("_ratio").over(everything)))
        .select("source", "source_size", F.least("_cap", F.col("_weight") * F.col("_final")).alias("target"))
    )


OWN = ("_size", "_source", "_source_size", "_target", "_rate", "_copies", "_copy")


def mix(
    docs: DataFrame, *, weights: Sequence[float] = (5, 2, 1), max_repeat: float = 3.0, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """Every row with _size, _source_size, _target and _copies, the number of times that the mix takes it.

    A source's rate is its target by its size. A document is taken floor(rate) times, and once more
    if a hash of its id and text falls under the fraction, so a rerun takes the same. Null texts
    have size 0; the null source is a source; rows of size 0 are taken like others. Identical rows
    are decided alike. All columns are kept, but for those that have the names of results or of
    helpers (OWN).
    """
    docs = without(docs, *OWN)
    sized = docs.withColumn("_size", F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long"))
    sizes = sized.groupBy(F.col(source_col).alias("source")).agg(F.sum("_size").alias("source_size"))
    per_source = cut(
        targets(sizes, weights, max_repeat).select(F.col("source").alias("_source"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"))
    )
    per_source = broadcast_if_small(per_source, BROADCAST_ROWS)
    rate = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(F.lit(0.0))
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    return (
        sized.join(per_source, F.col(source_col).eqNullSafe(F.col("_source")))
        .withColumn("_rate", rate)
        .withColumn("_copies", (F.floor("_rate") + (draw < F.col("_rate") - F.floor("_rate")).cast("int")).cast("int"))
        .drop("_source", "_rate")
    )


def emit(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows of mix(), each as often as it is taken, in the given columns."""
    taken = mixed.where("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return taken.select(*[F.col(f"`{c}`") for c in columns])


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.col("_copies")).alias("taken"),
    )
