"""Training statistics: label histograms, class weights, early stopping, learning rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import LabelSpec
from .align import label_ids


def type_histogram(records: DataFrame) -> DataFrame:
    """(type, n) of the entities of token records, most frequent first."""
    return records.select(F.explode("ner").alias("x")).groupBy(F.col("x.type").alias("type")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "type")


def observed_types(records: DataFrame) -> DataFrame:
    return records.select(F.explode("ner.type").alias("type")).where("type <> ''").distinct()


def label_counts(spark: SparkSession, records: DataFrame, spec: LabelSpec) -> DataFrame:
    """(label_id, type, n) of grid cells: background, joined words and each type, absent ones with 0.

    records: (id, n_words, ner). A sentence's background is its upper triangle less the joined words
    and one cell for each entity, at least 0. Entities of unknown types close a background cell.
    """
    background, follow = spec.sentinels
    known = list(spec.entity_types)
    some = records.where("n_words > 0")
    joined = F.aggregate("ner", F.lit(0), lambda a, x: a + F.greatest(F.size(x.indices) - 1, F.lit(0)))
    unknown = F.size(F.filter("ner", lambda x: ~F.coalesce(x.type.isin(known), F.lit(False))))
    cells = F.greatest(F.expr("n_words * (n_words + 1) div 2") - joined - F.size("ner"), F.lit(0))
    whole = some.agg(F.sum(joined).alias("follow"), F.sum(cells + unknown).alias("background"))
    fixed = whole.select(F.explode(F.array(F.struct(F.lit(background).alias("type"), F.col("background").alias("n")), F.struct(F.lit(follow).alias("type"), F.col("follow").alias("n")))).alias("x")).select("x.*")
    typed = some.select(F.explode("ner").alias("x")).where(F.col("x.type").isin(known)).groupBy(F.col("x.type").alias("type")).agg(F.count(F.lit(1)).alias("n"))
    return label_ids(spark, spec).join(fixed.unionByName(typed), "type", "left").select("label_id", "type", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def class_weights(counts: DataFrame, *, max_background: float = 0.1, min_background: float = 0.0) -> DataFrame:
    """(label_id, weight): inverse counts, scaled so that the entity labels average 1; background clamped, the floor wins."""
    everything = Window.partitionBy()
    raw = counts.withColumn("_r", 1.0 / F.greatest(F.col("n"), F.lit(1)))
    mean = F.avg(F.when(F.col("label_id") != 0, F.col("_r"))).over(everything)
    scaled = raw.withColumn("_w", F.col("_r") / mean)
    return scaled.select("label_id", F.when(F.col("label_id") == 0, F.greatest(F.lit(min_background), F.least(F.col("_w"), F.lit(max_background)))).otherwise(F.col("_w")).alias("weight"))


def early_stop(epochs: DataFrame, patience: int, floor: float = 0.0) -> DataFrame:
    """Epochs (epoch, f1) with best so far, epochs without improvement, and whether training has stopped before.

    An epoch improves if it exceeds all before it and the floor; a patience of 0 never stops.
    """
    w = Window.orderBy("epoch")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    told = epochs.withColumn("improved", F.col("f1") > F.coalesce(F.max("f1").over(before), F.lit(floor)))
    told = told.withColumn("best", F.greatest(F.max("f1").over(w), F.lit(floor))).withColumn("_last", F.max(F.when(F.col("improved"), F.col("epoch"))).over(w))
    told = told.withColumn("waited", F.col("epoch") - F.coalesce("_last", F.min("epoch").over(w) - 1))
    spent = (F.col("waited") >= patience) if patience > 0 else F.lit(False)
    return told.withColumn("_spent", spent.cast("int")).withColumn("stopped", F.coalesce(F.max("_spent").over(before), F.lit(0)) == 1).drop("_last", "_spent")


def learning_rates(spark: SparkSession, steps: int, warm_factor: float, rate: float = 1.0) -> DataFrame:
    """(step, rate): a linear rise over the warm-up steps, then a linear fall to 0."""
    warm = int(steps * warm_factor)
    step = F.col("id")
    up = step / F.lit(float(max(1, warm)))
    down = F.greatest(F.lit(0.0), (steps - step) / F.lit(float(max(1, steps - warm))))
    return spark.range(0, steps + 1).select(step.alias("step"), (F.when(step < warm, up).otherwise(down) * rate).alias("rate"))
