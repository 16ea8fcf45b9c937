"""Strict scores: an entity counts only with its document, all its spans and its type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import ratio, shift, span_key


def gold_keys(annotations: DataFrame) -> DataFrame:
    """(pmid, spans, type) of annotation documents, types as they stand."""
    each = annotations.select("pmid", F.explode("label").alias("l"))
    return each.select("pmid", span_key(F.col("l.spans")).alias("spans"), F.col("l.type").alias("type")).distinct()


def predicted_keys(records: DataFrame) -> DataFrame:
    """(pmid, spans, type) of postprocess records, spans of the whole text."""
    each = records.select("pmid", "fulltext_offset", F.explode("entity").alias("x"))
    return each.select("pmid", span_key(shift(F.col("x.sentence_spans"), F.col("fulltext_offset"))).alias("spans"), F.col("x.type").alias("type")).distinct()


def matches(gold: DataFrame, predicted: DataFrame, types: Sequence[str] | None = None) -> DataFrame:
    """Each key once with g and p: whether it is gold and whether it is predicted. One shuffle, no join."""
    key = ["pmid", "spans", "type"]
    both = gold.select(*key, F.lit(True).alias("g"), F.lit(False).alias("p")).unionByName(predicted.select(*key, F.lit(False).alias("g"), F.lit(True).alias("p")))
    if types is not None:
        both = both.where(F.col("type").isin(list(types)))
    return both.groupBy(*key).agg(F.bool_or("g").alias("g"), F.bool_or("p").alias("p"))


def scored(counts: DataFrame) -> DataFrame:
    """tp, fp and fn with precision, recall and f1, 0 where a denominator is; not rounded."""
    p, r = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    out = counts.withColumns({"precision": p, "recall": r})
    return out.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def evaluate(gold: DataFrame, predicted: DataFrame, types: Sequence[str] | None = None) -> DataFrame:
    """(type, tp, fp, fn, precision, recall, f1) for each type, and `overall` from the summed counts."""
    counts = (
        matches(gold, predicted, types).rollup("type")
        .agg(F.count_if(F.col("g") & F.col("p")).alias("tp"), F.count_if(~F.col("g") & F.col("p")).alias("fp"), F.count_if(F.col("g") & ~F.col("p")).alias("fn"), F.grouping("type").alias("_all"))
        .withColumn("type", F.when(F.col("_all") == 1, "overall").otherwise(F.col("type"))).drop("_all")
    )
    return scored(counts)


def totals(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """(n_documents, n_gold_entities, n_pred_entities): documents with any entity, and distinct keys; never filtered by type."""
    m = matches(gold, predicted)
    return m.agg(F.countDistinct("pmid").alias("n_documents"), F.count_if("g").alias("n_gold_entities"), F.count_if("p").alias("n_pred_entities"))


def cell_scores(cells: DataFrame) -> DataFrame:
    """(macro_precision, macro_recall, macro_f1, micro_f1) of cells (y_true, y_pred), from their confusion counts.

    Macro averages go over the classes that occur on either side; over all classes the micro score
    is the share of cells that agree.
    """
    confusion = cells.groupBy("y_true", "y_pred").agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0)
    side = lambda c, other: confusion.select(F.col(c).alias("label"), hit.alias("tp"), F.lit(0).alias("x") if other else F.col("n").alias("x"), F.col("n").alias("y") if other else F.lit(0).alias("y"))
    each = side("y_pred", False).select("label", "tp", F.col("x").alias("n_pred"), F.lit(0).alias("n_true")).unionByName(side("y_true", True).select("label", F.lit(0).alias("tp"), F.lit(0).alias("n_pred"), F.col("y").alias("n_true")))
    per = each.groupBy("label").agg(F.sum("tp").alias("tp"), (F.sum("n_pred") - F.sum("tp")).alias("fp"), (F.sum("n_true") - F.sum("tp")).alias("fn"))
    return scored(per).agg(
        F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"), F.avg("f1").alias("macro_f1"), (F.sum("tp") / F.sum(F.col("tp") + F.col("fn"))).alias("micro_f1")
    )


def counted_f1(n_correct: float, n_predicted: float, n_gold: float) -> tuple[float, float, float]:
    """(f1, precision, recall) of three counts; all 0 unless all counts are positive."""
    if not (n_correct and n_predicted and n_gold):
        return 0.0, 0.0, 0.0
    p, r = n_correct / n_predicted, n_correct / n_gold
    return 2 * p * r / (p + r), p, r
