"""Connected components of an edge table by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(edges: DataFrame) -> DataFrame:
    """(v, label) for every end of an edge (a, b): the smallest vertex that can be reached.

    Each round takes the smallest label among the neighbours and then the label's own label, so a
    path halves; every round is written to the shared folder. Hubs are pre-aggregated by groupBy
    and their joins left to adaptive skew splitting. An empty edge table gives an empty result.
    """
    both = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    labels = cut(both.groupBy(F.col("a").alias("v")).agg(F.least(F.col("v"), F.min("b")).alias("label")))
    while True:
        near = both.join(labels.select(F.col("v").alias("b"), "label"), "b").groupBy(F.col("a").alias("v")).agg(F.min("label").alias("near"))
        spread = labels.join(near, "v").select("v", F.col("label").alias("old"), F.least("label", "near").alias("mid"))
        jumped = spread.join(labels.select(F.col("v").alias("mid"), F.col("label").alias("far")), "mid", "left")
        new = cut(jumped.select("v", "old", F.least("mid", F.coalesce("far", "mid")).alias("label")))
        if not new.where("label <> old").limit(1).count():
            return new.select("v", "label")
        labels = new.select("v", "label")
