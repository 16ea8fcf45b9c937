"""Dense ordinals over a whole table, without a window over one partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import materialise

#: spark's monotonic ids hold the row's place in its partition in their lower bits.
_PLACE = (1 << 33) - 1


def with_ordinal(df: DataFrame, *by: str, name: str = "ord") -> DataFrame:
    """Rows with their place (from 0, no gaps) in the order of `by`; nulls come first.

    Two passes: the rows are sorted over the cluster by ranges and kept, then the rows of each range
    are counted, and a range begins where the counts before it add up to. Only those counts, one
    for each partition, meet. Rows that tie go by a hash of all their columns, so that a value
    that very many rows share is spread over ranges too; identical rows are in any order, but the same
    one wherever the result is used. A column of this name is replaced. An empty table gives no rows.
    """
    if not by:
        raise ValueError("an ordinal needs an order")
    rest = [c for c in df.columns if c != name or c in by]
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in rest])
    order = [*[F.col(f"`{c}`").asc_nulls_first() for c in by], F.col("_tie")]
    kept = df.select(*[F.col(f"`{c}`") for c in rest], tie.alias("_tie")).repartitionByRange(*order).sortWithinPartitions(*order)
    kept = materialise(kept.withColumns({"_range": F.spark_partition_id(), "_place": F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE))}))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = kept.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))  # a row for each partition
    starts = counts.select(F.col("_range").alias("_r"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    columns = [F.col(f"`{c}`") for c in rest if c != name]
    return kept.join(F.broadcast(starts), F.col("_range") == F.col("_r")).select(*columns, (F.col("_first") + F.col("_place")).alias(name))


def batches(df: DataFrame, size: int, *by: str, name: str = "batch") -> DataFrame:
    """Rows with their ordinal (ord) and the number of their batch: exactly `size` rows each, in order, but for the last."""
    return with_ordinal(df, *by).withColumn(name, F.expr(f"ord div {int(size)}"))
