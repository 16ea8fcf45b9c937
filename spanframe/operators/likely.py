"""Rows that may find a partner, told before any shuffle by a bitmap of the partners' hashed keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap: 16 MB at most, whatever the tables. With very many keys it tells less, but nothing wrong.
BITS = 1 << 27
#: Bytes of a piece of the bitmap, which a row takes along to read its bit.
PIECE = 256


def _bit(keys: Sequence[Column]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BITS))


def marked(rows: DataFrame, keys: Sequence[Column], others: DataFrame, other_keys: Sequence[Column], name: str = "_may") -> DataFrame:
    """Rows with a column that is false only if no row of `others` has the same key.

    `others` is read once here and once more by whoever joins it, so it should be stored or cheap.
    Equal keys of different types have different hashes, so then nothing is told and every row may have a partner.
    """
    kinds = [[f.dataType for f in df.select(*k).schema] for df, k in ((rows, keys), (others, other_keys))]
    if kinds[0] != kinds[1]:
        return rows.withColumn(name, F.lit(True))
    hashed = others.select((_bit(other_keys) + 1).alias("_bit"))  # bitmaps count from 1
    bitmaps = hashed.groupBy(F.bitmap_bucket_number("_bit").alias("_part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("_bits"))
    n = 4096 // PIECE
    pieces = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.substring("_bits", k * PIECE + 1, F.lit(PIECE)))
    bits = bitmaps.select("_part", F.posexplode(pieces).alias("_k", "_bits")).select(((F.col("_part") - 1) * n + F.col("_k")).alias("_piece"), "_bits")
    told = rows.withColumn("_bit", _bit(keys)).withColumn("_of", F.expr(f"_bit div {8 * PIECE}")).join(F.broadcast(bits), F.col("_of") == F.col("_piece"), "left")
    byte = F.conv(F.hex(F.substring("_bits", F.expr(f"cast(_bit % {8 * PIECE} div 8 as int)") + 1, F.lit(1))), 16, 10).cast("int")
    told = told.withColumn("_byte", byte)
    return told.withColumn(name, F.coalesce(F.expr("shiftright(_byte, cast(_bit % 8 as int)) & 1 = 1"), F.lit(False))).select(*rows.columns, name)


def likely(rows: DataFrame, keys: Sequence[Column], others: DataFrame, other_keys: Sequence[Column]) -> DataFrame:
    """Rows without most of those whose key no row of `others` has: before an inner join, which leaves out the rest."""
    return marked(rows, keys, others, other_keys).where("_may").drop("_may")


def left_join(rows: DataFrame, others: DataFrame, key: str) -> DataFrame:
    """rows.join(others, key, "left"), of which only rows that may find a partner are shuffled. No name but `key` stands in both."""
    told = marked(rows, [F.col(key)], others, [F.col(key)])
    alone = [F.lit(None).cast(f.dataType).alias(f.name) for f in others.schema if f.name != key]
    order = [*rows.columns, *[c for c in others.columns if c != key]]
    return told.where("_may").drop("_may").join(others, key, "left").select(*order).unionByName(told.where("not _may").drop("_may").select("*", *alone))
