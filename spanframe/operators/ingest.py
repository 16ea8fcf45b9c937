"""Annotation documents to ingest records."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import first_nonempty, fulltext, map_dashes, strip
from ..schemas import VERSION


def from_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Plain documents as (pmid, title, abstract): the first line and the rest, stripped."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    first = F.substring_index(text, "\n", 1)
    return docs.select(F.col(id_col).cast("string").alias("pmid"), strip(first).alias("title"), strip(F.substring(text, F.char_length(first) + 2, F.char_length(text))).alias("abstract"))


def excluded(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents whose pmid is not on the list."""
    return docs.join(ids.select("pmid").distinct(), "pmid", "left_anti")


def duplicate_ids(docs: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return docs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def nfkc(docs: DataFrame, *columns: str) -> DataFrame:
    """Compatibility composition of string columns. No builtin has it, so Arrow batches go through Python."""

    def run(batches: Iterator) -> Iterator:
        import unicodedata

        import pyarrow as pa

        for b in batches:
            cols = [
                pa.array([x if x is None or x.isascii() else unicodedata.normalize("NFKC", x) for x in c.to_pylist()], pa.string()) if n in columns else c
                for n, c in zip(b.schema.names, b.columns)
            ]
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

    return docs.mapInArrow(run, docs.schema)


def normalised(docs: DataFrame, *, compose: bool = True) -> DataFrame:
    """title and abstract normalised, with length_ok: whether both kept their length, so that offsets hold."""
    kept = docs.withColumns({"_title": F.col("title"), "_abstract": F.col("abstract")})
    out = (nfkc(kept, "title", "abstract") if compose else kept).withColumns({c: map_dashes(F.col(c)) for c in ("title", "abstract")})
    same = F.lit(True)
    for c in ("title", "abstract"):
        same = same & (F.char_length(c) == F.char_length(f"_{c}"))
    return out.withColumn("length_ok", same).drop("_title", "_abstract")


def ingest(docs: DataFrame, exclude: DataFrame | None = None, *, compose: bool = True) -> tuple[DataFrame, DataFrame]:
    """Records of (pmid, title, abstract) rows, and the rejected rows with a reason.

    Rows without an id, excluded ones, those with neither part, and those whose length normalisation
    changes are rejected. Keys that are null or empty fall through to empty.
    """
    told = docs.withColumns({c: strip(first_nonempty(F.col(c))) for c in ("pmid", "title", "abstract")})
    if exclude is not None:
        told = told.join(exclude.select("pmid").distinct().withColumn("_out", F.lit(True)), "pmid", "left")
    else:
        told = told.withColumn("_out", F.lit(None).cast("boolean"))
    told = normalised(told, compose=compose)
    reason = (
        F.when(F.col("pmid") == "", "no id").when(F.col("_out"), "excluded").when((F.col("title") == "") & (F.col("abstract") == ""), "no text").when(~F.col("length_ok"), "length changed")
    )
    told = told.withColumn("reason", reason)
    good = told.where("reason is null").select(
        F.lit(VERSION).alias("schema_version"), "pmid", "title", "abstract", fulltext(F.col("title"), F.col("abstract")).alias("fulltext"), *[c for c in docs.columns if c not in ("pmid", "title", "abstract")]
    )
    return good, told.where("reason is not null").select("pmid", "reason")


def inconsistent(records: DataFrame) -> DataFrame:
    """Ingest records whose fulltext is not that of their parts."""
    return records.where(F.col("fulltext") != fulltext(F.col("title"), F.col("abstract")))
