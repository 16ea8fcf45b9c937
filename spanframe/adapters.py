"""The driver's tables as the records that the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import fulltext
from .operators import align, tokenize
from .operators.ingest import from_lines
from .operators.storage import stored
from .schemas import LabelSpec

#: Pieces of a chunk at most, small enough that the tables' sentences are cut.
CHUNK = 24
SPEC = LabelSpec()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pmid, title, abstract, fulltext) of the documents: the first line is the title."""
    return from_lines(table(spark, sf_dir, "documents")).withColumn("fulltext", fulltext(F.col("title"), F.col("abstract")))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize.token_rows(documents(spark, sf_dir))


def chunks(spark: SparkSession, sf_dir: str, surface: bool = False) -> DataFrame:
    """Token records with ord, their place in the document, and their text if wanted."""
    return tokenize.token_records(documents(spark, sf_dir), CHUNK, word_limit=12, surface=surface)


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pmid, ord, label): each token that ends in -tion, with the token after the next as a second fragment.

    Types go by the token's length, among them an alias and an unknown one.
    """
    told = tokenize.token_arrays(documents(spark, sf_dir))
    at = F.filter(F.sequence(F.lit(0), F.size("words") - 3), lambda k: F.get("words", k).endswith("tion"))
    n = lambda k: F.char_length(F.get("words", k))
    kind = lambda k: F.when(n(k) % 7 == 0, "Foo").when(n(k) % 3 == 0, "ChemicalEntity").when(n(k) % 3 == 1, "Disease").otherwise("Species")
    label = F.transform(at, lambda k: F.struct(F.array(F.get("spans", k), F.get("spans", k + 2)).alias("spans"), kind(k).alias("type")))
    return told.where(F.size("words") > 2).select("pmid", F.lit(0).alias("ord"), label.alias("label")).where(F.size("label") > 0)


def labelled(spark: SparkSession, sf_dir: str, words: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Annotations, chunks and the fates of the labels; the first two are read several times, so they are computed once, chunks with their words only if wanted."""
    cut = chunks(spark, sf_dir).select("id", "pmid", "ord", "spans", *["sentence"] * words)
    notes, cut = stored(annotations(spark, sf_dir)), stored(cut)
    return notes, cut, align.assign_labels(notes, cut, SPEC)


def entities(fates: DataFrame) -> DataFrame:
    """(id, entity_ord, indices, type, n_words) of the assigned labels."""
    return fates.where("status = 'assigned'").select("id", F.col("label_ord").alias("entity_ord"), "indices", "type", "n_words")
