"""A corpus pipeline over `documents`: quality rules, exact and near duplicates, source mix, packing.

Each stage gets the rows that its predecessor kept, written as Parquet and read again. All but the
last return the columns of their input; the last returns the packed pieces. No SQL can state the
near-duplicate, mixing and packing stages, so ORACLE_SQL is None and the tests hold every stage
against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanframe.llm.common import cut, shared_dir, table
from spanframe.llm.exactdup import exact_copies
from spanframe.llm.mixing import emit, mix
from spanframe.llm.neardup import near_duplicates
from spanframe.llm.packing import pack
from spanframe.llm.quality import MOST_DOCS, quality_rules

ORACLE_SQL = None


#: The columns that operators read; all others travel beside them under one name, so that no name can clash.
READ, REST = ("doc_id", "text", "source"), "_others"


def _bare(docs: DataFrame) -> DataFrame:
    """The columns that operators read, and the others as one struct; a table without sources has the null source."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in READ]
    read = [F.col(c) if c in docs.columns or c != "source" else F.lit(None).cast("string").alias(c) for c in READ]
    return docs.select(*read, F.struct(*others, F.lit(0).alias("_end_of_row")).alias(REST))


def _like(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns that the stage got, in their order."""
    return out.select(*[F.col(c) if c in READ else F.col(REST)[c].alias(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go, with lines of more than MOST_DOCS documents as boilerplate; texts stay as they are.

    Null and empty texts have too few words and go. Null ids and sources are values like others;
    repeated rows are decided alike and each stays or goes.
    """
    return _like(quality_rules(_bare(docs), most=MOST_DOCS).where("_kept"), docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id stays; of several such rows, or of a group without ids, one."""
    return _like(exact_copies(_bare(docs)).where("_kept"), docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, similarity 0.8), the row with the smallest id stays.

    Each row counts by itself: of rows that share the id, the one with the smaller hash of its text
    comes first. Rows without an id or without words are linked with nothing and stay.
    """
    if docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count():
        rows = cut(_bare(docs).withColumn("_row", F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())))
        order = F.struct("doc_id", F.xxhash64("text").alias("h"), "_row")
        found = near_duplicates(rows.select("_row", "text"), num=80, id_col="_row").where("doc_id is not null").select(F.col("doc_id").alias("_row"), "component_id")
        best = found.groupBy("component_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("component_id")
        several = cut(found.join(best, "component_id").join(rows.select("_row", order.alias("order")), "_row"))
        stays = several.groupBy("component_id").agg(F.min("order").alias("least")).select(F.col("least._row").alias("_stays"))
        gone = several.select(F.col("_row").alias("_gone")).join(stays, F.col("_gone") == F.col("_stays"), "left_anti")
        return _like(rows.join(gone, rows["_row"] == gone["_gone"], "left_anti"), docs)
    gone = near_duplicates(docs.select("doc_id", "text"), num=80).where("not kept").select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it; the null source is a source, and identical rows are taken alike."""
    return _like(emit(mix(_bare(docs)), [*READ, REST]), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows, in sequences of at most 2048 tokens; a null or empty text is one piece of the end id."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mixing", mixing), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; what lies between is written to the shared folder."""
    docs, base = table(spark, sf_dir, "documents"), shared_dir(spark)
    for k, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}-{name}")
        docs = spark.read.parquet(f"{base}/{k}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
