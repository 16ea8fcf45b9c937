"""Readers: BioC XML, annotation JSON arrays, JSON lines, id lists, files that belong together by stem."""

from __future__ import annotations

import json
import logging
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import plain_path, strip
from ..schemas import BIOC
from .digests import file_hashes as file_hashes
from .json_arrays import json_elements

_STEM = r"([^/]*?)(?:\.[^/.]*)?$"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, sorted."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return sorted(s.getPath().getName() for s in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p) if s.isDirectory())


def stem(path) -> F.Column:
    return F.regexp_extract(path, _STEM, 1)


def bioc_xml(spark: SparkSession, path: str) -> DataFrame:
    """BioC documents (id, passage) of an XML file or folder; the schema is declared, so single elements stay arrays."""
    return spark.read.format("xml").option("rowTag", "document").schema(BIOC).load(path)


def annotation_json(spark: SparkSession, path: str | list[str], glob: str = "*.json") -> DataFrame:
    """(stem, ord, pmid, title, abstract, label) of files that hold a JSON array of annotation documents.

    Names of keys are matched exactly: PMID or pmid, articleTitle or title, abstract or text; of the
    two the first that is not empty. ord is the place in the file. A file of any size is read by many
    tasks, and only its documents are rows.
    """
    rows = json_elements(spark, path, glob).select(stem(F.col("file")).alias("stem"), F.col("ord").cast("int").alias("ord"), F.parse_json("value").alias("d"))
    text = lambda *keys: F.coalesce(*[F.nullif(F.variant_get("d", f"$.{k}", "string"), F.lit("")) for k in keys], F.lit(""))
    pairs = F.coalesce(F.variant_get("d", "$.label", "array<array<variant>>"), F.array().cast("array<array<variant>>"))
    rows = rows.select("stem", "ord", strip(text("PMID", "pmid")).alias("pmid"), strip(text("articleTitle", "title")).alias("title"), strip(text("abstract", "text")).alias("abstract"), pairs.alias("_l"))
    label = F.expr(
        "transform(_l, x -> struct(transform(variant_get(x[0], '$', 'array<array<int>>'), y -> struct(y[0] as s, y[1] as e)) as spans, variant_get(x[1], '$', 'string') as type))"
    )
    return rows.select("stem", "ord", "pmid", "title", "abstract", label.alias("label"))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON lines with their file's stem; blank lines are no rows."""
    read = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return read.select("*", stem(plain_path(F.col("_metadata.file_path"))).alias("stem"))


def id_list(spark: SparkSession, path: str | None) -> DataFrame:
    """(pmid) of a text file with an id on each line; none for no path, and with a warning for one that isn't there."""
    if path is not None and not exists(spark, path):
        logging.getLogger("spanframe").warning("no id list at %s: nothing is excluded", path)
        path = None
    if path is None:
        return spark.createDataFrame([], "pmid string")
    return spark.read.text(path).select(strip(F.col("value")).alias("pmid")).where("pmid <> ''").distinct()


def json_object(spark: SparkSession, path: str) -> dict[str, Any]:
    """One small JSON object, such as a configuration or manifest, on the driver."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def unmatched_stems(left: DataFrame, right: DataFrame) -> DataFrame:
    """Stems of the left that the right lacks."""
    return left.select("stem").distinct().join(right.select("stem").distinct(), "stem", "left_anti")
