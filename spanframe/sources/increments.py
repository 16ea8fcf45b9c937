"""Stages that run file by file: only inputs that are new or changed, and outputs of vanished ones go.

A stage's folder is partitioned by stem, the name of the file that its rows come from. Beside it stands a table
(stem, digest, rows) of what was done. A run takes the stems whose input digest is not in that table, stages
their rows, checks them, and moves stem after stem into place; the table is replaced last. A run that dies
before leaves stems that the next one does again, and none that is half there.
"""

from __future__ import annotations

import urllib.parse
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import plain_path
from ..operators.guards import Verdict, require
from ..operators.storage import materialise
from .readers import exists, stem
from .writers import _fs, _swap, publish

#: Bytes of a file whose content is hashed as one value; changed stems that are named in filters.
WHOLE_BYTES, NAMED = 1 << 30, 1_000
_FILES = "stem string, digest string, rows long"


def file_digests(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """(stem, path, digest) of the files in a folder: SHA-256 of the content.

    A file of more than WHOLE_BYTES is read by many tasks, and its digest is made of its length and of
    the number, and two sums of hashes, of its lines.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    small = files.where(F.col("length") <= WHOLE_BYTES).select("path", F.sha2("content", 256).alias("digest"))
    large = [(r["path"], r["length"]) for r in files.where(F.col("length") > WHOLE_BYTES).select("path", "length").collect()]
    if large:
        lines = spark.read.text([p for p, _ in large]).select(plain_path(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_size").alias("size"), "value")
        number = lambda *c: F.sum(F.xxhash64(*c).cast("decimal(38,0)")).cast("string")
        told = lines.groupBy("path").agg(F.concat_ws(" ", F.max("size").cast("string"), F.count(F.lit(1)).cast("string"), number("value"), number("value", F.lit(1))).alias("d"))
        small = small.unionByName(told.select("path", F.sha2("d", 256).alias("digest")))
    return small.select(stem(F.col("path")).alias("stem"), "path", "digest")


def done_files(spark: SparkSession, path: str) -> DataFrame:
    """(stem, digest, rows) of what a stage's folder holds; none if it never ran."""
    if not (exists(spark, path) and exists(spark, f"{path}.files")):
        return spark.createDataFrame([], _FILES)
    return spark.read.schema(_FILES).json(f"{path}.files")


def combined(inputs: list[DataFrame], parameters: str = "") -> DataFrame:
    """(stem, digest) of the stems that all inputs have, with one digest over theirs and the parameters."""
    out = inputs[0].select("stem", F.col("digest").alias("_d"))
    for k, x in enumerate(inputs[1:]):
        out = out.join(x.select("stem", F.col("digest").alias(f"_d{k}")), "stem")
    return out.select("stem", F.sha2(F.concat_ws("+", *[c for c in out.columns if c != "stem"], F.lit(parameters)), 256).alias("digest"))


@dataclass
class Changes:
    """The stems that a run has to do (todo), and those whose input is gone."""

    todo: DataFrame
    n_todo: int
    n_gone: int
    fresh: bool

    def pick(self, df: DataFrame) -> DataFrame:
        """The rows of the stems to do; few are named, so that only their folders are read."""
        if self.fresh:
            return df
        if self.n_todo <= NAMED:
            return df.where(F.col("stem").isin([r[0] for r in self.todo.select("stem").collect()]))
        return df.join(self.todo.select("stem"), "stem", "left_semi")


def changes(spark: SparkSession, path: str, now: DataFrame, force: bool = False) -> Changes:
    before = spark.createDataFrame([], _FILES) if force else done_files(spark, path)
    todo = materialise(now.join(before.select("stem", "digest"), ["stem", "digest"], "left_anti"))
    gone = before.join(now.select("stem"), "stem", "left_anti")
    return Changes(todo, todo.count(), gone.count(), before.limit(1).count() == 0)


def publish_files(rows: DataFrame, path: str, todo: DataFrame, now: DataFrame, checks: Callable[[int], Iterable[Verdict]] = lambda n: (), force: bool = False) -> tuple[int, int]:
    """Put rows (with stem) of the stems to do in the place of theirs, drop what has no input any more; gives the rows written, and those there are now.

    A failing check or job leaves all as it was. Stems to do without rows have none afterwards.
    """
    spark = rows.sparkSession
    before = done_files(spark, path)
    if force:
        before = before.limit(0)
    staging, run = f"{path}.staging-{uuid.uuid4().hex}", uuid.uuid4().hex
    fs, target, new = _fs(spark, path)
    seen = Observation()
    try:
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.partitionBy("stem").json(staging)
        n = int(seen.get["n"])
        require(*checks(n))
        counts = spark.read.schema("stem string").json(staging).groupBy("stem").agg(F.count(F.lit(1)).alias("rows"))
        made = todo.select("stem", "digest").join(counts, "stem", "left").select("stem", "digest", F.coalesce("rows", F.lit(0)).alias("rows"))
        kept = before.join(todo.select("stem"), "stem", "left_anti").join(now.select("stem"), "stem", "left_semi")
        table = materialise(made.unionByName(kept.select("stem", "digest", "rows")))
        fs.mkdirs(target)
        folders = lambda p: {s.getPath().getName() for s in fs.listStatus(new(p)) if s.isDirectory()}
        fresh = folders(staging)
        for name in sorted(fresh):
            _swap(fs, new(f"{staging}/{name}"), new(f"{path}/{name}"), new(f"{path}/_old-{run}"))
        stays = {r[0] for r in table.where("rows > 0").select("stem").collect()}
        for name in folders(path) - fresh:
            if urllib.parse.unquote(name.removeprefix("stem=")) not in stays:
                fs.delete(new(f"{path}/{name}"), True)
        publish(table.coalesce(1), f"{path}.files")
        return n, int(table.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0])
    finally:
        fs.delete(new(staging), True)
