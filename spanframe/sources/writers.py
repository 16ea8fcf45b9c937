"""Writers: rows are staged, checked and only then published; a manifest records what they came from."""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.guards import Verdict, require
from ..schemas import VERSION
from .readers import exists, file_hashes


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm.org.apache.hadoop.fs.Path


def _swap(fs, staging, target, old) -> None:
    """Move what is there aside, the new into its place, and only then delete the old; it is put back if the move fails."""
    there = fs.exists(target)
    if there and not fs.rename(target, old):
        raise OSError(f"could not move {target} aside")
    if not fs.rename(staging, target):
        if there:
            fs.rename(old, target)
        raise OSError(f"could not move {staging} to {target}")
    if there:
        fs.delete(old, True)


def publish(df: DataFrame, path: str, checks: Callable[[int], Iterable[Verdict]] = lambda n: (), *, staging: str | None = None) -> int:
    """Write JSON lines to a staging folder, check the number of rows written, then move it into place.

    A failing check or job leaves what was there before; the staging folder goes in either case. It lies
    beside the target, or where `staging` says, if that folder is read as a whole; what a run that was
    killed left there is replaced.
    """
    spark = df.sparkSession
    given, staging = staging, staging or f"{path}.staging-{uuid.uuid4().hex}"
    fs, target, new = _fs(spark, path)
    seen = Observation()
    try:
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(staging)
        n = int(seen.get["n"])
        require(*checks(n))
        fs.mkdirs(target.getParent())
        _swap(fs, new(staging), target, new(f"{given or path}.old-{uuid.uuid4().hex}"))
        return n
    finally:
        fs.delete(new(staging), True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file of the driver's, written beside its place and moved there."""
    fs, target, new = _fs(spark, path)
    staging = new(f"{path}.staging-{uuid.uuid4().hex}")
    out = fs.create(staging, True)
    out.write(bytearray(text.encode()))
    out.close()
    _swap(fs, staging, target, new(f"{path}.old-{uuid.uuid4().hex}"))


def write_json_array(df: DataFrame, path: str, order: str) -> None:
    """All rows as one JSON array in one file, by order: an exchange format, so one task sorts and writes them, row by row.

    The file is staged, and what was there stays until it is whole.
    """
    rows = df.select(F.lit(0).alias("_end"), F.col(order).alias("_o"), F.to_json(F.struct(*[c for c in df.columns if c != order])).alias("_v"))
    end = df.sparkSession.range(1).select(F.lit(1).alias("_end"), F.lit(None).cast(df.schema[order].dataType).alias("_o"), F.lit("]").alias("_v"))
    placed = rows.unionByName(end).repartition(1).sortWithinPartitions("_end", "_o").withColumn("_k", F.monotonically_increasing_id())
    before = F.when(F.col("_k") == 0, "[").when(F.col("_end") == 0, ",").otherwise("")
    staging, spark = f"{path}.staging-{uuid.uuid4().hex}", df.sparkSession
    fs, target, new = _fs(spark, path)
    try:
        placed.select(F.concat(before, "_v").alias("value")).write.text(staging)
        _swap(fs, new(staging), target, new(f"{path}.old-{uuid.uuid4().hex}"))
    finally:
        fs.delete(new(staging), True)


def input_hash(spark: SparkSession, path: str) -> str:
    """One digest over the sorted digests of all input files."""
    row = file_hashes(spark, path).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("sha256")), ","), 256).alias("h")).first()
    return row["h"]


def write_manifest(spark: SparkSession, path: str, stage: str, inputs: list[str], digest: str, count: int, code_version: str = "unknown") -> None:
    told = {"schema_version": VERSION, "stage": stage, "input_files": inputs, "input_hash": digest, "record_count": count, "timestamp": datetime.datetime.now(datetime.UTC).isoformat(), "code_version": code_version}
    write_text(spark, f"{path}.meta.json", json.dumps(told, indent=2, ensure_ascii=False))


def batch_manifest(stage: str, batch: int, count: int, rejected: int) -> str:
    """What a batch held, as JSON text."""
    return json.dumps({"schema_version": VERSION, "stage": stage, "batch": batch, "record_count": count, "rejected": rejected, "timestamp": datetime.datetime.now(datetime.UTC).isoformat()})


def up_to_date(spark: SparkSession, path: str, digest: str) -> bool:
    """Whether the output is there and its manifest tells the same input digest."""
    fs, p, new = _fs(spark, f"{path}.meta.json")
    if not (exists(spark, path) and fs.exists(p)):
        return False
    return json.loads(spark.read.text(f"{path}.meta.json", wholetext=True).first()[0]).get("input_hash") == digest


def metrics_json(scores: list[dict[str, Any]], totals: dict[str, int]) -> str:
    """Scores, rounded to four places here and nowhere else, as a JSON text: overall, by type, totals."""
    rounded = {r["type"]: {k: round(v, 4) if isinstance(v, float) else v for k, v in r.items() if k != "type"} for r in scores}
    overall = rounded.pop("overall", {})
    return json.dumps({"overall": overall, "per_type": dict(sorted(rounded.items())), **totals}, indent=2)


def metrics_table(scores: list[dict[str, Any]]) -> str:
    """A table of scores for people."""
    lines = [f"{'type':<26}{'P':>9}{'R':>9}{'F1':>9}{'tp':>8}{'fp':>8}{'fn':>8}"]
    for r in sorted(scores, key=lambda r: (r["type"] == "overall", r["type"])):
        lines.append(f"{r['type']:<26}{r['precision']:>9.4f}{r['recall']:>9.4f}{r['f1']:>9.4f}{r['tp']:>8}{r['fp']:>8}{r['fn']:>8}")
    return "\n".join(lines)
