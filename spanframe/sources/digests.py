"""SHA-256 of files of any size, without a file ever standing in one value.

The digest needs a file's bytes in order. Small files are one binary value each; of larger ones Spark's
text reader gives the splits to many tasks, which join lines to chunks, and the chunks, sorted by
their place, run through one digest. The reader takes off separators and a byte order mark; the
file's length tells whether they were there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import plain_path

#: Bytes of a file that is read as one value, and of a chunk of a larger one.
WHOLE_BYTES, CHUNK_BYTES = 1 << 28, 1 << 20
_MARK = b"\xef\xbb\xbf"


def _chunks(sep: bytes):
    """(path, size, split, place, chunk) from (path, size, split, line): lines of a split, joined with their separators."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names, kinds = ["path", "size", "split", "place", "chunk"], [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        key, parts, held, place = None, [], 0, 0

        def told():
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*key, place, b"".join(parts)), kinds)], names=names)

        for b in batches:
            for path, size, split, line in zip(*(c.to_pylist() for c in b.columns)):
                new = (path, size, split) != key
                if parts and (new or held >= CHUNK_BYTES):
                    yield told()
                    parts, held, place = [], 0, place + 1
                if new:
                    key, place = (path, size, split), 0
                parts += [line, sep]
                held += len(line) + len(sep)
        if parts:
            yield told()

    return run


def _digests(sep: bytes):
    """(path, length, sha256) from the sorted chunks of each file, a chunk at a time."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        path, size, read, last = None, 0, 0, b""
        plain = marked = hashlib.sha256()

        def told():
            # the last line got a separator that the file may not have
            for start, sha in ((0, plain), (len(_MARK), marked)):
                over = start + read - size
                if over in (0, len(sep)):
                    sha.update(last[: len(last) - over])
                    return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size], pa.int64()), pa.array([sha.hexdigest()])], names=["path", "length", "sha256"])
            raise ValueError(f"{path}: {read} bytes read of {size}; compressed files of this size have no digest here")

        for b in batches:
            for name, n, chunk in zip(*(c.to_pylist() for c in b.columns)):
                if name != path:
                    if path is not None:
                        yield told()
                    path, size, read, last = name, n, 0, b""
                    plain, marked = hashlib.sha256(), hashlib.sha256(_MARK)
                plain.update(last)
                marked.update(last)
                read += len(chunk)
                last = chunk
        if path is not None:
            yield told()

    return run


def file_hashes(spark: SparkSession, path: str, glob: str = "*", whole_bytes: int = WHOLE_BYTES, sep: str = "\n") -> DataFrame:
    """(path, length, sha256) of each file, as executors read it.

    Files over whole_bytes are shuffled once, in chunks; `sep`, one ASCII character, is where they may be cut, so it should
    be frequent in them: no stretch without it can be over 2 GB. Files without a byte give no row, as Spark's readers pass over them.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    out = files.where(F.col("length") <= whole_bytes).select("path", "length", F.sha2("content", 256).alias("sha256"))
    large = [r[0] for r in files.where(F.col("length") > whole_bytes).select("path").collect()]  # names of files of this size alone
    if not large:
        return out
    name = F.regexp_replace(plain_path(F.col("_metadata.file_path")), "^file:/+", "file:/")
    lines = spark.read.option("lineSep", sep).text(large).select(name.alias("path"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("line"))
    chunks = lines.mapInArrow(_chunks(sep.encode()), "path string, size long, split long, place long, chunk binary")
    ordered = chunks.repartition("path").sortWithinPartitions("path", "split", "place").select("path", "size", "chunk")
    return out.unionByName(ordered.mapInArrow(_digests(sep.encode()), "path string, length long, sha256 string"))
