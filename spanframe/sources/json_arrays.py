"""Large files that hold one JSON array of objects, read by many tasks.

Spark's text reader cuts the files at closing braces, wherever its tasks begin, so any store and any size will
do. What a task sees depends on where it stands: in a string or not, and how deep. So each split
first tells what it does to either state: where it ends, how much deeper, and how many objects
close at each depth. The splits of a file are then composed in order, which gives each its true
state and the number of elements that end before it. In a second reading each split cuts its own
elements; one that lies over several splits is put together from their parts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import plain_path
from ..operators.storage import materialise

#: Splits whose states are broadcast; more are joined by a shuffle.
MOST_SPLITS = 1_000_000
_STRING = re.compile(r'"(?:[^"\\]|\\.)*"', re.S)
_REST = re.compile(r'(?:[^"\\]|\\.)*"', re.S)
#: What may stand before an element: the array's bracket, commas, white space, a byte order mark.
_BEFORE = "﻿ \t\r\n,["


def scan(piece: str, inside: bool) -> tuple[bool, int]:
    """Whether a piece ends inside a string, and how much deeper it ends; pieces hold no closing brace but after their end."""
    if inside:
        close = _REST.match(piece)
        if close is None:
            return True, 0
        piece = piece[close.end() :]
    bare = _STRING.sub("", piece)
    opened = bare.find('"')
    if opened >= 0:
        bare = bare[:opened]
    return opened >= 0, bare.count("{") + bare.count("[") - bare.count("]")


def _pieces(spark: SparkSession, path: str | list[str], glob: str) -> DataFrame:
    text = spark.read.option("lineSep", "}").option("pathGlobFilter", glob).text(path)
    return text.select(plain_path(F.col("_metadata.file_path")).alias("file"), F.col("_metadata.file_block_start").alias("split"), "value")


def _effects(batches: Iterator) -> Iterator:
    """(file, split, start, inside, deeper, closed) for both start states of each split; closed has [depth, objects] pairs."""
    import pyarrow as pa

    key, states = None, []
    names = ["file", "split", "start", "inside", "deeper", "closed"]
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.list_(pa.list_(pa.int64()))]

    def told():
        rows = [(*key, start, inside, depth, [list(x) for x in closed.items()]) for start, (inside, depth, closed) in zip((False, True), states)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    for b in batches:
        for file, split, value in zip(*(c.to_pylist() for c in b.columns)):
            if (file, split) != key:
                if key is not None:
                    yield told()
                key, states = (file, split), [[False, 0, Counter()], [True, 0, Counter()]]
            for s in states:
                s[0], more = scan(value, s[0])
                s[1] += more
                if not s[0]:
                    s[1] -= 1
                    s[2][s[1]] += 1
    if key is not None:
        yield told()


def _composed(batches: Iterator) -> Iterator:
    """(file, split, inside, depth, before) of each split, from the effects of a file's splits in order."""
    import pyarrow as pa

    file, inside, depth, before, done = None, False, 0, 0, None
    for b in batches:
        rows = []
        for name, split, start, ends_inside, deeper, closed in zip(*(c.to_pylist() for c in b.columns)):
            if name != file:
                file, inside, depth, before, done = name, False, 0, 0, None
            if start == inside and split != done:
                rows.append((name, split, inside, depth, before))
                before += sum(n for level, n in closed if depth + level == 1)
                inside, depth, done = ends_inside, depth + deeper, split
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["file", "split", "inside", "depth", "before"])


def _elements(batches: Iterator) -> Iterator:
    """(file, ord, split, whole, value): elements that a split holds whole, and the parts of others."""
    import pyarrow as pa

    names, kinds = ["file", "ord", "split", "whole", "value"], [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
    key, out, size, parts = None, [], 0, []
    inside = depth = ord_ = first = 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    def rest():
        text = "".join(parts)
        # after the last element only the array's end is left, with the brace that the reader took to follow it
        return [(*key[:1], ord_, key[1], False, text)] if text and depth > 0 and text.lstrip(_BEFORE) else []

    for b in batches:
        for file, split, value, state, level, before in zip(*(c.to_pylist() for c in b.columns)):
            if (file, split) != key:
                if key is not None:
                    out += rest()
                key, parts = (file, split), []
                inside, depth, ord_ = state, level, before
                first = level > 1 or state  # the split begins within an element
            inside, more = scan(value, inside)
            depth += more
            parts += [value, "}"]
            if not inside:
                depth -= 1
                if depth == 1:
                    text = "".join(parts)
                    out.append((file, ord_, split, not first, text if first else text.lstrip(_BEFORE)))
                    size += len(text)
                    parts, first, ord_ = [], False, ord_ + 1
            if size > 1 << 24:
                yield batch()
                out, size = [], 0
    if key is not None:
        out += rest()
    if out:
        yield batch()


def json_elements(spark: SparkSession, path: str | list[str], glob: str = "*.json") -> DataFrame:
    """(file, ord, value) of each element of the arrays in files, as JSON text; ord is its place in the file.

    Elements are objects, and files are JSON in UTF-8; what isn't fails when it is parsed. The rows are
    the same for any size of splits, whatever braces and quotes strings hold. Files without elements give no
    rows. Two readings of the text; between them only a few numbers for each split are kept.
    """
    raw = _pieces(spark, path, glob)
    effects = materialise(raw.mapInArrow(_effects, "file string, split long, start boolean, inside boolean, deeper long, closed array<array<long>>"))
    states = materialise(effects.repartition("file").sortWithinPartitions("file", "split").mapInArrow(_composed, "file string, split long, inside boolean, depth long, before long"))
    small = F.broadcast(states) if states.limit(MOST_SPLITS + 1).count() <= MOST_SPLITS else states
    placed = raw.join(small, ["file", "split"]).select("file", "split", "value", "inside", "depth", "before")
    found = placed.mapInArrow(_elements, "file string, ord long, split long, whole boolean, value string")
    parts = found.where("not whole").groupBy("file", "ord").agg(F.array_sort(F.collect_list(F.struct("split", "value"))).alias("p"))
    joined = parts.select("file", "ord", F.ltrim(F.array_join(F.transform("p", lambda x: x.value), ""), F.lit(_BEFORE)).alias("value"))
    return found.where("whole").select("file", "ord", "value").unionByName(joined)
