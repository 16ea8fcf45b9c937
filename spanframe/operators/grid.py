"""Word-pair grids as sparse tables (id, row, col, label): encoding, decoding, masks and features.

Label 1 above the diagonal joins consecutive words of an entity. A label over 1 at (tail, head), on
or below the diagonal, closes an entity of that type.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import distance_bucket
from ..schemas import LabelSpec
from .likely import likely
from .storage import materialise, stored


def encode(entities: DataFrame, spec: LabelSpec) -> DataFrame:
    """Grid of (id, entity_ord, indices, type, n_words); an unknown type or an index past the words raises.

    Where entities claim a cell, the later one has it; within one, its closing cell comes last.
    """
    ids = F.create_map(*[F.lit(x) for kv in spec.label2id.items() for x in kv])
    label = F.try_element_at(ids, F.col("type"))
    bad = F.exists("indices", lambda x: (x < 0) | (x >= F.col("n_words")))
    sure = entities.where(F.size("indices") > 0).withColumn(
        "_label",
        F.when(label.isNull() | F.col("type").isin(list(spec.sentinels)), F.raise_error(F.concat(F.lit("unknown label: "), F.coalesce("type", F.lit("null")))).cast("int"))
        .when(bad, F.raise_error(F.concat(F.lit("index out of range in "), "id")).cast("int"))
        .otherwise(label),
    )
    at = F.array_sort("indices")
    edges = F.zip_with(F.slice(at, 1, F.size(at) - 1), F.slice(at, 2, F.size(at) - 1), lambda a, b: F.struct(a.alias("row"), b.alias("col"), F.lit(1).alias("label"), F.lit(0).alias("last")))
    anchor = F.struct(F.element_at(at, -1).alias("row"), F.element_at(at, 1).alias("col"), F.col("_label").alias("label"), F.lit(1).alias("last"))
    cells = sure.select("id", "entity_ord", F.explode(F.concat(F.filter(edges, lambda x: x.row < x.col), F.array(anchor))).alias("c"))
    return cells.groupBy("id", F.col("c.row").alias("row"), F.col("c.col").alias("col")).agg(F.max_by(F.col("c.label"), F.struct("entity_ord", "c.last")).cast("int").alias("label"))


def ascending_paths(edges: dict[int, list[int]], head: int, tail: int) -> Iterator[list[int]]:
    """Every path along ascending edges from head to tail, one after the other; only words that reach the tail are entered."""
    alive = {tail}
    for a in sorted((a for a in edges if head <= a < tail), reverse=True):
        if any(b in alive for b in edges[a]):
            alive.add(a)
    if head not in alive:
        return
    path, ways = [head], [iter([b for b in edges.get(head, ()) if b in alive] if head != tail else ())]
    if head == tail:
        yield [head]
    while path:
        b = next(ways[-1], None)
        if b is None:
            path.pop()
            ways.pop()
        elif b == tail:
            yield [*path, b]
        else:
            path.append(b)
            ways.append(iter([c for c in edges[b] if c in alive]))


_USEFUL = "(label = 1 and row < col) or (label > 1 and row >= col)"
#: Counts of paths stop here: no anchor's number grows beyond what a long holds.
MOST_PATHS = 1 << 62


def _by_sentence(grid: DataFrame, found: Callable[[dict[int, list[int]], list[tuple[int, int, int]]], Iterator[tuple]], names: list[str], schema: str) -> DataFrame:
    """What `found` gives for each sentence's edges and anchors (head, tail, label), after its id.

    A sentence's cells lie sorted in one task, which gives rows as it finds them: sentences are
    independent, and neither their number nor that of their rows is held anywhere at once. Repeated
    cells count once; cells of no use (label 1 on or below the diagonal, others above it) are left out.
    """
    useful = grid.where(_USEFUL).select("id", "row", "col", "label")
    kind = grid.schema["id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known = {"head": pa.int32(), "tail": pa.int32(), "label": pa.int32(), "indices": pa.list_(pa.int32()), "n_paths": pa.int64(), "longest": pa.int32(), "branching": pa.int32()}

        def cells() -> Iterator:
            for b in batches:
                yield from zip(*(c.to_pylist() for c in b.columns))

        def rows() -> Iterator:
            for key, own in itertools.groupby(cells(), lambda x: x[0]):
                edges, anchors = {}, set()
                for _, row, col, label in own:
                    if label == 1:
                        edges.setdefault(row, set()).add(col)
                    else:
                        anchors.add((col, row, label))
                for x in found({a: sorted(b) for a, b in edges.items()}, sorted(anchors)):
                    yield key, *x

        all_rows = rows()
        while some := list(itertools.islice(all_rows, 10_000)):
            ids, *rest = zip(*some)
            yield pa.RecordBatch.from_arrays([pa.array(ids), *(pa.array(list(c), known[n]) for c, n in zip(rest, names))], names=["id", *names])

    return useful.repartition("id").sortWithinPartitions("id").mapInArrow(run, f"id {kind}, {schema}")


def decode(grid: DataFrame) -> DataFrame:
    """(id, head, tail, label, indices) of every ascending path of edges from a head to its tail, each once."""

    def found(ways: dict[int, list[int]], anchors: list[tuple[int, int, int]]) -> Iterator[tuple]:
        for head, tail, label in anchors:
            for path in ascending_paths(ways, head, tail):
                yield head, tail, label, path

    return _by_sentence(grid, found, ["head", "tail", "label", "indices"], "head int, tail int, label int, indices array<int>")


def path_counts(ways: dict[int, list[int]], head: int) -> dict[int, tuple[int, int]]:
    """For each word that ascending paths from head reach, their number (MOST_PATHS at most) and the words of the longest."""
    told = {head: (1, 1)}
    for a in sorted(ways):
        if a in told:
            n, longest = told[a]
            for b in ways[a]:
                m, other = told.get(b, (0, 0))
                told[b] = min(MOST_PATHS, m + n), max(other, longest + 1)
    return told


def widest(ways: dict[int, list[int]], reached: Iterable[int], tail: int) -> int:
    """The most ways that lead on from one word towards the tail."""
    alive, most = {tail}, 0
    for a in sorted((a for a in ways if a < tail), reverse=True):
        n = sum(b in alive for b in ways[a])
        if n:
            alive.add(a)
            if a in reached:
                most = max(most, n)
    return most


@dataclass
class Guarded:
    """decoded: every path of the anchors that may be decoded; partial: for each other one, its first path, as
    (id, head, tail, label, indices); warnings: (id, head, tail, message, stats) of those others."""

    decoded: DataFrame
    partial: DataFrame
    warnings: DataFrame

    @property
    def all(self) -> DataFrame:
        return self.decoded.unionByName(self.partial)


def decode_guarded(grid: DataFrame, *, max_paths: int = 50_000, max_path_len: int = 30, max_branching: int = 128) -> Guarded:
    """decode() of the anchors that do not explode, with a warning and one path for each that does.

    An anchor explodes if it has more than max_paths paths, or if its longest path has more than
    max_path_len words and some word on the way more than max_branching ways on. All that is known before
    any path is made: one pass over a sentence's edges for each head adds up the paths to all its
    tails, in whole numbers that stop at MOST_PATHS. Anchors are judged one by one. Of one that explodes, the
    path of the smallest words is kept as evidence, beside the warning.
    """

    def found(ways: dict[int, list[int]], anchors: list[tuple[int, int, int]]) -> Iterator[tuple]:
        for head, group in itertools.groupby(anchors, lambda x: x[0]):
            told = path_counts(ways, head)
            for _, tail, label in group:
                n, longest = told.get(tail, (0, 0))
                wide = widest(ways, told, tail) if n > max_paths or longest > max_path_len else 0
                if n > max_paths or (longest > max_path_len and wide > max_branching):
                    yield head, tail, label, next(ascending_paths(ways, head, tail)), n, longest, wide
                else:
                    for path in ascending_paths(ways, head, tail):
                        yield head, tail, label, path, None, None, None

    names = ["head", "tail", "label", "indices", "n_paths", "longest", "branching"]
    rows = materialise(_by_sentence(grid, found, names, "head int, tail int, label int, indices array<int>, n_paths long, longest int, branching int"))
    over, plain = F.col("n_paths").isNotNull(), ["id", "head", "tail", "label", "indices"]
    stat = lambda c: [F.lit(c), F.col(c).cast("long")]
    message = F.when(F.col("n_paths") > max_paths, "too many paths").otherwise("long and wide")
    stats = F.create_map(*stat("n_paths"), *stat("longest"), *stat("branching"), F.lit("max_paths"), F.lit(max_paths).cast("long"))
    warnings = rows.where(over).select("id", "head", "tail", message.alias("message"), stats.alias("stats"))
    return Guarded(rows.where(~over).select(*plain), rows.where(over).select(*plain), warnings)


def entities(decoded: DataFrame, words: DataFrame, spec: LabelSpec) -> DataFrame:
    """Predict records: (id, entity) with the words and type of each decoded path, duplicates once.

    Paths are stored, so that only sentences that may have some meet them.
    """
    names = F.create_map(*[F.lit(x) for kv in spec.id2label.items() for x in kv])
    decoded = stored(decoded)
    told = decoded.join(likely(words.select("id", "sentence"), [F.col("id")], decoded, [F.col("id")]), "id").withColumn("type", F.element_at(names, F.col("label")))
    one = F.struct("indices", F.transform("indices", lambda k: F.element_at("sentence", k + 1)).alias("text"), "type")
    return told.groupBy("id").agg(F.transform(F.array_sort(F.collect_set(one)), lambda x: F.struct(x.text.alias("text"), x.indices.alias("indices"), x.type.alias("type"))).alias("entity"))


def compare(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """(n_correct, n_predicted, n_gold) of decoded paths (id, label, indices), as sets."""
    key = ["id", "label", "indices"]
    both = gold.select(*key, F.lit(1).alias("g"), F.lit(0).alias("p")).unionByName(predicted.select(*key, F.lit(0).alias("g"), F.lit(1).alias("p"))).groupBy(*key).agg(F.max("g").alias("g"), F.max("p").alias("p"))
    return both.agg(F.coalesce(F.sum(F.col("g") * F.col("p")), F.lit(0)).alias("n_correct"), F.coalesce(F.sum("p"), F.lit(0)).alias("n_predicted"), F.coalesce(F.sum("g"), F.lit(0)).alias("n_gold"))


def distance_cell(i: Column, j: Column) -> Column:
    """Distance feature of a cell: 19 on the diagonal, bucket + 9 above, bucket below."""
    return F.when(i == j, 19).when(j > i, distance_bucket(j - i) + 9).otherwise(distance_bucket(i - j)).cast("int")


def region(i: Column, j: Column) -> Column:
    """Region feature of a cell inside the sentence: 1 above the diagonal, 2 on and below it."""
    return F.when(j > i, 1).otherwise(2)


def pair_grid(sizes: DataFrame) -> DataFrame:
    """Every cell (id, i, j, dist, region) of sentences (id, n): n squared rows for one of n words, by its nature."""
    rows = sizes.where("n > 0").select("id", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
    cells = rows.select("id", "i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("j"))
    return cells.select("id", "i", "j", distance_cell(F.col("i"), F.col("j")).alias("dist"), region(F.col("i"), F.col("j")).alias("region"))


def loss_cells(grid: DataFrame, sizes: DataFrame) -> DataFrame:
    """(id, n_cells) in the loss: all on and above the diagonal, and labelled ones below it, counted in closed form."""
    below = grid.where("row > col and label > 0").groupBy("id").agg(F.count(F.lit(1)).alias("b"))
    return sizes.join(below, "id", "left").select("id", (F.expr("n * (n + 1) div 2") + F.coalesce("b", F.lit(0))).alias("n_cells"))


def loss_mask(grid: DataFrame, sizes: DataFrame) -> DataFrame:
    """Every cell (id, i, j) in the loss of sentences (id, n).

    A sentence meets the labels of its own cells below the diagonal as one row before its cells are made, so cells are never shuffled.
    """
    below = grid.where("row > col and label > 0").groupBy("id").agg(F.collect_set(F.struct("row", "col")).alias("_below"))
    rows = sizes.where("n > 0").join(below, "id", "left").select("id", "n", "_below", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
    own = F.transform(F.filter("_below", lambda x: x.row == F.col("i")), lambda x: x.col)
    cells = rows.select("id", "i", F.coalesce(own, F.array().cast("array<int>")).alias("_own"), F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("j"))
    return cells.where(in_loss(F.col("i"), F.col("j"), F.array_contains("_own", F.col("j")).cast("int"))).select("id", "i", "j")


def in_loss(i: Column, j: Column, label: Column) -> Column:
    return (j >= i) | (label > 0)


def argmax(scores: Column) -> Column:
    """Place (from 0) of the largest of an array's values, the first of equals."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def padded(records: DataFrame, value: str, batch_size: int, order: str = "ord") -> DataFrame:
    """Records with batch, length, and `value` padded with zeros to the batch's longest; order is a dense ordinal, as with_ordinal() gives."""
    batched = records.withColumn("batch", F.expr(f"`{order}` div {int(batch_size)}")).withColumn("length", F.size(value))
    longest = batched.groupBy("batch").agg(F.max("length").alias("width"))
    joined = batched.join(longest, "batch")
    return joined.withColumn(value, F.concat(F.col(value), F.array_repeat(F.lit(0), F.col("width") - F.col("length"))))


def max_pool(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, dim, value): the largest value in each dimension of a key's vectors."""
    return vectors.select(key, F.posexplode(vector).alias("dim", "v")).groupBy(key, "dim").agg(F.max(F.col("v").cast("double")).alias("value"))


def grid_of(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, "id string, row int, col int, label int")
