"""Resharding that moves the fewest bytes, by a minimum-cost flow.

A layout of old shards is to become one of new shards with given capacities. Old shards are sources
of the bytes that they hold, new shards sinks of their capacity, and a byte costs nothing where it
stays and one where it moves. The flow of least cost says how many bytes go from where to where. It
is carried out in blocks, hashed parts of an old shard of which only the sizes reach the driver:
whole blocks follow the flow, and the few that lie across the end of a transfer are cut between
rows. Only shards that give or take a row are written again.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, shared_dir, table

SHARDS = 24
#: Blocks of an old shard.
BLOCKS = 1_024
#: A row above this share of a new shard is placed by itself, so at most GRAIN rows for each new shard are.
GRAIN = 128
#: Bytes that a row takes beside its text.
OVERHEAD = 8


def min_cost_flow(supply: Sequence[int], capacity: Sequence[int], cost: np.ndarray) -> np.ndarray:
    """How much goes from each source to each sink, at the least total cost.

    Successive shortest paths with potentials: each round finds the cheapest way, over what may be
    sent on or taken back, from a source with supply to a sink with room, and fills it. Costs must
    not be negative, and the sinks must have room for all supply.
    """
    left, room = np.array(supply, np.int64), np.array(capacity, np.int64)
    if left.sum() > room.sum():
        raise ValueError("the new shards have less room than the old ones hold")
    n, m = len(left), len(room)
    flow, cost = np.zeros((n, m), np.int64), np.asarray(cost, float)
    at_source, at_sink = np.zeros(n), np.zeros(m)  # potentials
    while left.any():
        far = np.full(n + m, np.inf)
        far[:n][left > 0] = 0
        origin, done = np.full(n + m, -1), np.zeros(n + m, bool)
        on, back = cost + at_source[:, None] - at_sink[None, :], np.where(flow > 0, at_sink[None, :] - at_source[:, None] - cost, np.inf)
        while True:
            open_ = np.where(done, np.inf, far)
            k = int(open_.argmin())
            if not np.isfinite(open_[k]):
                break
            done[k] = True
            near, steps = (slice(n, None), on[k]) if k < n else (slice(0, n), back[:, k - n])
            better = ~done[near] & (far[k] + np.maximum(steps, 0) < far[near])
            far[near] = np.where(better, far[k] + np.maximum(steps, 0), far[near])
            origin[near] = np.where(better, k, origin[near])
        true = np.where(room > 0, far[n:] + at_sink, np.inf)  # a way's cost, as sources that still supply have the potential of their sum
        end = int(true.argmin())
        path, k = [n + end], n + end
        while origin[k] >= 0:
            k = int(origin[k])
            path.append(k)
        amount = min(int(left[k]), int(room[end]))
        for a, b in zip(path[1:], path):
            if a >= n:
                amount = min(amount, int(flow[b, a - n]))
        for a, b in zip(path[1:], path):
            if a < n:
                flow[a, b - n] += amount
            else:
                flow[b, a - n] -= amount
        left[k] -= amount
        room[end] -= amount
        most = far[np.isfinite(far)].max(initial=0.0)
        at_source += np.minimum(far[:n], most)
        at_sink += np.minimum(far[n:], most)
    return flow


def level(total: int, held: Sequence[int]) -> np.ndarray:
    """What each shard should take so that all come as near to equal as what they hold already allows.

    `total` more bytes are to be dealt; shards that hold more than the level take nothing. The
    amounts are whole numbers that sum to the total.
    """
    held = np.array(held, np.int64)
    order = np.argsort(held, kind="stable")
    rising = held[order]
    # the level over the k lowest shards, as long as it is not below the highest of these
    sums = np.cumsum(rising) + total
    k = max(k for k in range(1, len(held) + 1) if sums[k - 1] >= rising[k - 1] * k)
    base, extra = divmod(int(sums[k - 1]), k)
    take = np.zeros(len(held), np.int64)
    take[order[:k]] = base - rising[:k]
    take[order[:extra]] += 1
    return take


@dataclass
class Layout:
    """What was decided. placed: the narrow rows with shard and slot; moves: (old, new) -> bytes; old number
    `shards` is all that lay in no shard of the new layout; touched: the shards that give or take a row."""

    placed: DataFrame
    moves: dict[tuple[int, int], int]
    touched: list[int]


def reshard(rows: DataFrame, *, shards: int = SHARDS, blocks: int = BLOCKS, grain: int = GRAIN) -> Layout:
    """Shard and slot of every row: sizes near equal, the fewest bytes moved.

    rows: (row, old, size) and other columns, which stay; row is a number of its own for each row and must be the
    same whenever the frame is computed, so the caller cuts it. old: the shard where it lies, null or
    outside 0 to shards - 1 if it lies in none of the new layout's; size: its bytes, 0 or more, null
    as 0. shard and slot are added, slots without gaps from 0 in each shard; they replace columns of
    these names. An empty table gives no rows.

    Rows above 1 / grain of a shard's mean, of which there are at most grain for each shard, are
    placed by themselves, largest first: where they lie if there is room, else where most is. The flow
    then deals all others, with capacities that level what the shards hold. A shard is off the level
    by at most half a small row for each end of a transfer in it; only a row larger than a shard's
    mean makes one larger than that.
    """
    spark = rows.sparkSession
    inside = F.col("old").between(0, shards - 1)
    base = rows.select(*[c for c in rows.columns if c not in ("shard", "slot", "_block", "_size", "_old")], F.when(inside, F.col("old")).otherwise(shards).cast("int").alias("_old"), F.coalesce(F.col("size"), F.lit(0)).cast("long").alias("_size"))
    base = base.withColumn("_block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    total = base.agg(F.sum("_size")).first()[0]
    if total is None:
        return Layout(base.select(*rows.columns, F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")), {}, [])
    limit = total // (shards * grain)
    large = [tuple(r) for r in base.where(F.col("_size") > limit).select("row", "_old", "_size").collect()]
    small = base.where(F.col("_size") <= limit)
    sizes = {(o, b): (s, n) for o, b, s, n in small.groupBy("_old", "_block").agg(F.sum("_size"), F.count(F.lit(1))).collect()}  # blocks for each old shard at most

    # large rows, by themselves
    mean = total / shards
    held, counts = np.zeros(shards, np.int64), np.zeros(shards, np.int64)
    moves: dict[tuple[int, int], int] = {}
    alone = []
    for row, old, size in sorted(large, key=lambda x: (-x[2], x[0])):
        new = old if old < shards and (held[old] + size <= mean or not held[old]) else int(held.argmin())
        alone.append((row, new, int(counts[new])))
        held[new] += size
        counts[new] += 1
        moves[old, new] = moves.get((old, new), 0) + size

    # the flow of the others
    supply = np.zeros(shards + 1, np.int64)
    for (old, _), (s, _) in sizes.items():
        supply[old] += s
    cost = 1 - np.eye(shards + 1, shards)
    flow = min_cost_flow(supply, level(int(supply.sum()), held), cost)

    # each old shard's blocks along a line, on which its transfers are segments
    cuts: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for old in range(shards + 1):
        new = np.flatnonzero(flow[old])
        bound = np.cumsum(flow[old, new])
        at = 0
        for b in range(blocks):
            if (old, b) not in sizes:
                continue
            end = at + sizes[old, b][0]
            first, last = (int(np.searchsorted(bound, x, side)) for x, side in ((at, "right"), (end, "left")))
            last = max(min(last, len(new) - 1), min(first, len(new) - 1))
            first = min(first, last)
            # an old shard whose rows have no size has no flow: its rows stay, or go where the fewest bytes are
            stay = [old if old < shards else int(np.argmin(held))]
            cuts[old, b] = [(int(bound[k]) - at, int(new[k])) for k in range(first, last + 1)] if len(new) else [(0, stay[0])]
            at = end
    split = {k: v for k, v in cuts.items() if len(v) > 1}
    plan = "_o int, _b int, _ends array<struct<upto:long,shard:int>>"
    ends = F.broadcast(spark.createDataFrame([(*k, v) for k, v in cuts.items()], plan))
    order = Window.partitionBy("_old", "_block").orderBy("row")

    def line(some: DataFrame) -> DataFrame:
        """Rows of whole blocks with their rank in the block and their shard: a row goes by its middle, the last segment takes what is left."""
        told = some.join(ends, (F.col("_old") == F.col("_o")) & (F.col("_block") == F.col("_b")))
        told = told.withColumns({"_before": F.sum("_size").over(order) - F.col("_size"), "_rank": (F.row_number().over(order) - 1).cast("long")})
        within = F.filter("_ends", lambda x: 2 * F.col("_before") + F.col("_size") < 2 * x.upto)
        return told.withColumn("shard", F.coalesce(F.get(within, F.lit(0)), F.element_at("_ends", -1)).getField("shard"))

    # rows of each piece: known for whole blocks, counted for those that are cut
    pieces = {(o, b, v[0][1]): sizes[o, b] for (o, b), v in cuts.items() if len(v) == 1}
    begins = {k: 0 for k in pieces}
    if split:
        some = F.broadcast(spark.createDataFrame(list(split), "_so int, _sb int"))
        found = line(small.join(some, (F.col("_old") == F.col("_so")) & (F.col("_block") == F.col("_sb")))).groupBy("_old", "_block", "shard").agg(F.sum("_size"), F.count(F.lit(1)), F.min("_rank")).collect()
        pieces |= {(o, b, j): (s, n) for o, b, j, s, n, _ in found}
        begins |= {(o, b, j): r for o, b, j, _, _, r in found}
    told = []
    for (old, b, new), (s, n) in sorted(pieces.items()):
        told.append((old, b, new, int(counts[new]) - begins[old, b, new]))
        counts[new] += n
        held[new] += s
        moves[old, new] = moves.get((old, new), 0) + s
    where = F.broadcast(spark.createDataFrame(told, "_o2 int, _b2 int, _s2 int, _first long"))
    columns = [F.col(f"`{c}`") for c in rows.columns if c not in ("shard", "slot")]
    most = line(small).join(where, (F.col("_old") == F.col("_o2")) & (F.col("_block") == F.col("_b2")) & (F.col("shard") == F.col("_s2"))).select(*columns, "shard", (F.col("_rank") + F.col("_first")).alias("slot"))
    own = F.broadcast(spark.createDataFrame(alone, "_row long, shard int, slot long"))
    few = base.where(F.col("_size") > limit).join(own, F.col("row") == F.col("_row")).select(*columns, "shard", "slot")
    moved = {k for k in moves if k[0] != k[1]}
    return Layout(most.unionByName(few), moves, sorted({x for k in moved for x in k if x < shards}))


def current_layout(spark: SparkSession, path: str) -> dict[int, str]:
    """The folder of each shard, as the layout's newest manifest tells."""
    text = spark.read.option("wholetext", True).text(f"{path}/layout.json").first()[0]
    return {int(k): v for k, v in json.loads(text).items()}


def rewrite(docs: DataFrame, layout: Layout, path: str, *, row_col: str = "row", shards: int = SHARDS) -> dict[int, str]:
    """Write the shards that give or take a row anew, and publish the layout; gives the folder of each shard.

    docs has the rows of the layout with all their columns, and `row`. New files lie beside the old,
    which nothing changes: the manifest layout.json is replaced at last, in one step, so a run that
    dies before leaves the old layout valid, and shards that are not touched keep their files. Without
    a manifest all shards are written.
    """
    spark = docs.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    home = jvm.org.apache.hadoop.fs.Path(path)
    fs = home.getFileSystem(conf)
    old = current_layout(spark, path) if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/layout.json")) else {}
    write = [k for k in range(shards) if k in layout.touched or k not in old]
    run = f"{path}/{shared_dir(spark).rpartition('-')[2]}"
    at = layout.placed.where(F.col("shard").isin(write)).select(F.col("row").alias("_row"), "shard", "slot")
    rows = docs.join(at, F.col(row_col) == F.col("_row")).drop("_row")
    rows.repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(run)
    new = {k: (f"{run}/shard={k}" if k in write else old[k]) for k in range(shards)}
    temporary, final = (jvm.org.apache.hadoop.fs.Path(x) for x in (f"{run}/layout.json", f"{path}/layout.json"))
    out = fs.create(temporary, True)
    out.write(bytearray(json.dumps(new), "utf-8"))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(home.toUri(), conf)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(temporary, final, options)
    return new


def file_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """docs with `old`: the place of a row's file among the first so many files by name, null for all others."""
    named = docs.withColumn("_file", F.input_file_name())
    first = [r[0] for r in named.select("_file").distinct().orderBy("_file").limit(shards).collect()]
    return named.withColumn("old", (F.array_position(F.array(*[F.lit(f) for f in first]), F.col("_file")) - 1).cast("int") if first else F.lit(None).cast("int")).drop("_file")


def documents_resharded(docs: DataFrame, *, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row, under the law `bytes`.

    Size is the text's bytes in UTF-8 and OVERHEAD more; a null text has none. The old shards are the
    table's files in the order of their names: the first `shards` of them are shards of the new layout,
    whatever lies in later ones has to move. Rows go by their place, so null and repeated ids and
    repeated rows are no matter; equal texts may be in several shards. An empty table gives no rows.
    Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    size = (F.octet_length(text) + OVERHEAD).cast("long")
    rows = file_shards(docs.select(id_col, text_col), shards).select(F.monotonically_increasing_id().alias("row"), "old", F.col(id_col).alias("doc_id"), size.alias("size"), F.crc32(text).alias("text_crc32"))
    placed = reshard(cut(rows), shards=shards).placed
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_flow_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_resharded(table(spark, sf_dir, "documents"))
