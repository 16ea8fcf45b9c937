"""Resharding: the flow against every flow there is, the placement against its law, and files that are written again."""

import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanframe.llm.resharding import current_layout, documents_resharded, level, min_cost_flow, reshard, rewrite


def cheapest(supply, capacity, cost):
    """The least cost of all integer flows, by trying them."""
    if not supply:
        return 0
    best = None
    for split in itertools.product(*[range(min(supply[0], c) + 1) for c in capacity]):
        if sum(split) == supply[0]:
            rest = cheapest(supply[1:], [c - x for c, x in zip(capacity, split)], cost[1:])
            if rest is not None:
                total = rest + sum(x * y for x, y in zip(split, cost[0]))
                best = total if best is None else min(best, total)
    return best


def test_flow_is_the_cheapest():
    rng = random.Random(0)
    for _ in range(150):
        n, m = rng.randrange(1, 4), rng.randrange(1, 4)
        supply, cost = [rng.randrange(5) for _ in range(n)], [[rng.randrange(6) for _ in range(m)] for _ in range(n)]
        capacity = [rng.randrange(6) for _ in range(m)]
        if sum(supply) > sum(capacity):
            with pytest.raises(ValueError):
                min_cost_flow(supply, capacity, np.array(cost))
            continue
        flow = min_cost_flow(supply, capacity, np.array(cost))
        assert (flow >= 0).all() and flow.sum(1).tolist() == supply and (flow.sum(0) <= capacity).all()
        assert (flow * cost).sum() == cheapest(supply, capacity, cost)


def test_flow_moves_no_more_than_the_excess():
    """Where staying is free and moving costs one, what moves is what is above the capacities."""
    rng = np.random.default_rng(1)
    for _ in range(20):
        supply = rng.integers(0, 10**9, 25)
        capacity = level(int(supply.sum()), [0] * 24)
        flow = min_cost_flow(supply, capacity, 1 - np.eye(25, 24))
        assert flow.sum() - np.trace(flow) == np.maximum(supply[:24] - capacity, 0).sum() + supply[24]


def test_level():
    rng = random.Random(2)
    for _ in range(200):
        held = [rng.randrange(30) for _ in range(rng.randrange(1, 6))]
        total = rng.randrange(60)
        got = (np.array(held) + level(total, held)).tolist()
        want = list(held)
        for _ in range(total):
            want[want.index(min(want))] += 1
        assert sorted(got) == sorted(want)


def placed(spark, data, shards, **kw):
    """Results of reshard() over (row, old, size), with the layout."""
    layout = reshard(spark.createDataFrame(data, "row long, old int, size long").repartition(3), shards=shards, **kw)
    return layout, [tuple(r) for r in layout.placed.select("row", "shard", "slot").collect()]


@pytest.mark.parametrize("case", ["one file", "many files", "balanced", "huge row", "all in none", "one row", "no size"])
def test_placement(spark, case):
    rng = random.Random(case)
    n, shards, blocks = 3000, 6, 16
    old = {"one file": lambda k: 0, "many files": lambda k: k % 40, "balanced": lambda k: k % 6, "all in none": lambda k: None}.get(case, lambda k: k % 9)
    size = {"balanced": lambda k: 10, "no size": lambda k: rng.choice([0, None])}.get(case, lambda k: rng.randrange(1, 50))
    data = [(k, old(k), size(k)) for k in range(1 if case == "one row" else n)]
    if case == "huge row":
        data += [(n, 2, 10**6), (n + 1, 2, 9 * 10**5), (n + 2, None, 10**4)]
    layout, got = placed(spark, data, shards, blocks=blocks)
    sizes, slots = [0] * shards, defaultdict(list)
    of = {r: (o, s or 0) for r, o, s in data}
    for row, shard, slot in got:
        sizes[shard] += of[row][1]
        slots[shard].append(slot)
    assert sorted(r for r, _, _ in got) == sorted(of) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    if case not in ("huge row", "one row", "no size"):
        assert max(sizes) - min(sizes) <= 200
    if case == "huge row":
        assert sorted(sizes)[-1] == 10**6 and sorted(sizes)[-2] == 9 * 10**5 and sorted(sizes)[3] - min(sizes) <= 200
    moved = sum(of[row][1] for row, shard, _ in got if of[row][0] != shard)
    assert moved == sum(v for (a, b), v in layout.moves.items() if a != b)
    if case == "balanced":
        assert not moved and not layout.touched
    if case == "many files":  # no more than lies outside, and the ends of the transfers
        assert moved <= sum(s for o, s in of.values() if o >= shards) + 300


def test_empty_tables_and_odd_rows(spark):
    schema = "doc_id string, text string, shard string, _size int"
    data = [(None, None, "x", 1), (None, "", "x", 1), ("a", "é" * 3, "x", 1), ("a", "é" * 3, "x", 1), ("b", "long " * 50_000, "x", None)] + [(str(k), f"text {k}", "y", 2) for k in range(200)]
    got = documents_resharded(spark.createDataFrame(data, schema).repartition(3)).collect()
    told = sorted((r.doc_id or "", r.size, r.text_crc32, r.law, r.grown_shard) for r in got)
    assert told == sorted((i or "", len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), "bytes", None) for i, t, *_ in data)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(24)) and all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert documents_resharded(spark.createDataFrame([], schema)).count() == 0


def test_only_affected_files_are_written_again(spark, tmp_path):
    rng = random.Random(4)
    docs = spark.createDataFrame([(k, f"t{k} " * rng.randrange(1, 30), k % 4) for k in range(400)], "row long, text string, old int")
    rows = docs.withColumn("size", F.octet_length("text").cast("long"))
    path = f"file://{tmp_path}/layout"
    first = rewrite(docs, reshard(rows, shards=4, blocks=8), path, shards=4)
    read = lambda folders, k: sorted((r.slot, r.row, r.text) for r in spark.read.parquet(folders[k]).collect())
    assert current_layout(spark, path) == first and sum(len(read(first, k)) for k in range(4)) == 400
    # shard 2 and 3 are level; only what is above in 0 goes to 1
    level_ = [(k, "x" * 10, k % 4) for k in range(400)] + [(k, "x" * 10, 0) for k in range(400, 440)]
    more = spark.createDataFrame([r for r in level_ if r[2] != 1 or r[0] >= 160], "row long, text string, old int")
    layout = reshard(more.withColumn("size", F.lit(10).cast("long")), shards=4, blocks=8)
    assert layout.touched == [0, 1]
    second = rewrite(more, layout, path, shards=4)
    assert {k for k in range(4) if second[k] != first[k]} == {0, 1} and current_layout(spark, path) == second
    own = defaultdict(list)
    for r in layout.placed.collect():
        own[r["shard"]].append((r["slot"], r["row"], "x" * 10))
    assert read(second, 0) == sorted(own[0]) and read(second, 1) == sorted(own[1])
