"""The prefix trie of conversations, from the LCP array of the sorted conversations.

A conversation is the string of its turns' digests. Distinct strings are sorted over the cluster and
cut into blocks of consecutive ones. The LCP array tells how many turns each shares with the one
before it. Its Cartesian tree is the trie without its unary paths: an entry is a node of the depth
that it tells, over the strings between its nearest smaller values; entries with equal depths and
bounds are one node. Smaller values inside a block are found in its task, those beyond it by the
minima of the blocks. What spans several blocks is added up from one partial row for each block and
depth. Depths that no entry tells are put in, as nodes with the bounds of the node below them.

Counts and sums over a node's strings are differences of running sums, as every node is new at
exactly one string: the one where its bounds begin.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_if_small, cut, shared_dir, table

#: Bytes of a turn's digest, of which a string is made.
DIGEST = 16
#: Bytes of strings in a block, and blocks at most: of each block its first and last string and one number go to the driver.
BLOCK_BYTES, MAX_BLOCKS = 16 << 20, 4_096
#: Turns of one conversation that are gathered before it is put together.
PIECE_TURNS = 1_024
#: Nodes over several blocks are broadcast up to this number. Characters of ids that are hashed at a time.
BROADCAST_NODES, CHUNK = 100_000, 1 << 16
NO_ENDS = hashlib.sha256(b"").hexdigest()


def gather(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id and turns, an array of (digest, chars), a row for each conversation.

    Turns go by their number, null first; those with the same number by their digest. Null roles and
    texts are empty. Rows without a conversation's id are of no conversation and are left out.
    Repeated rows are turns that repeat. Texts become digests before anything is shuffled, and a
    long conversation is put together from pieces; its digests, not its texts, make one row.
    """
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    digest = F.substring(F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)), 1, DIGEST)
    each = turns.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), digest.alias("d"), F.char_length(text).cast("long").alias("n"))
    piece = F.floor(F.col("turn") / PIECE_TURNS)
    pieces = each.groupBy("conv_id", piece.alias("piece")).agg(F.array_sort(F.collect_list(F.struct("turn", "d", "n"))).alias("t"))
    pieces = pieces.withColumn("t", F.transform("t", lambda x: F.struct(x.d.alias("d"), x.n.alias("n"))))
    whole = pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("piece", F.lit(-(1 << 62))).alias("piece"), "t"))).alias("p"))
    return whole.select("conv_id", F.flatten(F.transform("p", lambda x: x.t)).alias("turns"))


def regenerated(convs: DataFrame) -> DataFrame:
    """Conversations that begin as their hundred's first does.

    Conversation c takes the first h turns of c - c % 100 (all if there are fewer, none if there is no
    such conversation), then its own after its first h, with h = crc32 of its decimal id, % 6.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")
    heads = convs.where("conv_id % 100 = 0").select(F.col("conv_id").alias("_base"), F.slice("turns", 1, 5).alias("_head"))
    told = convs.withColumn("_h", h).join(heads, F.col("conv_id") - F.col("conv_id") % 100 == F.col("_base"), "left")
    none = F.slice("turns", 1, 0)
    head = F.slice(F.coalesce("_head", none), F.lit(1), F.col("_h"))
    rest = F.slice("turns", F.col("_h") + 1, F.size("turns"))
    return told.select("conv_id", F.concat(head, rest).alias("turns"))


def _ends(copies: DataFrame) -> DataFrame:
    """(whole, ends): the SHA-256 of the ids of each string, in numeric order, comma-joined.

    A hash of this kind takes its bytes in order, so a string's ids meet in one task; they are
    sorted and joined over the cluster first, and come there as chunks, of which it holds one.
    """

    def join(batches: Iterator) -> Iterator:
        import pyarrow as pa

        key, first, ids, size = None, None, [], 0
        out: list[tuple] = []
        for b in batches:
            for whole, conv in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if ids and (whole != key or size > CHUNK):
                    out.append((key, first, ",".join(ids)))
                    ids, size = [], 0
                if not ids:
                    key, first = whole, conv
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            if sum(len(x[2]) for x in out) > 8 * CHUNK:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))], names=["whole", "first", "ids"])
                out = []
        if ids:
            out.append((key, first, ",".join(ids)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))], names=["whole", "first", "ids"])

    def hashed(batches: Iterator) -> Iterator:
        import pyarrow as pa

        key, state = None, None
        for b in batches:
            keys, ends = [], []
            for whole, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if whole == key:
                    state.update(b",")
                else:
                    if state is not None:
                        keys.append(key)
                        ends.append(state.hexdigest())
                    key, state = whole, hashlib.sha256()
                state.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ends, pa.string())], names=["whole", "ends"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["whole", "ends"])

    chunks = copies.repartitionByRange("whole", "conv_id").sortWithinPartitions("whole", "conv_id").mapInArrow(join, "whole binary, first long, ids string")
    return chunks.repartition("whole").sortWithinPartitions("whole", "first").mapInArrow(hashed, "whole binary, ends string")


def smaller_values(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value the places of the nearest smaller ones before (-1: none) and after it (the length: none)."""
    n = len(a)
    before, after, stack = np.full(n, -1), np.full(n, n), []
    values = a.tolist()
    for i, v in enumerate(values):
        while stack and values[stack[-1]] > v:
            after[stack.pop()] = i
        # an equal value shares its predecessor's smaller one
        before[i] = (before[stack[-1]] if values[stack[-1]] == v else stack[-1]) if stack else -1
        stack.append(i)
    return before, after


def common(a: bytes, b: bytes) -> int:
    """Turns that two strings of digests begin with alike."""
    n = min(len(a), len(b)) // DIGEST * DIGEST
    if a[:n] == b[:n]:
        return n // DIGEST
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    return int((x != y).argmax()) // DIGEST


def _least(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The minimum of values[lo:hi], all of them not empty, by minima of spans of powers of two."""
    spans, w = [values], 1
    while 2 * w <= len(values):
        spans.append(np.minimum(spans[-1][:-w], spans[-1][w:]))
        w *= 2
    level = np.frexp((hi - lo).astype(float))[1] - 1
    out = np.empty(len(lo), values.dtype)
    for k in np.unique(level):
        at = level == k
        out[at] = np.minimum(spans[k][lo[at]], spans[k][hi[at] - (1 << int(k))])
    return out


#: What a block tells: its nodes (block_at null), and its parts of nodes over several blocks.
_SCHEMA = """block long, from_block long, depth long, conv_id long, n_convs long, n_children long, n_leaves long, all_chars long, new_chars long,
    before long, own long, ends string, parent_conv_id long, parent_block long"""


def block_rows(strings: list[bytes], copies: np.ndarray, least: np.ndarray, chars: list[np.ndarray], ends: list[str], block: int, first_lcp: int, next_lcp: int, minima: list[int]) -> dict[str, np.ndarray]:
    """The rows of one block, in columns as in _SCHEMA.

    strings are sorted and distinct; first_lcp is what the first shares with the last of the block
    before, next_lcp what the last shares with the first of the next (-1: there is no such block).
    minima has the smallest LCP entry of each block, its first entry included.

    Rows with from_block null are whole nodes, with their parent's smallest conversation, or, if
    that node lies over several blocks, with the block where it begins as parent_block. The others
    are parts of nodes over several blocks, which go by that block and their depth; the part where
    the node begins has `before`, the characters of a first string's turns before the node's last,
    and `own`, all of its turns' characters.
    """
    m = len(strings)
    length = np.array([len(s) // DIGEST for s in strings])
    lcp = np.array([first_lcp, *[common(a, b) for a, b in zip(strings, strings[1:])], next_lcp])
    before, after = smaller_values(lcp)
    flat = np.concatenate([[0], np.cumsum(np.concatenate(chars))]) if m else np.zeros(1, np.int64)
    flat = flat.astype(np.int64)
    start = np.concatenate([[0], np.cumsum(length)])[:-1]
    upto = lambda i, d: flat[start[i] + d] - flat[start[i]]  # noqa: E731  characters of string i's first d turns
    place = np.arange(m)
    total = upto(place, length)
    run = lambda x: np.concatenate([[0], np.cumsum(x)]).astype(np.int64)
    n_copies, n_all, n_new = run(copies), run(copies * total), run(total - upto(place, np.maximum(lcp[:-1], 0)))
    n_leaf = run(lcp[1:] < length)

    # Cartesian nodes inside the block: entries between neighbours, equal ones merged, counted as children of their node
    entry = np.arange(1, m)
    whole = entry[(before[1:m] >= 0) & (after[1:m] <= m)]
    lo, hi, depth = before[whole], after[whole], lcp[whole]
    if len(whole):
        _, one, same = np.unique(np.stack([lo, depth], 1), axis=0, return_index=True, return_counts=True)
    else:
        one = same = np.zeros(0, np.int64)
    # every string is a node too, of its own depth, unless the next one begins with it
    lo, hi, depth = np.concatenate([lo[one], place]), np.concatenate([hi[one], place + 1]), np.concatenate([depth[one], length])
    same = np.concatenate([same, np.zeros(m, np.int64)])
    above = np.maximum(lcp[lo], lcp[hi])
    real = depth > above
    lo, hi, depth, same, above = lo[real], hi[real], depth[real], same[real], above[real]

    # their parents: of depth `above`, beginning at the nearest smaller entry
    left = np.where(lcp[lo] < above, lo, before[lo])
    right = np.where(lcp[hi] < above, hi, after[hi])
    is_open = (above >= 0) & ((left < 0) | (right > m))
    parent_conv = _least(least, np.maximum(left, 0), np.where(is_open | (above < 0), np.maximum(left, 0) + 1, np.minimum(right, m))) if len(lo) else lo
    starts = _starts(block, minima, max(first_lcp, next_lcp, 0))
    parent_block = np.where(left >= 0, block, starts[np.clip(above, 0, len(starts) - 1)])
    top_parent = np.where(above < 0, -1, np.where(is_open, -1, parent_conv))

    # each node once for each depth down from its parent
    times = depth - above
    node = np.repeat(np.arange(len(lo)), times)
    step = np.arange(len(node)) - np.repeat(np.cumsum(times) - times, times)
    at, to = lo[node], hi[node]
    d = above[node] + 1 + step
    last = d == depth[node]
    conv = _least(least, at, to) if len(at) else at
    prior = upto(at, np.maximum(d - 1, 0))
    n = n_copies[to] - n_copies[at]
    saved = (n_all[to] - n_all[at] - n * prior) - (total[at] - prior + n_new[to] - n_new[at + 1])
    exact = last & (length[at] == d)
    out = {
        "block": np.full(len(d), block), "from_block": np.full(len(d), -1), "depth": d, "conv_id": conv, "n_convs": n,
        "n_children": np.where(last, same[node] + (length[at] > d), 1), "n_leaves": n_leaf[to] - n_leaf[at], "all_chars": saved, "new_chars": np.zeros(len(d), np.int64),
        "before": np.full(len(d), -1), "own": np.full(len(d), -1), "ends": np.array([ends[i] if x else NO_ENDS for i, x in zip(at, exact)], object),
        "parent_conv_id": np.where(step > 0, conv, top_parent[node]), "parent_block": np.where((step == 0) & is_open[node], parent_block[node], -1),
        "has_parent_conv": (step > 0) | ((above >= 0) & ~is_open)[node],
    }
    if first_lcp < 0 and next_lcp < 0:
        return out

    # parts of nodes over several blocks: those that come in from the left, then those that begin here and go on
    come = np.arange(first_lcp + 1)
    ends_here = np.array([_first_below(lcp, d) for d in come], np.int64) if len(come) else come
    go = np.array([d for d in range(next_lcp + 1) if lcp[:m].min() < d], np.int64)
    begins = np.array([_last_below(lcp[:m], d) for d in go], np.int64) if len(go) else go
    d, at, to = np.concatenate([come, go]), np.concatenate([np.zeros(len(come), np.int64), begins]), np.concatenate([ends_here, np.full(len(go), m)])
    mine = np.concatenate([np.zeros(len(come), bool), np.ones(len(go), bool)])
    after_first = at + mine
    prior = upto(at, np.maximum(d - 1, 0))
    children = np.array([(lcp[a:b] == x).sum() for x, a, b in zip(d, after_first, to)], np.int64)
    part = {
        "block": np.full(len(d), block), "from_block": np.where(mine, block, starts[d]), "depth": d, "conv_id": _least(least, at, to), "n_convs": n_copies[to] - n_copies[at],
        "n_children": children + (mine & (length[at] > d)), "n_leaves": n_leaf[to] - n_leaf[at], "all_chars": n_all[to] - n_all[at], "new_chars": n_new[to] - n_new[after_first],
        "before": np.where(mine, prior, -1), "own": np.where(mine, total[at], -1), "ends": np.array([(ends[i] if length[i] == x else NO_ENDS) if y else None for i, x, y in zip(at, d, mine)], object),
        "parent_conv_id": np.full(len(d), -1), "parent_block": np.where(mine & (d > 0), np.where(lcp[:m].min() < d - 1, block, starts[np.maximum(d - 1, 0)]), -1),
        "has_parent_conv": np.zeros(len(d), bool),
    }
    return {k: np.concatenate([v, part[k]]) for k, v in out.items()}


def _first_below(lcp: np.ndarray, d: int) -> int:
    """Where a node of this depth that comes in from the left ends: at an entry below it, or with the block."""
    below = np.flatnonzero(lcp[1:] < d)
    return int(below[0]) + 1 if len(below) else len(lcp) - 1


def _last_below(lcp: np.ndarray, d: int) -> int:
    return int(np.flatnonzero(lcp < d)[-1])


def _starts(block: int, minima: list[int], most: int) -> np.ndarray:
    """For each depth up to `most`, the nearest block before this one with an entry below it: where a node that comes in begins."""
    out, b = np.full(most + 1, -1), block - 1
    for d in range(most, -1, -1):
        while b >= 0 and minima[b] >= d:
            b -= 1
        out[d] = b
    return out


def prefix_trie(convs: DataFrame, *, blocks: int | None = None) -> DataFrame:
    """The nodes of the trie of conversations (conv_id, turns), as gather() gives them.

    conv_id is a node's smallest member, depth its number of turns, parent_conv_id its parent's
    conv_id (null for the root), n_convs its members, n_children its children, n_leaves the nodes
    without children in its subtree, saved_tokens, over its subtree, each node's characters of its
    last turn times its members but one, and ends_sha256 the hash of the ids of the conversations
    that end in it. A conversation without turns is a member of the root alone. Without any
    conversation there is no node. Rows that repeat an id are members each.

    Equal conversations are one string with a count, so copies never widen a block, and a turn that
    very many begin with is a node over several blocks, added up from one row for each.
    """
    spark = convs.sparkSession
    told = convs.select(
        "conv_id", F.coalesce(F.unhex(F.array_join(F.transform("turns", lambda x: F.hex(x.d)), "")), F.lit(b"")).alias("whole"), F.transform("turns", lambda x: x.n).alias("chars")
    )
    each = cut(told)
    strings = each.groupBy("whole").agg(F.count(F.lit(1)).alias("copies"), F.min("conv_id").alias("least"), F.any_value("chars").alias("chars"))
    strings = cut(strings.join(_ends(each.select("whole", "conv_id")), "whole"))
    size = strings.agg(F.sum(F.octet_length("whole") + 64)).first()[0]
    if size is None:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    count = blocks or int(min(MAX_BLOCKS, max(1, -(-size // BLOCK_BYTES))))
    placed = cut(strings.repartitionByRange(count, "whole").sortWithinPartitions("whole").withColumn("block", F.spark_partition_id()))

    def summary(batches: Iterator) -> Iterator:
        import pyarrow as pa

        first = last = block = None
        low = 1 << 40
        for b in batches:
            for s, k in zip(b.column("whole").to_pylist(), b.column("block").to_pylist()):
                low = low if last is None else min(low, common(last, s))
                first, last, block = s if first is None else first, s, k
        if block is not None:
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([first]), pa.array([last]), pa.array([low], pa.int64())], names=["block", "first", "last", "low"])

    seen = sorted(placed.select("block", "whole").mapInArrow(summary, "block int, first binary, last binary, low long").collect())
    number = {r["block"]: k for k, r in enumerate(seen)}
    edge = [-1, *[common(a["last"], b["first"]) for a, b in zip(seen, seen[1:])], -1]
    minima = [min(r["low"], e) for r, e in zip(seen, edge)]

    def nodes(batches: Iterator) -> Iterator:
        import pyarrow as pa

        rows = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("whole", "copies", "least", "chars", "ends", "block")))]
        if not rows:
            return
        whole, copies, least, chars, ends, of = zip(*rows)
        k = number[of[0]]
        got = block_rows(list(whole), np.array(copies), np.array(least), [np.array(c, np.int64) for c in chars], list(ends), k, edge[k], edge[k + 1], minima)
        missing = {"from_block": got["from_block"] < 0, "before": got["before"] < 0, "own": got["own"] < 0, "parent_block": got["parent_block"] < 0, "parent_conv_id": ~got.pop("has_parent_conv")}
        names = [x.split()[0] for x in _SCHEMA.split(",")]
        out = pa.RecordBatch.from_arrays([pa.array(got[n], pa.string() if n == "ends" else pa.int64(), mask=missing.get(n)) for n in names], names=names)
        for at in range(0, out.num_rows, 50_000):
            yield out.slice(at, 50_000)

    path = f"{shared_dir(spark)}/trie"
    placed.mapInArrow(nodes, _SCHEMA).write.parquet(path)
    rows = spark.read.parquet(path)

    parts = rows.where("from_block is not null")
    wide = parts.groupBy("from_block", "depth").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "all_chars", "new_chars")],
        *[F.max(c).alias(c) for c in ("before", "own", "ends", "parent_block")],
    )
    saved = F.col("all_chars") - F.col("n_convs") * F.col("before") - (F.col("own") - F.col("before") + F.col("new_chars"))
    wide = cut(wide.withColumn("saved_tokens", saved))
    ids = wide.select(F.col("from_block").alias("_from"), F.col("depth").alias("_depth"), F.col("conv_id").alias("_conv"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256")]
    up = (F.col("parent_block") == F.col("_from")) & (F.col("depth") - 1 == F.col("_depth"))
    tops = wide.join(ids, up, "left").withColumn("parent_conv_id", F.col("_conv")).select(*out)
    small = rows.where("from_block is null").withColumn("saved_tokens", F.col("all_chars"))
    inner = small.where("parent_block is null").select(*out)
    # nodes right below one over several blocks: met in each block, so that no node's children meet in one task
    here = cut(parts.select("block", "from_block", F.col("depth").alias("_depth")).join(ids.withColumnRenamed("_depth", "_d"), (F.col("from_block") == F.col("_from")) & (F.col("_depth") == F.col("_d"))).select(F.col("block").alias("_block"), "_from", "_depth", "_conv"))
    below = small.where("parent_block is not null").drop("parent_conv_id")
    below = below.join(broadcast_if_small(here, BROADCAST_NODES), (F.col("block") == F.col("_block")) & up).withColumnRenamed("_conv", "parent_conv_id").select(*out)
    return inner.unionByName(below).unionByName(tops)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(regenerated(gather(table(spark, sf_dir, "conversations"))))


#: CRC-32 of a decimal number, bit by bit.
_CRC = """xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ord(x) AS UBIGINT))),
    lambda a, x: list_reduce(list_prepend(xor(a, x), list_transform(range(8), lambda y: 0::UBIGINT)), lambda b, y: CASE WHEN b & 1 = 1 THEN xor(b >> 1, 3988292384::UBIGINT) ELSE b >> 1 END)))"""
#: Prefixes spelt out: every conversation with each of its prefixes, and every node with all nodes above it.
ORACLE_OP13 = f"""
WITH t AS (SELECT conv_id AS c, turn, sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS d, length(coalesce(text, '')) AS n FROM conversations WHERE conv_id IS NOT NULL),
e AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, d) AS i FROM t),
h AS (SELECT c, c - c % 100 AS base, CAST({_CRC} AS BIGINT) % 6 AS h FROM (SELECT DISTINCT c FROM t)),
r AS (SELECT h.c, 0 AS part, i, d, n FROM h JOIN e ON e.c = base AND i <= h UNION ALL SELECT h.c, 1, i, d, n FROM h JOIN e ON e.c = h.c AND i > h),
q AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, i) AS depth, d, n FROM r),
p AS MATERIALIZED (SELECT c, depth, n, string_agg(d, '/') OVER (PARTITION BY c ORDER BY depth) AS key,
      coalesce(string_agg(d, '/') OVER (PARTITION BY c ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS up FROM q UNION ALL SELECT c, 0, 0, '', NULL FROM h),
size AS (SELECT c, max(depth) AS depth FROM p GROUP BY c),
ends AS (SELECT depth, key, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ends FROM p JOIN size USING (c, depth) GROUP BY ALL),
node AS MATERIALIZED (SELECT depth, key, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs, any_value(n) AS n FROM p GROUP BY depth, key),
kids AS (SELECT depth - 1 AS depth, up AS key, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL),
full_ AS MATERIALIZED (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (depth, key)),
tree AS (SELECT p.depth, p.key, count(*) FILTER (f.n_children = 0) AS n_leaves, CAST(sum((f.n_convs - 1) * f.n) AS BIGINT) AS saved FROM full_ f JOIN p ON p.c = f.conv_id AND p.depth <= f.depth GROUP BY ALL)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM full_ f JOIN tree USING (depth, key) LEFT JOIN ends USING (depth, key) LEFT JOIN node up ON up.depth = f.depth - 1 AND up.key = f.up
"""
