"""The prefix trie against one that is built turn by turn."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from spanframe.llm.trie import common, gather, prefix_trie, regenerated, smaller_values


def brute(data, again):
    convs = defaultdict(list)
    for c, turn, role, text, *_ in data:
        if c is not None:
            convs[c].append(((turn is not None, turn or 0), role or "", text or ""))
    convs = {c: [x[1:] for x in sorted(t, key=lambda x: x[0])] for c, t in convs.items()}
    if again:
        whole = {}
        for c, own in convs.items():
            h = zlib.crc32(str(c).encode()) % 6
            base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
            whole[c] = convs.get(base, [])[:h] + own[h:]
        convs = whole
    nodes = defaultdict(list)
    for c, t in convs.items():
        for d in range(len(t) + 1):
            nodes[tuple(t[:d])].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for k in nodes:
        if k:
            kids[k[:-1]] += 1
    for k, members in nodes.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in kids
            saved[k[:d]] += (len(members) - 1) * len(k[-1][1]) if k else 0
    out = []
    for k, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in members if len(convs[c]) == len(k)))
        out.append((min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), kids[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n):
    """Few different turns, so that prefixes are shared; long, equal and lone conversations; nulls."""
    rng = random.Random(seed)
    data = []
    for c in range(n):
        if c % 7 == 3:
            continue
        for turn in range(rng.choice([1, 1, 2, 3, 5, 8])):
            data.append((c, None if turn == 0 and c % 5 == 0 else turn, rng.choice(["user", None, ""]), rng.choice(["a", "bé", "", None, "ccc"])))
    for c in (n + 100, n + 101, n + 250):
        data += [(c, t, "user", f"turn {t % 50}") for t in range(90 if c == n + 100 else 89)]
    data += [(n + 300 + k, 0, "user", "hello") for k in range(60)] + [(n + 400, 0, "a", "x" * 100_000), (-5, 0, "a", "b"), (-100, 0, "q", "r"), (None, 0, "user", "lost")]
    rng.shuffle(data)
    return data


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("again", [True, False])
@pytest.mark.parametrize("blocks", [None, 5, 60])
def test_equals_brute_force(spark, monkeypatch, blocks, again):
    monkeypatch.setattr("spanframe.llm.trie.PIECE_TURNS", 16)
    data = corpus(1, 150)
    convs = gather(spark.createDataFrame([(*r, 5) for r in data], SCHEMA + ", depth int").repartition(4))
    got = sorted(map(tuple, prefix_trie(regenerated(convs) if again else convs, blocks=blocks).collect()), key=str)
    assert got == brute(data, again)


def test_one_path_and_equal_conversations(spark):
    """No branch at all; only equal conversations; one that is the beginning of another; conversations without turns."""
    cases = [
        [(5, 0, "u", "a"), (5, 1, "u", "b")],
        [(c, 0, "u", "a") for c in range(50)],
        [(1, 0, "u", "a"), (2, 0, "u", "a"), (2, 1, "u", "b"), (3, 0, "u", "a"), (3, 1, "u", "b"), (3, 2, "u", "b")],
        [(c, 0, "u", f"only {c}") for c in range(101, 140)],
    ]
    for data in cases:
        for blocks in (1, 4):
            for again in (False, True):
                convs = gather(spark.createDataFrame(data, SCHEMA))
                got = sorted(map(tuple, prefix_trie(regenerated(convs) if again else convs, blocks=blocks).collect()), key=str)
                assert got == brute(data, again)
    assert prefix_trie(gather(spark.createDataFrame([], SCHEMA))).count() == 0
    assert prefix_trie(gather(spark.createDataFrame([(None, 1, "u", "a")], SCHEMA))).count() == 0


def test_ties_and_repeated_rows(spark):
    """Turns with one number go by their digest, whatever order the rows come in."""
    rows = [(1, 0, "u", "a"), (1, 0, "u", "b"), (1, 0, "u", "a"), (2, 0, "u", "b"), (2, 0, "u", "a"), (2, 0, "u", "a")]
    got = prefix_trie(gather(spark.createDataFrame(rows, SCHEMA))).collect()
    assert sorted((r.depth, r.n_convs) for r in got) == [(0, 2), (1, 2), (2, 2), (3, 2)]


def test_smaller_values():
    rng = random.Random(0)
    for _ in range(200):
        a = [rng.randrange(5) for _ in range(rng.randrange(1, 15))]
        before, after = smaller_values(np.array(a))
        for i, v in enumerate(a):
            assert before[i] == max((j for j in range(i) if a[j] < v), default=-1)
            assert after[i] == min((j for j in range(i + 1, len(a)) if a[j] < v), default=len(a))
    x = bytes(range(64))
    assert common(x, x) == 4 and common(x, x[:32]) == 2 and common(b"", x) == 0 and common(x[:16] + x[:48], x) == 1
