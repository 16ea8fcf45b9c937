import random

import numpy as np
import pytest

from spanframe.llm.components import components
from spanframe.llm import neardup
from spanframe.llm.neardup import linked_sets, n_bands, near_duplicates, rare_prefix, shingle_hashes, signature, sketch_cut


def brute(data, num, n=5):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())

    sets = [(i, shingles(t)) for i, t in data]
    p = {i: i for i, _ in data}

    def find(x):
        while p[x] != x:
            x = p[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= num * len(a | b):
                x, y = sorted((find(i), find(j)))
                p[y] = x
    return sorted(((i, len(s), find(i), i == find(i)) if i is not None else (None, len(s), None, True) for i, s in sets), key=str)


def corpus(seed=0):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    data = [(1, None), (2, ""), (3, " \n"), (None, "a b c d e f"), (4, "A b c d e f"), (5, "a B c d e f"), (6, "one two"), (7, "ONE two"), (8, "one"), (9, "lone " * 6000)]
    at = 10
    for size in (2, 3, 5, 60, 150):
        base = [word() for _ in range(120)]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randrange(0, 7)):
                w[rng.randrange(len(w))] = word()
            data.append((at, " ".join(w)))
            at += 1
    common = " ".join(word() for _ in range(60))
    for _ in range(60):
        data.append((at, common + " " + " ".join(word() for _ in range(rng.randrange(10, 60)))))
        at += 1
    rng.shuffle(data)
    return data


@pytest.mark.parametrize("num, small, block, wide", [(85, 32, 128, 32), (80, 4, 8, 32), (85, 2, 16, 32), (80, 2, 4, 1)])
def test_equals_brute_force(spark, num, small, block, wide):
    data = corpus()
    df = spark.createDataFrame([(i, t, "x") for i, t in data], "doc_id long, text string, n_shingles string").repartition(3)
    got = sorted(map(tuple, near_duplicates(df, num=num, small=small, block=block, wide=wide).collect()), key=str)
    assert got == brute(data, num)


@pytest.mark.parametrize("small, block, pairs", [(1000, 1, 20), (32, 2, 40)])
def test_small_buckets_of_a_group_in_several_parts(spark, small, block, pairs):
    """Pairs whose every bucket holds documents of a wide family, which is linked with neither."""
    rng = random.Random(5)
    runs = [" ".join(f"r{j}w{i}" for i in range(16)) for j in range(80)]
    wide = lambda: sorted(rng.sample(range(80), 70))
    data = [(i, " ".join(runs[j] for j in wide())) for i in range(120)]
    for p in range(pairs):
        x = wide()
        y = sorted((set(x) - set(rng.sample(x, 3))) | set(rng.sample(sorted(set(range(80)) - set(x)), 3)))
        data += [(1000 + 2 * p + k, " ".join(runs[j] for j in z)) for k, z in enumerate((x, y))]
    want = brute(data, 85)
    assert sum(not r[3] for r in want) >= pairs
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert sorted(map(tuple, near_duplicates(df, num=85, small=small, block=block).collect()), key=str) == want


def loose_bucket(n, rng):
    """Documents that share most of their words with all others, and are linked in threes only."""
    runs = [" ".join(f"t{j}w{i}" for i in range(12)) for j in range(40)]
    data = []
    for k in range(0, n, 3):
        own = [f"o{k}w{i}" for i in range(160)]
        for m in range(3):
            w = list(own)
            w[rng.randrange(160)] = f"x{k}y{m}"
            data.append((k + m, " ".join(runs + w)))
    return data


def test_loose_bucket_meets_by_rare_shingles(spark, monkeypatch):
    """Every document is in buckets of all the others; entries grow with rows, not with their square."""
    dealt = []
    real = neardup.by_rare_shingles

    def counted(rows, num, den):
        out = neardup.cut(real(rows, num, den))
        widest = out.groupBy("key").count().agg({"count": "max"}).first()[0] or 0
        dealt.append((rows.count(), out.count(), widest))
        return out

    monkeypatch.setattr(neardup, "by_rare_shingles", counted)
    data = loose_bucket(360, random.Random(3))
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, near_duplicates(df, num=85, small=2, block=4, wide=4).collect()), key=str)
    assert got == brute(data, 85)
    (rows, entries, widest), = dealt
    assert rows > 200 and entries <= rows * 130 and widest < rows / 4


def test_rare_prefixes_of_linked_sets_meet():
    rng = np.random.default_rng(1)
    level = rng.integers(0, 90, 1 << neardup.RARITY_BITS).astype(np.uint8)
    for _ in range(300):
        n = int(rng.integers(1, 300))
        a = np.unique(rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2))
        drop = int(len(a) * 15 // 100)
        b = np.sort(np.delete(a, rng.choice(len(a), drop, replace=False)))
        assert 100 * len(b) >= 85 * len(a)
        x, y = rare_prefix(a, level, 85, 100), rare_prefix(b, level, 85, 100)
        assert len(x) <= 0.15 * len(a) + 1 and len(np.intersect1d(x, y))
    assert (rare_prefix(a[:1], level, 85, 100) == a[:1]).all()


def test_hot_sets_and_null_ids(spark, monkeypatch):
    """Rows of sets that very many rows share take another way to their component."""
    monkeypatch.setattr("spanframe.llm.neardup.HOT_ROWS", 5)
    data = corpus(1) + [(5000 + k, "hot words that many rows of this table have in common") for k in range(40)] + [(6000 + k, " ") for k in range(40)]
    data += [(None, None)] * 9 + [(None, "hot words that many rows of this table have in common")] * 3 + [(7000, "Hot words that many rows of this table have in common")]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, near_duplicates(df, num=85).collect()), key=str)
    assert got == brute(data, 85)


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(5, "a b c d e f g"), (5, "a b c d e f g"), (9, "a b c d e f g")], "doc_id long, text string")
    assert sorted(map(tuple, near_duplicates(df).collect())) == [(5, 3, 5, True), (5, 3, 5, True), (9, 3, 5, False)]
    assert near_duplicates(df.limit(0)).count() == 0


def test_ids_with_several_texts(spark):
    """One vertex with the links of all its texts; the pipeline's stage drops rows, not ids."""
    text = lambda name, n=60, last="": " ".join(f"{name}{i}" for i in range(n)) + last
    data = []
    for k in range(0, 200, 10):
        data += [(k + 1, text(f"a{k}x")), (k + 1, text(f"b{k}x")), (k + 1, ""), (k + 2, text(f"a{k}x", last=" new")), (k + 3, text(f"b{k}x", last=" new"))]
        data += [(k + 4, text(f"c{k}x")), (k + 5, text(f"c{k}x")), (k + 5, text(f"d{k}x")), (k + 6, text(f"d{k}x", last=" new"))]
        data += [(k + 7, text(f"e{k}x")), (k + 8, text(f"f{k}x")), (k + 8, text(f"e{k}x", last=" new"))]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, near_duplicates(df, num=80).collect()), key=str) == brute(data, 80)
    import corpus_pipeline

    kept = {tuple(r) for r in corpus_pipeline.near(spark, df, "").collect()}
    want = {(i, t) for (i, t) in data if not (t.endswith(" new") or (t.startswith("c") and i % 10 == 5))}
    assert kept == want


def test_linked_sets_and_sketches():
    rng = np.random.default_rng(0)
    most, missed = sketch_cut(0.85), 0
    assert 60 < most < 100
    for _ in range(150):
        n = int(rng.integers(40, 600))
        both, d = rng.integers(0, 1 << 63, n, np.uint64), max(1, int(n * 0.15 / 2))
        a, b = np.unique(np.concatenate([both, rng.integers(0, 1 << 63, d, np.uint64)])), np.unique(np.concatenate([both, rng.integers(0, 1 << 63, d, np.uint64)]))
        exact = 100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b))
        assert linked_sets([a, b], 85, 100)[0, 1] == exact
        (ka, oa), (kb, ob) = signature(a, n_bands(0.85)), signature(b, n_bands(0.85))
        missed += exact and (not (ka == kb).any() or np.bitwise_count((oa ^ ob).view(np.uint64)).sum() > most)
    assert missed == 0
    assert len(shingle_hashes("A b c d e f")) == 2 and (shingle_hashes("a B") == shingle_hashes("A b")).all()


def test_components(spark):
    chain = [(k, k + 1) for k in range(0, 60)] + [(100, 200), (200, 150), (7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert got == {k: 0 for k in range(61)} | {100: 100, 200: 100, 150: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
