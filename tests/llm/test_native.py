"""Exact dedup, mixing and quality rules against brute force on small, awkward tables."""

import collections
import hashlib
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from spanframe.llm.exactdup import exact_copies
from spanframe.llm.mixing import emit, mix, targets
from spanframe.llm.quality import quality_rules, statistics

SCHEMA = "doc_id long, text string, source string, _x string, n long"
LONG = "one two three four five six " * 2000


def rows():
    hot = [(100 + i, "Hot TEXT with words", "hot", "c", i) for i in range(120)]
    return hot + [
        (1, None, "a", None, 1), (2, "", "a", "q", None), (3, "Ab c\nAb c\n\n x # $", None, "q", 2), (4, "aB C\naB C\n\n X # $", "b", "q", 2),
        (4, "aB C\naB C\n\n X # $", "b", "q", 2), (None, "aB C\naB C\n\n X # $", "b", "q", 2), (5, "É é", "c", "", 0), (6, "é é", "c", "", 0),
        (7, LONG, "a", "", 0), (8, LONG + "!", "d", "", 0), (9, "  lead x\x0b y\x1cz ", "a", "", 0), (None, None, None, None, None),
        (10, " ".join(f"w{i}" for i in range(60)), "a", "", 0),
    ]


def lower(t):
    return (t or "").encode().lower().decode()


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


@pytest.mark.parametrize("hot_rows", [500, 10])
def test_exact_copies(spark, hot_rows):
    data = rows()
    got = exact_copies(spark.createDataFrame(data, SCHEMA).repartition(5), hot_rows=hot_rows).collect()
    assert len(got) == len(data) and set(got[0].asDict()) == {"doc_id", "text", "source", "_x", "n", "_keep_id", "_group_size", "_kept", "_sha256"}
    groups = collections.defaultdict(list)
    for i, t, *_ in data:
        groups[lower(t)].append(i)
    kept = collections.Counter()
    for r in got:
        g = groups[lower(r.text)]
        assert r._keep_id == max((x for x in g if x is not None), default=None) and r._group_size == len(g)
        assert r._sha256.hex() == hashlib.sha256(lower(r.text).encode()).hexdigest()
        assert not r._kept or r.doc_id == r._keep_id
        kept[lower(r.text)] += r._kept
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    least = exact_copies(spark.createDataFrame(data, SCHEMA), keep="min", hot_rows=hot_rows).where("_kept and source = 'hot'").collect()
    assert [r.doc_id for r in least] == [100]
    assert exact_copies(spark.createDataFrame([], SCHEMA)).count() == 0


def water(sizes, weights=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % 3] for k, s in enumerate(order)}
    target, left, free = {}, float(sum(sizes.values())), set(order)
    while free:
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]
        free -= over
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5, None: 3}, {"a": 0, "b": 0}, {"a": 1, "b": 1, "c": 1, "d": 900, "é": 2, "Z": 0}, {"x": 7}])
def test_targets(spark, sizes):
    got = {r.source: r.target for r in targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    assert got == pytest.approx(water(sizes))


def test_mix(spark):
    data = rows() + [(1000 + i, "w " * (i % 50 + 1), f"s{i % 3}", None, 0) for i in range(3000)]
    df = spark.createDataFrame(data, SCHEMA)
    mixed = mix(df)
    got = mixed.collect()
    size = collections.Counter()
    for _, t, s, *_ in data:
        size[s] += len(words(t))
    want, taken = water(size), collections.Counter()
    for r in got:
        assert r._size == len(words(r.text)) and r._source_size == size[r.source] and r._target == pytest.approx(want[r.source])
        rate = want[r.source] / size[r.source] if size[r.source] else 0
        assert int(rate - 1e-9) <= r._copies <= rate + 1
        taken[r.source] += r._size * r._copies
    for s in ("s0", "s1", "s2"):
        f = want[s] / size[s] % 1
        spread = sum(len(words(t)) ** 2 * f * (1 - f) for _, t, x, *_ in data if x == s) ** 0.5
        assert abs(taken[s] - want[s]) <= 4 * spread
    assert emit(mixed, df.columns).count() == sum(r._copies for r in got)
    assert sorted(map(str, got)) == sorted(map(str, mix(df.repartition(7)).collect()))
    assert mix(spark.createDataFrame([], SCHEMA)).count() == 0


def brute(t):
    w = words(t)
    grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    twice = collections.Counter(grams)
    at = {k + d for k, g in enumerate(grams) if twice[g] > 1 for d in range(3)}
    lines = [x for x in (t or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(at)


def test_quality(spark):
    footer = "Shared FOOTER line of the host with quite a few words in it"
    body = lambda k, n: " ".join(f"u{k}x{i}" for i in range(n))
    data = rows() + [(2000 + k, body(k, 60) + "\n" + footer.lower().replace(" ", "  "), "h", None, 0) for k in range(20)]
    data += [(3000 + k, f"{body(k + 50, 10)}\n" + f"{footer} \n" * 5, "h", None, 0) for k in range(5)]
    data += [(4000 + k, body(999, 70), "h", None, 0) for k in range(40)]  # copies count once
    df = spark.createDataFrame(data, SCHEMA)
    got = quality_rules(df, clean=True).collect()
    assert len(got) == len(data)
    for r in got:
        n = brute(r.text)
        assert (r._n_words, r._word_chars, r._n_symbols, r._n_dup_lines, r._n_repeat_words) == n
        assert r._base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        if r.doc_id is not None and r.doc_id >= 2000:
            assert r._kept == (not 3000 <= r.doc_id < 4000) and ("footer" in r._clean_text.lower()) is False
            assert r._removed_words == (12 * r.text.lower().count("footer") if r.doc_id < 4000 else 0) or r._removed_words == 13 * r.text.lower().count("footer")
    assert quality_rules(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeated_windows(spark):
    """No, few and many repeated windows, ends of texts and white space of all six kinds."""
    import random

    rng = random.Random(4)
    texts = ["", " ", "a", "a b", "a b c", "a b c a b c", "\x0b a\x0cb \r\n c\t", "x\x85y \xa0 z", "a a a a", "q " * 40]
    texts += [" ".join(rng.choice("abcdefg"[:k]) for _ in range(n)) for k in (2, 4, 7) for n in (5, 30, 300)]
    texts += [" ".join(f"w{rng.randrange(9)}" for _ in range(n)) for n in (20, 60, 200, 900)]
    got = {r.doc_id: r for r in statistics(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for k, t in enumerate(texts):
        r = got[k]
        assert (r._n_words, r._word_chars, r._n_symbols, r._n_dup_lines, r._n_repeat_words) == brute(t), t


def test_columns_with_clashing_names(spark):
    names = ("_kept", "kept", "_source", "size", "n_words", "_digest", "component_id", "copies", "_norm", "_size")
    df = spark.createDataFrame([(i, f"some text {i % 2}", "s", *names) for i in range(4)], "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names))
    for out, result in ((exact_copies(df), "_kept"), (mix(df), "_size"), (quality_rules(df), "_kept")):
        rows = out.collect()
        assert len(rows) == 4 and len(set(out.columns)) == len(out.columns) and not isinstance(rows[0][result], str) and rows[0].kept == "kept" and rows[0].n_words == "n_words"


def test_absolute_line_limit(spark):
    footers = [" ".join(f"f{j}x{i}" for i in range(11)) for j in range(9)]
    body = lambda k, n: " ".join(f"u{k}x{i}" for i in range(n))
    data = [(k, body(k, 60) + "\n" + (footers[k % 9] if k < 315 else "les."), "h") for k in range(700)]
    data += [(1000 + k, "\n".join([body(1000 + k, 10), *footers]), "h") for k in range(4)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    share = {r.doc_id: r for r in quality_rules(df).collect()}
    both = {r.doc_id: r for r in quality_rules(df, most=30).collect()}
    assert all(share[k]._removed_words == 0 and share[k]._kept for k in [*range(315), 1000, 1001, 1002, 1003])
    assert all(both[k]._removed_words == 11 and both[k]._kept for k in range(315))
    assert all(both[k]._removed_words == 99 and not both[k]._kept for k in range(1000, 1004))
    far = {r.doc_id: r for r in quality_rules(df, share=0.99, most=30).collect()}
    assert all(far[k]._removed_words == 0 for k in range(315, 700))  # short chance lines stay
    assert {r.doc_id for r in corpus_pipeline.quality(spark, df, "").collect()} == set(range(700))
