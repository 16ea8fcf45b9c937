"""Every stage of the pipeline against brute force on its own input, over a small corpus with all kinds of rows."""

import random
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from spanframe.llm.common import shared_dir

from .test_native import brute, lower, water, words
from .test_neardup import brute as near_brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _kept string, _size int, component_id string"


def corpus():
    rng = random.Random(3)  # columns after n_chars have the names of results
    text = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    out = [(0, None), (1, ""), (2, "too short"), (3, "again and " * 60)]
    base = text(150)
    out += [(10 + k, base if k % 2 else base.upper()) for k in range(12)]
    for k in range(20):
        w = base.split()
        w[rng.randrange(150)] = f"new{k}"
        out.append((30 + k, " ".join(w)))
    out += [(100 + k, text(rng.randrange(50, 400)) + "\nfooter") for k in range(150)]
    out += [(300, text(9000)), (400, "é" + text(60))]
    return [(i, t, "en", None if i % 11 == 0 else f"s{i % 4}", len(t or ""), "k", 7, None) for i, t in out]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame(corpus(), SCHEMA).repartition(3).write.parquet(f"{base}/documents.parquet")
    docs, out = spark.read.parquet(f"{base}/documents.parquet"), []
    for k, (name, f) in enumerate(corpus_pipeline.STAGES):
        f(spark, docs, str(base)).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
        out.append(sorted(map(tuple, docs.collect()), key=str))
        assert name == "packing" or docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "_kept", "_size", "component_id"]
    return str(base), out


def test_quality_keeps_clean_documents(stages):
    want = [r for r in corpus() if (n := brute(r[1]))[0] >= 50 and 100 * n[4] <= 50 * n[0]]
    assert stages[1][0] == sorted(want, key=str)


def test_exact(stages):
    best = defaultdict(list)
    for r in stages[1][0]:
        best[lower(r[1])].append(r)
    assert stages[1][1] == sorted((max(g) for g in best.values()), key=str)


def test_near(stages):
    kept = {r[0] for r in near_brute([(r[0], r[1]) for r in stages[1][1]], 80) if r[3]}
    assert stages[1][2] == [r for r in stages[1][1] if r[0] in kept] and len(kept) < len(stages[1][1])


def test_mixing(stages):
    size = Counter()
    for r in stages[1][2]:
        size[r[3]] += len(words(r[1]))
    target, taken = water(size), Counter(stages[1][3])
    for r in stages[1][2]:
        rate = target[r[3]] / size[r[3]]
        assert int(rate - 1e-9) <= taken.pop(r, 0) <= int(rate + 1e-9) + 1
    assert not taken


def test_packing(stages):
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = Counter((r[0], len(tok.encode(r[1], add_special_tokens=False).ids) + 1) for r in stages[1][3])
    got, seqs = Counter(), defaultdict(int)
    for doc_id, _, _, length, _, seq, _ in stages[1][4]:
        got[doc_id] += length
        seqs[seq] += length
    assert got == sum((Counter({i: n * c}) for (i, n), c in want.items()), Counter())
    assert max(seqs.values()) <= 2048 and len(seqs) <= 1.1 * sum(seqs.values()) / 2048 + 1


def test_run_and_empty_table(spark, stages, tmp_path):
    rows = corpus_pipeline.run(spark, stages[0])
    assert sorted(r.length for r in rows.collect()) == sorted(r[3] for r in stages[1][4])
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert shared_dir(spark) != shared_dir(spark)


@pytest.mark.parametrize("repeat", [False, True])
def test_stages_take_only_the_columns_that_are_there(spark, repeat):
    """No source and no other column, with and without ids that repeat; a group's smallest id stays, of rows that share it one."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(900)}" for _ in range(200)]
    near = lambda k: " ".join([*base[:k], f"new{k}", *base[k + 1 :]])
    other = lambda: " ".join(f"v{rng.randrange(900)}" for _ in range(80))
    data = [(7, near(3)), (5, near(90)), (9, near(150)), (None, near(20)), (11, other()), (12, other())] + ([(5, near(120)), (12, other())] if repeat else [])
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(2)
    for _, f in corpus_pipeline.STAGES[:4]:
        assert f(spark, docs, "").columns == docs.columns
    kept = Counter(r.doc_id for r in corpus_pipeline.near(spark, docs, "").collect())
    assert kept == Counter({5: 1, None: 1, 11: 1, 12: 2 if repeat else 1})
    assert corpus_pipeline.packing(spark, docs, "").count() == len(data)
