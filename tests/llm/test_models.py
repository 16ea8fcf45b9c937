"""Held-out accuracy of the trained operators, and their answers for odd rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanframe.llm import langid, toxicity

SYLLABLES = {"aa": "ka lo mi tu re", "bb": "sch ung ber zu ein", "cc": "ción os la que ado"}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang].split()) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_language_mixture(spark):
    rng = random.Random(1)
    train = [(i, text(rng, x, 40), x) for i, x in enumerate(list(SYLLABLES) * 30)] + [(900, None, "aa"), (901, "karo", None)]
    langs, logp = langid.train(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    assert langs == sorted(SYLLABLES)
    data = [(i, text(rng, x, rng.randrange(3, 60)), x) for i, x in enumerate(list(SYLLABLES) * 30)]
    mixed = (500, text(rng, "aa", 60) + " " + text(rng, "bb", 30), "aa")
    odd = [(600, None, ""), (601, "", ""), (602, "123 !?", ""), (None, "ka" * 20000, "aa")]
    got = {r.doc_id: r for r in langid.predict(spark.createDataFrame(data + [mixed] + odd, "doc_id long, text string, lang_pred string"), langs, logp).collect()}
    assert len(got) == len(data) + 5
    assert np.mean([got[i].lang_pred == x for i, _, x in data]) > 0.97
    assert got[500].lang_pred == "aa" and 0.55 < got[500].score < 0.75 and ",bb:0." in got[500].languages
    assert [(got[i].lang_pred, got[i].score) for i in (600, 601, 602)] == [("und", 0.0)] * 3 and got[None].lang_pred == "aa"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert langid.predict(spark.createDataFrame(data, "doc_id long, text string, x string"), *langid.train(spark.createDataFrame([], "doc_id long, text string, lang string"))).where("lang_pred = 'und'").count() == len(data)


def plain_mixture(logp, w, rounds):
    """EM with a responsibility for each gram and language, one at a time."""
    n = logp.shape[1]
    share = [1 / n] * n
    for _ in range(rounds):
        new = [0.0] * n
        for g in range(len(w)):
            r = [share[k] * math.exp(logp[g, k]) for k in range(n)]
            for k in range(n):
                new[k] += w[g] * r[k] / sum(r) / sum(w)
        moved = max(abs(a - b) for a, b in zip(new, share))
        share = new
        if moved < 1e-3:
            break
    return share, sum(w[g] * math.log(sum(share[k] * math.exp(logp[g, k]) for k in range(n))) for g in range(len(w)))


def test_mixture_equals_plain_em():
    rng = np.random.default_rng(3)
    for n in (1, 2, 4):
        for grams in (1, 3, 40):
            logp = np.log(rng.dirichlet(np.ones(60), n).T[:grams])
            w = rng.integers(1, 9, grams).astype(float)
            share, ll = langid.mixture(logp, w)
            want, want_ll = plain_mixture(logp, w, 20)
            assert share == pytest.approx(want, abs=1e-9) and ll == pytest.approx(want_ll)
            # the chosen set is the best of the nested ones by penalised likelihood, looked at until one is no better
            order = sorted((k for k in range(n) if want[k] >= 0.02), key=lambda k: -want[k])
            cost = 3 * math.log(max(w.sum(), 2)) / 2
            best, chosen = max((w @ logp[:, k], -k) for k in range(n))
            best_set = {-chosen}
            for k in range(2, len(order) + 1):
                value = plain_mixture(logp[:, order[:k]], w, 20)[1] - cost * (k - 1)
                if value <= best:
                    break
                best, best_set = value, set(order[:k])
            got, proportions = langid.infer(logp, w)
            assert set(got.tolist()) == best_set and (np.diff(proportions) <= 0).all()


def test_many_languages_odd_rows_and_empty_table(spark):
    rows = [(i, f"{chr(97 + i % 250 // 10)}{chr(97 + i % 10)}x " * 30, f"l{i % 250:03d}") for i in range(500)]
    langs, logp = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(langs) == 250 and logp.shape[1] == 250
    df = spark.createDataFrame([(i, t, "x", "y") for i, t, _ in rows], "doc_id long, text string, score string, languages string")
    assert all(r.lang_pred == rows[r.doc_id][2] for r in langid.predict(df, langs, logp).collect())
    assert langid.predict(df.limit(0), langs, logp).count() == 0


def test_out_of_fold_probabilities():
    """No label and no feature choice of a document's own fold reaches its probability; each equals a model fitted by hand."""
    rng = np.random.default_rng(5)
    n, m = 90, 30
    has = rng.random((n, m)) < 0.2
    y = np.stack([has[:, :3].any(1), has[:, 5:8].any(1)], 1).astype(float)
    y[::17, 0] = np.nan
    fold, allowed = rng.integers(0, 3, n), rng.random((2, 4, m)) < 0.8
    ptr, cols = np.concatenate([[0], np.cumsum(has.sum(1))]), np.nonzero(has)[1]
    features = {str(k): k for k in range(m)}
    chain, oof = toxicity.fit_chain(ptr, cols, y, features, fold, allowed)
    for k in range(3):
        more = np.zeros((n, 0))
        for c in range(2):
            rows = [i for i in range(n) if fold[i] != k and not np.isnan(y[i, c])]
            only = [[j for j in range(m) if has[i, j] and allowed[c, k, j]] for i in rows]
            fitted = toxicity.Linear.fit(np.cumsum([0] + [len(x) for x in only]), np.array([j for x in only for j in x], int), oof[rows, :c], y[rows, c], m)
            for i in np.flatnonzero(fold == k):
                z = fitted.weights[has[i]].sum() + oof[i, :c] @ fitted.dense + fitted.bias
                assert oof[i, c] == pytest.approx(1 / (1 + math.exp(-z)))
        flipped = y.copy()
        flipped[fold == k, 0] = 1 - flipped[fold == k, 0]
        assert toxicity.fit_chain(ptr, cols, flipped, features, fold, allowed)[1][fold == k, 0] == pytest.approx(oof[fold == k, 0])
    assert toxicity.fit_chain(ptr, cols, np.full((n, 2), np.nan), features, fold, allowed)[1].max() < 1e-9


def test_ranked_features(spark):
    rng = random.Random(6)
    data = [(f"f{k}", rng.randrange(40), rng.randrange(4)) for k in range(60)]
    got = [r.f for r in toxicity.ranked(spark.createDataFrame(data, "f string, t long, c long"), 40, 400, 25).collect()]
    odds = lambda t, c: math.log((t + 0.5) / 41) - math.log((c + 0.5) / 401)
    want = sorted((-odds(t, c) * math.log1p(t), f) for f, t, c in data if t >= 4 and odds(t, c) > 3)
    assert got == [f for _, f in want[:25]]


def test_toxicity_chain(spark):
    rng = random.Random(2)
    bad = ["vileword", "foulterm", "rotten"]
    data, labels = [], []
    for i in range(900):
        w = text(rng, "aa", 40).split()
        y = i % 4 == 0
        for _ in range(rng.randrange(1, 5) if y else 0):
            w.insert(rng.randrange(len(w)), rng.choice(bad) + rng.choice(["", "s", "ness"]))
        data.append((i, " ".join(w), y))
        if i < 500:
            labels.append((i, int(y)))
    data += [(None, None, False), (5000, "", False), (5001, "123", False), (5002, "ka " * 30000 + "foulterm", True)]
    df = spark.createDataFrame(data, "doc_id long, text string, p_toxic boolean")
    chain = toxicity.train(df, spark.createDataFrame(labels + [(1, None), (None, 1), (2, 0)], "doc_id long, toxic int"))
    assert len(chain.models) == 2 and [len(m.dense) for m in chain.models] == [0, 1]
    got = {r.doc_id: r for r in toxicity.predict(df, chain).collect()}
    assert all(got[i].is_toxic == y for i, _, y in data if i is None or i >= 500)
    assert toxicity.predict(df.limit(0), chain).count() == 0
    named = toxicity.train(df.select(F.col("doc_id").cast("string").alias("doc_id"), "text"), spark.createDataFrame([(str(i), y, i % 2) for i, y in labels], "doc_id string, toxic int, quality int"))
    assert len(named.models) == 2
    none = toxicity.train(df, spark.createDataFrame([], "doc_id long, toxic int"))
    assert none is None and toxicity.predict(df, none).where("is_toxic").count() == 0
