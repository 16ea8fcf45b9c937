"""Toxicity by a classifier chain: linear models in sequence, each fed by the earlier ones' probabilities.

The categories are the labels that the table has: low quality first, then toxic. Later models are
trained on out-of-fold probabilities of the earlier ones: a document's comes from a model that saw
neither it nor its label, not even in the choice of features. Features are words, letter 5-grams and
runs of signs of the whole text, chosen for each category by how much more of its documents than
of the others have them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_if_small, cut, small_batches, table

#: Bounds of the sample that the models are fitted on, for each class, and of the features.
MAX_DOCS, MAX_FEATURES = 5_000, 2_048
#: Features are taken from this log-odds of toxic against clean documents on.
MIN_ODDS = 3.0
#: ... if at least this share of the sampled toxic documents, and four, have them.
MIN_SHARE = 0.015
#: The chain, in order: what each category's label says, and the folds of its out-of-fold probabilities.
CHAIN = {"low_quality": "1 - quality", "toxic": "toxic"}
FOLDS = 3

_WORD = re.compile(r"[^\W\d_]+|[^\w\s]{2,}|\|")


def word_features(word: str) -> tuple[str, ...]:
    """The word and its letter 5-grams, with its ends marked; a run of signs by itself."""
    marked = f"^{word}$"
    if not word[0].isalpha():
        return (marked,)
    return (marked, *(marked[k : k + 5] for k in range(max(1, len(marked) - 4))))


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


class _Cached(dict):
    """What a function gives for each word; emptied when it grows large."""

    def __init__(self, f):
        super().__init__()
        self.f = f

    def __missing__(self, word: str):
        if len(self) >= 200_000:
            self.clear()
        found = self[word] = self.f(word)
        return found


@dataclass
class Linear:
    """Logistic regression on binary features, given as row pointers and columns, and a few dense ones."""

    weights: np.ndarray
    dense: np.ndarray
    bias: float

    @staticmethod
    def fit(ptr: np.ndarray, cols: np.ndarray, more: np.ndarray, y: np.ndarray, n: int, rounds: int = 200, l2: float = 1e-5) -> Linear:
        """Full-batch gradient steps with a step of its own for each weight; deterministic.

        Features were chosen as signs of toxicity, so their weights stay at 0 or above.
        """
        owner = np.repeat(np.arange(len(y)), np.diff(ptr))
        w, v, b = np.zeros(n), np.zeros(more.shape[1]), 0.0
        gw, gv, gb = np.full(n, 1e-8), np.full(len(v), 1e-8), 1e-8
        positive = max(y.sum(), 1)
        weight = np.where(y > 0, len(y) / (2 * positive), len(y) / (2 * max(len(y) - positive, 1)))
        for _ in range(rounds):
            z = np.bincount(owner, w[cols], len(y)) + more @ v + b
            e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight / len(y)
            g, h, c = np.bincount(cols, e[owner], n) + l2 * w, more.T @ e + l2 * v, e.sum()
            gw, gv, gb = gw + g * g, gv + h * h, gb + c * c
            w, v, b = np.maximum(w - 0.5 * g / np.sqrt(gw), 0), v - 0.5 * h / np.sqrt(gv), b - 0.5 * c / np.sqrt(gb)
        return Linear(w, v, b)

    def probability(self, ptr: np.ndarray, cols: np.ndarray, more: np.ndarray) -> np.ndarray:
        owner = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
        z = np.bincount(owner, self.weights[cols], len(ptr) - 1) + more @ self.dense + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Chain:
    features: dict[str, int]
    models: list[Linear] = field(default_factory=list)

    def probabilities(self, ptr: np.ndarray, cols: np.ndarray) -> np.ndarray:
        """One column for each category, each model getting those before it."""
        found = np.zeros((len(ptr) - 1, 0))
        for m in self.models:
            found = np.concatenate([found, m.probability(ptr, cols, found)[:, None]], 1)
        return found


def _part(ptr: np.ndarray, cols: np.ndarray, rows: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row pointers and columns of some rows, with the allowed features only."""
    owner = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    use = rows[owner] & allowed[cols]
    n = np.bincount(owner[use], minlength=len(ptr) - 1)[rows]
    return np.concatenate([[0], np.cumsum(n)]), cols[use]


def _fitted(ptr: np.ndarray, cols: np.ndarray, more: np.ndarray, y: np.ndarray, rows: np.ndarray, allowed: np.ndarray) -> Linear:
    """A model of the rows that have a label; one that always says no if they don't have both classes."""
    rows = rows & ~np.isnan(y)
    if len(np.unique(y[rows])) < 2:
        return Linear(np.zeros(len(allowed)), np.zeros(more.shape[1]), -30.0)
    return Linear.fit(*_part(ptr, cols, rows, allowed), more[rows], y[rows], len(allowed))


def fit_chain(ptr: np.ndarray, cols: np.ndarray, labels: np.ndarray, features: dict[str, int], fold: np.ndarray, allowed: np.ndarray) -> tuple[Chain, np.ndarray]:
    """A model for each column of labels (nan: unknown), in order, and the out-of-fold probabilities.

    allowed[c, k] tells the features that may be used for category c without fold k; the last k is
    for all rows. A text's length is no feature: long texts are judged alike.
    """
    n, folds = len(ptr) - 1, allowed.shape[1] - 1
    chain, more, everything = Chain(features), np.zeros((n, 0)), np.ones(n, bool)
    for c, y in enumerate(labels.T.astype(float)):
        chain.models.append(_fitted(ptr, cols, more, y, everything, allowed[c, folds]))
        unseen = np.zeros(n)
        for k in range(folds):
            m = _fitted(ptr, cols, more, y, fold != k, allowed[c, k])
            unseen[fold == k] = m.probability(*_part(ptr, cols, fold == k, np.ones(len(features), bool)), more[fold == k])
        more = np.concatenate([more, unseen[:, None]], 1)
    return chain, more


def train(docs: DataFrame, labels: DataFrame, *, max_docs: int = MAX_DOCS, max_features: int = MAX_FEATURES) -> Chain | None:
    """Fit the chain on the labelled rows of docs(doc_id, text); None if no document is toxic or none is not.

    About max_docs rows of each class of `toxic` at most, drawn by a hash of doc_id, are used, with
    their whole texts. Feature counts are summed by Spark; the driver gets the chosen features and the
    sample's rows in terms of them. Labels other than 0 and 1 are unknown, of several labels of a
    document the largest counts, and null ids are left out; rows that repeat an id count each time.
    Without labels of quality, that category's probability is 0.
    """
    small_batches(docs.sparkSession)
    missing = [F.lit(None).cast("int").alias(c) for c in ("quality", "toxic") if c not in labels.columns]
    sure = labels.select("*", *missing).where("toxic in (0, 1) and doc_id is not null")
    told = sure.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max(F.expr("case when quality in (0, 1) then quality end")).alias("quality"))
    n = {r[0]: r[1] for r in told.groupBy("toxic").count().collect()}
    if not (n.get(0) and n.get(1)):
        return None
    drawn = F.pmod(F.xxhash64(F.lit(9), "doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    chosen = told.where(drawn < F.when(F.col("toxic") == 1, F.lit(max_docs / n[1])).otherwise(F.lit(max_docs / n[0])))
    fold = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(FOLDS)).cast("int")
    classes = [F.expr(e).cast("int").alias(c) for c, e in CHAIN.items()]
    chosen = broadcast_if_small(cut(chosen.select("doc_id", fold.alias("fold"), *classes)), 4 * max_docs)
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(chosen, "doc_id")
    names = [f"n{c}_{y}" for c in range(len(CHAIN)) for y in (0, 1)]

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        cache = _Cached(word_features)
        for b in batches:
            total: dict[tuple[str, int], np.ndarray] = {}
            ys = [b.column(c).to_pylist() for c in CHAIN]
            for k, (t, at) in enumerate(zip(b.column("text").to_pylist(), b.column("fold").to_pylist())):
                one = np.array([int(y[k] == v) for y in ys for v in (0, 1)])
                for f in {f for w in words_of(t) for f in cache[w]}:
                    total[f, at] = total.get((f, at), 0) + one
            if total:
                sums = np.stack(list(total.values()))
                yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in total], pa.string()), pa.array([k for _, k in total], pa.int32()), *(pa.array(x, pa.int64()) for x in sums.T)], names=["f", "fold", *names])

    sums = [F.sum(F.when(F.col("fold") == k, F.col(c)).otherwise(0)).alias(f"{c}_{k}") for c in names for k in range(FOLDS)]
    counted = cut(sample.mapInArrow(count, "f string, fold int, " + ", ".join(f"{c} long" for c in names)).groupBy("f").agg(*sums).where(" or ".join("+".join(f"n{c}_1_{k}" for k in range(FOLDS)) + " >= 4" for c in range(len(CHAIN)))))
    whole = sample.groupBy("fold").agg(*[F.count_if(F.col(c) == y).alias(f"n{i}_{y}") for i, c in enumerate(CHAIN) for y in (0, 1)]).collect()
    chosen_by = {}
    for c in range(len(CHAIN)):
        for out in range(FOLDS + 1):
            kept = [k for k in range(FOLDS) if k != out]
            have = {y: sum(r[f"n{c}_{y}"] for r in whole if r["fold"] != out) for y in (0, 1)}
            yes, no = (sum((F.col(f"n{c}_{y}_{k}") for k in kept), F.lit(0)) for y in (1, 0))
            chosen_by[c, out] = [r["f"] for r in ranked(counted.select("f", yes.alias("t"), no.alias("c")), have[1], have[0], max_features).collect()]
    features = {f: k for k, f in enumerate(sorted({f for x in chosen_by.values() for f in x}))}
    allowed = np.zeros((len(CHAIN), FOLDS + 1, len(features)), bool)
    for (c, out), x in chosen_by.items():
        allowed[c, out, [features[f] for f in x]] = True

    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            told_, size = _columns(b.column("text").to_pylist(), features)
            keep = [b.column(c) for c in ("doc_id", "fold", *CHAIN)]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(told_, pa.list_(pa.int32())), pa.array(size, pa.int64())], names=["doc_id", "fold", *CHAIN, "cols", "size"])

    kind = sample.schema["doc_id"].dataType.simpleString()
    got = sample.mapInArrow(rows, f"doc_id {kind}, fold int, " + ", ".join(f"{c} int" for c in CHAIN) + ", cols array<int>, size long").orderBy("doc_id", "size").collect()
    ptr = np.concatenate([[0], np.cumsum([len(r["cols"]) for r in got])]).astype(np.int64)
    cols = np.fromiter((c for r in got for c in r["cols"]), np.int64, int(ptr[-1]))
    y = np.array([[np.nan if r[c] is None else r[c] for c in CHAIN] for r in got], float)
    return fit_chain(ptr, cols, y, features, np.array([r["fold"] for r in got]), allowed)[0]


def ranked(counts: DataFrame, n_yes: int, n_no: int, most: int) -> DataFrame:
    """The features of counts(f, t, c) that speak for a class: enough of its n_yes documents have them, and far more than of the n_no others."""
    odds = F.log((F.col("t") + 0.5) / (n_yes + 1)) - F.log((F.col("c") + 0.5) / (n_no + 1))
    return counts.where(F.col("t") >= max(4.0, MIN_SHARE * n_yes)).withColumn("odds", odds).where(F.col("odds") > MIN_ODDS).orderBy(F.desc(F.col("odds") * F.log1p("t")), "f").limit(most)


def _columns(texts: list[str], features: dict[str, int], cache: _Cached | None = None) -> tuple[list[list[int]], list[int]]:
    """Each text's sorted feature numbers and its number of distinct words."""
    known = cache if cache is not None else _Cached(lambda w: tuple(features[f] for f in word_features(w) if f in features))
    told, size = [], []
    for t in texts:
        w = words_of(t)
        told.append(sorted({c for x in w for c in known[x]}))
        size.append(len(w))
    return told, size


def predict(docs: DataFrame, chain: Chain | None, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """doc_id, a probability for each category of CHAIN, and is_toxic of each row.

    Null texts are empty; texts without a word, and all texts without a chain, get 0 and are not
    toxic. A probability of just the threshold is toxic. Null and repeated ids are passed on, a row
    for each row; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        cache = _Cached(lambda w: tuple(chain.features[f] for f in word_features(w) if f in chain.features))
        for b in batches:
            p = np.zeros((b.num_rows, len(CHAIN)))
            if chain is not None:
                told, size = _columns(b.column("text").to_pylist(), chain.features, cache)
                ptr = np.concatenate([[0], np.cumsum([len(x) for x in told])]).astype(np.int64)
                p = chain.probabilities(ptr, np.array([c for x in told for c in x], np.int64))
                p[np.array(size) == 0] = 0
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, pa.float64()) for c in p.T), pa.array(p[:, -1] >= threshold, pa.bool_())], names=["doc_id", *(f"p_{c}" for c in CHAIN), "is_toxic"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"p_{c} double" for c in CHAIN) + ", is_toxic boolean")


def op9_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return predict(docs, train(docs, table(spark, sf_dir, "labels")))
