"""Languages of a text as a mixture: expectation-maximisation over trigram likelihoods.

Each language is a smoothed distribution over hashed letter trigrams. A document's trigrams are
draws from a mixture of them; EM estimates the proportions, and the set of languages is the one
whose likelihood, less a penalty for each further language, is largest.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table

BUCKETS = 1 << 16
#: Bound of the sample that the model is fitted on, for each language.
MAX_DOCS_PER_LANGUAGE = 1_000


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters (Unicode category L)."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the letter trigrams of the whole text; empty if it has no letter.

    Letters are lower-cased; any run of other characters, and either end, is one gap.
    """
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[c]
    if not letter.any():
        return np.empty(0, np.int64), np.empty(0)
    c = np.concatenate([[32], np.where(letter, c, 32), [32]]).astype(np.uint32)
    c = c[np.concatenate([[True], (c[1:] != 32) | (c[:-1] != 32)])]
    h = (c[:-2] * np.uint32(0x9E3779B1)) ^ (c[1:-1] * np.uint32(0x85EBCA77)) ^ (c[2:] * np.uint32(0xC2B2AE3D))
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    counts = np.bincount((h >> np.uint32(16)).astype(np.int64), minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, counts[at].astype(float)


def mixture(logp: np.ndarray, w: np.ndarray, rounds: int = 20) -> tuple[np.ndarray, float]:
    """Proportions and log-likelihood of counts w under rows logp (grams x languages), by EM."""
    top = logp.max(1, keepdims=True)
    p = np.exp(logp - top)
    share = np.full(logp.shape[1], 1 / logp.shape[1])
    total = w.sum()
    for _ in range(rounds):
        mixed = p @ share
        new = share * (p.T @ (w / mixed)) / total
        moved = np.abs(new - share).max()
        share = new
        if moved < 1e-3:
            break
    return share, float(w @ (np.log(p @ share) + top[:, 0]))


def infer(logp: np.ndarray, w: np.ndarray, penalty: float = 3.0, least: float = 0.02) -> tuple[np.ndarray, np.ndarray]:
    """Indices and proportions of the chosen set of languages, largest first.

    Sets are nested: the languages by their share in the mixture of all, while a share is at least
    `least`. Each language costs penalty * log(grams) / 2, as a trigram's letters count three times.
    """
    share, _ = mixture(logp, w)
    order = np.argsort(-share, kind="stable")
    order = order[share[order] >= least]
    single = w @ logp
    best, best_set, best_share = float(single.max()), np.array([int(single.argmax())]), np.ones(1)
    cost = penalty * np.log(max(w.sum(), 2)) / 2
    for k in range(2, len(order) + 1):
        s, ll = mixture(logp[:, order[:k]], w)
        if ll - cost * (k - 1) <= best:
            break
        best, best_set, best_share = ll - cost * (k - 1), order[:k], s
    rank = np.argsort(-best_share, kind="stable")
    return best_set[rank], best_share[rank]


def train(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang", key: Column | None = None, max_docs: int = MAX_DOCS_PER_LANGUAGE, alpha: float = 0.05) -> tuple[list[str], np.ndarray]:
    """Languages and the log-probability of each hashed trigram (grams x languages).

    Fitted on whole texts of about max_docs rows at most of each language, drawn by a hash of `key`.
    Every language of the labelled rows is learned; the driver and each worker hold BUCKETS numbers
    for each. Rows without a text or language are left out, repeated rows count each time, and
    without any labelled row there is no language.
    """
    drawn = F.pmod(F.xxhash64(F.lit(8), key if key is not None else F.col(text_col)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    rows = labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), drawn.alias("drawn"))
    sizes = rows.groupBy("lang").count().collect()
    langs = sorted(r[0] for r in sizes)
    if not langs:
        return [], np.zeros((BUCKETS, 0), np.float32)
    rates = F.broadcast(rows.sparkSession.createDataFrame([(r[0], max_docs / r[1]) for r in sizes], "_lang string, _rate double"))  # a row for each language
    sample = rows.join(rates, F.col("lang") == F.col("_lang")).where("drawn < _rate").select("lang", "text")
    index = {x: k for k, x in enumerate(langs)}

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total: dict[int, np.ndarray] = {}
        for b in batches:
            for x, t in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                at, n = trigrams(t)
                total.setdefault(index[x], np.zeros(BUCKETS))[at] += n
        for k, c in total.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k), pa.int32()), pa.array(at, pa.int32()), pa.array(c[at], pa.float64())], names=["k", "gram", "n"])

    table_ = sample.mapInArrow(count, "k int, gram int, n double").groupBy("k", "gram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.full((BUCKETS, len(langs)), alpha)
    counts[table_["gram"].to_numpy(), table_["k"].to_numpy()] += table_["n"].to_numpy()
    return langs, np.log(counts / counts.sum(0)).astype(np.float32)


def predict(docs: DataFrame, langs: list[str], logp: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text", extra: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, the columns `extra`, lang_pred, score and languages (the chosen set, with proportions) of each row.

    Texts that are null or have no letter, and all texts where no language was learned, are `und`
    with score 0. The score is the proportion of the language in the whole mixture. Of languages with
    equal proportions, the first in code-point order is predicted. Null and repeated ids are passed
    on, a row for each row; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    more = extra or {}
    rows = docs.select(F.col(id_col).alias("doc_id"), *[c.alias(n) for n, c in more.items()], F.coalesce(F.col(text_col), F.lit("")).alias("_text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            pred, score, sets = [], [], []
            for t in b.column("_text").to_pylist():
                at, w = trigrams(t)
                if not len(at) or not langs:
                    pred.append("und")
                    score.append(0.0)
                    sets.append("")
                    continue
                chosen, share = infer(logp[at].astype(float), w)
                pred.append(langs[chosen[0]])
                score.append(float(min(1.0, share[0])))
                sets.append(",".join(f"{langs[k]}:{s:.3f}" for k, s in zip(chosen, share)))
            cols = [b.column(k) for k in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(sets, pa.string())], names=[*b.schema.names[:-1], "lang_pred", "score", "languages"])

    schema = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in rows.schema if x.name != "_text")
    return rows.mapInArrow(run, f"{schema}, lang_pred string, score double, languages string")


def op8_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    langs, logp = train(docs.where(~held_out), key=F.col("doc_id"))
    return predict(docs, langs, logp, extra={"held_out": held_out}).select("doc_id", "held_out", "lang_pred", "score", "languages")
