import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from spanframe.llm.packing import best_fit, pack

PATH = P.path("byte_bpe_50k.json")


def plain_best_fit(lengths, caps, weights, score):
    """The same choice in plain Python: every open bin is looked at for every piece."""
    left, out = [], {}
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        need = (lengths[k] / caps[0], 1 / caps[1], lengths[k] ** 2 / caps[2])
        best = None
        for b, r in enumerate(left):
            if all(x - d >= -1e-9 for x, d in zip(r, need)):
                rest = [x - d for x, d in zip(r, need)]
                value = sum(w * x * x for w, x in zip(weights, rest)) if score == "norm" else -sum(w * x * d for w, x, d in zip(weights, r, need))
                if best is None or value < best[0] - 1e-15:
                    best = (value, b)
        if best is None:
            best = (0, len(left))
            left.append([1, 1, 1])
        left[best[1]] = [x - d for x, d in zip(left[best[1]], need)]
        out[k] = best[1]
    return [out[k] for k in range(len(lengths))]


@pytest.mark.parametrize("score", ["norm", "dot"])
@pytest.mark.parametrize("caps", [(64, 64, 64.0**2), (64, 3, 64.0**2), (64, 64, 900.0)])
def test_best_fit_equals_a_plain_search(score, caps):
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 40, 600):
        lengths = 2 ** rng.integers(0, 6, n)  # halves and quarters: equal scores are equal in floating point
        weights = (1.0, 0.0, 0.0) if score == "norm" else (1.0, 0.5, 0.25)
        assert best_fit(lengths, caps, weights, score)[0].tolist() == plain_best_fit(lengths.tolist(), caps, weights, score)


@pytest.mark.parametrize("score", ["norm", "dot"])
@pytest.mark.parametrize("caps", [(100, 100, 1e4), (100, 3, 1e4), (100, 100, 6e3)])
def test_best_fit_keeps_every_capacity(score, caps):
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 60, 1500)
    bins, offset, _ = best_fit(lengths, caps, (1, 0.01, 0.1), score)
    for b in range(bins.max() + 1):
        own = np.flatnonzero(bins == b)
        own = own[np.argsort(offset[own])]
        assert len(own) and lengths[own].sum() <= caps[0] and len(own) <= caps[1] and (lengths[own] ** 2).sum() <= caps[2]
        assert offset[own].tolist() == (np.cumsum(lengths[own]) - lengths[own]).tolist()
    if caps == (100, 100, 1e4) and score == "norm":
        assert bins.max() + 1 <= 1.01 * lengths.sum() / 100 + 1


def test_pack_round_trip(spark):
    tok = Tokenizer.from_file(PATH)
    data = [(1, None, 1), (None, "", 2), (3, "word " * 700, 3), (3, "word " * 700, 3), (4, "a b c", 4)] + [(10 + i, "tok " * (i + 1), 0) for i in range(80)]
    df = spark.createDataFrame(data, "doc_id long, text string, piece long").repartition(3)
    for shard_docs in (1000, 10, 3):
        rows = pack(df, PATH, size=128, shard_docs=shard_docs, chunk=300, ids=True).collect()
        seqs, docs = defaultdict(list), defaultdict(list)
        for r in rows:
            assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
            seqs[r.sequence_id].append(r)
            docs[r.doc_id].append(r)
        for s in seqs.values():
            s.sort(key=lambda r: r.offset)
            assert [r.offset for r in s] == np.concatenate([[0], np.cumsum([r.length for r in s])])[:-1].tolist() and sum(r.length for r in s) <= 128
        for i, t, _ in data:
            want = tok.encode(t or "", add_special_tokens=False).ids + [0]
            own = sorted(docs[i], key=lambda r: (r.start, r.piece))[:: 2 if i == 3 else 1]
            assert np.frombuffer(b"".join(r.ids for r in own), "<u4").tolist() == want
            assert [r.piece for r in own] == list(range(len(own))) and all(r.length == 128 for r in own[1:])
        assert sum(len(d) for d in docs.values()) == len(rows)
        assert shard_docs == 3 or len(seqs) <= 1.1 * sum(r.length for r in rows) / 128 + 1
    assert pack(df.limit(0), PATH).count() == 0


@pytest.mark.parametrize("kind, big", [("long", (1 << 60) + 1), ("string", "x-1")])
def test_ids_keep_their_value_and_type(spark, kind, big):
    """Whole numbers above 2^53 beside a null, and strings."""
    ids = [big, None, big + 2 if kind == "long" else "x-2"]
    got = pack(spark.createDataFrame([(i, "a b") for i in ids], f"doc_id {kind}, text string").coalesce(1), PATH)
    assert dict(got.dtypes)["doc_id"] == ("bigint" if kind == "long" else kind)
    assert Counter(r.doc_id for r in got.collect()) == Counter(ids)
