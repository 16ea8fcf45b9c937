import random

import numpy as np
import public_tokenizers as P
import pytest

from spanframe.llm.tokens import Encoder, encode_huge, token_counts

PATH = P.path("byte_bpe_50k.json")
ODD = ["", " ", " a", "a  b", "x\n y", "don't <|endoftext|> stop", "é　b", "\x1c a", "tab\tx", "a\xa0b", "ñ" * 300, "日本語 text", "a\r\nb c", "<|endoftext|> x <|endoftext|>"]


@pytest.fixture(scope="module")
def enc():
    return Encoder(PATH)


def test_ids_equal_the_library(enc):
    rng = random.Random(0)
    for t in ODD + ["".join(rng.choice("ab1 .\n\t'é　s") for _ in range(rng.randint(0, 60))) for _ in range(500)]:
        want = enc.library(t)
        assert np.frombuffer(enc.encode_bytes(t), "<u4").tolist() == want
        for chunk, overlap in ((4, 1), (9, 3), (30, 10)):
            assert np.frombuffer(encode_huge(t, enc, chunk, overlap), "<u4").tolist() == want


def test_counts_on_rows(spark, enc):
    rows = [(1, None, "x"), (1, "", "x"), (None, "two words", "y"), (7, "word " * 3000, None), (8, "z" * 5000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(map(tuple, token_counts(df, PATH, chunk=500, overlap=20, limit=2).collect()), key=str)
    want = sorted(((i, len((t or "").encode()), n := len(enc.library(t or "")), n > 2) for i, t, _ in rows), key=str)
    assert got == want
    assert token_counts(df.limit(0), PATH).count() == 0
