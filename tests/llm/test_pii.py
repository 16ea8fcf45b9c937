import itertools
import random
import re

import numpy as np
import pytest

from spanframe.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            d = re.sub(r"[^0-9]", "", m[0])
            if (
                kind == "email"
                or (kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")))
                or (kind == "card" and 16 <= len(d) <= 19 and pii.luhn(d))
                or (kind == "phone" and 8 <= len(d) <= 15)
            ):
                out.append((kind, *m.span()))
    return out


def test_base_equals_patterns():
    rng = random.Random(0)
    for alphabet in ("a@.b-", "019.", "4 -17", "+1 ()-.2", "a1@. +-é4"):
        for _ in range(3000):
            t = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
            assert pii.base_spans(t) == brute(t), t
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_gradient():
    tagger = pii.Tagger.new(4, 1)
    tagger.p = {k: v.astype(np.float64) for k, v in tagger.p.items()}
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, pii.SYMBOLS, (6, 3)), rng.integers(0, pii.TAGS, (6, 3))
    _, grad = tagger.loss(x, y)
    for k, p in tagger.p.items():
        at = tuple(int(rng.integers(s)) for s in p.shape) if k not in ("xf", "xb") else (int(x[2, 1]), 3)
        old, eps = p[at], 1e-3
        p[at] = old + eps
        up = tagger.loss(x, y)[0]
        p[at] = old - eps
        assert (up - tagger.loss(x, y)[0]) / (2 * eps) == pytest.approx(grad[k][at], abs=2e-3)
        p[at] = old


@pytest.fixture(scope="module")
def tagger():
    return pii.default_tagger()


def test_held_out_spans(tagger):
    """Of labelled spans that the patterns miss, most are found; little is found that is no span."""
    examples = pii.made_examples(150, seed=99)
    missed = hit = wrong = 0
    for (_, spans), (base, got) in zip(examples, pii.all_spans([t for t, _ in examples], tagger)):
        beyond = set(spans) - set(base)
        missed, hit = missed + len(beyond), hit + len(beyond & set(got))
        wrong += sum(not any(a < y and x < b for _, x, y in spans) for _, a, b in got)
    assert missed > 200 and hit / missed > 0.85 and wrong < 0.02 * missed


def test_viterbi_and_sure_positions(tagger):
    """The best path by looking at every path; sure positions are outside on it, whatever is around them."""
    rng = np.random.default_rng(4)
    for size in (1, 2, 3, 4):
        e, move = rng.normal(0, 2, (size, 6)), rng.normal(0, 1, (6, 6))
        paths = list(itertools.product(range(6), repeat=size))
        best = max(paths, key=lambda p: sum(e[t, k] for t, k in enumerate(p)) + sum(move[a, b] for a, b in zip((0, *p), (*p, 0))))
        assert tuple(pii.viterbi([e], move)[0]) == best
    runs = [rng.normal(0, 2, (int(n), 6)) for n in rng.integers(1, 40, 50)]
    for one, e in zip(pii.viterbi(runs, move), runs):
        assert one.tolist() == pii.viterbi([e], move)[0].tolist()
        may = pii.unsure(e, np.arange(len(e)) == 0, np.arange(len(e)) == len(e) - 1, move)
        assert (one[~may] == 0).all()


def test_every_window_and_one_path(tagger):
    """Scoring only the windows that can hold a plausible span gives the same spans; so does one path over all positions."""
    texts = [t for t, _ in pii.made_examples(25, seed=7)] + ["plain words only " * 90, "", "x", "lorem ipsum " * 200 + "me at home dot org " + "dolor " * 300]
    some = [pii.tagged_spans([t], tagger)[0] for t in texts]
    whole = pii.tagged_spans(texts, tagger, every=True)
    plausible = lambda t, spans: [s for s in spans if pii.plausible(s[0], t[s[1] : s[2]])]
    assert [plausible(t, s) for t, s in zip(texts, some)] == [plausible(t, s) for t, s in zip(texts, whole)]
    for t, found in zip(texts, whole):
        coded = np.concatenate([np.zeros(pii.SIDE, np.uint8), pii.symbols_of(t), np.zeros(pii.SIDE + pii.STEP, np.uint8)])
        blocks = -(-len(t) // pii.STEP)
        if blocks:
            e = pii._merged(tagger, coded, np.arange(blocks) * pii.STEP).reshape(-1, pii.TAGS)[: len(t)]
            e[0] += tagger.p["start"] - tagger.p["move"][0]
            e[-1] -= tagger.p["move"][:, 0]
            assert pii._spans(pii.viterbi([e], tagger.p["move"])[0]) == found


def test_windows_agree_with_any_place(tagger):
    s = "(555) 123-4567"
    for pad in (0, 10, 95, 96, 220, 239, 240, 250, 256, 270, 500):
        text = ("lorem ipsum dolor " * 60)[:pad] + " call " + s + " now " + "amet " * 30
        base, spans = pii.all_spans([text], tagger)[0]
        assert base == [] and [text[a:b] for k, a, b in spans if k == "phone"] == [s], pad


def test_rows(spark, tagger):
    data = [(1, None), (2, ""), (None, "a@b.co 1.2.3.4"), (3, "x " * 50_000 + "+1 (555) 555-1234"), (3, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"'), (4, "Version 2.0 and 4111111111111112")]
    df = spark.createDataFrame([(i, t, 0) for i, t in data], "doc_id long, text string, spans int")
    got = sorted(map(tuple, pii.find_personal_data(df).collect()), key=str)
    assert len(got) == len(data)
    by = {(r[0], r[6]): r for r in got}
    assert by[(None, "email:0:6,ip:7:14")][1:5] == (1, 1, 0, 0) and by[(3, "phone:100000:100017")][4] == 1
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert [by[(i, "")][5] for i in (1, 2, 4)] == [empty] * 3 and by[(3, "secret:9:49")][5] == empty
    assert all(r[7] == len([x for x in r[6].split(",") if x]) for r in got)
    assert pii.find_personal_data(df.limit(0)).count() == 0
