"""Word pieces, sentence ends, one-pass token records, and the searches that place labels, against plain code."""

import json
import os
import platform
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from spanframe.functions import text
from spanframe.operators import align, pieces, sentences, tokenize
from spanframe.operators.pieces import Vocabulary

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
BEGINS, GOES_ON = frozenset({"un", "a", "able", "b", "u", "é"}), frozenset({"able", "n", "a", "b", "le", "ab", "ffable"})


def plain_pieces(word):
    """Every cut tried from the longest."""
    out, rest, known = [], word, BEGINS
    while rest:
        some = [rest[:n] for n in range(len(rest), 0, -1) if rest[:n] in known]
        if not some or len(word) > pieces.LONGEST_WORD:
            return None
        out.append(some[0])
        rest, known = rest[len(some[0]) :], GOES_ON
    return out


def test_word_pieces(spark):
    rng = random.Random(0)
    words = {"unable", "unaffable", "able", "ba", "x", "", "é", "éa", "ax", "a" * 100, "a" * 101} | {"".join(rng.choice("abulenx") for _ in range(rng.randrange(1, 9))) for _ in range(300)}
    table = spark.createDataFrame([(p, True) for p in BEGINS] + [(p, False) for p in GOES_ON] + [("a", True), ("", False)], "piece string, begins boolean")
    rows = spark.createDataFrame([(w, 1) for w in words for _ in range(2)] + [(None, 1)], "word string, pieces int")
    got = {r.word: r.pieces for r in pieces.word_pieces(rows, table).collect()}
    assert got == {w: plain_pieces(w) for w in words}
    known = Vocabulary.of(table)
    assert {w: list(known.pieces(w)) if None not in known.pieces(w) else None for w in words} == got
    assert pieces.word_pieces(rows, table.limit(0)).where("pieces is not null").count() == 1  # the empty word
    assert Vocabulary.of(table.limit(0)).pieces("a") == (None,)


def test_unknown_rate(spark):
    table = spark.createDataFrame([("a", True), ("b", False)], "piece string, begins boolean")
    words = spark.createDataFrame([("d1", "ab", 3), ("d1", "x", 1), ("d2", "x", 2), ("d3", "", 4)], "pmid string, word string, n long")
    got = {r.pmid: (r.n_pieces, r.unk_rate, r.supported) for r in pieces.piece_rates(words, pieces.word_pieces(words, table), 0.2).collect()}
    assert got == {"d1": (7, 1 / 7, True), "d2": (2, 1.0, False), "d3": (0, 0.0, True)}


def test_vocabulary_files(spark, tmp_path):
    (tmp_path / "v.txt").write_text("[PAD]\n[UNK]\nun\n##able\n[\n")
    assert sorted(map(tuple, pieces.vocabulary_file(spark, str(tmp_path / "v.txt")).collect())) == [("[", True), ("able", False), ("un", True)]
    (tmp_path / "v.json").write_text(json.dumps({"model": {"vocab": {"un": 0, "able</w>": 1}}}))
    assert sorted(map(tuple, pieces.vocabulary_file(spark, str(tmp_path / "v.json")).collect())) == [("able", False), ("able", True), ("un", False), ("un", True)]


def test_records_in_one_pass(spark):
    docs = [("a", "One two three. Four five! six"), ("b", ""), ("c", None), ("d", "x " * 40 + "verylongword."), ("e", "¤ ¤ ¤ a")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "pmid string, fulltext string, ord int").repartition(2)
    got = {(r.pmid, r.ord): r for r in tokenize.token_records(df, 12, word_limit=10).collect()}
    assert {k: (r.id, r.sentence) for k, r in got.items() if k[0] == "a"} == {("a", 0): ("a_0_0", ["One", "two", "three", "."]), ("a", 1): ("a_1_0", ["Four", "five", "!"]), ("a", 2): ("a_2_0", ["six"])}
    assert [tuple(s) for s in got["a", 1].spans] == [(15, 19), (20, 24), (24, 25)]
    d = [got[k] for k in sorted(k for k in got if k[0] == "d")]
    assert [len(r.sentence) for r in d] == [10, 10, 10, 10, 2] and d[-1].sentence == ["LONG_WORD", "."] and d[-1].chunk_idx == 4
    assert not {k for k in got if k[0] in "bc"}
    odd = tokenize.token_records(df, 12, unknown="^¤$", most_unknown=0.5).collect()
    assert [(r.pmid, r.id, r.sentence) for r in odd if r.id is None] == [("e", None, [])] and {r.pmid for r in odd if r.id} == {"a", "d"}
    known = Vocabulary(frozenset("x"), frozenset())
    assert {r.pmid for r in tokenize.token_records(df, 12, vocabulary=known, most_unknown=0.5).collect() if r.id} == {"d"}
    assert tokenize.token_records(df.limit(0)).count() == 0


def test_records_equal_token_rows(spark):
    """The same words, places and sentences as tokens that are rows, in any order of the chunks."""
    rng = random.Random(1)
    docs = spark.createDataFrame([(str(k), " ".join(rng.choice(["ab", "c.", "Dé!", "f?", "..", "(g)", "_h'"]) for _ in range(rng.randrange(200)))) for k in range(60)], "pmid string, fulltext string")
    rows = sorted((r.pmid, r.s, r.e, r.word, r.sent_idx) for r in tokenize.token_rows(docs).collect())
    made = tokenize.token_records(docs, 9).collect()
    assert sorted((r.pmid, s.s, s.e, w, r.sent_idx) for r in made for w, s in zip(r.sentence, r.spans)) == rows
    assert all(sum(max(1, -(-len(w) // 4)) for w in r.sentence) + 2 <= 9 or len(r.sentence) == 1 for r in made)


def test_gaps_are_no_rows_of_tokens(spark):
    """Places count the characters between tokens, but only tokens are made into rows."""
    df = spark.createDataFrame([("a", "  b\n\n c'd.\U0001d4b3 \U0001f600\x01e "), ("b", " \t"), ("c", None)], "pmid string, fulltext string")
    made = tokenize.tokens(df)
    assert [tuple(r) for r in made.orderBy("ord").collect()] == [("a", 2, "b", 2, 3), ("a", 6, "c'd", 6, 9), ("a", 7, ".", 9, 10), ("a", 8, "\U0001d4b3", 10, 11), ("a", 10, "\U0001f600", 12, 13), ("a", 12, "e", 14, 15)]
    assert "Filter RLIKE" not in made._jdf.queryExecution().optimizedPlan().toString()


def test_token_passes_hand_on_bounded_batches():
    """A batch of many documents leaves in parts of bounded words, in order, so that a worker's memory doesn't grow with its batch."""
    import pyarrow as pa

    texts = [None, "", *["a bc. " * 1500] * 60, "x " * (2 * tokenize.FLUSH_WORDS), ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["pmid", "fulltext"])
    made = list(tokenize._array_batches([batch], "pmid"))
    sizes = [sum(map(len, b.column("words").to_pylist())) for b in made]
    assert len(made) > 5 and max(sizes[:-1]) <= 3 * tokenize.FLUSH_WORDS and sum(sizes) == 60 * 4500 + 2 * tokenize.FLUSH_WORDS
    assert [k for b in made for k in b.column("pmid").to_pylist()] == list(range(len(texts)))
    rows = list(tokenize._row_batches([batch], "pmid"))
    assert max(b.num_rows for b in rows) <= tokenize.FLUSH_WORDS
    flat = [(k, w, x["s"], x["e"]) for b in made for k, ws, xs in zip(*(c.to_pylist() for c in b.columns)) for w, x in zip(ws, xs)]
    assert flat == [(r["pmid"], r["word"], r["s"], r["e"]) for b in rows for r in b.to_pylist()]


class _Passed:
    """A table that keeps the function which its Arrow batches would pass through."""

    def __init__(self, schema):
        self.schema, self.run = schema, None

    def select(self, *_):
        return self

    def mapInArrow(self, run, _):
        self.run = run
        return self


@pytest.mark.parametrize("made", [tokenize.token_arrays, tokenize.token_rows, tokenize.token_records])
def test_memory_of_a_token_pass_does_not_grow_with_its_batch(spark, made):
    """Beside the batch itself, a worker holds no more for ten times the documents in it, or for more batches."""
    import tracemalloc

    import pyarrow as pa

    docs = _Passed(spark.createDataFrame([], "pmid long, fulltext string").schema)
    made(docs)

    def peak(n, times):
        batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(["Cells of a bc. " * 700] * n)], names=["pmid", "fulltext"])
        before, arrow, rows = pa.total_allocated_bytes(), 0, 0
        tracemalloc.start()
        for b in docs.run(iter([batch] * times)):
            arrow, rows = max(arrow, pa.total_allocated_bytes() - before), rows + b.num_rows
            assert b.nbytes < 8_000_000
            del b
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows >= n * times
        return most + arrow

    peak(1, 1)  # classes of characters and modules, once
    few = peak(30, 1)
    assert peak(300, 1) < 1.5 * few and peak(30, 5) < 1.5 * few


_HOLES = """
import sys
import pyarrow as pa
from spanframe.operators import tokenize

def resident():
    return next(int(x.split()[1]) for x in open("/proc/self/smaps_rollup") if x.startswith("Rss")) // 1000

one = pa.RecordBatch.from_arrays([pa.array(["a"] * 50), pa.array(["one two " * 500] * 50)], names=["pmid", "fulltext"])
run = lambda: sum(b.num_rows for b in tokenize._array_batches(iter([one]), "pmid"))
run()  # classes of characters and modules, once
freed = b"x" * (31 << 20)
del freed  # from now on blocks of this size lie in the heap
blocks, small = [], []
for _ in range(5):
    blocks.append(b"x" * (20 << 20))
    small.append(b"x" * (1 << 20))
del blocks  # what lies after each keeps its place
before = resident()
assert run() == 50
print(before, resident())
"""


@pytest.mark.skipif(platform.libc_ver()[0] != "glibc", reason="of glibc's heap")
def test_a_token_pass_gives_back_the_place_of_former_batches():
    out = subprocess.run([sys.executable, "-c", _HOLES], cwd=ROOT, env={**os.environ, "PYTHONPATH": ROOT}, capture_output=True, text=True, check=True).stdout
    before, after = map(int, out.split())
    assert after < before - 60, out


def test_tokens_cut_as_arrays():
    """The array pass finds what the pattern finds, in texts of all kinds of characters, across the bounds of texts and parts."""
    import pyarrow as pa
    import regex

    from spanframe.functions.text import TOKEN
    from spanframe.operators.cut import FLUSH_BYTES, cut, parts

    rng = random.Random(5)
    some = "ab_'’.?!,-é\u0301ß 中\u200d\u2028\ue000𝒳🙂\x00\n\t½²٣\u00ad\u2060"
    texts = [None, "", *["".join(rng.choice(some) for _ in range(rng.randrange(40))) for _ in range(400)], "x" * (2 * FLUSH_BYTES), ""]
    plain = [[(m[0], *m.span()) for m in regex.finditer(TOKEN, t or "")] for t in texts]
    t = cut(pa.array(["skipped", *texts]).slice(1))
    toks = list(zip(t.words.to_pylist(), t.s.tolist(), t.e.tolist()))
    assert [toks[a:b] for a, b in zip(t.bounds, t.bounds[1:])] == plain
    assert [t.raw[a:b].decode() for a, b in zip(t.begins, t.ends)] == t.words.to_pylist()
    split = list(parts(pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["k", "t"])))
    assert [k for p, _ in split for k in p.column(0).to_pylist()] == list(range(len(texts))) and [w for _, x in split for w in x.words.to_pylist()] == [w for d in plain for w, _, _ in d]


def test_sentences_of_many_texts_at_once(spark):
    """Ends and counts from arrays are those of one text after the other."""
    from collections import Counter

    import pyarrow as pa

    from spanframe.operators.cut import cut

    rng = random.Random(7)
    some = ["Dr", "p", "A", "12", "it", "It", "É", "_x", ".", ".", ".", "?", "!", ")", '"', " ", " ", " ", "…", "²"]
    texts = [None, ".", *["".join(rng.choice(some) for _ in range(rng.randrange(30))) for _ in range(500)], ""]
    t = cut(pa.array(texts))
    toks = list(zip(t.words.to_pylist(), t.s.tolist(), t.e.tolist()))
    each = [toks[a:b] for a, b in zip(t.bounds, t.bounds[1:])]
    splitter = sentences.Boundaries(frozenset({"dr", "p"}), frozenset({"it"}), frozenset({("12", "a")}))
    assert [{k for k in range(b - a) if m[k]} for a, b in zip(t.bounds, t.bounds[1:]) for m in [splitter.marked(t)[a:b]]] == [splitter.ends(x) for x in each]
    want = Counter()
    for x in each:
        dotted = {k - 1: after for k, before, after in sentences.contexts(x) if before}
        want.update(("word", w.lower(), "dot" if k in dotted else None) for k, (w, _, _) in enumerate(x) if w[0].isalnum())
        want.update(("pair", x[k][0].lower(), after.lower()) for k, after in dotted.items() if after and after[0].isalnum())
    df = spark.createDataFrame([(x,) for x in texts], "fulltext string")
    assert {(r.kind, r.a, r.b): r.n for r in sentences._occurrences(df, "fulltext").collect()} == want


def test_strip_takes_white_space_of_any_kind(spark):
    df = spark.range(0x3100).selectExpr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE') as c").select(F.concat("c", F.lit("a"), "c").alias("c"))
    assert df.where(~text.strip(F.col("c")).eqNullSafe(F.regexp_replace("c", r"(?U)^\s+|\s+$", ""))).count() == 0


def test_label_ids_need_no_python_workers(spark):
    """The table of labels is literals: no rows of Python, for which an executor would start a second set of workers."""
    made = align.label_ids(spark, align.LabelSpec())
    assert "ExistingRDD" not in made._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in made.collect()] == [(k, x) for x, k in align.LabelSpec().label2id.items()] and made.dtypes == [("label_id", "int"), ("type", "string")]


def test_boundaries_are_plain_numbers(spark):
    """What a chunk takes along to meet its labels is two arrays of numbers, without a sort."""
    df = spark.createDataFrame([([(0, 2), (3, 5)],)], "w array<struct<s:int,e:int>>").select(align.boundary_index(F.col("w")).alias("x"))
    assert df.select("x.*").dtypes == [("starts", "array<int>"), ("ends", "array<int>")] and "sort" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_chunks_of_many_sizes():
    """Chunks by sums and searches are those of the plain fold."""
    import numpy as np

    rng = random.Random(6)
    for limit in (1, 5, 12):
        sizes = [rng.randrange(1, 9) for _ in range(300)]
        ends = [rng.random() < 0.2 for _ in sizes[1:]] + [True]
        plain, total = [], 0
        for k, n in enumerate(sizes):
            if not total or total + n + 2 > limit:
                plain.append(k)
                total = 0
            total = 0 if ends[k] else total + n
        assert tokenize.chunk_starts(np.array(sizes), np.array(ends), limit).tolist() == plain


SENTENCES = ["Dr. {n} saw the patient", "The dose of 3.5 mg was given by {n}", "Samples, e.g. blood or tissue, were kept by {n}", "See Fig. {k} for details", "{n} et al. found it in cells", "J. {n} wrote the report", "It was seen (in mice.)", 'She said "no."', "Was it {n}?", "In {k} it ended", "The approx. value was {k}", "Results by Prof. {n} were clear", "All details of the report on cells and the patient are clear to {n}", "What ended the report was a patient with clear cells"]
NAMES = ["Smith", "Jones", "Lee", "Garcia", "Kim", "Brown"]


def made_texts(rng, n):
    """Texts with the tokens (by offset) that end their sentences."""
    out = []
    for _ in range(n):
        text, ends = "", []
        for _ in range(12):
            x = rng.choice(SENTENCES).format(n=rng.choice(NAMES), k=rng.randrange(1, 90))
            x += "" if x[-1] in ".?)\"" else "."
            text += (" " if text else "") + x
            ends.append(len(text))
        out.append((text, ends))
    return out


def f1(splitter, data):
    import regex

    from spanframe.functions.text import TOKEN

    hit = made = wanted = 0
    for text, ends in data:
        toks = [(m[0], *m.span()) for m in regex.finditer(TOKEN, text)]
        got = {toks[k][2] for k in splitter.ends(toks)}
        hit, made, wanted = hit + len(got & set(ends)), made + len(got), wanted + len(ends)
    return 2 * hit / (made + wanted)


def test_learned_sentence_ends(spark):
    """Abbreviations, initials, numbers and closing quotes; the rule that needs no model ends sentences in abbreviations too."""
    rng = random.Random(0)
    docs = spark.createDataFrame([(t,) for t, _ in made_texts(rng, 400)] + [(None,), ("",)], "fulltext string").repartition(3)
    told = sentences.learn(docs)
    short = {r.word for r in told.words.where("abbreviation").collect()}
    assert {"dr", "fig", "al", "prof", "g", "approx"} <= short and not short & {"it", "details", "cells", "report", "patient"}
    held = made_texts(random.Random(1), 200)
    learned, rule = f1(told.splitter(), held), f1(tokenize.EveryMark(), held)
    print(short, f"F1 of sentence ends on held-out texts: learned {learned:.4f}, every mark {rule:.4f}")
    assert learned > 0.98 and rule < 0.85
    nothing = sentences.learn(docs.limit(0))
    assert nothing.words.count() == 0 and nothing.splitter() == sentences.Boundaries()


def test_first_containing_equals_search(spark):
    """Overlapping, nested, empty and far ranges, labels on their edges and across them, whatever the width of a bucket."""
    rng = random.Random(3)
    span = lambda far: (lambda a: (a, a + rng.randrange(0, far)))(rng.randrange(-50, 2000))
    chunks = [(p, o, *span(rng.choice([5, 300, 900]))) for p in "ab" for o in range(40)]
    labels = [(p, k, sorted(span(40) for _ in range(rng.choice([0, 1, 1, 2])))) for p in "abz" for k in range(120)]
    want = {}
    for p, k, spans in labels:
        own = [(o, s, e) for q, o, s, e in chunks if q == p and all(s <= a and b <= e for a, b in spans)]
        want[p, k] = min(own) if own else (None, None, None)
    ldf = spark.createDataFrame(labels, "pmid string, label_ord int, spans array<struct<s:int,e:int>>").repartition(3)
    cdf = spark.createDataFrame(chunks, "pmid string, ord int, s int, e int")
    for bucket in (1_000_000, 256, 7):
        got = {(r.pmid, r.label_ord): (r.chunk_ord, r.chunk_s, r.chunk_e) for r in align.first_containing(ldf, cdf, bucket=bucket).collect()}
        assert got == want


def test_a_document_of_very_many_chunks(spark):
    """100,000 chunks and labels in one document: each label meets the chunks about it, not all."""
    n = 100_000
    chunks = spark.range(n).select(F.lit("p").alias("pmid"), F.col("id").cast("int").alias("ord"), (F.col("id") * 100).cast("int").alias("s"), (F.col("id") * 100 + 99).cast("int").alias("e"))
    spans = F.array(F.struct((F.col("id") * 100 + 5).cast("int").alias("s"), (F.col("id") * 100 + 9).cast("int").alias("e")))
    labels = spark.range(n).select(F.lit("p").alias("pmid"), F.col("id").cast("int").alias("label_ord"), spans.alias("spans"))
    got = align.first_containing(labels, chunks)
    assert got.where("chunk_ord = label_ord").count() == n


def test_binary_search_of_boundaries(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(300):
        at, words = 0, []
        for _ in range(rng.randrange(0, 12)):
            a = at + rng.randrange(0, 3)
            b = a + rng.randrange(0, 4)
            words.append((a, b))
            at = rng.choice([b, b, a])  # some words repeat a boundary
        rng.random() < 0.2 and rng.shuffle(words)
        rows.append(([tuple(sorted((rng.randrange(0, 14), rng.randrange(0, 14)))) for _ in range(rng.randrange(0, 3))], words))

    def plain(spans, words):
        starts, ends, out = {w[0]: k for k, w in enumerate(words)}, {w[1]: k for k, w in enumerate(words)}, set()
        for a, b in spans:
            i, j = starts.get(a), ends.get(b)
            if i is None or j is None or i > j:
                return None
            out |= set(range(i, j + 1))
        return sorted(out) if spans else None

    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, f array<struct<s:int,e:int>>, w array<struct<s:int,e:int>>")
    got = {r.k: r.x for r in df.select("k", align.resolve_fragments(F.col("f"), align.boundary_index(F.col("w"))).alias("x")).collect()}
    assert got == {k: plain(*r) for k, r in enumerate(rows)}


@pytest.mark.parametrize("text, ends", [("A b. c", []), ("Version 3.5 is. It", [5]), ("He (left.) She", [4]), ("No? Yes! end.", [1, 3, 5]), ("It is p. 5. Then", [5]), ("So ... it", []), ("What?! A", [2])])
def test_marks(text, ends):
    import regex

    from spanframe.functions.text import TOKEN

    toks = [(m[0], *m.span()) for m in regex.finditer(TOKEN, text)]
    assert sorted(sentences.Boundaries(abbreviations=frozenset({"p"})).ends(toks)) == ends
