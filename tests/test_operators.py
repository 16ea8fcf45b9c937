"""Operators on small hand-made inputs."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from spanframe.functions.text import distance_bucket, fulltext, map_dashes, rebase, strip
from spanframe.operators import align, convert, evaluate, grid, guards, ingest, stats, tokenize, vote
from spanframe.operators.ordinals import batches, with_ordinal
from spanframe.operators.predict import batch_predictor, rule_predictor
from spanframe.schemas import BIOC, LabelSpec, ModelConfig

SPEC = LabelSpec()
SPANS = "array<struct<s:int,e:int>>"


def one(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_offsets_and_text(spark):
    rows = [(5, 10, 11), (15, 10, 11), (11, 10, 11), (15, 10, 13), (0, 20, 21)]
    assert one(spark, rebase(F.col("o"), F.col("t"), F.col("a")), rows, "o int, t int, a int") == [5, 15, 11, 13, 0]
    assert one(spark, fulltext(F.col("t"), F.col("a")), [("A", "B"), ("", "B"), ("A", "")], "t string, a string") == ["A B", "B", "A"]
    assert one(spark, map_dashes(F.col("x")), [("a–b−c",), ("co­op",)], "x string") == ["a-b-c", "coop"]
    assert one(spark, strip(F.col("x")), [("\t  a b \n",)], "x string") == ["a b"]
    assert one(spark, distance_bucket(F.col("d")), [(x,) for x in (0, 1, 2, 3, 4, 255, 256, 999)], "d int") == [0, 1, 2, 2, 3, 8, 9, 9]


def test_ingest(spark):
    rows = [("1", "ﬁn", "x"), ("2", "a–b", " c "), ("", "t", ""), ("3", "", " "), ("4", "t", None), ("5", "co­op", "")]
    good, bad = ingest.ingest(spark.createDataFrame(rows, "pmid string, title string, abstract string"), spark.createDataFrame([("4",)], "pmid string"))
    assert [(r.pmid, r.fulltext) for r in good.collect()] == [("2", "a-b c")]
    assert sorted(map(tuple, bad.collect())) == [("", "no id"), ("1", "length changed"), ("3", "no text"), ("4", "excluded"), ("5", "length changed")]
    assert ingest.inconsistent(good).count() == 0
    dup = spark.createDataFrame([("f", "1"), ("f", "1"), ("g", "1")], "stem string, pmid string")
    assert [tuple(r) for r in ingest.duplicate_ids(dup, "stem", "pmid").collect()] == [("f", "1", 2)]


def test_tokens(spark):
    docs = spark.createDataFrame([("a", "IL-2's x²"), ("b", ""), ("c", "\U0001f600 é‐z _\n\t")], "pmid string, fulltext string")
    got = sorted((r.pmid, r.s, r.e, r.word) for r in tokenize.tokens(docs).collect())
    assert got[:4] == [("a", 0, 2, "IL"), ("a", 2, 3, "-"), ("a", 3, 6, "2's"), ("a", 7, 8, "x")]
    arrow = sorted((r.pmid, s["s"], s["e"], w) for r in tokenize.token_arrays(docs).collect() for w, s in zip(r.words, r.spans))
    assert arrow == got


def test_greedy_chunks(spark):
    def plain(sizes, limit):
        out, total, chunk = [], 0, 0
        for n in sizes:
            if total > 0 and total + n + 2 > limit:
                chunk, total = chunk + 1, 0
            total += n
            out.append(chunk)
        return out

    assert plain([3, 4, 5, 9, 1, 2], 10) == [0, 0, 1, 2, 3, 3]
    rng = random.Random(0)
    cases = [[3, 4, 5, 9, 1, 2], [], [50], *[[rng.randrange(1, 12) for _ in range(rng.randrange(30))] for _ in range(200)]]
    got = one(spark, tokenize.greedy_breaks(F.col("x"), 10), [(c,) for c in cases], "x array<int>")
    for sizes, breaks in zip(cases, got):
        want = plain(sizes, 10)
        assert breaks == [k for k in range(1, len(want)) if want[k] != want[k - 1]]


def test_fragments_and_islands(spark):
    words = [(0, 4), (5, 8), (9, 12), (13, 17), (18, 22)]
    cases = {((5, 8), (13, 17)): [1, 3], ((5, 17),): [1, 2, 3], ((99, 110),): None, ((5, 9),): None, (): None}
    got = one(spark, align.resolve_fragments(F.col("f"), align.boundary_index(F.col("w"))), [(list(f), words) for f in cases], f"f {SPANS}, w {SPANS}")
    assert got == list(cases.values())
    islands = [[], [1], [1, 2], [1, 3], [0, 2, 4], [2, 0, 1]]
    got = one(spark, vote.island_spans(F.col("i"), F.col("w")), [(i, words) for i in islands], f"i array<int>, w {SPANS}")
    assert [[tuple(x) for x in g] for g in got] == [[], [(5, 8)], [(5, 12)], [(5, 8), (13, 17)], [(0, 4), (9, 12), (18, 22)], [(0, 12)]]


def test_assign_labels(spark):
    chunks = spark.createDataFrame(
        [("p_0_0", "p", 0, ["ab", "cd"], [(0, 2), (3, 5)]), ("p_0_1", "p", 1, ["b", "cd", "ef"], [(1, 2), (3, 5), (6, 8)]), ("q_0_0", "q", 0, ["x"], [(0, 1)])],
        f"id string, pmid string, ord int, sentence array<string>, spans {SPANS}",
    )
    labels = [([(0, 2)], "ChemicalEntity"), ([(1, 2)], "Disease"), ([(6, 8)], "Disease"), ([(0, 2)], "Foo"), ([(3, 5), (6, 8)], "Species"), ([], "Disease")]
    docs = spark.createDataFrame([("p", 0, [([(0, 2)], "Disease")]), ("p", 1, labels), ("zz", 0, [([(0, 1)], "Disease"), ([(0, 1)], "Species")])], f"pmid string, ord int, label array<struct<spans:{SPANS},type:string>>")
    fates = align.assign_labels(docs, chunks, SPEC, "_bc5cdr")
    got = {(r.pmid, r.label_ord): (r.status, r.id if r.status == "assigned" else None, r.indices if r.status == "assigned" else None) for r in fates.collect()}
    assert got == {
        ("p", 0): ("assigned", "p_0_0", [0]), ("p", 1): ("dropped", None, None), ("p", 2): ("assigned", "p_0_1", [2]), ("p", 3): ("unknown", None, None),
        ("p", 4): ("filtered", None, None), ("p", 5): ("dropped", None, None), ("zz", 0): ("dropped", None, None), ("zz", 1): ("filtered", None, None),
    }
    assert tuple(align.alignment_counts(fates).first()) == (8, 2, 3)
    done = {r.id: [(x.indices, x.type) for x in r.ner] for r in align.with_entities(docs, chunks, fates).collect()}
    assert done == {"p_0_0": [([0], "Chemical")], "p_0_1": [([2], "Disease")]}


def test_id_join(spark):
    t = spark.createDataFrame([("A", 0), ("B", 1), ("C", 2)], "id string, t int")
    p = spark.createDataFrame([("C", 0, "c"), ("B", 1, "b"), ("A", 2, "first"), ("A", 3, "second")], "id string, ord int, v string")
    assert [tuple(r) for r in align.join_by_id(t, p).orderBy("t").collect()] == [("A", 0, "second"), ("B", 1, "b"), ("C", 2, "c")]


def test_vote_and_postprocess(spark):
    votes = spark.createDataFrame([(k, x) for k, x in enumerate(["Chemical", "Disease", "Disease", "Chemical"])], "o int, t string").withColumn("k", F.lit(1))
    assert vote.majority(votes, ["k"], "t", ["o"]).first().majority == "Chemical"
    text = "aa bb cc. aa bb"
    tokens = spark.createDataFrame([("1_0_0", "1", 0, [(0, 2), (3, 5), (6, 8), (8, 9)]), ("1_1_0", "1", 1, [(10, 12), (13, 15)]), ("1_2_0", "1", 2, []), ("1_3_0", "1", 3, [(10, 12)])], f"id string, pmid string, ord int, spans {SPANS}")
    entity = "array<struct<text:array<string>,indices:array<int>,type:string>>"
    preds = [("1_0_0", 0, [(["aa"], [0], "Disease"), (["bb"], [1], "Species"), (["aa", "cc"], [0, 2], "Chemical")]), ("1_1_0", 1, [(["aa"], [0], "Chemical"), (["bb"], [1], "Disease")]), ("1_2_0", 2, []), ("1_3_0", 3, [])]
    out = {r.id: r for r in vote.postprocess(tokens, spark.createDataFrame(preds, f"id string, ord int, entity {entity}"), spark.createDataFrame([("1", text)], "pmid string, fulltext string")).collect()}
    assert set(out) == {"1_0_0", "1_1_0", "1_3_0"} and out["1_1_0"].fulltext_offset == 10 and out["1_1_0"].sentence_str == "aa bb" and out["1_3_0"].entity == []
    assert [(x.text_str, [tuple(s) for s in x.sentence_spans], x.type) for x in out["1_0_0"].entity] == [("aa", [(0, 2)], "Disease"), ("bb", [(3, 5)], "Species"), ("aa cc", [(0, 2), (6, 8)], "Chemical")]
    assert [(x.text_str, x.type) for x in out["1_1_0"].entity] == [("aa", "Disease"), ("bb", "Species")]


ENT = "id string, entity_ord int, indices array<int>, type string, n_words int"


def test_grid(spark):
    ents = spark.createDataFrame([("a", 0, [1, 2], "Chemical", 5), ("b", 0, [1, 3], "Disease", 5), ("c", 0, [4], "Species", 5)], ENT)
    cells = grid.encode(ents, SPEC)
    assert sorted(map(tuple, cells.collect())) == [("a", 1, 2, 1), ("a", 2, 1, 2), ("b", 1, 3, 1), ("b", 3, 1, 3), ("c", 4, 4, 5)]
    assert sorted((r.id, tuple(r.indices), r.label) for r in grid.decode(cells).collect()) == [("a", (1, 2), 2), ("b", (1, 3), 3), ("c", (4,), 5)]
    branching = grid.grid_of(spark, [("x", 1, 2, 1), ("x", 2, 3, 1), ("x", 1, 3, 1), ("x", 3, 1, 4), ("x", 0, 2, 2), ("x", 3, 2, 1)])
    assert sorted(tuple(r.indices) for r in grid.decode(branching).collect()) == [(1, 2, 3), (1, 3)]
    for bad in [("a", 0, [1], "Nope", 5), ("a", 0, [9], "Disease", 2), ("a", 0, [1], "<suc>", 5)]:
        with pytest.raises(Exception):
            grid.encode(spark.createDataFrame([bad], ENT), SPEC).collect()
    overlap = spark.createDataFrame([("z", 0, [1, 2, 3], "Chemical", 5), ("z", 1, [1, 3], "Disease", 5)], ENT)
    assert sorted((tuple(r.indices), r.label) for r in grid.decode(grid.encode(overlap, SPEC)).collect()) == [((1, 2, 3), 3), ((1, 3), 3)]


def test_grid_paths_and_explosions(spark):
    rng = random.Random(4)
    rows, want = [], set()
    for k in range(12):
        n = 9
        edges = {(a, b) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.3}
        anchors = {(rng.randrange(n), 0) for _ in range(2)} | {(8, rng.randrange(3))}
        rows += [(str(k), a, b, 1) for a, b in edges] + [(str(k), t, h, 3) for t, h in anchors if t >= h]
        for t, h in anchors:
            for size in range(n) if t >= h else ():
                for mid in itertools.combinations(range(h, t + 1), size + 1):
                    if mid[0] == h and mid[-1] == t and all(p in edges for p in zip(mid, mid[1:])):
                        want.add((str(k), mid))
    assert {(r.id, tuple(r.indices)) for r in grid.decode(grid.grid_of(spark, rows)).collect()} == want
    full = [("f", a, b, 1) for a in range(30) for b in range(a + 1, 30)] + [("f", 29, 0, 2), ("f", 5, 4, 3)]
    told = grid.decode_guarded(grid.grid_of(spark, full), max_paths=1000)
    assert [tuple(r.indices) for r in told.decoded.collect()] == [(4, 5)] and [(r.head, r.tail, r.stats["n_paths"]) for r in told.warnings.collect()] == [(0, 29, 2**28)]
    assert [tuple(r.indices) for r in told.partial.collect()] == [tuple(range(30))]


def test_explosions_do_not_overflow(spark):
    """70 and 2,000 diamonds in a row: more paths than a long holds."""
    for k in (61, 70, 2000):
        cells = [("d", a, b, 1) for j in range(k) for a, b in ((3 * j, 3 * j + 1), (3 * j, 3 * j + 2), (3 * j + 1, 3 * j + 3), (3 * j + 2, 3 * j + 3))] + [("d", 3 * k, 0, 2)]
        told = grid.decode_guarded(grid.grid_of(spark, cells))
        r = told.warnings.first()
        assert r.stats["n_paths"] == min(2**k, grid.MOST_PATHS) and r.stats["longest"] == 2 * k + 1 and r.stats["branching"] == 2
        assert told.decoded.count() == 0 and told.partial.first().indices[:5] == [0, 1, 3, 4, 6]


def test_long_and_wide(spark):
    """The second rule needs both; a fan that doesn't reach the tail is no branching; heads share tails."""
    chain = [("a", k, k + 1, 1) for k in range(9)]
    fan = [("a", 3, k, 1) for k in range(20, 30)]
    meet = [("a", k, 40, 1) for k in range(20, 30)] + [("a", 9, 40, 1)]
    warned = lambda cells, **kw: sorted((r.head, r.tail, r.stats["longest"], r.stats["branching"]) for r in grid.decode_guarded(grid.grid_of(spark, cells), **kw).warnings.collect())
    to9, to40 = [("a", 9, 0, 2)], [("a", 40, 0, 2), ("a", 40, 5, 3), ("a", 40, 3, 3)]
    assert warned(chain + fan + meet + to9 + to40, max_path_len=5, max_branching=5) == [(0, 40, 11, 11), (3, 40, 8, 11)]
    assert warned(chain + fan + meet + to9 + to40, max_path_len=11, max_branching=5) == [] and warned(chain + fan + to9, max_path_len=5, max_branching=5) == []


def test_ordinals(spark):
    rng = random.Random(5)
    data = [(None if k % 3 == 0 else rng.randrange(4), k, "x") for k in range(500)] + [(1, 7, "same")] * 3
    df = spark.createDataFrame(data, "a int, b int, ord string").repartition(5)
    got = with_ordinal(df, "a", "b").collect()
    assert sorted(r.ord for r in got) == list(range(503)) and got[0].asDict().keys() == {"a", "b", "ord"}
    told = [(r.a, r.b) for r in sorted(got, key=lambda r: r.ord)]
    assert told == sorted(((a, b) for a, b, _ in data), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    assert with_ordinal(df.limit(0), "a").count() == 0
    sizes = {r["batch"]: r["count"] for r in batches(df, 50, "a", "b").groupBy("batch").count().collect()}
    assert sizes == {k: 50 for k in range(10)} | {10: 3}
    one = df.withColumn("a", F.lit(1)).drop("ord")  # a single value: its rows are still in several ranges
    assert one.sparkSession.conf.get("spark.sql.shuffle.partitions") == "4" and sorted(r.ord for r in with_ordinal(one, "a").collect()) == list(range(503))


def test_grid_features(spark):
    sizes = spark.createDataFrame([("a", 3)], "id string, n int")
    got = {(r.i, r.j): (r.dist, r.region) for r in grid.pair_grid(sizes).collect()}
    assert got[0, 0] == (19, 2) and got[0, 1] == (10, 1) and got[0, 2] == (11, 1) and got[2, 0] == (2, 2) and len(got) == 9
    loss = spark.createDataFrame([(0, 0, 0), (0, 1, 0), (1, 1, 0), (1, 0, 2), (1, 0, 0)], "i int, j int, l int")
    assert [r[0] for r in loss.select(grid.in_loss(F.col("i"), F.col("j"), F.col("l"))).collect()] == [True, True, True, True, False]
    recs = spark.createDataFrame([(0, [1, 2]), (1, [3]), (2, [])], "ord int, v array<int>")
    assert {r.ord: (r.v, r.length) for r in grid.padded(recs, "v", 2).collect()} == {0: ([1, 2], 2), 1: ([3, 0], 1), 2: ([], 0)}


def test_scores(spark):
    golden = [("CellLine", 50, 77, 0, 0.3937, 1.0, 0.565), ("Species", 387, 96, 6, 0.8012, 0.9847, 0.8836), ("none", 0, 0, 0, 0, 0, 0)]
    for r in evaluate.scored(spark.createDataFrame([g[:4] for g in golden], "type string, tp long, fp long, fn long")).collect():
        want = next(g for g in golden if g[0] == r.type)
        assert [round(r[k], 4) for k in ("precision", "recall", "f1")] == list(want[4:])
    schema = f"pmid string, spans {SPANS}, type string"
    gold = spark.createDataFrame([("1", [(0, 2), (5, 7)], "A"), ("1", [(8, 9)], "B"), ("2", [(0, 1)], "A")], schema)
    pred = spark.createDataFrame([("1", [(0, 2), (5, 7)], "A"), ("1", [(8, 9)], "A"), ("3", [(0, 1)], "A")], schema)
    got = {r.type: (r.tp, r.fp, r.fn) for r in evaluate.evaluate(gold, pred).collect()}
    assert got == {"overall": (1, 2, 2), "A": (1, 2, 1), "B": (0, 0, 1)}
    assert {r.type for r in evaluate.evaluate(gold, pred, ["A"]).collect()} == {"overall", "A"} and tuple(evaluate.totals(gold, pred).first()) == (3, 3, 3)
    assert evaluate.counted_f1(0, 0, 3) == (0.0, 0.0, 0.0) and evaluate.counted_f1(1, 2, 2) == (0.5, 0.5, 0.5)
    notes = spark.createDataFrame([("1", [([(5, 7), (0, 2)], "A")])], f"pmid string, label array<struct<spans:{SPANS},type:string>>")
    assert evaluate.gold_keys(notes).intersect(gold).count() == 1


def test_training_statistics(spark):
    recs = spark.createDataFrame([("a", 3, [([0, 1], "Chemical"), ([2], "Nope")]), ("b", 1, []), ("c", 0, [])], "id string, n_words int, ner array<struct<indices:array<int>,type:string>>")
    counts = stats.label_counts(spark, recs, SPEC)
    assert {r.label_id: r.n for r in counts.collect()} == {0: 6 - 3 + 1 + 1, 1: 1, 2: 1, 3: 0, 4: 0, 5: 0, 6: 0, 7: 0}
    w = {r.label_id: r.weight for r in stats.class_weights(spark.createDataFrame([(0, 10**9), (1, 10), (2, 5), (3, 0)], "label_id int, n long"), min_background=0.05).collect()}
    assert w[0] == 0.05 and (w[1] + w[2] + w[3]) / 3 == pytest.approx(1) and w[3] == pytest.approx(10 * w[1])
    stop = stats.early_stop(spark.createDataFrame([(1, 0.0), (2, 0.2), (3, 0.1), (4, 0.1), (5, 0.9)], "epoch int, f1 double"), 2).orderBy("epoch").collect()
    assert [r.improved for r in stop] == [False, True, False, False, True] and [r.stopped for r in stop] == [False, False, False, False, True]
    lr = {r.step: r.rate for r in stats.learning_rates(spark, 10, 0.2).collect()}
    assert (lr[0], lr[1], lr[2], lr[10]) == (0, 0.5, 1, 0)


def test_guards(spark):
    g = lambda v: v.status
    assert [g(guards.record_parity(*x)) for x in ((100, 95), (1000, 970), (100, 90), (None, 50), (0, 0), (10, 12))] == ["warn", "warn", "error", "skip", "skip", "pass"]
    assert [g(guards.alignment(*x)) for x in ((4, 1000), (20, 1000), (10, 100), (0, 0))] == ["pass", "warn", "error", "skip"]
    assert [g(guards.vocabulary(["C"], ["C", "D"])), g(guards.vocabulary(["C"], ["C", "D"], True)), g(guards.vocabulary(["C"], []))] == ["error", "warn", "skip"]
    assert [g(guards.known_types(["Foo"], SPEC)), g(guards.head_size(8, SPEC)), g(guards.head_size(7, SPEC)), g(guards.same_types(SPEC.entity_types, SPEC)), g(guards.same_types(["Disease"], SPEC)), g(guards.hidden_size(1, 2))] == ["error", "pass", "error", "pass", "error", "error"]
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    assert guards.join_completeness(ids("a", "b"), ids("a")).detail == "1 missing: b" and g(guards.join_completeness(ids("a"), ids("a", "b"))) == "warn" and g(guards.join_completeness(ids("a"), ids("a"))) == "pass"
    with pytest.raises(guards.GuardError, match="record parity"):
        guards.require(guards.record_parity(100, 1))


def test_label_spec():
    assert SPEC.label2id["Chemical"] == 2 and SPEC.id2label[7] == "VariantOrPolymorphism" and SPEC.included("_bc5cdr") == ("Chemical", "Disease") and SPEC.included("_odd") == SPEC.entity_types
    for bad in (("<suc>", "<pad>"), ("<pad>",)):
        with pytest.raises(ValueError):
            LabelSpec(sentinels=bad)


def passage(kind, offset, text, annotations=()):
    return ([(kind, "type")], offset, text, list(annotations))


def annotation(kind, *locations):
    return ("id", [(kind, "type")], [(n, o) for o, n in locations], None)


def test_convert(spark):
    title, text = passage("title", 0, "abcde fghij", [annotation("ChemicalEntity", (5, 5)), annotation("ChemicalEntity", (5, 0)), annotation("Odd", (0, 3)), annotation("DiseaseOrPhenotypicFeature", (0, 3), (5, 0))]), "xyz"
    docs = [("1", [title, passage("abstract", 13, text, [annotation("DiseaseOrPhenotypicFeature", (0, 2), (13, 3))])]), ("2", [passage("title", 3, "t"), passage("abstract", 5, "a")]), ("3", [passage("title", 0, "t")]), ("4", None)]
    good, bad = convert.convert(spark.createDataFrame(docs, BIOC), convert.BIORED_TYPES)
    row = good.first()
    assert good.count() == 1 and [([tuple(s) for s in x.spans], x.type) for x in row.label] == [([(5, 10)], "Chemical"), ([(0, 2), (12, 15)], "Disease")]
    assert dict(map(tuple, bad.collect())) == {"2": "title not at 0", "3": "no abstract", "4": "no title"}


def test_predictors(spark):
    tokens = spark.createDataFrame([("a", "1", ["x1", "x2", "y", "x3"]), ("b", "1", [])], "id string, pmid string, sentence array<string>")
    out = {r.id: [(x.text, x.indices, x.type) for x in r.entity] for r in rule_predictor({"X": lambda w: w.startswith("x")})(tokens).collect()}
    assert out == {"a": [(["x1", "x2"], [0, 1], "X"), (["x3"], [3], "X")], "b": []}
    model = batch_predictor(lambda: "x", lambda m, b: [[([k], "M") for k, w in enumerate(s) if w.startswith(m)] for s in b], 1)
    assert {r.id: [x.indices for x in r.entity] for r in model(tokens).collect()} == {"a": [[0], [1], [3]], "b": []}


def test_model_config():
    values = dict.fromkeys(("bert_name",), "x") | dict.fromkeys("bert_hid_size lstm_hid_size conv_hid_size biaffine_size ffnn_hid_size dist_emb_size type_emb_size epochs seed batch_size label_num".split(), 1)
    values |= dict.fromkeys("emb_dropout conv_dropout out_dropout learning_rate bert_learning_rate weight_decay clip_grad_norm warm_factor".split(), 0.1)
    c = ModelConfig.of(values | {"use_bert_last_4_layers": True, "dilation": [1], "entity_types": ["A"], "save_path": "m", "odd": 1})
    assert c.load_path == "m" and c.min_bg_weight == 0.0


def test_postprocess_needs_no_texts_beside_surfaces(spark):
    """Records that carry their text give what the join with texts gives, among them a type that the vote changes."""
    docs = spark.createDataFrame([("1", "Aspirin helps. 𝒳 and aspirin, (aspirin). Or aspirin"), ("2", "  "), ("3", None)], "pmid string, fulltext string")
    tokens = tokenize.token_records(docs, 12, surface=True)
    entity = F.transform(F.filter(F.sequence(F.lit(0), F.size("sentence") - 1), lambda k: F.lower(F.get("sentence", k)) == "aspirin"), lambda k: F.struct(F.array(F.lit("x")).alias("text"), F.array(k).alias("indices"), F.when(F.col("ord") == 1, "Disease").otherwise("Chemical").alias("type")))
    told = tokens.select("id", "ord", entity.alias("entity"))
    got, want = vote.postprocess(tokens, told), vote.postprocess(tokens.drop("sentence_str"), told, docs)
    rows = sorted(map(str, got.collect()))
    assert rows == sorted(map(str, want.collect())) and "Disease" in "".join(rows)
