"""Readers, writers and whole flows on small files."""

import glob
import json

import pytest
from pyspark.sql import functions as F

from spanframe.operators import guards, ingest
from spanframe.operators.convert import BIORED_TYPES
from spanframe.operators.predict import batch_predictor, rule_predictor
from spanframe.plans import cli
from spanframe.plans.pipeline import Flow, convert_corpus, cross_validate, fold
from spanframe.schemas import LabelSpec
from spanframe.sources import readers, writers

XML = """<?xml version="1.0" encoding="UTF-8"?>
<collection><source>s</source>
<document><id>7</id>
<passage><infon key="type">title</infon><offset>0</offset><text>Aspirin works</text>
<annotation id="1"><infon key="type">ChemicalEntity</infon><location offset="0" length="7"/><text>Aspirin</text></annotation></passage>
<passage><infon key="type">abstract</infon><offset>14</offset><text>It treats pain. Aspirin again.</text>
<annotation id="2"><infon key="type">DiseaseOrPhenotypicFeature</infon><location offset="24" length="4"/><text>pain</text></annotation>
<annotation id="3"><infon key="type">ChemicalEntity</infon><location offset="30" length="7"/><text>Aspirin</text></annotation></passage>
</document>
<document><id>8</id><passage><infon key="type">title</infon><offset>2</offset><text>x</text></passage></document>
</collection>"""


def docs_file(folder, name, docs):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps(docs), encoding="utf-8")


def test_xml_to_scores(spark, tmp_path):
    (tmp_path / "c.xml").write_text(XML, encoding="utf-8")
    assert convert_corpus(spark, str(tmp_path / "c.xml"), str(tmp_path / "ann"), BIORED_TYPES) == (1, 1)
    part = glob.glob(str(tmp_path / "ann/part*"))[0]
    told = json.load(open(part, encoding="utf-8"))
    assert told == [{"PMID": "7", "articleTitle": "Aspirin works", "abstract": "It treats pain. Aspirin again.", "label": [[[[0, 7]], "Chemical"], [[[24, 28]], "Disease"], [[[30, 37]], "Chemical"]]}]
    docs_file(tmp_path / "in", "c.json", told)
    ann = str(tmp_path / "in")
    flow = Flow(spark, str(tmp_path / "out"), LabelSpec(), suffix="_biored")
    ingested = flow.ingest(ann)
    tokenized = flow.tokenize(ingested)
    labelled = flow.label(ann, tokenized)
    rows = spark.read.json(labelled)
    assert rows.select(F.explode("ner.type")).count() == 3
    base = dict.fromkeys("bert_hid_size lstm_hid_size conv_hid_size biaffine_size ffnn_hid_size dist_emb_size type_emb_size epochs seed batch_size".split(), 8)
    base |= dict.fromkeys("emb_dropout conv_dropout out_dropout learning_rate bert_learning_rate weight_decay clip_grad_norm warm_factor".split(), 0.1)
    base |= {"bert_name": "x", "use_bert_last_4_layers": True, "dilation": [1]}
    made = flow.config(labelled, base, encoder_size=8)
    assert made.label_num == 8 and json.load(open(tmp_path / "out/config.json"))["entity_types"][0] == "Chemical"
    assert flow.weights(labelled, made).count() == 8
    with pytest.raises(guards.GuardError):
        flow.config(labelled, {**base, "entity_types": ["Chemical", "Disease", "Species"]})
    predicted = flow.predict(tokenized, rule_predictor({"Chemical": lambda w: w == "Aspirin", "Disease": lambda w: w == "again"}))
    done = flow.postprocess(ingested, tokenized, predicted)
    scores = json.loads(flow.evaluate(ann, done))
    assert scores["overall"] == {"tp": 2, "fp": 1, "fn": 1, "precision": 0.6667, "recall": 0.6667, "f1": 0.6667} and scores["n_documents"] == 1
    # unchanged inputs: nothing runs; changed ones: it runs again
    before = (tmp_path / "out/ingest.meta.json").read_text()
    flow.ingest(ann)
    assert (tmp_path / "out/ingest.meta.json").read_text() == before and json.loads(before)["record_count"] == 1
    docs_file(tmp_path / "in", "d.json", [{"pmid": "9", "PMID": "", "title": " T ", "text": "more"}])
    assert spark.read.json(flow.ingest(ann)).where("pmid = '9'").first().fulltext == "T more"
    assert "0.6667" in writers.metrics_table([scores["overall"] | {"type": "overall"}])


def test_failed_check_keeps_what_was_there(spark, tmp_path):
    path = str(tmp_path / "x")
    assert writers.publish(spark.range(3), path) == 3
    with pytest.raises(guards.GuardError):
        writers.publish(spark.range(10), path, lambda n: [guards.record_parity(100, n)])
    assert spark.read.json(path).count() == 3 and not glob.glob(f"{path}.staging*")


def test_duplicates_fail_within_a_file_only(spark, tmp_path):
    docs_file(tmp_path / "a", "1.json", [{"pmid": "1", "title": "t"}])
    docs_file(tmp_path / "a", "2.json", [{"pmid": "1", "title": "t"}])
    flow = Flow(spark, str(tmp_path / "o"), LabelSpec())
    ingested = flow.ingest(str(tmp_path / "a"))
    assert spark.read.json(ingested).count() == 2
    with pytest.raises(guards.GuardError, match="several files"):
        flow.tokenize(ingested)
    docs_file(tmp_path / "b", "1.json", [{"pmid": "1", "title": "t"}, {"pmid": "1", "title": "u"}])
    with pytest.raises(guards.GuardError, match="duplicate ids"):
        Flow(spark, str(tmp_path / "p"), LabelSpec()).ingest(str(tmp_path / "b"))


def test_readers(spark, tmp_path):
    docs_file(tmp_path / "a", "x.json", [{"PMID": "", "pmid": "7", "title": "t", "label": [[[[0, 1], [2, 3]], "A"], [[], "B"]]}, {"articleTitle": "u"}])
    got = readers.annotation_json(spark, str(tmp_path / "a")).orderBy("ord").collect()
    assert [(r.stem, r.ord, r.pmid, r.title) for r in got] == [("x", 0, "7", "t"), ("x", 1, "", "u")]
    assert [([tuple(s) for s in x.spans], x.type) for x in got[0].label] == [([(0, 1), (2, 3)], "A"), ([], "B")] and got[1].label == []
    (tmp_path / "ids.txt").write_text(" 1 \n\n2\n")
    assert sorted(r[0] for r in readers.id_list(spark, str(tmp_path / "ids.txt")).collect()) == ["1", "2"] and readers.id_list(spark, None).count() == 0
    (tmp_path / "l").mkdir()
    (tmp_path / "l/y.jsonl").write_text('{"pmid":"1"}\n\n{"pmid":"2"}\n')
    lines = readers.json_lines(spark, str(tmp_path / "l"), "pmid string")
    assert lines.count() == 2 and readers.unmatched_stems(lines, spark.createDataFrame([("z",)], "stem string")).first().stem == "y"
    import hashlib

    assert readers.file_hashes(spark, str(tmp_path / "ids.txt")).first().sha256 == hashlib.sha256(b" 1 \n\n2\n").hexdigest()
    writers.write_json_array(spark.createDataFrame([(1, "é"), (0, "a")], "o int, v string"), str(tmp_path / "arr"), "o")
    assert json.load(open(glob.glob(str(tmp_path / "arr/part*"))[0], encoding="utf-8")) == [{"v": "a"}, {"v": "é"}]


def test_folds_and_cli(spark, tmp_path):
    docs = spark.range(200).select(F.col("id").cast("string").alias("pmid"))
    parts = [fold(docs, k, 5) for k in range(5)]
    assert sum(v.count() for _, v in parts) == 200 and all(t.count() + v.count() == 200 for t, v in parts)
    docs_file(tmp_path / "in", "c.json", [{"pmid": "1", "title": "Arthritis", "abstract": "and aspirine.", "label": [[[[0, 9]], "Disease"]]}])
    args = ["--output-dir", str(tmp_path / "o"), "--annotations", str(tmp_path / "in")]
    assert cli.main(["predict", *args], spark) == 0 and cli.main(["evaluate", *args], spark) == 0 and cli.main(["train-data", *args], spark) == 0
    assert json.load(open(tmp_path / "o/metrics.json"))["overall"]["tp"] == 1
    docs_file(tmp_path / "in", "d.json", [{"pmid": "1"}, {"pmid": "1"}])
    assert cli.main(["train-data", *args], spark) == 1


def test_excluded_documents(spark):
    docs = spark.createDataFrame([("1",), ("2",)], "pmid string")
    assert [r[0] for r in ingest.excluded(docs, spark.createDataFrame([("2",)], "pmid string")).collect()] == ["1"]


def test_single_steps_filters_and_warnings(spark, tmp_path, caplog):
    docs_file(tmp_path / "in", "c.json", [{"pmid": "1", "title": "Arthritis", "abstract": "and aspirine.", "label": [[[[0, 9]], "Disease"]]}, {"pmid": "2", "title": "xx xx", "label": []}])
    docs_file(tmp_path / "in", "d.json", [{"pmid": "3", "title": "xx xx xx", "label": []}])
    (tmp_path / "rules.json").write_text('{"Disease": "itis$"}')
    args = ["--output-dir", str(tmp_path / "o"), "--annotations", str(tmp_path / "in"), "--unknown", "^xx$", "--rules", str(tmp_path / "rules.json"), "--exclude", str(tmp_path / "none.txt")]
    for step in ("ingest", "tokenize", "label", "infer", "postprocess", "evaluate"):
        assert cli.main([step, *args], spark) == 0
    assert {r.pmid for r in spark.read.json(str(tmp_path / "o/tokenize")).collect()} == {"1"}
    scores = json.load(open(tmp_path / "o/metrics.json"))
    assert scores["overall"]["tp"] == 1 and scores["overall"]["fp"] == 0
    told = " ".join(r.getMessage() for r in caplog.records)
    assert "no id list" in told and "annotation files without tokens: d" in told


def test_lost_documents_are_an_error(spark, tmp_path, monkeypatch):
    docs_file(tmp_path / "in", "c.json", [{"pmid": str(k), "title": "One. Two. Three. Four."} for k in range(4)])
    flow = Flow(spark, str(tmp_path / "o"), LabelSpec())
    ingested = flow.ingest(str(tmp_path / "in"))
    from spanframe.operators import tokenize

    whole = tokenize.token_records
    monkeypatch.setattr(tokenize, "token_records", lambda docs, *a, **b: whole(docs, *a, **b).where("pmid <> '3'"))
    with pytest.raises(guards.GuardError, match="record parity"):
        flow.tokenize(ingested)


def test_a_model_must_score_the_labels(spark, tmp_path):
    docs_file(tmp_path / "in", "c.json", [{"pmid": "1", "title": "One"}])
    flow = Flow(spark, str(tmp_path / "o"), LabelSpec())
    tokenized = flow.tokenize(flow.ingest(str(tmp_path / "in")))
    with pytest.raises(guards.GuardError, match="head size"):
        flow.predict(tokenized, batch_predictor(lambda: None, lambda m, b: [[] for _ in b], head=5))
    assert spark.read.json(flow.predict(tokenized, batch_predictor(lambda: None, lambda m, b: [[] for _ in b], head=8))).count() == 1


def test_cross_validation(spark):
    docs = [(str(k), 0, "a", [([(0, 1)], "Disease")] if k % 2 else []) for k in range(12)]
    notes = spark.createDataFrame(docs, "pmid string, ord int, title string, label array<struct<spans:array<struct<s:int,e:int>>,type:string>>")
    words = ["a" if k % 2 else "b" for k in range(12)]
    tokens = spark.createDataFrame([(f"{k}_0", str(k), [w], [(0, 1)], k) for k, w in enumerate(words)], "id string, pmid string, sentence array<string>, spans array<struct<s:int,e:int>>, ord long")
    texts = spark.createDataFrame([(str(k), w) for k, w in enumerate(words)], "pmid string, fulltext string")
    sizes = []

    def fit(train):
        sizes.append(train.count())
        return rule_predictor({"Disease": lambda w: w == "a"})

    rows = [r for r in cross_validate(notes, tokens, texts, fit, 3).collect() if r.type == "overall"]
    assert sorted(r.fold for r in rows) == [0, 1, 2] and sum(r.tp for r in rows) == 6 and sum(r.fp + r.fn for r in rows) == 0 and sum(sizes) == 24


def test_arrays_of_no_rows(spark, tmp_path):
    writers.write_json_array(spark.createDataFrame([], "o int, v string"), str(tmp_path / "arr"), "o")
    assert json.load(open(glob.glob(str(tmp_path / "arr/part*"))[0])) == []
