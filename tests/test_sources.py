"""Arrays in files of any size, whatever the splits; stages file by file; streams that publish once."""

import json
import random

import pytest

from spanframe.sources import readers
from spanframe.sources.json_arrays import json_elements, scan


@pytest.fixture
def splits(spark):
    """Sets the size of splits, and puts it back."""
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"]
    before = {k: spark.conf.get(k, None) for k in keys}

    def use(size):
        spark.conf.set(keys[0], str(size))
        spark.conf.set(keys[1], "1")

    yield use
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def nasty(rng, depth=0):
    """A JSON value with brackets, braces, quotes and backslashes in its strings."""
    text = lambda: "".join(rng.choice(['"', "\\", "{", "}", "[", "]", ",", "a", "é", "\n", "\\\"", "}}"]) for _ in range(rng.randrange(9)))
    kind = rng.randrange(6) if depth < 3 else 0
    if kind < 3:
        return text()
    if kind == 3:
        return rng.choice([1, None, True, -2.5])
    if kind == 4:
        return [nasty(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {text(): nasty(rng, depth + 1) for _ in range(rng.randrange(4))}


def test_arrays_are_the_same_for_any_splits(spark, tmp_path, splits):
    rng = random.Random(0)
    want = {}
    for name, n, kw in (("a", 40, {}), ("b", 25, {"indent": 2}), ("c", 1, {}), ("none", 0, {}), ("d", 30, {"ensure_ascii": False, "separators": (",", ":")})):
        docs = [{"k": nasty(rng), "x" * rng.randrange(30): [nasty(rng), {}]} for _ in range(n)]
        (tmp_path / f"{name}.json").write_text(json.dumps(docs, **kw) + "\n" * rng.randrange(2), encoding="utf-8")
        want |= {(name, i): d for i, d in enumerate(docs)}
    for size in (1 << 20, 700, 64, 9):
        splits(size)
        rows = json_elements(spark, str(tmp_path))
        got = {(r.file.rpartition("/")[2][:-5], r.ord): json.loads(r.value) for r in rows.collect()}
        assert got == want and rows.count() == len(want)


def test_scan():
    assert scan('{"a":"}', False) == (True, 1) and scan('"', True) == (False, 0) and scan('\\"', True) == (True, 0)
    assert scan('{"a\\\\":[1', False) == (False, 2) and scan('x", "y', True) == (True, 0) and scan("]", False) == (False, -1)


def test_annotations_over_splits(spark, tmp_path, splits):
    docs = [{"pmid": str(k), "title": 'brace } and "quote" \\', "abstract": "{" * (k % 4), "label": [[[[0, 1]], "Disease"]] * (k % 3)} for k in range(60)]
    (tmp_path / "f.json").write_text(json.dumps(docs))
    whole = sorted(map(str, readers.annotation_json(spark, str(tmp_path)).collect()))
    splits(100)
    assert sorted(map(str, readers.annotation_json(spark, str(tmp_path)).collect())) == whole and len(whole) == 60


def write(folder, name, docs):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text(json.dumps(docs))


def test_one_changed_file_runs_alone(spark, tmp_path, monkeypatch, caplog):
    from spanframe.operators.predict import word_rules
    from spanframe.plans.pipeline import Flow
    from spanframe.schemas import LabelSpec
    from spanframe.sources import increments

    doc = lambda k, text: [{"pmid": str(k), "title": f"Arthritis {text}", "abstract": "and more.", "label": [[[[0, 9]], "Disease"]]}]
    for k in range(6):
        write(tmp_path / "in", f"0{k} x", doc(k, "one"))
    flow, ann = Flow(spark, str(tmp_path / "out"), LabelSpec()), str(tmp_path / "in")
    done = []
    changes = increments.changes
    monkeypatch.setattr(increments, "changes", lambda *a: (x := changes(*a), done.append((sorted(r[0] for r in x.todo.select("stem").collect()), x.n_gone)))[0])

    def run():
        done.clear()
        a = flow.ingest(ann)
        b = flow.tokenize(a)
        flow.label(ann, b)
        c = flow.predict(b, word_rules({"Disease": "itis$"}))
        d = flow.postprocess(a, b, c)
        return {r.pmid: (r.stem, r.sentence_str) for r in flow.read(d, "pmid string, sentence_str string").where("sentence_str like 'Arthritis%'").collect()}

    first = run()
    assert len(first) == 6 and first["3"][0] == "03 x" and all(len(x) == 6 for x, _ in done)
    stamp = {p: p.stat().st_mtime_ns for p in (tmp_path / "out/postprocess").rglob("part*.json")}
    assert run() == first and all(x == ([], 0) for x in done)
    # one changes, one comes, one goes
    write(tmp_path / "in", "03 x", doc(3, "two"))
    write(tmp_path / "in", "new", doc(9, "three"))
    (tmp_path / "in/05 x.json").unlink()
    second = run()
    assert done == [(["03 x", "new"], 1)] * 5
    assert second == {k: v for k, v in first.items() if k not in ("3", "5")} | {"3": ("03 x", "Arthritis two and more."), "9": ("new", "Arthritis three and more.")}
    kept = {p: p.stat().st_mtime_ns for p in (tmp_path / "out/postprocess").rglob("part*.json")}
    assert sum(stamp.get(p) == t for p, t in kept.items()) == 4
    assert json.loads((tmp_path / "out/postprocess.meta.json").read_text())["record_count"] == 6
    # predictions of a file without tokens are a warning
    flow.tokenize(flow.ingest(ann), unknown="two", most_unknown=0.1)
    flow.postprocess(*(str(tmp_path / "out" / x) for x in ("ingest", "tokenize", "predict")))
    assert "record_count" in (tmp_path / "out/tokenize.meta.json").read_text()


def test_large_files_have_digests(spark, tmp_path, monkeypatch):
    from spanframe.sources import increments

    monkeypatch.setattr(increments, "WHOLE_BYTES", 50)
    write(tmp_path / "in", "a", [{"k": k} for k in range(30)])
    write(tmp_path / "in", "b", [])
    digests = lambda: {r.stem: r.digest for r in increments.file_digests(spark, str(tmp_path / "in")).collect()}
    first = digests()
    assert first.keys() == {"a", "b"} and digests() == first
    write(tmp_path / "in", "a", [{"k": k} for k in range(29)] + [{"k": 31}])
    assert digests()["a"] != first["a"] and digests()["b"] == first["b"]


def lines(path, *docs):
    path.write_text("".join(json.dumps(dict(zip(("pmid", "title", "abstract"), d))) + "\n" for d in docs))


def test_a_stream_publishes_once(spark, tmp_path, monkeypatch):
    """A run that dies between staging and publishing, or right after publishing, loses and repeats nothing."""
    from spanframe.sources import writers
    from spanframe.streaming import ingest as stream

    src, out, ck = tmp_path / "src", str(tmp_path / "sink"), str(tmp_path / "ck")
    src.mkdir()
    run = lambda: stream.ingest_new(spark, str(src), out, ck).awaitTermination()
    told = lambda: sorted((r.pmid, r.fulltext) for r in stream.published(spark, out).collect())
    lines(src / "1.json", ("1", "a", "b"), ("", "x", ""), ("2", "c", ""), ("2", "c", ""))
    run()
    assert told() == [("1", "a b"), ("2", "c")]
    assert sorted(tuple(r) for r in stream.rejected(spark, out).collect()) == [("", "no id", 0), ("2", "repeated in its batch", 0)]
    assert json.loads((tmp_path / "sink.batches/0.json").read_text()) | {"timestamp": 0} == {"schema_version": "1", "stage": "ingest", "batch": 0, "record_count": 4, "rejected": 2, "timestamp": 0}
    # dies when the rows are staged, and nothing is moved yet
    lines(src / "2.json", ("3", "d", ""), ("1", "again", ""))
    swap = writers._swap

    def dies(fs, staging, target, old):
        if target.toString().endswith("batch=1") and "rejects" not in target.toString():
            raise OSError("killed")
        swap(fs, staging, target, old)

    monkeypatch.setattr(writers, "_swap", dies)
    with pytest.raises(Exception):
        run()
    monkeypatch.setattr(writers, "_swap", swap)
    assert told() == [("1", "a b"), ("2", "c")]
    # dies when the batch is published, and the stream doesn't know it yet
    publish = stream.publish_batch

    def dies_late(*a, **b):
        publish(*a, **b)
        raise RuntimeError("killed")

    monkeypatch.setattr(stream, "publish_batch", dies_late)
    with pytest.raises(Exception):
        run()
    monkeypatch.setattr(stream, "publish_batch", publish)
    for _ in range(2):
        run()
        assert told() == [("1", "a b"), ("2", "c"), ("3", "d")]
    assert ("1", "published before", 1) in {tuple(r) for r in stream.rejected(spark, out).collect()}


def test_a_batch_that_loses_rows_is_not_published(spark, tmp_path, monkeypatch):
    from spanframe.operators.guards import GuardError
    from spanframe.streaming import ingest as stream

    docs = spark.createDataFrame([("1", "a", ""), ("2", "b", "")], "pmid string, title string, abstract string")
    whole = stream.ingest
    monkeypatch.setattr(stream, "ingest", lambda d, **kw: whole(d.where("pmid <> '2'"), **kw))
    with pytest.raises(GuardError, match="documents of a batch"):
        stream.publish_batch(docs, 0, str(tmp_path / "sink"))
    assert stream.published(spark, str(tmp_path / "sink")).count() == 0
    monkeypatch.setattr(stream, "ingest", whole)
    stream.publish_batch(docs.limit(0), 1, str(tmp_path / "sink"))
    assert stream.published(spark, str(tmp_path / "sink")).count() == 0


def test_cross_validation_and_weights_by_command(spark, tmp_path, capsys):
    from spanframe.plans import cli

    doc = lambda k: {"pmid": str(k), "title": "Arthritis and pain", "abstract": "", "label": [[[[0, 9]], "Disease"]] + [[[[14, 18]], "Disease"]] * (k % 2)}
    for fold in ("fold_0",):
        for part, n in (("train", 4), ("val", 2)):
            (tmp_path / "folds" / fold / part).mkdir(parents=True)
            write(tmp_path / "folds" / fold / part, "x", [doc(k) for k in range(n)])
    (tmp_path / "rules.json").write_text('{"Disease": "itis$"}')
    rules = ["--rules", str(tmp_path / "rules.json")]
    assert cli.main(["cross-validate", "--output-dir", str(tmp_path / "cv"), "--folds", str(tmp_path / "folds"), *rules], spark) == 0
    told = json.loads((tmp_path / "cv/cross_validation.json").read_text())
    assert told["folds"].keys() == {"fold_0"} and told["folds"]["fold_0"]["overall"]["fn"] == 1
    assert {k: told["all"]["overall"][k] for k in ("tp", "fp", "fn", "recall")} == {"tp": 2, "fp": 0, "fn": 1, "recall": 0.6667}
    one = ["--output-dir", str(tmp_path / "o"), "--annotations", str(tmp_path / "folds/fold_0/train")]
    assert cli.main(["cross-validate", *one, *rules, "--n-folds", "2"], spark) == 0
    assert json.loads((tmp_path / "o/cross_validation.json").read_text())["all"]["overall"]["tp"] == 4
    base = dict.fromkeys("bert_hid_size lstm_hid_size conv_hid_size biaffine_size ffnn_hid_size dist_emb_size type_emb_size epochs seed batch_size".split(), 8)
    base |= dict.fromkeys("emb_dropout conv_dropout out_dropout learning_rate bert_learning_rate weight_decay clip_grad_norm warm_factor".split(), 0.1)
    (tmp_path / "base.json").write_text(json.dumps(base | {"bert_name": "x", "use_bert_last_4_layers": True, "dilation": [1]}))
    assert cli.main(["train-data", *one, "--config", str(tmp_path / "base.json")], spark) == 0 and cli.main(["weights", *one], spark) == 0
    weights = json.loads((tmp_path / "o/class_weights.json").read_text())
    assert len(weights) == 8 and weights["3"] < weights["4"]


def test_digests_of_files_in_chunks(spark, tmp_path, monkeypatch):
    """Any bytes, with and without a last line's end or a byte order mark, in splits of any size."""
    import hashlib

    rng = random.Random(2)
    cases = [b"", b"\n", b"a", b"a\n\n", b"\xef\xbb\xbfa\nb", b"\xef\xbb\xbfa\nb\n", b"\r\n\r", b"x" * 5000, b"ab\n" * 4000, b"\n" * 3000, rng.randbytes(20_000), rng.randbytes(20_000) + b"\n"]
    for k, x in enumerate(cases):
        (tmp_path / f"a b+{k}.bin").write_bytes(x)
    want = sorted((len(x), hashlib.sha256(x).hexdigest()) for x in cases if x)
    monkeypatch.setattr("spanframe.sources.digests.CHUNK_BYTES", 700)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split in ("1000b", "7777b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            got = readers.file_hashes(spark, str(tmp_path), "*.bin", whole_bytes=0).collect()
            assert sorted((r.length, r.sha256) for r in got) == want
            assert all(r.path.startswith("file:/") and r.path.endswith(".bin") for r in got) and len({r.path for r in got}) == len(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.length, r.sha256) for r in readers.file_hashes(spark, str(tmp_path), "*.bin").collect()) == want
