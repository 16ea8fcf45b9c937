"""What joins shuffle and what queries store: few rows beside few partners, and no texts that nobody reads."""

import os
import random
from urllib.parse import urlparse
from urllib.request import url2pathname

import pytest
from pyspark.sql import functions as F

from spanframe import adapters as A
from spanframe import queries
from spanframe.operators import align, grid, likely, predict, tokenize, vote


def shuffled(spark, act) -> int:
    """Rows that all stages of an action wrote for others."""
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = lambda: {(x.stageId(), x.attemptId()): x.shuffleWriteRecords() for x in list_of(store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._gateway.jvm.double, 0), None))}
    list_of = lambda seq: [seq.apply(k) for k in range(seq.size())]
    before = stages()
    act()
    return sum(n for k, n in stages().items() if k not in before)


@pytest.fixture
def data(spark, tmp_path):
    words = "station apple mention line. nation stone motion oxen woven alone, region gone. thing on a table"
    rng = random.Random(5)
    rows = [(k, f"title {k}\n" + " ".join(rng.choice(words.split()) for _ in range(200))) for k in range(40)] + [(90, None), (91, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


@pytest.fixture
def kept(monkeypatch):
    """Tables that are stored, as (columns, plan)."""
    out, real = [], queries.stored

    def stored(df):
        out.append((df.columns, df._jdf.queryExecution().optimizedPlan().toString()))
        return real(df)

    for module in (A, align, grid, queries, vote):
        if hasattr(module, "stored"):
            monkeypatch.setattr(module, "stored", stored)
    return out


def test_marked_loses_no_partner(spark):
    """Every key that has a partner is told, whatever its bit; of others, nearly none; other types tell nothing."""
    rows = spark.range(40_000).select(F.concat(F.lit("k"), "id").alias("k"), "id", F.when(F.col("id") % 7 > 0, F.col("id")).alias("n"))
    some = rows.where("id % 3 = 0").select("k", F.col("n").alias("m"))
    told = likely.marked(rows, [F.col("k"), F.col("n")], some, [F.col("k"), F.col("m")])
    assert told.columns == [*rows.columns, "_may"] and told.count() == 40_000 and told.where("id % 3 = 0 and not _may").count() == 0 and told.where("id % 3 > 0 and _may").count() < 100
    assert likely.marked(rows, [F.col("id")], rows, [F.col("id").cast("int")]).where("not _may").count() == 0
    others = some.select("k", F.col("m").alias("x")).unionByName(some.limit(5).select("k", F.lit(-1).cast("long").alias("x")))
    got, want = likely.left_join(rows, others, "k"), rows.join(others, "k", "left")
    assert got.select(want.columns).exceptAll(want).count() == 0 and want.exceptAll(got.select(want.columns)).count() == 0
    assert likely.left_join(rows, others.where("false"), "k").where("x is null").count() == 40_000


def test_predictions_beside_their_records_need_no_join(spark):
    """The same records as those of predictions that are joined by id, and with several columns of predictions."""
    docs = spark.createDataFrame([("1", "Lime stone. lime and 𝒳 lime, stone. Or lime (stone)"), ("2", " "), ("3", None)], "pmid string, fulltext string")
    tokens = tokenize.token_records(docs, 12, surface=True)
    rules = {"Chemical": lambda w: w.rlike("^[Ll]ime$"), "Disease": lambda w: w.rlike("^stone$")}
    odd = F.transform("entity", lambda x: F.struct(x.text.alias("text"), x.indices.alias("indices"), F.when(F.col("ord") == 1, "Species").otherwise(x.type).alias("type")))
    told = predict.rule_predictor(rules, keep=("ord", "spans", "sentence_str"))(tokens).withColumn("entity", odd)
    want = sorted(map(str, vote.postprocess(tokens, predict.rule_predictor(rules)(tokens).withColumn("entity", odd)).collect()))
    assert sorted(map(str, vote.voted(vote.stored(vote.surfaced(told))).collect())) == want and "Species" in want[-1]  # by the vote
    both = vote.stored(vote.surfaced(told.withColumn("other", F.slice("entity", 1, 0)), columns=("entity", "other")))
    assert sorted(map(str, vote.voted(both.drop("other")).collect())) == want
    assert vote.voted(both.drop("entity").withColumnRenamed("other", "entity")).where(F.size("entity") > 0).count() == 0


def test_the_vote_shuffles_changed_records_only(spark):
    """20,000 records of which one changes: neither they nor their surfaces without rivals are joined."""
    entity = F.array(F.struct(F.lit(0).alias("entity_ord"), F.when(F.col("id") < 3, "rival").otherwise("plain").alias("text_str"), F.array(F.struct(F.lit(0).alias("s"), F.lit(5).alias("e"))).alias("sentence_spans"), F.when(F.col("id") == 1, "Disease").otherwise("Chemical").alias("type")))
    told = vote.stored(spark.range(20_000).select(F.col("id").alias("_row"), F.col("id").cast("string").alias("id"), F.lit("p").alias("pmid"), F.col("id").alias("ord"), F.lit(0).alias("fulltext_offset"), entity.alias("entity")))
    got = []
    n = shuffled(spark, lambda: got.extend(vote.voted(told).where("entity[0].type <> 'Chemical'").collect()))
    assert got == [] and n < 1000


def test_flow_stores_no_texts(spark, data, kept):
    """Gold and prediction are made in one pass beside their records: no text, no words and no join in what is stored."""
    queries.predict_postprocess_evaluate(spark, data).collect()
    assert [c for c, _ in kept if {"sentence", "sentence_str", "spans"} & set(c)] == [] and not any("Join" in p for c, p in kept if "fulltext_offset" in c) and kept


def test_surfaces_store_no_texts(spark, data, kept):
    queries.entity_surfaces(spark, data).collect()
    assert [c for c, _ in kept if {"sentence", "sentence_str", "spans"} & set(c)] == [] and not any("Join" in p for c, p in kept if "fulltext_offset" in c) and kept


def test_empty_surfaces_store_no_texts(spark, data, kept):
    queries.empty_surfaces(spark, data).collect()
    assert [c for c, _ in kept if {"sentence", "sentence_str", "spans"} & set(c)] == [] and not any("Join" in p for c, p in kept if "fulltext_offset" in c) and kept


def _chunks_and_labels(spark, n: int):
    """A document of n chunks of three words, and five labels, one of them without spans, one nowhere, one off the words' ends."""
    at = (F.col("id") * 40).cast("int")
    spans = F.array(*[F.struct((at + k).alias("s"), (at + k + 4).alias("e")) for k in (0, 5, 10)])
    chunks = spark.range(n).select(F.concat(F.lit("p_"), "id").alias("id"), F.lit("p").alias("pmid"), F.col("id").cast("int").alias("ord"), F.array(*map(F.lit, ("aaaa", "bbbb", "cccc"))).alias("sentence"), spans.alias("spans"))
    labels = [([(400, 404), (405, 409)], "Disease"), ([(40 * n - 40, 40 * n - 36)], "Species"), ([], "Disease"), ([(40 * n + 9, 40 * n + 12)], "Disease"), ([(401, 404)], "Disease")]
    return chunks, spark.createDataFrame([("p", 0, labels)], "pmid string, ord int, label array<struct<spans:array<struct<s:int,e:int>>,type:string>>")


def test_labels_meet_few_chunks(spark):
    """Of 20,000 chunks, those about the labels are shuffled."""
    chunks, notes = _chunks_and_labels(spark, 20_000)
    got = []
    n = shuffled(spark, lambda: got.extend(align.assign_labels(notes, vote.stored(chunks), A.SPEC).collect()))
    told = {r.label_ord: (r.status, r.id, r.indices, r.n_words) for r in got}
    assert told == {0: ("assigned", "p_10", [0, 1], 3), 1: ("assigned", "p_19999", [0], 3), 2: ("dropped", "p_0", None, 3), 3: ("dropped", None, None, None), 4: ("dropped", "p_10", None, 3)}
    assert n < 1000


def test_label_counts_shuffle_sizes_once(spark, data, kept):
    """Chunks meet annotated documents as sizes, and only those with labels meet these."""
    df = queries.label_cells(spark, data)
    assert all("sentence" not in c and "document_id" not in c for c, _ in kept)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "size(spans" in plan.partition("LeftSemi")[2] and "LeftSemi" in plan
    want = {k: n for k, _, n in df.collect()}
    notes, cut, fates = A.labelled(spark, data)
    per = {r.id: r.n for r in fates.where("status = 'assigned'").groupBy("id").agg(F.count("*").alias("n")).collect()}
    rows = cut.join(notes.select("pmid").distinct(), "pmid").select("id", F.size("spans").alias("n")).collect()
    assert want[1] == sum(per.values()) > 0 and want[0] == sum(max(0, r.n * (r.n + 1) // 2 - 2 * per.get(r.id, 0)) for r in rows)


def test_class_weights_shuffle_few_chunks(spark):
    """Records with labels: 20,000 chunks meet annotated documents once, and five labels are no reason to shuffle them again."""
    chunks, notes = _chunks_and_labels(spark, 20_000)
    chunks = vote.stored(chunks.select("id", "pmid", "ord", "spans"))
    fates, got = align.assign_labels(notes, chunks, A.SPEC), []
    sized = chunks.select("id", "pmid", F.size("spans").alias("n_words"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        n = shuffled(spark, lambda: got.extend(align.with_entities(notes, sized, fates).where("size(ner) > 0").collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {(r.id, len(r.ner), r.n_words) for r in got} == {("p_10", 1, 3), ("p_19999", 1, 3)} and n < 30_000


def test_decoded_paths_meet_few_sentences(spark):
    chunks, _ = _chunks_and_labels(spark, 20_000)
    decoded = spark.createDataFrame([("p_7", 0, 1, 2, [0, 1]), ("p_7", 0, 1, 2, [0, 1]), ("p_9", 2, 2, 3, [2]), ("q_0", 0, 0, 3, [0])], "id string, head int, tail int, label int, indices array<int>")
    words, got = vote.stored(chunks.select("id", "sentence")), []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        n = shuffled(spark, lambda: got.extend(grid.entities(decoded, words, A.SPEC).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r.id: [(x.text, x.indices, x.type) for x in r.entity] for r in got} == {"p_7": [(["aaaa", "bbbb"], [0, 1], "Chemical")], "p_9": [(["cccc"], [2], "Disease")]} and n < 1000


def test_stored_offsets_are_differences(spark):
    """A million offsets, which no dictionary makes smaller, take less than a byte each; strings, nulls and arrays come back."""
    df = spark.range(0, 1_000_000, 1, 2).select(F.col("id").cast("string").alias("s"), (F.col("id") * 7 + F.xxhash64("id") % 3).cast("int").alias("n"), F.when(F.col("id") % 5 > 0, F.array(F.col("id"), F.lit(None))).alias("a"), (F.col("id") % 2 == 0).alias("b"))
    assert vote.stored(df).exceptAll(df).count() == 0
    out = vote.stored(df.select("n"))
    assert out.count() == 1_000_000 and sum(os.path.getsize(url2pathname(urlparse(f).path)) for f in out.inputFiles()) < 1_000_000
