"""The flows: conversion, training data, prediction, evaluation. Each stage is published only if its checks pass.

Stages are folders of JSON lines, a part for each input file, with a manifest. Files whose digest is unchanged
are not run again unless forced, and those that vanished go. A failing check stops the flow and leaves what was
published before.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import align, evaluate, guards, ingest, stats, tokenize, vote
from ..operators.convert import convert
from ..operators.pieces import Vocabulary
from ..operators.predict import Predictor
from ..operators.storage import materialise
from ..schemas import INGEST, POSTPROCESS, PREDICT, TOKEN, LabelSpec, ModelConfig
from ..sources import increments, readers, writers

#: Changed annotation files that are named to the reader; beyond that it reads the folder.
FEW_FILES = 10_000


@dataclass
class Flow:
    spark: SparkSession
    out: str
    spec: LabelSpec
    force: bool = False
    suffix: str | None = None
    max_length: int = 500

    def stage(self, name: str, sources: list[str], inputs: list[DataFrame], build: Callable[[increments.Changes], tuple[DataFrame, Callable[[int], list[guards.Verdict]]]], parameters: str = "") -> str:
        """Run and publish a stage for the files whose input changed, drop those whose input is gone; gives its folder.

        inputs: (stem, digest) of each input's files; a stem must be in all of them. build gives the rows, with
        their stem, of the changed files.
        """
        path = f"{self.out}/{name}"
        now = materialise(increments.combined(inputs, parameters))
        found = increments.changes(self.spark, path, now, self.force)
        if not found.n_todo and not found.n_gone and readers.exists(self.spark, path):
            return path
        rows, checks = build(found)
        _, n = increments.publish_files(rows, path, found.todo, now, checks if found.n_todo else lambda n: [], self.force)
        digest = now.agg(F.sha2(F.array_join(F.array_sort(F.collect_list("digest")), ","), 256)).first()[0]
        writers.write_manifest(self.spark, path, name, sources, digest, n)
        return path

    def done(self, path: str) -> DataFrame:
        return increments.done_files(self.spark, path)

    def read(self, path: str, schema: str) -> DataFrame:
        """A published stage's rows, with the stem of the file that they come from and their place."""
        return self.spark.read.schema(schema + ", ord long, stem string").option("mode", "FAILFAST").json(path)

    def ingest(self, annotations: str, exclude: str | None = None) -> str:
        files = materialise(increments.file_digests(self.spark, annotations))
        left_out = readers.id_list(self.spark, exclude)
        listed = left_out.agg(F.sha2(F.array_join(F.array_sort(F.collect_list("pmid")), ","), 256)).first()[0]

        def build(found: increments.Changes):
            few = [r[0] for r in found.pick(files).select("path").limit(FEW_FILES + 1).collect()]
            docs = found.pick(readers.annotation_json(self.spark, few if 0 < len(few) <= FEW_FILES else annotations))
            guards.require(guards.empty("duplicate ids", ingest.duplicate_ids(docs.where("pmid <> ''"), "stem", "pmid")))
            good, _ = ingest.ingest(docs.select("stem", "ord", "pmid", "title", "abstract"), left_out)
            guards.require(guards.empty("fulltext", ingest.inconsistent(good)))
            return good, lambda n: []

        return self.stage("ingest", [annotations], [files], build, listed)

    def tokenize(self, ingested: str, vocabulary: Vocabulary | None = None, splitter: tokenize.Splitter | None = None, unknown: str | None = None, most_unknown: float = 0.05) -> str:
        """Chunks of all documents, in one pass; with a vocabulary or a pattern of unknown words, of those with at most that share of them.

        Documents, not chunks, are held against the input, less those that the filter leaves out.
        Documents without words have no share; they stay, and give no chunk.
        """

        def build(found: increments.Changes):
            every = self.read(ingested, INGEST)
            guards.require(guards.empty("ids in several files", ingest.duplicate_ids(every, "pmid")))
            records = found.pick(every)
            limit = most_unknown if vocabulary is not None or unknown is not None else None
            made = tokenize.token_records(records, self.max_length, vocabulary=vocabulary, splitter=splitter, unknown=unknown, most_unknown=limit, keep=("stem",))
            seen, before = Observation(), records.count()
            made = made.observe(seen, F.count_if(F.coalesce(F.col("ord"), F.lit(0)) == 0).alias("documents")).where("id is not null")
            placed = made.withColumn("ner", F.array().cast("array<struct<indices:array<int>,fragments:array<struct<start_char:int,end_char:int>>,type:string>>"))
            return placed, lambda n: [guards.record_parity(before, int(seen.get["documents"]))]

        return self.stage("tokenize", [ingested], [self.done(ingested)], build, f"{self.max_length} {unknown} {most_unknown} {vocabulary} {splitter}")

    def label(self, annotations: str, tokenized: str) -> str:
        files = materialise(increments.file_digests(self.spark, annotations))
        guards.require(guards.unmatched("annotation files without tokens", readers.unmatched_stems(files, self.done(tokenized).where("rows > 0"))))

        def build(found: increments.Changes):
            docs, chunks = found.pick(readers.annotation_json(self.spark, annotations)), found.pick(self.read(tokenized, TOKEN))
            fates = materialise(align.assign_labels(docs, chunks, self.spec, self.suffix))
            c = align.alignment_counts(fates).first()
            annotated = chunks.join(docs.select("pmid").distinct(), "pmid", "left_semi").count()
            return align.with_entities(docs, chunks, fates), lambda n: [guards.alignment(c["n_dropped"], c["n_total"]), guards.record_parity(annotated, n)]

        return self.stage("label", [annotations, tokenized], [files, self.done(tokenized)], build, f"{self.suffix} {self.spec}")

    def config(self, labelled: str, base: dict[str, Any], encoder_size: int | None = None, allow_removal: bool = False) -> ModelConfig:
        """The base configuration with the types of this flow's suffix, checked against what was observed; written as config.json."""
        seen = [r[0] for r in stats.observed_types(self.read(labelled, TOKEN)).collect()]
        verdicts = [guards.known_types(seen, self.spec), guards.vocabulary(seen, base.get("entity_types") or [], allow_removal)]
        if encoder_size is not None:
            verdicts.append(guards.hidden_size(base["bert_hid_size"], encoder_size))
        guards.require(*verdicts)
        types = list(self.spec.included(self.suffix))
        made = ModelConfig.of({**base, "entity_types": types, "label_num": len(self.spec.sentinels) + len(types)})
        writers.write_text(self.spark, f"{self.out}/config.json", json.dumps(asdict(made), indent=2))
        writers.write_text(self.spark, f"{self.out}/label2id.json", json.dumps(self.spec.label2id, indent=2))
        return made

    def weights(self, labelled: str, config: ModelConfig) -> DataFrame:
        """Class weights of the training labels; the configuration must have the specification's types."""
        guards.require(guards.same_types(config.entity_types, self.spec))
        records = self.read(labelled, TOKEN).select("id", F.size("sentence").alias("n_words"), "ner")
        return stats.class_weights(stats.label_counts(self.spark, records, self.spec), min_background=config.min_bg_weight)

    def write_weights(self, labelled: str, config: dict[str, Any]) -> str:
        """Class weights by label, as JSON text, also written as class_weights.json."""
        rows = self.weights(labelled, ModelConfig.of(config)).orderBy("label_id").collect()
        text = json.dumps({str(r["label_id"]): r["weight"] for r in rows}, indent=2)
        writers.write_text(self.spark, f"{self.out}/class_weights.json", text)
        return text

    def predict(self, tokenized: str, predictor: Predictor, head: int | None = None) -> str:
        """Predictions of all chunks; a model's head must have the specification's labels, rules have none.

        What a model's decoder warns of is published beside the predictions, as predict-warnings, and is a
        warning of the flow; it doesn't stop it.
        """

        def build(found: increments.Changes):
            guards.require(guards.head_size(head if head is not None else getattr(predictor, "head", None), self.spec))
            tokens = found.pick(self.read(tokenized, TOKEN))
            n_tokens, made = tokens.count(), predictor(tokens.drop("stem"))
            told = getattr(predictor, "warnings", None)
            if told is not None:
                n = writers.publish(told, f"{self.out}/predict-warnings")
                guards.require(guards.Verdict("decoding", "warn" if n else "pass", f"{n} anchors with too many paths, listed in predict-warnings"))
            return made.join(tokens.select("id", "stem"), "id"), lambda n: [guards.equal_counts("predictions", n_tokens, n)]

        return self.stage("predict", [tokenized], [self.done(tokenized)], build, str(getattr(predictor, "name", "")))

    def postprocess(self, ingested: str, tokenized: str, predicted: str) -> str:
        """Entities of the documents; files that lack predictions, or predictions that lack tokens or texts, are a warning."""
        inputs = [self.done(p) for p in (ingested, tokenized, predicted)]
        for name, left, right in (("predictions without texts", 2, 0), ("predictions without tokens", 2, 1), ("tokens without predictions", 1, 2)):
            guards.require(guards.unmatched(name, readers.unmatched_stems(inputs[left], inputs[right])))

        def build(found: increments.Changes):
            tokens, predictions = found.pick(self.read(tokenized, TOKEN)), found.pick(self.read(predicted, PREDICT))
            guards.require(guards.join_completeness(tokens, predictions))
            done = vote.postprocess(tokens, predictions, found.pick(self.read(ingested, INGEST)).select("pmid", "fulltext", "ord"))
            before = tokens.where(F.size("spans") > 0).count()
            return done.join(tokens.select("pmid", "stem").distinct(), "pmid"), lambda n: [guards.record_parity(before, n)]

        return self.stage("postprocess", [ingested, tokenized, predicted], inputs, build)

    def evaluate(self, annotations: str, postprocessed: str, types: list[str] | None = None) -> str:
        """Metrics as JSON text, also written as metrics.json."""
        gold = evaluate.gold_keys(readers.annotation_json(self.spark, annotations))
        found = evaluate.predicted_keys(self.read(postprocessed, POSTPROCESS))
        scores = [r.asDict() for r in evaluate.evaluate(gold, found, types).collect()]
        text = writers.metrics_json(scores, evaluate.totals(gold, found).first().asDict())
        writers.write_text(self.spark, f"{self.out}/metrics.json", text)
        return text


def convert_corpus(spark: SparkSession, xml: str, out: str, types: dict[str, str]) -> tuple[int, int]:
    """BioC XML to one JSON array of annotation documents; gives the numbers converted and left out."""
    good, bad = convert(readers.bioc_xml(spark, xml), types)
    value = lambda c: F.parse_json(F.to_json(c))
    label = F.transform("label", lambda x: F.array(value(F.transform(x.spans, lambda y: F.array(y.s, y.e))), F.variant_get(value(F.array(x.type)), "$[0]", "variant")))
    seen = Observation()
    rows = good.select(F.col("pmid").alias("_o"), F.col("pmid").alias("PMID"), F.col("title").alias("articleTitle"), "abstract", label.alias("label"))
    writers.write_json_array(rows.observe(seen, F.count(F.lit(1)).alias("n")), out, "_o")
    return int(seen.get["n"]), bad.count()


def fold(docs: DataFrame, k: int, of: int, key: str = "pmid") -> tuple[DataFrame, DataFrame]:
    """Training and validation documents of fold k, dealt by a hash of their id."""
    own = F.pmod(F.xxhash64(key), F.lit(of)) == k
    return docs.where(~own), docs.where(own)


def cross_validate(annotations: DataFrame, tokens: DataFrame, texts: DataFrame, fit: Callable[[DataFrame], Predictor], folds: int = 5, types: list[str] | None = None) -> DataFrame:
    """(fold, type, tp, .. f1): for each fold, scores of a predictor fitted to the other folds' token records.

    annotations: gold documents; tokens: labelled token records with ord; texts: (pmid, fulltext). A
    document is in one fold only. Micro averages over folds come from the summed counts.
    """
    out = None
    for k in range(folds):
        scores = cross_validate_fold(annotations, tokens, texts, fit, k, folds, types).select(F.lit(k).alias("fold"), "*")
        out = scores if out is None else out.unionByName(scores)
    if out is None:
        raise ValueError("at least one fold is needed")
    return out


def cross_validate_flows(
    spark: SparkSession, out: str, spec: LabelSpec, names: list[str], parts: list[tuple[str, str | tuple[int, int]]], fit: Callable[[DataFrame], Predictor], suffix: str | None = None, max_length: int = 500
) -> str:
    """Scores of each fold and their sums, as JSON text, also written as cross_validation.json.

    parts: for each fold, the folder of training annotations, and either that of the held-out ones or (k, n),
    which deals one folder's documents over n folds by a hash of their id. Each fold has its own folder of stages,
    so a fold whose files are unchanged is not prepared again. `fit` gets the labelled token records of the training side.
    """
    told, every = {}, None
    for name, (train, held) in zip(names, parts, strict=True):
        flow = Flow(spark, f"{out}/all" if isinstance(held, tuple) else f"{out}/{name}/train", spec, suffix=suffix, max_length=max_length)
        labelled = flow.read(flow.label(train, flow.tokenize(flow.ingest(train))), TOKEN)
        if isinstance(held, tuple):
            scores = cross_validate_fold(readers.annotation_json(spark, train), labelled, flow.read(f"{flow.out}/ingest", INGEST), fit, *held)
        else:
            other = Flow(spark, f"{out}/{name}/val", spec, suffix=suffix, max_length=max_length)
            ingested = other.ingest(held)
            tokens = other.read(other.tokenize(ingested), TOKEN)
            done = vote.postprocess(tokens, fit(labelled)(tokens.drop("stem")), other.read(ingested, INGEST).select("pmid", "fulltext"))
            scores = evaluate.evaluate(evaluate.gold_keys(readers.annotation_json(spark, held)), evaluate.predicted_keys(done))
        scores = materialise(scores)
        told[name] = [r.asDict() for r in scores.collect()]
        every = scores if every is None else every.unionByName(scores)
    if every is None:
        raise ValueError("at least one fold is needed")
    summed = evaluate.scored(every.groupBy("type").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")]))
    both = {"folds": {k: json.loads(writers.metrics_json(v, {})) for k, v in told.items()}, "all": json.loads(writers.metrics_json([r.asDict() for r in summed.collect()], {}))}
    text = json.dumps(both, indent=2)
    writers.write_text(spark, f"{out}/cross_validation.json", text)
    return text


def cross_validate_fold(annotations: DataFrame, tokens: DataFrame, texts: DataFrame, fit: Callable[[DataFrame], Predictor], k: int, folds: int, types: list[str] | None = None) -> DataFrame:
    """(type, tp, .. f1) of fold k: a predictor fitted to the other folds' token records, scored on this one's."""
    train, held = fold(tokens, k, folds)
    done = vote.postprocess(held, fit(train)(held.drop("stem")), texts.select("pmid", "fulltext"))
    return evaluate.evaluate(evaluate.gold_keys(fold(annotations, k, folds)[1]), evaluate.predicted_keys(done), types)
