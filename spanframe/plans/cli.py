"""Command line: python -m spanframe.plans.cli STAGE --output-dir DIR [...]; exits with 1 if a check fails."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from ..operators import pieces, sentences
from ..operators.convert import BC5CDR_TYPES, BIORED_TYPES
from ..operators.guards import GuardError
from ..operators.predict import Predictor, named_fit, named_predictor, word_rules
from ..schemas import INGEST, LabelSpec
from ..sources.readers import json_lines, subfolders
from .pipeline import Flow, convert_corpus, cross_validate_flows


FLOWS = ("convert", "train-data", "predict", "evaluate", "cross-validate")
STEPS = ("ingest", "tokenize", "label", "config", "weights", "infer", "postprocess")
#: Patterns of words by type that predict without a model, for demonstrations.
DEMO = {"Disease": "(?i)(itis|osis|emia)$", "Chemical": "(?i)(ine|ol|ate)$"}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("stage", choices=[*FLOWS, *STEPS], help="a flow, or one step over what the steps before it left in the output folder")
    p.add_argument("--output-dir", required=True)
    p.add_argument("--force", action="store_true", help="run stages that are up to date, too")
    p.add_argument("--annotations", help="folder of annotation JSON arrays")
    p.add_argument("--xml", help="BioC XML, for convert")
    p.add_argument("--corpus", choices=["biored", "bc5cdr"], default="biored")
    p.add_argument("--exclude", help="text file with an id on each line")
    p.add_argument("--spec", help="label specification; the built-in one by default")
    p.add_argument("--suffix", help="model suffix, such as _biored")
    p.add_argument("--config", help="base model configuration, for train-data")
    p.add_argument("--max-length", type=int, default=500)
    p.add_argument("--folds", help="folder of folds, each a folder with train and val annotations, for cross-validate; without it --annotations are dealt over --n-folds")
    p.add_argument("--n-folds", type=int, default=5)
    p.add_argument("--predictor", help="module:name of a predictor, such as one of word_pair_predictor()")
    p.add_argument("--rules", help="JSON object of patterns for words, by type; without it and --predictor, a demonstration's")
    p.add_argument("--vocabulary", help="file of word pieces, a piece on each line or a tokenizer's JSON; documents with too many unknown pieces are left out")
    p.add_argument("--learn-sentences", action="store_true", help="learn abbreviations from the documents, and end sentences by them instead of at every mark")
    p.add_argument("--unknown", help="pattern of words in no supported language, where there is no vocabulary")
    p.add_argument("--most-unknown", type=float, default=0.05, help="largest share of unknown pieces or words")
    return p


def _read(path: str):
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def chosen_predictor(a: argparse.Namespace) -> Predictor:
    if a.predictor:
        return named_predictor(a.predictor)
    return word_rules(_read(a.rules) if a.rules else DEMO)


def models(spark: SparkSession, a: argparse.Namespace, ingested: str) -> tuple[pieces.Vocabulary | None, sentences.Boundaries | None]:
    """The vocabulary and the sentence splitter that the options ask for."""
    known = pieces.Vocabulary.of(pieces.vocabulary_file(spark, a.vocabulary)) if a.vocabulary else None
    return known, sentences.learn(json_lines(spark, ingested, INGEST)).splitter() if a.learn_sentences else None


def run_folds(spark: SparkSession, a: argparse.Namespace, spec: LabelSpec) -> str:
    """Scores of every fold and over all of them, as JSON text, also written as cross_validation.json."""
    found = named_fit(a.predictor) if a.predictor else lambda train: chosen_predictor(a)
    if a.folds:
        names = subfolders(spark, a.folds)
        parts = [(f"{a.folds}/{x}/train", f"{a.folds}/{x}/val") for x in names]
    else:
        names, parts = [str(k) for k in range(a.n_folds)], [(a.annotations, (k, a.n_folds)) for k in range(a.n_folds)]
    return cross_validate_flows(spark, a.output_dir, spec, names, parts, found, a.suffix, a.max_length)


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(args)
    spark = spark or SparkSession.builder.appName("spanframe").getOrCreate()
    flow = Flow(spark, a.output_dir, LabelSpec.load(a.spec) if a.spec else LabelSpec(), a.force, a.suffix, a.max_length)
    at = {step: f"{a.output_dir}/{step}" for step in STEPS} | {"predict": f"{a.output_dir}/predict"}
    steps = {
        "ingest": lambda: flow.ingest(a.annotations, a.exclude),
        "tokenize": lambda: flow.tokenize(at["ingest"], *models(spark, a, at["ingest"]), unknown=a.unknown, most_unknown=a.most_unknown),
        "label": lambda: flow.label(a.annotations, at["tokenize"]),
        "config": lambda: flow.config(at["label"], _read(a.config)),
        "weights": lambda: print(flow.write_weights(at["label"], _read(f"{a.output_dir}/config.json"))),
        "cross-validate": lambda: print(run_folds(spark, a, flow.spec)),
        "infer": lambda: flow.predict(at["tokenize"], chosen_predictor(a)),
        "postprocess": lambda: flow.postprocess(at["ingest"], at["tokenize"], at["predict"]),
        "convert": lambda: print(convert_corpus(spark, a.xml, a.output_dir, BIORED_TYPES if a.corpus == "biored" else BC5CDR_TYPES)),
        "evaluate": lambda: print(flow.evaluate(a.annotations, at["postprocess"])),
    }
    flows = {"train-data": ["ingest", "tokenize", "label", *(["config"] if a.config else [])], "predict": ["ingest", "tokenize", "infer", "postprocess"]}
    try:
        for step in flows.get(a.stage, [a.stage]):
            steps[step]()
    except GuardError as e:
        print(f"check failed: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
