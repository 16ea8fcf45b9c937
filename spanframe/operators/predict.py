"""Predictors: anything that turns token records into predict records.

The one that ships is a rule, for tests and demonstrations; it does not stand for a trained model.
A neural one plugs in as a function over Arrow batches (`batch_predictor`), loaded once a worker.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator
from typing import Any, Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENTITY = "array<struct<text:array<string>,indices:array<int>,type:string>>"


class Predictor(Protocol):
    def __call__(self, tokens: DataFrame) -> DataFrame:
        """(id, pmid, sentence, entity) for each token record."""


def rule_predictor(rules: dict[str, Callable[[Column], Column]], join_runs: bool = True, keep: tuple[str, ...] = ()) -> Predictor:
    """Entities from conditions on words, by type: runs of matching words, or each by itself. Columns of the token records in `keep` go with them."""

    def of(name: str, rule: Callable[[Column], Column]) -> Column:
        hits = F.filter(F.transform("sentence", lambda w, k: F.when(rule(w), k)), lambda k: k.isNotNull())
        starts = F.filter(hits, lambda k, i: (i == 0) | (F.get(hits, i - 1) < k - 1)) if join_runs else hits
        ends = F.filter(hits, lambda k, i: (i == F.size(hits) - 1) | (F.get(hits, i + 1) > k + 1)) if join_runs else hits
        return F.zip_with(starts, ends, lambda a, b: F.struct(F.slice("sentence", a + 1, b - a + 1).alias("text"), F.sequence(a, b).alias("indices"), F.lit(name).alias("type")))

    def predict(tokens: DataFrame) -> DataFrame:
        found = [of(name, rule) for name, rule in rules.items()]
        entity = F.when(F.size("sentence") > 0, F.concat(*found)).otherwise(F.array().cast(ENTITY))
        return tokens.select("id", "pmid", "sentence", entity.alias("entity"), *[c for c in ("ord",) if c in tokens.columns and c not in keep], *keep)

    return predict


def batch_predictor(load: Callable[[], Any], infer: Callable[[Any, list[list[str]]], list[list[tuple[list[int], str]]]], batch_size: int = 64, head: int | None = None) -> Predictor:
    """A model as a predictor: `load` once in each worker, `infer` on batches of sentences.

    infer gives (indices, type) of each sentence's entities, as many lists as it got sentences. head
    is the number of labels that the model scores, which a flow holds against its specification.
    """

    def predict(tokens: DataFrame) -> DataFrame:
        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            model = load()
            kind = pa.list_(pa.struct([("text", pa.list_(pa.string())), ("indices", pa.list_(pa.int32())), ("type", pa.string())]))
            for whole in batches:
                for at in range(0, whole.num_rows, batch_size):
                    b = whole.slice(at, batch_size)
                    words = b.column("sentence").to_pylist()
                    found = infer(model, words)
                    if len(found) != len(words):
                        raise ValueError(f"{len(found)} results for {len(words)} sentences")
                    told = [[{"text": [w[k] for k in ix], "indices": ix, "type": t} for ix, t in e] for w, e in zip(words, found)]
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.array(told, kind)], names=[*b.schema.names, "entity"])

        rows = tokens.select("id", "pmid", "sentence", *[c for c in ("ord",) if c in tokens.columns])
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
        return rows.mapInArrow(run, f"{schema}, entity {ENTITY}")

    predict.head = head
    return predict


def word_rules(patterns: dict[str, str]) -> Predictor:
    """Entities from a pattern for the words of each type."""
    return rule_predictor({name: lambda w, p=pattern: w.rlike(p) for name, pattern in patterns.items()})


def named_predictor(name: str) -> Predictor:
    """The predictor that a module holds, by `module:name`."""
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def named_fit(name: str) -> Callable[[DataFrame], Predictor]:
    """The function of training records that gives a predictor, by `module:name`, for cross-validation."""
    return named_predictor(name)
