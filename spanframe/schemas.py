"""Record types of the stage boundaries, and the label specification."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields
from typing import Any

SPAN = "struct<s:int,e:int>"
NER = "struct<indices:array<int>,fragments:array<struct<start_char:int,end_char:int>>,type:string>"

ANNOTATION = f"pmid string, title string, abstract string, label array<struct<spans:array<{SPAN}>,type:string>>"
INGEST = "schema_version string, pmid string, title string, abstract string, fulltext string"
TOKEN = f"schema_version string, id string, document_id string, pmid string, sentence array<string>, spans array<{SPAN}>, ner array<{NER}>"
PREDICT = "schema_version string, id string, pmid string, sentence array<string>, entity array<struct<text:array<string>,indices:array<int>,type:string>>"
POSTPROCESS = f"schema_version string, id string, pmid string, sentence_str string, fulltext_offset int, entity array<struct<text_str:string,sentence_spans:array<{SPAN}>,type:string>>"
MANIFEST = "schema_version string, stage string, input_files array<string>, input_hash string, record_count long, timestamp string, code_version string"
GRID = "id string, row int, col int, label int"
METRICS = "type string, tp long, fp long, fn long, precision double, recall double, f1 double"
DECODE_WARNING = "id string, head int, tail int, message string, stats map<string,long>"
_BIOC_ANNOTATION = "struct<_id:string,infon:array<struct<_VALUE:string,_key:string>>,location:array<struct<_length:int,_offset:int>>,text:string>"
#: A BioC document as Spark's XML reader sees it.
BIOC = f"id string, passage array<struct<infon:array<struct<_VALUE:string,_key:string>>,offset:int,text:string,annotation:array<{_BIOC_ANNOTATION}>>>"

VERSION = "1"

# Fixed values of the label vocabulary: names, order, aliases and filters are data formats.
SENTINELS = ("<pad>", "<suc>")
ENTITY_TYPES = ("Chemical", "Disease", "Gene_Or_GeneProduct", "Species", "CellLine", "VariantOrPolymorphism")
ALIASES = {
    "ChemicalsAndDrugs": "Chemical",
    "Gene": "Gene_Or_GeneProduct",
    "ChemicalEntity": "Chemical",
    "DiseaseOrPhenotypicFeature": "Disease",
    "GeneOrGeneProduct": "Gene_Or_GeneProduct",
    "OrganismTaxon": "Species",
    "SequenceVariant": "VariantOrPolymorphism",
}
MODEL_FILTERS = {"_bc5cdr": ("Chemical", "Disease"), "_biored": ENTITY_TYPES, "_combined": ENTITY_TYPES}


@dataclass(frozen=True)
class LabelSpec:
    """Sentinels, entity types in the order of their ids, aliases, and the types that each model suffix includes."""

    entity_types: tuple[str, ...] = ENTITY_TYPES
    aliases: dict[str, str] = field(default_factory=lambda: dict(ALIASES))
    model_filters: dict[str, tuple[str, ...] | None] = field(default_factory=lambda: dict(MODEL_FILTERS))
    sentinels: tuple[str, ...] = SENTINELS

    def __post_init__(self):
        if tuple(self.sentinels) != SENTINELS:
            raise ValueError(f"sentinels must be {list(SENTINELS)}, in this order")

    @property
    def label2id(self) -> dict[str, int]:
        return {x: k for k, x in enumerate((*self.sentinels, *self.entity_types))}

    @property
    def id2label(self) -> dict[int, str]:
        return {k: x for x, k in self.label2id.items()}

    def included(self, suffix: str | None) -> tuple[str, ...]:
        """Types of a model suffix, in the specification's order; all for none, an unknown one or one without a list."""
        chosen = self.model_filters.get(suffix) if suffix else None
        return tuple(x for x in self.entity_types if chosen is None or x in chosen)

    @staticmethod
    def load(path: str) -> LabelSpec:
        with open(path, encoding="utf-8") as f:
            d = json.load(f)
        filters = {k: tuple(v["include"]) if "include" in v else None for k, v in d.get("model_filters", {}).items()}
        return LabelSpec(tuple(d["entity_types"]), dict(d.get("aliases", {})), filters, tuple(d["sentinels"]))


@dataclass
class ModelConfig:
    """Hyper-parameters of a model; unknown keys of a file are ignored."""

    bert_name: str
    bert_hid_size: int
    use_bert_last_4_layers: bool
    lstm_hid_size: int
    conv_hid_size: int
    biaffine_size: int
    ffnn_hid_size: int
    dist_emb_size: int
    type_emb_size: int
    dilation: list[int]
    emb_dropout: float
    conv_dropout: float
    out_dropout: float
    epochs: int
    learning_rate: float
    bert_learning_rate: float
    weight_decay: float
    clip_grad_norm: float
    warm_factor: float
    seed: int
    batch_size: int
    label_num: int
    entity_types: list[str]
    min_bg_weight: float = 0.0
    load_path: str | None = None
    save_path: str | None = None

    def __post_init__(self):
        if self.load_path is None:
            self.load_path = self.save_path
        if self.save_path is None:
            self.save_path = self.load_path

    @staticmethod
    def of(values: dict[str, Any]) -> ModelConfig:
        known = {f.name for f in fields(ModelConfig)}
        return ModelConfig(**{k: v for k, v in values.items() if k in known})
