"""BioC documents to annotation documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import rebase

# The type names of two corpora and their canonical ones.
BIORED_TYPES = {
    "ChemicalEntity": "Chemical",
    "DiseaseOrPhenotypicFeature": "Disease",
    "GeneOrGeneProduct": "Gene_Or_GeneProduct",
    "OrganismTaxon": "Species",
    "CellLine": "CellLine",
    "SequenceVariant": "VariantOrPolymorphism",
}
BC5CDR_TYPES = {"Chemical": "Chemical", "Disease": "Disease"}


def infon(infons: Column, key: str) -> Column:
    """The value of a named entry of an element's infons."""
    return F.get(F.filter(infons, lambda x: x["_key"] == key), F.lit(0))["_VALUE"]


def passages(docs: DataFrame) -> DataFrame:
    """(pmid, title, abstract, abstract_offset, problem, passage): of several passages of a type the last counts.

    problem: null, or why the document can't be converted (no title, no abstract, title not at 0).
    separator_ok tells whether the abstract begins one after the title.
    """
    of = lambda kind: F.filter("passage", lambda p: F.get(F.filter(p.infon, lambda x: x["_key"] == "type"), F.lit(0))["_VALUE"] == kind)
    titles, abstracts = of("title"), of("abstract")
    last = lambda a: F.try_element_at(a, F.lit(-1))
    told = docs.select(F.col("id").cast("string").alias("pmid"), "passage", F.get(titles, F.lit(0)).alias("_first"), last(titles).alias("_t"), last(abstracts).alias("_a"))
    problem = F.when(F.col("_t").isNull(), "no title").when(F.col("_a").isNull(), "no abstract").when(F.col("_first.offset") != 0, "title not at 0")
    title, abstract = F.coalesce("_t.text", F.lit("")), F.coalesce("_a.text", F.lit(""))
    return told.select(
        "pmid", title.alias("title"), abstract.alias("abstract"), F.col("_a.offset").alias("abstract_offset"), problem.alias("problem"), (F.col("_a.offset") == F.char_length(title) + 1).alias("separator_ok"), "passage"
    )


def convert(docs: DataFrame, types: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Annotation documents, and (pmid, problem) of those that can't be converted.

    Annotations of unknown types, without locations, or with any empty location are left out whole;
    offsets become those of the fulltext.
    """
    told = passages(docs)
    known = F.create_map(*[F.lit(x) for kv in types.items() for x in kv])
    place = lambda o: rebase(o, F.char_length("title"), F.col("abstract_offset"))
    flat = F.flatten(F.transform(F.coalesce("passage", F.array()), lambda p: F.coalesce(p.annotation, F.array().cast(_annotation_type(docs)))))
    read = F.transform(
        flat,
        lambda a: F.struct(
            F.transform(F.coalesce(a.location, F.array().cast("array<struct<_length:int,_offset:int>>")), lambda x: F.struct(place(x["_offset"]).alias("s"), place(x["_offset"] + x["_length"]).alias("e"))).alias("spans"),
            F.try_element_at(known, infon(a.infon, "type")).alias("type"),
        ),
    )
    good = F.filter(read, lambda x: x.type.isNotNull() & (F.size(x.spans) > 0) & ~F.exists(x.spans, lambda y: y.s >= y.e))
    return told.where("problem is null").select("pmid", "title", "abstract", good.alias("label")), told.where("problem is not null").select("pmid", "problem")


def _annotation_type(docs: DataFrame) -> str:
    fields = {f.name: f for f in docs.schema["passage"].dataType.elementType.fields}
    return fields["annotation"].dataType.simpleString()
