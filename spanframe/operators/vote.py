"""Predictions back to text: spans, surfaces and the majority type of each surface."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import shift, slice_text, strip, surface
from ..schemas import VERSION
from .align import join_by_id, last_wins
from .likely import left_join
from .storage import stored


def island_spans(indices: Column, words: Column) -> Column:
    """One span (s, e) for each run of consecutive word indices; empty for none. Indices past the words raise."""
    at = F.array_sort(indices)
    begins = F.filter(at, lambda x, k: (k == 0) | (F.get(at, k - 1) < x - 1))
    ends = F.filter(at, lambda x, k: (k == F.size(at) - 1) | (F.get(at, k + 1) > x + 1))
    return F.zip_with(begins, ends, lambda a, b: F.struct(F.element_at(words, a + 1).s.alias("s"), F.element_at(words, b + 1).e.alias("e")))


def majority(votes: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], contested: bool = False) -> DataFrame:
    """(keys, majority): the most frequent value of each key; of equals, the one met first by `order`. If `contested`, only of keys with several values."""
    counted = votes.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*order)).alias("_first"))
    best = F.min_by(F.col(value), F.struct((-F.col("_n")).alias("n"), F.col("_first")))
    if contested:
        return counted.groupBy(*keys).agg(best.alias("majority"), F.count(F.lit(1)).alias("_kinds")).where("_kinds > 1").drop("_kinds")
    return counted.groupBy(*keys).agg(best.alias("majority"))


def surfaced(records: DataFrame, text: bool = True, columns: Sequence[str] = ("entity",)) -> DataFrame:
    """(_row, id, pmid, ord, sentence_str, fulltext_offset, entity) of token records (id, pmid, ord, spans, sentence_str, entity) with predictions.

    Each entity has its place, surface, spans relative to the sentence, and type. Records without words are left
    out; entities without text are too. Without `text`, so is sentence_str, for those who need surfaces only. Records
    may have several columns of predictions.
    """
    told = records.where(F.size("spans") > 0).withColumn("fulltext_offset", F.get("spans", F.lit(0)).s)

    def real(name: str) -> Column:
        spans = F.transform(name, lambda x, k: F.struct(k.alias("entity_ord"), shift(island_spans(x.indices, F.col("spans")), -F.col("fulltext_offset")).alias("sentence_spans"), x.type.alias("type")))
        named = F.transform(spans, lambda x: F.struct(x.entity_ord.alias("entity_ord"), surface(F.col("sentence_str"), x.sentence_spans).alias("text_str"), x.sentence_spans.alias("sentence_spans"), x.type.alias("type")))
        return F.coalesce(F.filter(named, lambda x: (F.size(x.sentence_spans) > 0) & (strip(x.text_str) != "")), F.array()).alias(name)

    return told.select(F.monotonically_increasing_id().alias("_row"), "id", "pmid", "ord", *["sentence_str"] * text, "fulltext_offset", *map(real, columns))


def voted(told: DataFrame, keys: Sequence[str] = ("pmid", "text_str")) -> DataFrame:
    """Postprocess records of surfaced() ones, which should be stored: types by majority of the keys.

    Only surfaces with several types are voted on, and only records of which an entity's type changes meet the outcome.
    """
    own = [c for c in told.columns if c not in ("_row", "entity")]
    each = told.select("_row", *own, F.explode("entity").alias("x")).select("*", "x.*").drop("x")
    best = majority(each, keys, "type", ("ord", "entity_ord"), contested=True)
    cond = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    for k in keys:
        best = best.withColumnRenamed(k, f"_{k}")
    changed = each.join(best, cond).where(F.col("majority").isNotNull() & ~F.col("majority").eqNullSafe(F.col("type")))
    changed = stored(changed.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("entity_ord", "majority"))).alias("_types")))
    entity = F.transform("entity", lambda x: F.struct(x.text_str.alias("text_str"), x.sentence_spans.alias("sentence_spans"), F.coalesce(F.try_element_at("_types", x.entity_ord), x.type).alias("type")))
    return left_join(told, changed, "_row").select(F.lit(VERSION).alias("schema_version"), *[c for c in own if c != "ord"], entity.alias("entity"), "ord")


def postprocess(tokens: DataFrame, predictions: DataFrame, texts: DataFrame | None = None, keys: Sequence[str] = ("pmid", "text_str")) -> DataFrame:
    """Postprocess records: spans relative to the chunk's sentence, and types by majority of (document, surface).

    tokens: token records with ord; predictions: (id, ord, entity); texts: (pmid, fulltext), last row
    of a pmid first declared by ord if there is one; token records with their sentence_str need no texts. Surfaces
    are computed once and serve both the vote and the result: records are stored with them. Where predictions are
    made beside their token records, surfaced() and voted() need no join of the two.
    """
    slim = F.transform("entity", lambda x: F.struct(x.indices.alias("indices"), x.type.alias("type"))).alias("entity")
    cut = [c for c in ("sentence_str",) if c in tokens.columns]
    told = join_by_id(tokens.select("id", "pmid", "ord", "spans", *cut), predictions.select("id", F.col("ord").alias("p_ord"), slim), "p_ord").where(F.size("spans") > 0)
    if not cut:
        texts = last_wins(texts, "pmid", "ord").drop("ord") if "ord" in texts.columns else texts.dropDuplicates(["pmid"])
        told = told.join(texts.select("pmid", "fulltext"), "pmid", "left").withColumn("sentence_str", slice_text(F.coalesce("fulltext", F.lit("")), F.get("spans", F.lit(0)).s, F.element_at("spans", -1).e))
    return voted(stored(surfaced(told)), keys)
