"""Labels to chunks and words: type normalisation, containment, boundary resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import LabelSpec
from .likely import left_join, likely
from .storage import stored

#: Characters of a bucket of offsets, about as many as a short chunk has.
BUCKET = 64


def label_ids(spark: SparkSession, spec: LabelSpec) -> DataFrame:
    """(label_id, type) in the specification's order; made of literals, as a list of rows would start Python workers."""
    rows = F.array(*[F.struct(F.lit(k).cast("int").alias("label_id"), F.lit(x).alias("type")) for x, k in spec.label2id.items()])
    return spark.range(0, 1, 1, 1).select(F.inline(rows))


def canonical_type(raw: Column, spec: LabelSpec) -> Column:
    """The alias's type, else the raw name if it is an entity type, else null."""
    known = F.create_map(*[F.lit(x) for t in spec.entity_types for x in (t, t)], *[F.lit(x) for a in sorted(spec.aliases.items()) if a[0] not in spec.entity_types for x in a])
    return F.try_element_at(known, raw)


def type_included(name: Column, spec: LabelSpec, suffix: str | None) -> Column:
    return name.isin(list(spec.included(suffix)))


def last_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the largest order of each key."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r")).select(key, "_r.*")


def join_by_id(tokens: DataFrame, predictions: DataFrame, order: str = "ord") -> DataFrame:
    """Token rows with the last prediction of their id."""
    return tokens.join(last_wins(predictions, "id", order).drop(order), "id")


def first_containing(labels: DataFrame, chunks: DataFrame, id_col: str = "pmid", bucket: int = BUCKET, made: dict[str, Column] | None = None) -> DataFrame:
    """Each label with the first chunk (by ord) whose range holds all its spans; chunk columns null if none does.

    labels: (id, label_ord, spans); chunks: (id, ord, s, e). All spans lie in a range if their extent
    does; labels without spans are in the first chunk. The line of offsets is cut in buckets: a chunk
    stands in each that it touches, a label in that where it begins, so an equi-join on document and
    bucket meets a label with the few chunks about it, and a large document is spread over tasks.
    Of chunks, only those in buckets that may hold a label are shuffled. One minimum for each label
    follows: no window, partial before the shuffle. `made` are columns of a label and its chunk together, made where
    they meet, so that other columns of chunks go no further.
    """
    lo, hi = F.array_min(F.transform("spans", lambda x: x.s)), F.array_max(F.transform("spans", lambda x: x.e))
    told = labels.withColumns({"_lo": lo, "_hi": hi})
    place = lambda c: F.floor(c / bucket)
    more = [c for c in chunks.columns if c not in (id_col, "ord", "s", "e")]
    c = chunks.select(F.col(id_col).alias("_cid"), F.struct("ord", "s", "e").alias("_c"), *more)
    spread = c.withColumn("_bucket", F.explode(F.sequence(place(F.col("_c.s")), F.greatest(place(F.col("_c.s")), place(F.col("_c.e"))))))
    begun = told.where("_lo is not null").withColumn("_at", place(F.col("_lo")))
    spread = likely(spread, [F.col("_cid"), F.col("_bucket")], begun, [F.col(id_col), F.col("_at")])
    met = begun.join(spread, (F.col(id_col) == F.col("_cid")) & (F.col("_at") == F.col("_bucket")) & (F.col("_c.s") <= F.col("_lo")) & (F.col("_hi") <= F.col("_c.e")), "left")
    bare = told.where("_lo is null")
    own = likely(c, [F.col("_cid")], bare, [F.col(id_col)]).groupBy("_cid").agg(F.min(F.struct("_c", *more)).alias("_m")).select("_cid", "_m.*")
    bare = bare.join(own, F.col(id_col) == F.col("_cid"), "left")
    hit = F.when(F.col("_cid").isNotNull(), F.struct("_c.ord", "_c.s", "_c.e", *[x.alias(k) for k, x in (made or {}).items()])).alias("_hit")
    placed = met.select(*labels.columns, hit).groupBy(*labels.columns).agg(F.min("_hit").alias("_hit")).unionByName(bare.select(*labels.columns, hit))
    return placed.select(*labels.columns, *[F.col(f"_hit.{x}").alias(f"chunk_{x}") for x in ("ord", "s", "e")], *[F.col(f"_hit.{k}").alias(k) for k in made or {}])


def boundary_index(words: Column) -> Column:
    """A chunk's words (s, e) as (starts, ends), their offsets from the last word to the first: plain numbers, nothing is sorted."""
    return F.struct(F.reverse(words.getField("s")).alias("starts"), F.reverse(words.getField("e")).alias("ends"))


def _word_at(offsets: Column, offset: Column) -> Column:
    """The last word with an offset; null if no word has it."""
    at = F.array_position(offsets, offset)
    return F.when(at > 0, F.size(offsets) - at.cast("int"))


def resolve_fragments(spans: Column, index: Column) -> Column:
    """Word indices that the fragments cover, or null if one starts or ends off a word boundary.

    `index` is boundary_index() of the chunk's words; each boundary costs a look through the chunk's offsets, whose number its limit bounds.
    Where boundaries repeat, the last word counts. The indices are the sorted union of the fragments'
    ranges. Without fragments the result is null.
    """
    pairs = F.transform(spans, lambda x: F.struct(_word_at(index.getField("starts"), x.s).alias("a"), _word_at(index.getField("ends"), x.e).alias("b")))
    good = (F.size(spans) > 0) & F.forall(pairs, lambda p: F.coalesce(p.a <= p.b, F.lit(False)))
    ranges = F.transform(F.filter(pairs, lambda p: p.a <= p.b), lambda p: F.sequence(p.a, p.b))
    return F.when(good, F.array_sort(F.array_distinct(F.flatten(ranges))))


def assign_labels(annotations: DataFrame, chunks: DataFrame, spec: LabelSpec, suffix: str | None = None) -> DataFrame:
    """Every label with its fate: (pmid, label_ord, type, status, id, indices, fragments, n_words), the last of its chunk.

    annotations: (pmid, ord, label); the last row of a pmid counts. chunks: token records with ord.
    status: unknown, filtered, dropped or assigned. A label that fails on the boundaries of the first
    chunk that holds it is dropped, without a look at later ones.
    """
    told = last_wins(annotations.select("pmid", "ord", "label"), "pmid", "ord").select("pmid", F.posexplode_outer("label").alias("label_ord", "l")).where("l is not null")
    told = told.select("pmid", "label_ord", F.col("l.spans").alias("spans"), canonical_type(F.col("l.type"), spec).alias("type"))
    index = boundary_index(F.col("spans")).alias("words")
    ranged = chunks.where(F.size("spans") > 0).select("pmid", "ord", F.get("spans", F.lit(0)).s.alias("s"), F.element_at("spans", -1).e.alias("e"), "id", index)
    made = {"id": F.col("id"), "indices": resolve_fragments(F.col("spans"), F.col("words")), "n_words": F.size("words.starts")}
    found = first_containing(told, ranged, made=made)
    indices = F.col("indices")
    status = F.when(F.col("type").isNull(), "unknown").when(~type_included(F.col("type"), spec, suffix), "filtered").when(indices.isNull(), "dropped").otherwise("assigned")
    return found.withColumn("status", status).select(
        "pmid", "label_ord", "type", "status", "id", "indices", F.transform("spans", lambda x: F.struct(x.s.alias("start_char"), x.e.alias("end_char"))).alias("fragments"),
        "n_words",
    )


def with_entities(annotations: DataFrame, chunks: DataFrame, fates: DataFrame) -> DataFrame:
    """Token records of annotated documents, with their assigned labels as `ner`, in label order.

    Labels are few beside chunks: those of each chunk are stored, and only chunks that may have some meet them.
    """
    ner = (
        fates.where("status = 'assigned'").groupBy("id")
        .agg(F.array_sort(F.collect_list(F.struct("label_ord", "indices", "fragments", "type"))).alias("n"))
        .select("id", F.transform("n", lambda x: F.struct(x.indices.alias("indices"), x.fragments.alias("fragments"), x.type.alias("type"))).alias("ner"))
    )
    empty = F.array().cast("array<struct<indices:array<int>,fragments:array<struct<start_char:int,end_char:int>>,type:string>>")
    kept = chunks.drop("ner").join(annotations.select("pmid").distinct(), "pmid", "left_semi")
    return left_join(kept, stored(ner), "id").withColumn("ner", F.coalesce("ner", empty))


def alignment_counts(fates: DataFrame) -> DataFrame:
    """One row (n_total, n_assigned, n_dropped): all labels, and those known and included that found no words."""
    return fates.agg(F.count(F.lit(1)).alias("n_total"), F.count_if(F.col("status") == "assigned").alias("n_assigned"), F.count_if(F.col("status") == "dropped").alias("n_dropped"))


def ordered(df: DataFrame, *by: str, partition: str, name: str = "ord") -> DataFrame:
    """Rows with their place (from 0) in their partition, by declared columns."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(partition).orderBy(*by)) - 1)
