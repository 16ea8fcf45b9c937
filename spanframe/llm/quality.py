"""Quality rules, in DataFrame operations only: text statistics and lines that many documents of a host share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, broadcast_if_small, cut, lower_ascii, table, without

#: Frequent lines are broadcast up to this number, and joined by a shuffle beyond it.
BROADCAST_ROWS = 200_000
#: Distinct documents of a host above which a line of five words or more is boilerplate, however large the host.
MOST_DOCS = 30


#: The six white-space characters of the contract.
_BLANK = " \t\n\x0b\f\r"


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once, however the optimiser moves the expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _words(text: Column) -> Column:
    """The words of a text; an empty array if it has none."""
    return _let(F.btrim(text, F.lit(_BLANK)), lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE)))


def _lines(text: Column) -> Column:
    """Hash of the normalised line, number of words and place, of each line that has a word."""

    def told(line: Column, at: Column) -> Column:
        return _let(_words(line), lambda w: F.struct(F.xxhash64(lower_ascii(F.concat_ws(" ", w))).alias("h"), F.size(w).cast("long").alias("w"), at.alias("at")))

    return F.filter(F.transform(F.split(text, "\n"), told), lambda x: x.w > 0)


def _repeats(words: Column) -> Column:
    """Words at positions that a three-word window covers whose words occur in another window, too.

    Windows are hashed. Most texts have no equal ones and are done by a hash set; where few hashes
    repeat, their positions are found by looking for them; otherwise windows are sorted with their
    positions, and equal neighbours repeat. sort_array compares in generated code, unlike array_sort.
    """

    def windows(w: Column) -> Column:
        hashed = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
        return F.slice(hashed, 1, F.greatest(F.size(w) - 2, F.lit(0)))

    def again(h: Column) -> Column:
        return _let(F.sort_array(h), lambda s: F.array_distinct(F.filter(s, lambda x, i: x == F.get(s, i - 1))))

    def looked_for(h: Column, few: Column) -> Column:
        return F.filter(F.transform(h, lambda x, i: F.when(F.array_contains(few, x), i)), lambda i: i.isNotNull())

    def by_sorting(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("g"), i.alias("p"))))
        return _let(placed, lambda s: F.sort_array(F.transform(F.filter(s, lambda x, i: (x.g == F.get(s, i - 1).g) | (x.g == F.get(s, i + 1).g)), lambda x: x.p)))

    def covered(at: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(at, start, lambda a, p: F.struct((a.n + F.least(F.lit(3), p - a.last)).alias("n"), p.alias("last")), lambda a: a.n)

    def count(h: Column) -> Column:
        told = _let(again(h), lambda few: _let(F.when(F.size(few) <= FEW, looked_for(h, few)).otherwise(by_sorting(h)), covered))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(told)

    return _let(windows(words), count)


#: Up to so many repeated windows are looked for one by one.
FEW = 16

STATISTICS = ("_n_words", "_word_chars", "_n_symbols", "_n_dup_lines", "_n_repeat_words")


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns and _n_words, _word_chars, _n_symbols, _n_dup_lines, _n_repeat_words of whole texts (null: empty).

    The work for one text is n log n at most, in one row.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    by_words = _let(_words(text), lambda w: F.struct(F.size(w).cast("long").alias("n"), F.char_length(F.concat_ws("", w)).cast("long").alias("c"), _repeats(w).cast("long").alias("r")))
    lined = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(_BLANK)) != "")
    return docs.withColumns(
        {
            "_by_words": by_words,
            "_n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
            "_n_dup_lines": _let(lined, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        }
    ).withColumns({"_n_words": F.col("_by_words.n"), "_word_chars": F.col("_by_words.c"), "_n_repeat_words": F.col("_by_words.r")}).drop("_by_words")


def frequent_lines(lined: DataFrame, *, min_docs: int = 10, share: float = 0.1, most: int | None = None, min_words: int = 5) -> DataFrame:
    """_host and _h, the hash, of each line that more distinct documents of its host hold than the limit.

    lined: (_host, _digest, _lines) of each document. The limit is min_docs or, if more, this share
    of the host's distinct documents. With `most`, lines of min_words words or more are frequent
    above so many documents, too, however large the host. Documents with the same text count once,
    so copies of one document don't make its lines frequent.
    """
    hosts = lined.select("_host", "_digest").distinct().groupBy("_host").agg(F.count(F.lit(1)).alias("_docs"))
    each = lined.select("_host", "_digest", F.explode("_lines").alias("_l")).select("_host", "_digest", F.col("_l.h").alias("_h"), F.col("_l.w").alias("_w"))
    counts = each.distinct().groupBy("_host", "_h").agg(F.count(F.lit(1)).alias("_n"), F.max("_w").alias("_w")).where(F.col("_n") > min_docs)
    hosts = broadcast_if_small(cut(hosts.withColumnRenamed("_host", "_host2")), BROADCAST_ROWS)
    often = F.col("_n") > share * F.col("_docs")
    if most is not None:
        often |= (F.col("_n") > most) & (F.col("_w") >= min_words)
    return cut(counts.join(hosts, F.col("_host").eqNullSafe(F.col("_host2"))).where(often).select("_host", "_h"))


OWN = (
    *STATISTICS, "_removed_words", "_base_failed", "_kept", "_clean_text", "_by_words",
    "_id", "_rid", "_rhost", "_rdigest", "_digest", "_gone", "_h", "_host", "_lines", "_l", "_row", "_w", "_docs", "_host2", "_n",
)


def verdicts(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", min_docs: int = 10, share: float = 0.1, least: float = 0.3, most: int | None = None,
    min_words: int = 5,
) -> DataFrame:
    """_id, _host and _digest of every row with its statistics, _removed_words, _gone, _base_failed and _kept; no texts.

    Texts are read once, into statistics and line hashes, which are written to the shared folder;
    all that follows reads those. _gone has the places of the removed lines.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(F.col(id_col).alias("_id"), F.col(host_col).alias("_host"), text.alias("_text"))
    lined = statistics(own, "_text").select("_id", "_host", F.xxhash64("_text").alias("_digest"), *STATISTICS, _lines(F.col("_text")).alias("_lines"))
    lined = cut(lined).withColumn("_row", F.monotonically_increasing_id())
    frequent = broadcast_if_small(frequent_lines(lined, min_docs=min_docs, share=share, most=most, min_words=min_words), BROADCAST_ROWS)
    at = lined.select("_row", F.col("_host").alias("_rhost"), F.explode("_lines").alias("_l"))
    removed = (
        at.join(frequent, (F.col("_l.h") == F.col("_h")) & F.col("_rhost").eqNullSafe(F.col("_host")))
        .groupBy("_row").agg(F.sum("_l.w").alias("_removed_words"), F.collect_list("_l.at").alias("_gone"))
    )
    joined = lined.drop("_lines").join(removed, "_row", "left").withColumn("_removed_words", F.coalesce("_removed_words", F.lit(0)))
    failed = (F.col("_n_words") < 50) | (100 * F.col("_n_repeat_words") > 50 * F.col("_n_words"))
    kept = ~failed & (F.col("_n_words") - F.col("_removed_words") >= least * F.col("_n_words"))
    return joined.drop("_row").withColumns({"_base_failed": failed, "_kept": kept})


def quality_rules(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", clean: bool = False, **limits) -> DataFrame:
    """Every row with its statistics, _removed_words, _base_failed and _kept; with `clean`, _clean_text too.

    Lines above the limit of frequent_lines() are removed; a document of which less than the share
    `least` of its words is left is depleted and not kept (`limits`: those of verdicts()). Null texts
    are empty, and fail for having too few words; the null host is a host; a null id is an id; rows
    with the same id, host and text are decided alike, as they have the same lines. All columns are
    kept, but for those that have the names of results or of helpers (OWN).
    """
    docs = without(docs, *OWN)
    text = F.coalesce(F.col(text_col), F.lit(""))
    told = verdicts(docs, id_col=id_col, text_col=text_col, host_col=host_col, **limits).dropDuplicates(["_id", "_host", "_digest"]).withColumnsRenamed({"_host": "_rhost", "_digest": "_rdigest"})
    same = F.col(id_col).eqNullSafe(F.col("_id")) & F.col(host_col).eqNullSafe(F.col("_rhost")) & (F.col("_digest") == F.col("_rdigest"))
    out = docs.withColumn("_digest", F.xxhash64(text)).join(told if clean else told.drop("_gone"), same)
    if clean:
        out = out.withColumn("_clean_text", F.when(F.col("_gone").isNull(), text).otherwise(F.array_join(F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains("_gone", i)), "\n")))
    return out.drop("_id", "_rhost", "_rdigest", "_digest", "_gone")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words")
    return verdicts(docs, most=MOST_DOCS).select(F.col("_id").alias("doc_id"), *[F.col(f"_{n}").alias(n) for n in names])


ORACLE_OP7 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, unnest(range(len(x))) AS i, unnest(x) AS w FROM (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS x FROM d)),
g AS (SELECT rid, i, w || chr(1) || lead(w, 1) OVER o || chr(1) || lead(w, 2) OVER o AS g FROM w WINDOW o AS (PARTITION BY rid ORDER BY i)),
r AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, g) AS n FROM g WHERE g IS NOT NULL) WHERE n > 1),
c AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM r) GROUP BY rid),
l AS (SELECT rid, source, t, line, trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
      FROM (SELECT rid, source, t, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM l GROUP BY rid),
hosts AS (SELECT source, count(DISTINCT t) AS docs FROM d GROUP BY source),
often AS (SELECT l.source, norm FROM l JOIN hosts h ON h.source IS NOT DISTINCT FROM l.source GROUP BY l.source, norm, docs HAVING count(DISTINCT t) > 10 AND (count(DISTINCT t) > 0.1 * docs OR count(DISTINCT t) > 30 AND max(len(string_split(norm, ' '))) >= 5)),
gone AS (SELECT rid, CAST(sum(len(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) AS BIGINT) AS n FROM l JOIN often o ON o.norm = l.norm AND o.source IS NOT DISTINCT FROM l.source GROUP BY rid),
s AS (SELECT doc_id, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
      length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, coalesce(gone.n, 0) AS removed_words
      FROM d LEFT JOIN c USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN gone USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT *, NOT base_failed AND n_words - removed_words >= 0.3 * n_words AS kept FROM b
"""
