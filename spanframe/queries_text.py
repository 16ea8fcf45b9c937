"""The registered queries of word pieces and learned sentence ends, with their SQL; queries.py loads them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import adapters as A
from .operators import pieces, sentences, tokenize
from .operators.storage import materialise
from .queries import EVERY_MARK, FOURS, ITEMS, TOK, chunked, item_words, query

# The vocabulary of the items' words stands in for a file: words that occur twice, endings, and every character.
_VOCABULARY = rf"""{ITEMS}, voc AS MATERIALIZED (SELECT DISTINCT piece, begins FROM (
    SELECT word AS piece, TRUE AS begins FROM w GROUP BY word HAVING count(*) > 1 UNION ALL SELECT unnest(string_split(word, '')), TRUE FROM w UNION ALL SELECT unnest(string_split(word, '')), FALSE FROM w
    UNION ALL SELECT right(word, 3), FALSE FROM w WHERE length(word) > 3 UNION ALL SELECT right(word, 2), FALSE FROM w WHERE length(word) > 2))"""
#: Pieces of each different word of `dw`.
_DICT = r"""at0 AS (SELECT word, unnest(range(length(word))) AS pos FROM dw WHERE length(word) <= 100), tries AS (SELECT word, pos, unnest(range(1, length(word) - pos + 1)) AS n FROM at0),
best AS (SELECT word, pos, max(n) AS n FROM tries JOIN voc ON piece = substr(word, CAST(pos + 1 AS INT), CAST(n AS INT)) AND begins = (pos = 0) GROUP BY ALL),
walk AS (SELECT word, 0::BIGINT AS pos, []::VARCHAR[] AS pieces FROM dw UNION ALL SELECT walk.word, walk.pos + best.n, list_append(pieces, substr(walk.word, CAST(walk.pos + 1 AS INT), CAST(best.n AS INT))) FROM walk JOIN best USING (word, pos)),
dict AS MATERIALIZED (SELECT dw.word, pieces FROM dw LEFT JOIN walk ON walk.word = dw.word AND walk.pos = length(dw.word))"""
_PIECES = f"""{_VOCABULARY}, dw AS (SELECT DISTINCT word FROM tok), {_DICT},
rates AS MATERIALIZED (SELECT pmid, CAST(sum(coalesce(len(pieces), 1)) AS BIGINT) AS n_pieces, sum(CAST(pieces IS NULL AS INT)) / sum(coalesce(len(pieces), 1)) AS unk_rate FROM tok JOIN dict USING (word) GROUP BY pmid)"""
_BY_PIECES = f"{_PIECES}, s1 AS (SELECT s0.*, row_number() OVER (PARTITION BY pmid, sent ORDER BY ord) - 1 AS i, coalesce(len(pieces), 1) AS n FROM s0 JOIN dict USING (word) JOIN rates USING (pmid) WHERE unk_rate <= 0.05)"


def _vocabulary(spark, sf) -> DataFrame:
    w = materialise(item_words(spark, sf).select("word"))
    every = w.select(F.explode(F.split("word", "")).alias("piece")).distinct()
    n = F.char_length("word")
    out = w.groupBy(F.col("word").alias("piece")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("piece", F.lit(True).alias("begins"))
    for more in (every.select("piece", F.lit(True)), every.select("piece", F.lit(False)), *[w.where(n > k).select(F.expr(f"right(word, {k})"), F.lit(False)) for k in (2, 3)]):
        out = out.union(more)
    return out.where("piece <> ''").distinct()


def _told(made: DataFrame) -> DataFrame:
    return made.select("id", F.size("spans").cast("long").alias("n_words"), F.get("spans", F.lit(0)).s.alias("s"), F.element_at("spans", -1).e.alias("e"))


@query("word_pieces", f"WITH RECURSIVE {TOK}, {_PIECES} SELECT word, array_to_string(pieces, '|') AS pieces FROM dict")
def word_pieces(spark, sf):
    """Every different word of the documents as the longest pieces of a vocabulary; null if the vocabulary lacks some part."""
    return pieces.word_pieces(A.tokens(spark, sf).select("word"), _vocabulary(spark, sf)).select("word", F.array_join("pieces", "|").alias("pieces"))


@query("piece_unknown_rate", f"WITH RECURSIVE {TOK}, {_PIECES} SELECT pmid, n_pieces, round(unk_rate, 9) AS unk_rate, unk_rate <= 0.05 AS supported FROM rates")
def piece_unknown_rate(spark, sf):
    """Documents with their share of unknown pieces, from the counts of their words."""
    words = materialise(A.tokens(spark, sf).groupBy("pmid", "word").agg(F.count(F.lit(1)).alias("n")))
    return pieces.piece_rates(words, pieces.word_pieces(words, _vocabulary(spark, sf))).withColumn("unk_rate", F.round("unk_rate", 9))


@query("piece_chunks", f"WITH {chunked(EVERY_MARK, _BY_PIECES)} SELECT id, n_words, s, e FROM chunks")
def piece_chunks(spark, sf):
    """Chunks by the vocabulary's pieces, of the documents that it knows, in the one pass that the flow makes."""
    known = pieces.Vocabulary.of(_vocabulary(spark, sf))
    return _told(tokenize.token_records(A.documents(spark, sf), A.CHUNK, word_limit=1_000_000, vocabulary=known, most_unknown=0.05).where("id is not null"))


@query("piece_places", f"WITH RECURSIVE {_VOCABULARY}, dw AS (SELECT DISTINCT word FROM w), {_DICT}, n AS (SELECT item_id, ord, coalesce(len(pieces), 1) AS n FROM w JOIN dict USING (word)), u AS (SELECT *, sum(n) OVER (PARTITION BY item_id ORDER BY ord) AS u FROM n) SELECT item_id AS id, ord, CAST(u - n + 1 AS INT) AS first_piece, CAST(u AS INT) AS last_piece FROM u")
def piece_places(spark, sf):
    """The first and last piece of every word of the items, by the vocabulary."""
    items = materialise(item_words(spark, sf))
    told = items.join(pieces.word_pieces(items.select("word"), _vocabulary(spark, sf)), "word")
    return tokenize.piece_alignment(told, lambda _: F.coalesce(F.size("pieces"), F.lit(1))).withColumn("ord", F.col("ord").cast("long"))


_ALNUM = r"^[\p{L}\p{N}]"
_SHORT = r"^(\p{Nd}+|[\p{L}\p{M}\p{N}\p{Pc}])$"


def _ll(k: str, n: str, p: str) -> str:
    sure = f"least(greatest({p}, 1e-12), 1 - 1e-12)"
    return f"({k} * ln({sure}) + ({n} - {k}) * ln(1 - {sure}))"


def _association(a: str, b: str, ab: str, n: str) -> str:
    rest, others = f"({b} - {ab})", f"({n} - {a})"
    return f"2 * ({_ll(ab, a, f'({ab} / {a})')} + {_ll(rest, others, f'coalesce({rest} / nullif({others}, 0), 0)')} - {_ll(ab, a, f'({b} / {n})')} - {_ll(rest, others, f'({b} / {n})')})"


_LEARNED = rf"""x0 AS MATERIALIZED (SELECT *, lag(word) OVER o AS pw, lag(e) OVER o AS pe, lead(word) OVER o AS nw, lead(s) OVER o AS ns, lead(word, 2) OVER o AS nnw, lead(s, 2) OVER o AS nns FROM tok WINDOW o AS (PARTITION BY pmid ORDER BY ord)),
x1 AS (SELECT lower(word) AS word, coalesce(nw = '.' AND ns = e AND (nns IS NULL OR nns > e + 1), FALSE) AS dot, lower(nnw) AS b FROM x0 WHERE regexp_matches(word, '{_ALNUM}')),
per AS MATERIALIZED (SELECT word, count(*) FILTER (dot) AS n_dot, count(*) FILTER (NOT dot) AS n_plain FROM x1 GROUP BY word),
tot AS (SELECT CAST(sum(n_dot) AS DOUBLE) AS d, CAST(sum(n_dot + n_plain) AS DOUBLE) AS n FROM per),
sw0 AS (SELECT word, n_dot, n_plain, 2 * ({_ll("n_dot", "(n_dot + n_plain)", "0.99::DOUBLE")} - {_ll("n_dot", "(n_dot + n_plain)", "(d / n)")}) * exp(-CAST(length(word) AS DOUBLE)) * pow(CAST(length(word) AS DOUBLE), -n_plain) AS score FROM per, tot WHERE n_dot > 0),
sw AS MATERIALIZED (SELECT *, score >= 0.3 AND NOT regexp_matches(word, '^\p{{Nd}}+$') AS abbreviation FROM sw0),
pairs AS MATERIALIZED (SELECT word AS a, b, count(*) AS n_ab FROM x1 WHERE dot AND regexp_matches(b, '{_ALNUM}') GROUP BY ALL),
st0 AS (SELECT b AS word, sum(n_ab) AS n_start FROM pairs WHERE NOT regexp_matches(a, '{_SHORT}') AND a NOT IN (SELECT word FROM sw WHERE abbreviation) GROUP BY b),
st1 AS (SELECT CAST(greatest(coalesce(sum(n_start), 0), 1) AS DOUBLE) AS ends FROM st0),
st AS MATERIALIZED (SELECT word, {_association("ends", "(n_dot + n_plain)", "n_start", "n")} AS score FROM st0 JOIN per USING (word), st1, tot WHERE n_start / (n_dot + n_plain) > ends / n),
co0 AS (SELECT a, b, n_ab, pa.n_dot + pa.n_plain AS n_a, pb.n_dot + pb.n_plain AS n_b FROM pairs JOIN per pa ON pa.word = a JOIN per pb ON pb.word = b WHERE regexp_matches(a, '{_SHORT}') OR a IN (SELECT word FROM sw WHERE abbreviation)),
co AS MATERIALIZED (SELECT a, b, {_association("n_a", "n_b", "n_ab", "n")} AS score FROM co0, tot WHERE n_ab > 1 AND n_ab / n_a > n_b / n)"""
_ENDS = rf"""{_LEARNED},
y0 AS (SELECT *, sum(CASE WHEN word IN (')', ']', '}}', '"', '''', '»', '”', '’') AND s = coalesce(pe, -1) THEN 0 ELSE 1 END) OVER (PARTITION BY pmid ORDER BY ord) AS g FROM x0),
y1 AS (SELECT pmid, g, arg_min(word, ord) AS word, min(s) AS s, max(ord) AS last, max(e) AS e, arg_max(word, ord) AS lw FROM y0 GROUP BY ALL),
y2 AS (SELECT *, lag(lw) OVER o AS bw, lag(e) OVER o AS be, lead(word) OVER o AS aw, lead(s) OVER o AS a_s FROM y1 WINDOW o AS (PARTITION BY pmid ORDER BY g)),
y3 AS (SELECT *, CASE WHEN be = s AND regexp_matches(bw, '{_ALNUM}') THEN bw END AS before FROM y2 WHERE word IN ('.', '?', '!') AND (a_s IS NULL OR a_s > e)),
y4 AS (SELECT y3.*, co.a IS NOT NULL AS pair, sw.word IS NOT NULL AS short, st.word IS NOT NULL AS starter FROM y3 LEFT JOIN co ON co.a = lower(before) AND co.b = lower(aw) AND co.score >= 7.88
  LEFT JOIN sw ON sw.word = lower(before) AND sw.abbreviation LEFT JOIN st ON st.word = lower(aw) AND st.score >= 30),
fin AS (SELECT pmid, last AS ord, 1 AS fin FROM y4 WHERE word <> '.' OR aw IS NULL OR (NOT regexp_matches(aw, '^\p{{Ll}}') AND CASE WHEN before IS NULL THEN TRUE WHEN pair THEN FALSE
  WHEN short OR regexp_matches(before, '^\p{{Lu}}$') THEN regexp_matches(aw, '^\p{{Lu}}') AND starter WHEN regexp_matches(before, '^\p{{Nd}}+$') THEN NOT regexp_matches(aw, '^\p{{Nd}}') ELSE TRUE END)),
s0 AS (SELECT tok.*, CAST(coalesce(sum(fin) OVER (PARTITION BY pmid ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INT) AS sent FROM tok LEFT JOIN fin USING (pmid, ord))"""


@query(
    "sentence_words",
    f"WITH {TOK}, {_LEARNED} SELECT 'word' AS kind, word, NULL AS after, round(score, 4) + 0.0 AS score, abbreviation AS used FROM sw UNION ALL SELECT 'starter', word, NULL, round(score, 4) + 0.0, TRUE FROM st WHERE score >= 30 UNION ALL SELECT 'collocation', a, b, round(score, 4) + 0.0, TRUE FROM co WHERE score >= 7.88",
)
def sentence_words(spark, sf):
    """What the documents teach about full stops: scored words, words that begin sentences, collocations."""
    told = sentences.learn(A.documents(spark, sf))
    row = lambda kind, word, after, used: [F.lit(kind).alias("kind"), F.col(word).alias("word"), after.alias("after"), (F.round("score", 4) + F.lit(0.0)).alias("score"), used.alias("used")]
    none, yes = F.lit(None).cast("string"), F.lit(True)
    words = told.words.select(*row("word", "word", none, F.col("abbreviation")))
    return words.unionByName(told.starters.select(*row("starter", "word", none, yes))).unionByName(told.collocations.select(*row("collocation", "a", F.col("b"), yes)))


@query("sentence_ends", f"WITH {chunked(_ENDS, FOURS)} SELECT id, n_words, s, e FROM chunks")
def sentence_ends(spark, sf):
    """Chunks of sentences that end where the learned tables say."""
    docs = A.documents(spark, sf)
    return _told(tokenize.token_records(docs, A.CHUNK, splitter=sentences.learn(docs).splitter()))
