"""Word pieces by the longest match with a vocabulary, unknown words, and the place of each word's pieces.

No vocabulary is trained here: it is a table of pieces, from a file of a public tokenizer or any other
source. A piece is (piece, begins): one that begins a word, or one that goes on. A word is cut
greedily into the longest pieces that fit; if some rest has none, the whole word is unknown.

Two ways give the same pieces. word_pieces() cuts each distinct word once, by joins, which suits
tables of words. Vocabulary does it inside a pass over texts, with a memory of the words
that it has met, and so needs no shuffle at all.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import materialise

#: Characters of a word at most; longer ones are unknown.
LONGEST_WORD = 100
#: Pieces of a vocabulary at most that tasks hold, or that a join broadcasts; a larger one is joined by a shuffle.
MOST_PIECES = 500_000


class Vocabulary:
    """A vocabulary that tasks hold: pieces(word) is a tuple, with None for an unknown word."""

    def __init__(self, begins: frozenset[str], goes_on: frozenset[str]):
        self.begins, self.goes_on = begins, goes_on
        self.longest = max(map(len, begins | goes_on), default=0)

    @staticmethod
    def of(table: DataFrame) -> Vocabulary:
        """From a table (piece, begins), which must be small enough."""
        rows = table.select("piece", "begins").where("piece <> ''").limit(MOST_PIECES + 1).collect()
        if len(rows) > MOST_PIECES:
            raise ValueError(f"a vocabulary of more than {MOST_PIECES} pieces is not for tasks to hold; use word_pieces()")
        return Vocabulary(frozenset(r["piece"] for r in rows if r["begins"]), frozenset(r["piece"] for r in rows if not r["begins"]))

    def __repr__(self) -> str:
        text = "\n".join([*sorted(self.begins), "", *sorted(self.goes_on)])
        return f"Vocabulary({hashlib.sha256(text.encode()).hexdigest()})"

    def __getstate__(self):
        return self.begins, self.goes_on, self.longest

    def __setstate__(self, state):
        self.begins, self.goes_on, self.longest = state

    def pieces(self, word: str) -> tuple[str | None, ...]:
        known = self.__dict__.get("_known")
        if known is None:
            known = self._known = lru_cache(1 << 17)(self._cut)
        return known(word)

    def _cut(self, word: str) -> tuple[str | None, ...]:
        if len(word) > LONGEST_WORD:
            return (None,)
        out, at = [], 0
        while at < len(word):
            own = self.goes_on if at else self.begins
            end = next((e for e in range(min(len(word), at + self.longest), at, -1) if word[at:e] in own), None)
            if end is None:
                return (None,)
            out.append(word[at:end])
            at = end
        return tuple(out)


def vocabulary_file(spark: SparkSession, path: str, mark: str = "##") -> DataFrame:
    """(piece, begins) of a vocabulary: a text file with a piece on each line, or a tokenizer's JSON file.

    Pieces that go on are those with `mark` before them, as in word-piece vocabularies; a JSON file whose
    vocabulary marks the end of a word by `</w>` instead has pieces of both kinds: what ends a word
    may also begin it. Pieces in square brackets are signs, not text.
    """
    if not path.endswith(".json"):
        lines = spark.read.text(path).select(F.col("value").alias("piece"))
        goes = F.col("piece").startswith(mark)
        told = lines.select(F.when(goes, F.expr(f"substring(piece, {len(mark) + 1})")).otherwise(F.col("piece")).alias("piece"), (~goes).alias("begins"))
    else:
        names = list(json.loads(spark.read.text(path, wholetext=True).first()[0])["model"]["vocab"])
        if any(x.endswith("</w>") for x in names):
            rows = [(x.removesuffix("</w>"), b) for x in names for b in (True, False)]
        else:
            rows = [(x.removeprefix(mark), not x.startswith(mark)) for x in names]
        told = spark.createDataFrame(rows, "piece string, begins boolean")
    return told.where("piece <> '' and not (piece like '[%' and piece like '%]' and length(piece) > 2)").distinct()


def word_pieces(words: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(word, pieces) of each distinct word of a table (word): the pieces, or null if the word is unknown.

    Every place of a word is joined with the longest piece of the vocabulary that begins there, and
    a fold walks from one to the next. The vocabulary is broadcast if it is small. Null words are left
    out; the empty word has no pieces.
    """
    told = materialise(vocabulary.select("piece", "begins").where("piece <> ''").distinct())
    longest = told.agg(F.coalesce(F.max(F.char_length("piece")), F.lit(0))).first()[0]
    small = F.broadcast(told) if told.limit(MOST_PIECES + 1).count() <= MOST_PIECES else told
    each = materialise(words.select("word").where("word is not null").distinct())
    size = F.char_length("word")
    places = each.where(size <= LONGEST_WORD).select("word", F.explode(F.sequence(F.lit(0), size - 1)).alias("at")).where("word <> ''")
    tries = places.select("word", "at", F.explode(F.sequence(F.lit(1), F.least(F.lit(max(longest, 1)), size - F.col("at")))).alias("n"))
    found = tries.withColumns({"piece": F.substring("word", F.col("at") + 1, F.col("n")), "begins": F.col("at") == 0}).join(small, ["piece", "begins"])
    best = found.groupBy("word", "at").agg(F.max("n").cast("int").alias("n")).groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("at", "n"))).alias("steps"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("pieces"))

    def step(a: Column, k: Column) -> Column:
        n = F.try_element_at(F.col("steps"), a.at)
        more = F.struct((a.at + n).alias("at"), F.concat(a.pieces, F.array(F.substring("word", a.at + 1, n))).alias("pieces"))
        return F.when((k == a.at) & n.isNotNull(), more).otherwise(a)

    walked = F.aggregate(F.sequence(F.lit(0), size - 1), start, step)
    done = best.withColumn("w", walked).where(F.col("w.at") == size).select("word", F.col("w.pieces").alias("pieces"))
    none = F.when(F.col("word") == "", F.array().cast("array<string>"))
    return each.join(done, "word", "left").select("word", F.coalesce("pieces", none).alias("pieces"))


def piece_rates(words: DataFrame, pieces: DataFrame, threshold: float = 0.05, id_col: str = "pmid") -> DataFrame:
    """(id, n_pieces, unk_rate, supported) from how often each word is in each document (id, word, n) and word_pieces().

    An unknown word is one unknown piece. Documents without pieces are supported.
    """
    told = words.join(pieces, "word")
    count, odd = F.coalesce(F.size("pieces"), F.lit(1)), F.col("pieces").isNull()
    rates = told.groupBy(id_col).agg(F.sum(F.col("n") * F.when(odd, 1).otherwise(count)).alias("n_pieces"), F.sum(F.when(odd, F.col("n")).otherwise(0)).alias("_odd"))
    rate = F.coalesce(F.try_divide(F.col("_odd"), F.col("n_pieces")), F.lit(0.0))
    return rates.select(id_col, "n_pieces", rate.alias("unk_rate"), (rate <= threshold).alias("supported"))
