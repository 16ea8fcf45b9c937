"""Where sentences end, from what the texts themselves tell: abbreviations, collocations, words that begin sentences.

A full stop belongs to an abbreviation if its word stands before full stops far more often than words
do by chance, is short, and is seldom without one. The learned tables come from counts: of words with
and without a full stop, of words after sentence ends, and of pairs around a full stop. Each task counts
its own texts first, so that what is shuffled grows with different words, not with tokens.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cut import Cut, parts
from .storage import materialise

if TYPE_CHECKING:
    import numpy as np

#: Scores from which a word is an abbreviation, a pair a collocation, and a word one that begins sentences.
ABBREVIATION, COLLOCATION, STARTER = 0.3, 7.88, 30.0
#: Entries of the learned tables at most that tasks hold.
MOST = 1_000_000
#: Words that a task holds before it counts them.
COUNTED_WORDS = 500_000
_MARKS, _CLOSING = frozenset(".?!"), frozenset(")]}\"'»”’")


def contexts(toks: list[tuple[str, int, int]]) -> Iterator[tuple[int, str | None, str | None]]:
    """(place, word before, word after) of each full stop that may end a sentence: one that no token follows at once."""
    for k, (word, s, e) in enumerate(toks):
        if word == ".":
            after = toks[k + 1] if k + 1 < len(toks) else None
            if after is None or after[1] > e:
                before = toks[k - 1][0] if k and toks[k - 1][2] == s else None
                yield k, before if before and before[0].isalnum() else None, after and after[0]


def _dotted(t: Cut) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Of the tokens of many texts, as contexts() of each text has it: whether each is the word before a full stop, and the places (word, word after) of pairs."""
    import numpy as np

    touches, ended, starts = t.touches(), t.ended(), t.alnum()
    dot = np.flatnonzero(t.marks(".") & ~touches)
    dot = dot[dot > 0]
    dot = dot[touches[dot - 1] & starts[dot - 1]]
    dotted = np.zeros(len(t.s), bool)
    dotted[dot - 1] = True
    two = dot[~ended[dot]]
    two = two[starts[two + 1]]
    return dotted, (two - 1, two + 1)


def _occurrences(docs: DataFrame, text_col: str) -> DataFrame:
    """(kind, a, b, n): words (a, with 'dot' if b), and pairs around full stops, counted in each task."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        counts: Counter = Counter()
        held: dict[str | None, list[pa.Array]] = {"dot": [], None: []}

        def flush():
            kind, a, b, n = zip(*((*k, v) for k, v in counts.items()))
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((kind, a, b, n), (pa.string(), pa.string(), pa.string(), pa.int64()))], names=["kind", "a", "b", "n"])

        def count():
            for dot, some in held.items():
                if some:
                    each = pc.value_counts(pa.concat_arrays(some))
                    for word, n in zip(each.field("values").to_pylist(), each.field("counts").to_pylist()):
                        counts["word", word.lower(), dot] += n
                    some.clear()

        for batch in batches:
            for _, t in parts(batch, 0):
                dotted, pairs = _dotted(t)
                starts = t.alnum()
                held["dot"].append(t.words.filter(pa.array(starts & dotted)))
                held[None].append(t.words.filter(pa.array(starts & ~dotted)))
                for a, b in zip(*(t.words.take(pa.array(x)).to_pylist() for x in pairs)):
                    counts["pair", a.lower(), b.lower()] += 1
                if sum(map(len, held[None])) > COUNTED_WORDS:
                    count()
                if len(counts) > 500_000:
                    yield flush()
                    counts.clear()
        count()
        if counts:
            yield flush()

    return docs.select(text_col).mapInArrow(run, "kind string, a string, b string, n long").groupBy("kind", "a", "b").agg(F.sum("n").alias("n"))


def _log_likelihood(k: Column, n: Column, p: Column) -> Column:
    """The logarithm of a chance p's likelihood, with k hits of n; bounded away from 0 and 1."""
    sure = F.least(F.greatest(p, F.lit(1e-12)), F.lit(1 - 1e-12))
    return k * F.log(sure) + (n - k) * F.log(1 - sure)


def association(n_a: Column, n_b: Column, n_ab: Column, n: Column) -> Column:
    """Twice the log-likelihood ratio of `b follows a more, or less, often than chance` to `as often`."""
    p, p1, p2 = n_b / n, n_ab / n_a, F.coalesce(F.try_divide(n_b - n_ab, n - n_a), F.lit(0.0))
    return 2 * (_log_likelihood(n_ab, n_a, p1) + _log_likelihood(n_b - n_ab, n - n_a, p2) - _log_likelihood(n_ab, n_a, p) - _log_likelihood(n_b - n_ab, n - n_a, p))


@dataclass
class Learned:
    """The learned tables: words (word, n_dot, n_plain, score, abbreviation), starters (word, score), collocations (a, b, score)."""

    words: DataFrame
    starters: DataFrame
    collocations: DataFrame

    def splitter(self) -> Boundaries:
        """What tasks need to split: the words that the tables name, a small part of all words."""

        def held(df: DataFrame) -> list[tuple]:
            rows = df.limit(MOST + 1).collect()
            if len(rows) > MOST:
                raise ValueError(f"more than {MOST} entries are not for tasks to hold")
            return [tuple(r) for r in rows]

        return Boundaries(
            frozenset(r[0] for r in held(self.words.where("abbreviation").select("word"))),
            frozenset(r[0] for r in held(self.starters.select("word"))),
            frozenset(held(self.collocations.select("a", "b"))),
        )


def learn(docs: DataFrame, text_col: str = "fulltext", *, abbreviation: float = ABBREVIATION, collocation: float = COLLOCATION, starter: float = STARTER) -> Learned:
    """Learn from texts; no labels are needed. Null texts are empty, and an empty table teaches nothing.

    Words are taken without regard to case. A word's score is the log-likelihood ratio of `nearly always
    before a full stop` to `as often as any word`, less for long words and for each time that it stands without.
    """
    counts = materialise(_occurrences(docs, text_col))
    per = counts.where("kind = 'word'").groupBy(F.col("a").alias("word")).agg(F.sum(F.when(F.col("b").isNotNull(), F.col("n")).otherwise(0)).alias("n_dot"), F.sum(F.when(F.col("b").isNull(), F.col("n")).otherwise(0)).alias("n_plain"))
    total = per.agg(F.coalesce(F.sum("n_dot"), F.lit(0)), F.coalesce(F.sum(F.col("n_dot") + F.col("n_plain")), F.lit(0))).first()
    n_dots, n = F.lit(float(total[0])), F.lit(float(max(total[1], 1)))
    own = F.col("n_dot") + F.col("n_plain")
    size = F.char_length("word")
    fit = 2 * (_log_likelihood(F.col("n_dot"), own, F.lit(0.99)) - _log_likelihood(F.col("n_dot"), own, n_dots / n))
    score = fit * F.exp(-size.cast("double")) * F.pow(size.cast("double"), -F.col("n_plain"))
    digits = F.col("word").rlike(r"(?U)^\d+$")
    words = materialise(per.where("n_dot > 0").select("word", "n_dot", "n_plain", score.alias("score"), ((score >= abbreviation) & ~digits).alias("abbreviation")))

    pairs = counts.where("kind = 'pair'").select("a", "b", "n")
    short = words.where("abbreviation").select(F.col("word").alias("a"))
    # words after full stops that no abbreviation, initial or number owns: what sentences begin with
    after = pairs.join(short, "a", "left_anti").where(~F.col("a").rlike(r"(?U)^(\d+|\w)$")).groupBy(F.col("b").alias("word")).agg(F.sum("n").alias("n_start"))
    ends = F.lit(float(max(after.agg(F.coalesce(F.sum("n_start"), F.lit(0))).first()[0], 1)))
    begun = after.join(per, "word").withColumn("score", association(ends, own, F.col("n_start"), n))
    starters = begun.where((F.col("score") >= starter) & (F.col("n_start") / own > ends / n)).select("word", "score")
    two = pairs.join(words.select(F.col("word").alias("a"), (F.col("n_dot") + F.col("n_plain")).alias("n_a")), "a").join(per.select(F.col("word").alias("b"), own.alias("n_b")), "b")
    two = two.withColumn("score", association(F.col("n_a"), F.col("n_b"), F.col("n"), n))
    special = two.join(short, "a", "left_semi").unionByName(two.where(F.col("a").rlike(r"(?U)^(\d+|\w)$") & F.col("a").isNotNull()).join(short, "a", "left_anti"))
    collocations = special.where((F.col("score") >= collocation) & (F.col("n") > 1) & (F.col("n") / F.col("n_a") > F.col("n_b") / n)).select("a", "b", "score")
    return Learned(words, starters, collocations)


@dataclass(frozen=True)
class Boundaries:
    """A splitter with learned tables.

    Marks that another token follows at once end nothing, but for closing brackets and quotes, which
    they take with them. Question and exclamation marks end a sentence. A full stop does unless
    the next word begins in lower case, its pair is a collocation, or its word is an abbreviation, an initial or
    a number; after abbreviations and initials a capital word that begins sentences shows an end all
    the same, and after a number any capital word does.
    """

    abbreviations: frozenset[str] = field(default_factory=frozenset)
    starters: frozenset[str] = field(default_factory=frozenset)
    collocations: frozenset[tuple[str, str]] = field(default_factory=frozenset)

    def __repr__(self) -> str:
        text = str([sorted(self.abbreviations), sorted(self.starters), sorted(self.collocations)])
        return f"Boundaries({hashlib.sha256(text.encode()).hexdigest()})"

    def ends(self, toks: list[tuple[str, int, int]]) -> set[int]:
        out = set()
        for k, (word, s, e) in enumerate(toks):
            if word not in _MARKS:
                continue
            last = k
            while last + 1 < len(toks) and toks[last + 1][0] in _CLOSING and toks[last + 1][1] == toks[last][2]:
                last += 1
            after = toks[last + 1] if last + 1 < len(toks) else None
            if after is not None and after[1] == toks[last][2]:
                continue
            before = toks[k - 1][0] if k and toks[k - 1][2] == s else None
            if word != "." or self._stops(before, after and after[0]):
                out.add(last)
        return out

    def marked(self, t: Cut) -> np.ndarray:
        """ends() of many texts at once: only marks are looked at."""
        import numpy as np
        import pyarrow as pa

        touches, out = t.touches(), np.zeros(len(t.s), bool)
        k = np.flatnonzero(t.marks("".join(_MARKS)))
        if not len(k):
            return out
        goes_on = touches & np.concatenate([t.marks("".join(_CLOSING))[1:], [False]])
        stops = np.flatnonzero(~goes_on)
        last = stops[np.searchsorted(stops, k)]
        k, last = k[~touches[last]], last[~touches[last]]
        full = t.marks(".")[k]
        out[last[~full]] = True
        k, last = k[full], last[full]
        word = lambda at, there: t.words.take(pa.array(np.where(there, at, 0), mask=~there)).to_pylist()
        before, after = word(k - 1, (k > 0) & touches[k - 1]), word(last + 1, ~t.ended()[last])
        out[last[np.fromiter(map(self._stops, before, after), bool, len(k))]] = True
        return out

    def _stops(self, before: str | None, after: str | None) -> bool:
        if after is None:
            return True
        if after[0].islower():
            return False
        if before is None or not before[0].isalnum():
            return True
        low, next_ = before.lower(), after.lower()
        if (low, next_) in self.collocations:
            return False
        if low in self.abbreviations or (len(before) == 1 and before.isupper()):
            return after[0].isupper() and next_ in self.starters
        if before.isdigit():
            return not after[0].isdigit()
        return True
