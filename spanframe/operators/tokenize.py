"""Tokens with offsets, sentences, and chunks of bounded length."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator
from typing import TYPE_CHECKING, Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import GAP, LONG_WORD, TILE, record_id
from ..schemas import VERSION
from .cut import Cut, lists, parts
from .pieces import Vocabulary

if TYPE_CHECKING:
    import numpy as np
    import pyarrow as pa

Pieces = Callable[[Column], Column]
MARKS = ".?!"
#: Rows of words at most that a task hands on at once.
FLUSH_WORDS = 50_000


def piece_count(word: Column) -> Column:
    """The default stand-in for a sub-word tokenizer: one piece for each begun four characters."""
    return F.greatest(F.lit(1), F.ceil(F.char_length(word) / 4).cast("int"))


def tokens(docs: DataFrame, id_col: str = "pmid", text_col: str = "fulltext", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, ord, word, s, e) of each token, by builtins alone.

    The pattern tiles the text by tokens with the gap before each, so a token ends where the summed length of the
    pieces does; gaps are no rows. ord counts tokens and the characters of gaps.
    """
    order = Window.partitionBy(id_col).orderBy("_pos")
    tiled = docs.select(id_col, *keep, F.posexplode(F.regexp_extract_all(F.col(text_col), F.lit(TILE), F.lit(0))).alias("_pos", "_piece"))
    cut = tiled.select(id_col, *keep, "_pos", F.regexp_replace("_piece", f"^{GAP}", "").alias("word"), F.char_length("_piece").alias("_n"))
    size = F.char_length("word")
    placed = cut.withColumns({"e": F.sum("_n").over(order).cast("int"), "ord": (F.sum(F.col("_n") - size + 1).over(order) - 1).cast("int")})
    return placed.select(id_col, *keep, "ord", "word", (F.col("e") - size).alias("s"), "e")


def _array_batches(batches: Iterable, id_col: str) -> Iterator:
    """Arrow batches (id, words, spans) of Arrow batches (id, text), in parts of bounded texts."""
    import pyarrow as pa

    for b in batches:
        for part, t in parts(b):
            yield pa.RecordBatch.from_arrays([part.column(0), *lists(t.bounds, t.words, t.s, t.e)], names=[id_col, "words", "spans"])


def token_arrays(docs: DataFrame, id_col: str = "pmid", text_col: str = "fulltext") -> DataFrame:
    """(id, words, spans): the same tokens as one row for each document, without any shuffle, through Arrow."""
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(lambda batches: _array_batches(batches, id_col), f"{id_col} {kind}, words array<string>, spans array<struct<s:int,e:int>>")


def _row_batches(batches: Iterable, id_col: str) -> Iterator:
    """Arrow batches (id, ord, word, s, e, sent_idx) of Arrow batches (id, text), each of FLUSH_WORDS words at most."""
    import numpy as np
    import pyarrow as pa

    for b in batches:
        for part, t in parts(b):
            ended = np.concatenate([[0], np.cumsum(t.marks(MARKS))])[:-1]
            ints = [pa.array(x.astype(np.int32)) for x in (t.within(np.arange(len(t.s))), t.s, t.e, t.within(ended))]
            made = pa.RecordBatch.from_arrays([part.column(0).take(pa.array(t.text)), ints[0], t.words, *ints[1:]], names=[id_col, "ord", "word", "s", "e", "sent_idx"])
            for at in range(0, made.num_rows, FLUSH_WORDS):
                yield made.slice(at, FLUSH_WORDS)


def token_rows(docs: DataFrame, id_col: str = "pmid", text_col: str = "fulltext") -> DataFrame:
    """(id, ord, word, s, e, sent_idx): the tokens of each document with their sentence, without any shuffle, through Arrow.

    The same as sentences(tokens(...)), but that ord counts tokens and not pieces.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(lambda batches: _row_batches(batches, id_col), f"{id_col} {kind}, ord int, word string, s int, e int, sent_idx int")


def greedy_breaks(sizes: Column, limit: Column | int) -> Column:
    """Positions (from 0) at which a new chunk begins, for an array of piece counts.

    A chunk closes when the next word, with two places for the ends, would exceed the limit. Only
    the breaks are carried along, so the fold is linear in the words.
    """
    most = F.lit(limit) if isinstance(limit, int) else limit
    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("sum"), F.array().cast("array<int>").alias("breaks"))

    def step(a: Column, n: Column) -> Column:
        cut = (a.sum > 0) & (a.sum + n + 2 > most)
        return F.struct((a.i + 1).alias("i"), F.when(cut, n).otherwise(a.sum + n).alias("sum"), F.when(cut, F.concat(a.breaks, F.array(a.i))).otherwise(a.breaks).alias("breaks"))

    return F.aggregate(sizes, start, step, lambda a: a.breaks)


class Splitter(Protocol):
    """Ends of sentences among a text's tokens (word, s, e). One that also has `marked` tells them for the tokens of many texts at once."""

    def ends(self, toks: list[tuple[str, int, int]]) -> set[int]: ...


class EveryMark:
    """The rule that needs no model: every full stop, question or exclamation mark ends a sentence."""

    def ends(self, toks: list[tuple[str, int, int]]) -> set[int]:
        return {k for k, t in enumerate(toks) if t[0] in MARKS}

    def marked(self, t: Cut) -> np.ndarray:
        return t.marks(MARKS)


def _marked(splitter: Splitter, t: Cut) -> np.ndarray:
    """Whether a sentence ends with each token, by what a splitter says of one text after the other."""
    import numpy as np

    out, words = np.zeros(len(t.s), bool), t.words.to_pylist()
    toks = list(zip(words, t.s.tolist(), t.e.tolist()))
    for a, b in itertools.pairwise(t.bounds.tolist()):
        out[[a + k for k in splitter.ends(toks[a:b])]] = True
    return out


def _of_each(words: pa.Array, told: Callable[[str], tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers for each word, asked once for each different one."""
    import numpy as np

    coded = words.dictionary_encode()
    known = np.array([told(w) for w in coded.dictionary.to_pylist()], int).reshape(-1, 2)
    return tuple(known[coded.indices.to_numpy()].T)


def chunk_starts(sizes: np.ndarray, ends: np.ndarray, limit: int) -> np.ndarray:
    """The first words of the greedy chunks of words with these sizes (1 at least).

    A chunk closes with its sentence, or when the next word, with two places for the ends, would
    exceed the limit; a word that exceeds it alone is a chunk. The last word must be an end.
    """
    import numpy as np

    if not len(sizes):
        return np.array([], int)
    upto, at, stops = np.concatenate([[0], np.cumsum(sizes)]), np.arange(len(sizes)), np.flatnonzero(ends) + 1
    after = np.maximum(np.searchsorted(upto, upto[:-1] + limit - 2, side="right") - 1, at + 1)
    after = np.minimum(after, stops[np.searchsorted(stops, at, side="right")]).tolist()
    out, k = [], 0
    while k < len(after):
        out.append(k)
        k = after[k]
    return np.array(out)


def token_records(
    docs: DataFrame, max_length: int = 500, *, id_col: str = "pmid", text_col: str = "fulltext", word_limit: int | None = None, vocabulary: Vocabulary | None = None, splitter: Splitter | None = None,
    unknown: str | None = None, most_unknown: float | None = None, keep: tuple[str, ...] = (), surface: bool = False,
) -> DataFrame:
    """Token records (schema_version, id, document_id, pmid, sent_idx, chunk_idx, sentence, spans, ord) of documents, in one pass.

    A document's words, sentences, piece counts and chunks are made together from its text, so
    nothing is shuffled, tokens are never rows, and ord, the place in the document, comes with them.
    Pieces are the vocabulary's, or else those of piece_count(); sentences the splitter's, or else end at
    every mark. Words over `word_limit` characters keep their span under a placeholder, of which the
    vocabulary counts the pieces.

    With `most_unknown`, documents are left out whose share of unknown pieces is larger: those that
    the vocabulary lacks, or words that match the pattern `unknown`. Such a document is one record
    with a null id, so that a caller can count it. Documents without words give no record. Null
    texts are empty. Columns in `keep` go with each record. With `surface`, so does `sentence_str`, the text
    from its first word to its last, so that nobody has to join records with texts for it.
    """
    longest = word_limit or max_length
    split = splitter or EveryMark()
    named = ["sentence_str"] if surface else []

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        import regex

        odd = regex.compile(unknown).search if unknown else None
        for b in batches:
            for part, t in parts(b):
                told = pc.if_else(pa.array(t.e - t.s > longest), LONG_WORD, t.words)
                sizes, n_pieces, n_odd = np.maximum(1, -(-(t.e - t.s) // 4)), np.ones(len(t.s), int), np.zeros(len(t.s), int)
                if vocabulary is not None:
                    sizes, n_odd = _of_each(told, lambda w: (max(1, len(x := vocabulary.pieces(w))), x.count(None)))
                    n_pieces = sizes
                elif odd:
                    n_odd = _of_each(t.words, lambda w: (0, odd(w) is not None))[1]
                ends = split.marked(t) if hasattr(split, "marked") else _marked(split, t)
                keeps, lost = np.ones(len(t.s), bool), np.array([], int)
                if most_unknown is not None:
                    n, bad = (np.diff(np.concatenate([[0], np.cumsum(x)])[t.bounds]) for x in (n_pieces, n_odd))
                    lost = np.flatnonzero((n > 0) & (bad / np.maximum(n, 1) > most_unknown))
                    keeps = ~np.isin(t.text, lost)
                text, ends, sizes = t.text[keeps], ends[keeps], sizes[keeps]
                first = chunk_starts(sizes, ends | np.concatenate([text[1:] != text[:-1], np.ones(min(1, len(text)), bool)]), max_length)
                row, sent = text[first], np.concatenate([[0], np.cumsum(ends)])[first]
                at = np.arange(len(first))
                new_text = np.concatenate([np.ones(min(1, len(row)), bool), row[1:] != row[:-1]])
                new_sent = new_text | np.concatenate([np.zeros(min(1, len(row)), bool), sent[1:] != sent[:-1]])
                since = lambda new: np.maximum.accumulate(np.where(new, at, 0))
                ints = [(sent - sent[since(new_text)]), at - since(new_sent), at - since(new_text)]
                none = pa.nulls(len(lost), pa.int32())
                ints = [pa.concat_arrays([pa.array(x.astype(np.int32)), none]) for x in ints]
                if len(lost):
                    told = told.filter(pa.array(keeps))
                rows = pa.array(np.concatenate([row, lost]))
                upto = np.concatenate([first, np.full(len(lost) + 1, len(text))])
                own = [part.column(c).take(rows) for c in (0, *range(2, 2 + len(keep)))]
                cuts = []
                if surface:
                    last = np.concatenate([first[1:], [len(text)]])[: len(first)] - 1
                    texts = [t.raw[x:y].decode() for x, y in zip(t.begins[keeps][first].tolist(), t.ends[keeps][last].tolist())]
                    cuts = [pa.array(texts + [None] * len(lost), pa.string())]
                yield pa.RecordBatch.from_arrays([own[0], *ints, *lists(upto, told, t.s[keeps], t.e[keeps]), *own[1:], *cuts], names=["pmid", "sent_idx", "chunk_idx", "ord", "sentence", "spans", *keep, *named])

    kind = docs.schema[id_col].dataType.simpleString()
    kept = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep) + "".join(f", {c} string" for c in named)
    made = docs.select(F.col(id_col).alias("pmid"), text_col, *keep).mapInArrow(run, f"pmid {kind}, sent_idx int, chunk_idx int, ord int, sentence array<string>, spans array<struct<s:int,e:int>>{kept}")
    name = F.when(F.col("ord").isNotNull(), record_id(F.col("pmid"), F.col("sent_idx"), F.col("chunk_idx")))
    return made.select(F.lit(VERSION).alias("schema_version"), name.alias("id"), F.col("pmid").alias("document_id"), "pmid", "sent_idx", "chunk_idx", "sentence", "spans", "ord", *keep, *named)


def supported_language(toks: DataFrame, unknown: Column, threshold: float = 0.05, id_col: str = "pmid") -> DataFrame:
    """(id, unk_rate, supported): documents whose share of unknown pieces is at most the threshold."""
    return toks.groupBy(id_col).agg(F.avg(unknown.cast("double")).alias("unk_rate")).withColumn("supported", F.col("unk_rate") <= threshold)


def piece_alignment(toks: DataFrame, pieces: Pieces = piece_count, id_col: str = "id") -> DataFrame:
    """(id, ord, first_piece, last_piece) of each word, after one place for the start sign; null for words without pieces."""
    upto = F.sum("_n").over(Window.partitionBy(id_col).orderBy("ord"))
    told = toks.withColumn("_n", pieces(F.col("word"))).withColumn("_upto", upto)
    some = F.col("_n") > 0
    return told.select(id_col, "ord", F.when(some, F.col("_upto") - F.col("_n") + 1).cast("int").alias("first_piece"), F.when(some, F.col("_upto")).cast("int").alias("last_piece"))
