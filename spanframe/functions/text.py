"""Strings and spans; offsets count code points, and spans are half-open structs (s, e)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dashes that become ASCII hyphens, and characters that are deleted.
DASHES = "‐‒–—―−─"
DELETED = "­ "

# The classes of characters that make tokens.
_ODD = "\\ue000-\\uf8ff\\u0084\\u0086\\u0088\\u0089\\u0090\\u0095\\u0097\\u202b\\u202d\\u2060\\u2062\\u2063\\u2fff"
TOKEN = rf"[\w']+|[{_ODD}]|[\p{{P}}\p{{S}}]"
#: A token with the characters before it that are in none, so that pieces tile the text up to its last token.
GAP = rf"(?U)[^\w'{_ODD}\p{{P}}\p{{S}}]*"
TILE = rf"{GAP}(?:{TOKEN})"


#: White space of any kind.
WHITE = "\t\n\x0b\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.trim(c, F.lit(WHITE))


def first_nonempty(*columns: Column) -> Column:
    """The first that is neither null nor empty, else the empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def fulltext(title: Column, abstract: Column) -> Column:
    """The parts that are not empty, joined by one space."""
    return F.concat_ws(" ", F.nullif(title, F.lit("")), F.nullif(abstract, F.lit("")))


def map_dashes(c: Column) -> Column:
    return F.translate(c, DASHES + DELETED, "-" * len(DASHES))


def rebase(offset: Column, title_length: Column, abstract_offset: Column) -> Column:
    """An offset of the source document as one of the fulltext: the abstract begins one after the title."""
    return F.when(offset < abstract_offset, offset).otherwise(title_length + 1 + offset - abstract_offset)


def slice_text(text: Column, start: Column, end: Column) -> Column:
    return F.substring(text, start + 1, F.greatest(end - start, F.lit(0)))


def surface(text: Column, spans: Column) -> Column:
    """The text of each span, joined by one space."""
    return F.array_join(F.transform(spans, lambda x: slice_text(text, x.s, x.e)), " ")


def shift(spans: Column, by: Column) -> Column:
    return F.transform(spans, lambda x: F.struct((x.s + by).alias("s"), (x.e + by).alias("e")))


def span_key(spans: Column) -> Column:
    """Spans as a set: sorted and distinct, so order and repeats don't matter."""
    return F.array_sort(F.array_distinct(spans))


def ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def record_id(*parts: Column) -> Column:
    return F.concat_ws("_", *[p.cast("string") for p in parts])


#: What stands for a word that is too long.
LONG_WORD = "LONG_WORD"


def distance_bucket(d: Column) -> Column:
    """0, then 1 + the binary logarithm rounded down, at most 9."""
    return F.when(d <= 0, F.lit(0)).otherwise(F.least(F.lit(9), 1 + F.floor(F.log2(d.cast("double")) + F.lit(1e-12)).cast("int"))).cast("int")


def plain_path(uri: Column) -> Column:
    """The path that a file's URI tells, without its escapes."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
