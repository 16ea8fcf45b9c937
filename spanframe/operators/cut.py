"""The tokens of a batch of texts as arrays: a class for each code point, and runs of classes; no step for each token in Python."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from typing import TYPE_CHECKING

from ..functions.text import TOKEN

if TYPE_CHECKING:
    import numpy as np
    import pyarrow as pa

#: Bytes of text that a task cuts at once; a longer document is cut by itself.
FLUSH_BYTES = 100_000


@lru_cache(1)
def _classes() -> np.ndarray:
    """For each code point: 1 if it makes a token with others beside it, 2 if it is a token by itself, else 0."""
    import numpy as np
    import regex

    out, find = np.zeros(0x110000, np.uint8), regex.compile(TOKEN).finditer
    for block in range(0, len(out), 0x800):  # surrogates, a block by themselves, are no characters
        if block != 0xD800:
            for m in find("\n".join(chr(c) * 2 for c in range(block, block + 0x800))):
                out[block + m.start() // 3] = 1 if m.end() - m.start() == 2 else 2
    return out


@dataclass
class Cut:
    """The tokens of texts: `bounds` are the first token of each text and their number; s and e count code points of the text.

    `begins` and `ends` are the same places as bytes of `raw`, `first` the code point that each token begins with.
    """

    raw: bytes
    bounds: np.ndarray
    words: pa.Array
    s: np.ndarray
    e: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @cached_property
    def text(self) -> np.ndarray:
        """The text of each token."""
        import numpy as np

        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def marks(self, signs: str) -> np.ndarray:
        """Whether each token is one of some signs that are tokens by themselves."""
        import numpy as np

        return np.isin(self.first, [ord(c) for c in signs])

    def alnum(self) -> np.ndarray:
        """Whether each token begins with a letter or digit."""
        import numpy as np

        some, at = np.unique(self.first, return_inverse=True)
        return np.array([chr(c).isalnum() for c in some.tolist()], bool)[at]

    def touches(self) -> np.ndarray:
        """Whether the next token of the same text follows each at once."""
        import numpy as np

        return np.concatenate([(self.s[1:] == self.e[:-1]) & (self.text[1:] == self.text[:-1]), np.zeros(min(1, len(self.s)), bool)])

    def ended(self) -> np.ndarray:
        """Whether each token is the last of its text."""
        import numpy as np

        return np.concatenate([self.text[1:] != self.text[:-1], np.ones(min(1, len(self.s)), bool)])

    def within(self, upto: np.ndarray) -> np.ndarray:
        """Of sums over all tokens before each, those over the tokens before it in its text."""
        return upto - upto[self.bounds[self.text]]


def cut(texts: pa.Array) -> Cut:
    """The tokens of an array of strings; nulls are empty."""
    import numpy as np
    import pyarrow as pa

    whole = texts.fill_null("").cast(pa.large_string())
    at = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    raw = whole.buffers()[2].slice(at[0], at[-1] - at[0]).to_pybytes() if at[-1] > at[0] else b""
    points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    byte = np.concatenate([[0], np.cumsum(width)])
    text = np.searchsorted(byte, at - at[0])  # the first code point of each text
    kind = _classes()[points]
    run, single = kind == 1, kind == 2
    joined = run[1:] & run[:-1]  # with the code point before, in the same text
    inner = text[(text > 0) & (text < len(points))]
    joined[inner - 1] = False
    first = np.flatnonzero(single | (run & ~np.concatenate([[False], joined])[: len(run)]))
    end = np.flatnonzero(single | (run & ~np.concatenate([joined, [False]])[: len(run)])) + 1
    bounds = np.searchsorted(first, text)
    begins, ends = byte[first], byte[end]
    offsets = np.concatenate([[0], np.cumsum(ends - begins)]).astype(np.int32)
    inside = np.frombuffer(raw, np.uint8)[np.repeat(kind > 0, width)]
    words = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets.tobytes()), pa.py_buffer(inside.tobytes()))
    start = np.repeat(text[:-1], np.diff(bounds))
    return Cut(raw, bounds, words, (first - start).astype(np.int32), (end - start).astype(np.int32), begins, ends, points[first])


@lru_cache(1)
def _trim() -> Callable[[int], int]:
    """The C library's malloc_trim; nothing where there is none."""
    import ctypes

    return getattr(ctypes.CDLL(None) if os.name == "posix" else None, "malloc_trim", lambda _: 0)


def parts(batch: pa.RecordBatch, column: int = 1) -> Iterator[tuple[pa.RecordBatch, Cut]]:
    """A batch in parts of FLUSH_BYTES of text, and one document's more at most, each with its tokens.

    A batch's bytes may lie in the heap, where what is made meanwhile keeps the place of former batches from
    the system. After a batch, free memory is given back, so that a worker doesn't grow with its batches.
    """
    import numpy as np
    import pyarrow.compute as pc

    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < batch.num_rows:
        done = sizes[first - 1] if first else 0
        end = min(batch.num_rows, int(np.searchsorted(sizes, done + FLUSH_BYTES)) + 1)
        part = batch.slice(first, end - first)
        yield part, cut(part.column(column))
        first = end
    if batch.nbytes > FLUSH_BYTES:
        _trim()(0)


def lists(offsets: np.ndarray, words: pa.Array, s: np.ndarray, e: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Lists of words and of their spans (s, e)."""
    import numpy as np
    import pyarrow as pa

    at = pa.array(offsets.astype(np.int32))
    span = [pa.field("s", pa.int32()), pa.field("e", pa.int32())]
    return pa.ListArray.from_arrays(at, words), pa.ListArray.from_arrays(at, pa.StructArray.from_arrays([pa.array(s), pa.array(e)], fields=span))
