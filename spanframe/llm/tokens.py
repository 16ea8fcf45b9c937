"""Token counts: exact byte-level BPE over whole texts, huge ones in overlapping chunks.

Huge documents are encoded chunk by chunk. Neighbouring chunks overlap; each encoding knows the
byte offset of every token, and the two are spliced at a boundary that both have and that no
context can move. Where the overlap holds no such boundary it is widened, up to the whole text.
"""

from __future__ import annotations

import base64
import functools
import re
from array import array
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table

#: Characters over which the split pattern means the same in every regex library: printable ASCII,
#: tab, line feed, and Latin letters and signs. Texts with others go to the tokenizer's own library.
PLAIN = re.compile(r"[\t\n\x20-\x7e\xa1-ɏ]*\Z")

class Encoder:
    """Ids of the public byte-level BPE, as the tokenizers library gives them without added tokens.

    A text in the characters of PLAIN, without the sign that opens special tokens, is encoded with
    the same vocabulary's rank file, which gives the same ids several times faster. Every other
    text is encoded by the tokenizers library itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        ranks_path = path[: -len(".json")] + ".tiktoken"
        try:
            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            fast = tiktoken.Encoding(ranks_path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            encode = fast.encode_ordinary
        except (ImportError, FileNotFoundError):
            encode = self.library
        self.plain = encode

    def library(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    @functools.cached_property
    def widths(self) -> np.ndarray:
        """Bytes of each token's text."""
        size = self.tokenizer.get_vocab_size()
        widths = np.zeros(size, np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            # the byte-level alphabet writes each byte as one character; special tokens are ASCII
            widths[i] = len(token)
        return widths

    def encode_bytes(self, text: str) -> bytes:
        """The ids of the whole text as little-endian unsigned 32-bit integers."""
        plain = "<|" not in text and PLAIN.match(text)
        return array("I", self.plain(text) if plain else self.library(text)).tobytes()


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker."""
    return Encoder(path)


#: A white-space character after another character always starts a new piece of the split pattern,
#: wherever the encoding began; followed by a further character that is not white space, neither
#: side needs to look across.
STABLE = re.compile(r"(?<=[^\s]) (?=[^\s])")


def encode_huge(text: str, enc: Encoder, chunk: int, overlap: int) -> bytes:
    """encode_bytes() of a huge text, a chunk of so many characters at a time.

    Chunk k + 1 starts inside chunk k, overlap characters before its end. Both are encoded, and the
    ids are spliced at the first stable boundary after the start of chunk k + 1 at which both have a
    token start. If there is none, the overlap doubles; at a whole chunk, the chunk doubles too, so
    that a text without any boundary is encoded in one piece.
    """
    out, start, skip = [], 0, 0  # skip: bytes at the chunk's start that the chunk before has covered
    while True:
        end = min(len(text), start + chunk)
        ids = np.frombuffer(enc.encode_bytes(text[start:end]), "<u4")
        offsets = np.concatenate(([0], np.cumsum(enc.widths[ids])))
        first = int(np.searchsorted(offsets, skip))
        if end == len(text):
            out.append(ids[first:].tobytes())
            return b"".join(out)
        width, spliced = overlap, False
        while not spliced:
            begin = max(start + 1, end - width)
            after = np.frombuffer(enc.encode_bytes(text[begin:end]), "<u4")
            starts = np.concatenate(([0], np.cumsum(enc.widths[after])))
            shift = len(text[start:begin].encode())
            for m in STABLE.finditer(text, begin + 1, end - 1):
                at = len(text[begin : m.start()].encode())
                i, j = int(np.searchsorted(offsets, shift + at)), int(np.searchsorted(starts, at))
                # aligned: both have a token that starts there, and agree on what follows up to the next one
                if offsets[i] == shift + at and starts[j] == at and i + 1 < len(ids) and j + 1 < len(after) and ids[i] == after[j] and shift + at >= skip:
                    out.append(ids[first:i].tobytes())
                    start, skip, spliced = begin, at, True
                    break
            if not spliced:
                if begin == start + 1:
                    chunk *= 2  # no stable boundary in the whole chunk: widen it and encode it anew
                    break
                width *= 2


def token_counts(
    docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024, chunk: int = 65_536, overlap: int = 1_024
) -> DataFrame:
    """n_bytes, n_tokens and over_limit of each row's whole text.

    Null and empty texts have 0 bytes and 0 tokens. Null or repeated ids are passed on, a row for
    each row. Other columns are not read. Texts over `chunk` characters are encoded chunk by chunk.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        enc = encoder(path)
        for b in batches:
            texts = b.column("text").to_pylist()
            n = [len(encode_huge(t, enc, chunk, overlap) if len(t) > chunk else enc.encode_bytes(t)) // 4 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
