"""Best-fit packing of token pieces into sequences, with several capacities at once."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_if_small, cut, small_batches, table
from .tokens import encode_huge, encoder

#: Documents for each shard that is packed on its own. Sequences filled to less than LOOSE of their
#: tokens, of which each shard leaves a few, are merged with those of other shards afterwards.
SHARD_DOCS, LOOSE = 8_192, 0.9
#: Tasks of the packing stage at most; sequences that a merge moves are broadcast up to this number.
MAX_TASKS, MAX_MOVES = 20_000, 100_000


def best_fit(
    lengths: np.ndarray, capacity: Sequence[float], weights: Sequence[float], score: str = "norm", docs: np.ndarray | None = None, attention: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece, from 0, and the order in which they were placed.

    What is packed is a piece, or a run of pieces if `docs` and `attention` tell how many documents
    and how much attention cost it has. Each piece demands (tokens, 1 document, tokens squared as attention cost) of a bin's capacities.
    Pieces go in decreasing size. Of the open bins whose residuals hold all three demands, "norm"
    takes the one with the least weighted norm of what would be left, "dot" the one with the largest
    weighted dot product of residual and demand; ties go to the oldest bin. If none holds it, a new
    bin is opened, even for a piece that is too large by itself for a soft capacity.
    """
    caps, w = np.asarray(capacity, float), np.asarray(weights, float)
    docs = np.ones(len(lengths)) if docs is None else docs
    attention = lengths.astype(float) ** 2 if attention is None else attention
    need = np.stack([lengths / caps[0], docs / caps[1], attention / caps[2]], 1)
    order = np.argsort(-lengths, kind="stable")
    least = need.min(0) if len(need) else need
    bins, offsets = np.empty(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    left, name, n_open, n_bins = np.empty((1024, 3)), np.empty(1024, np.int64), 0, 0
    filled = np.zeros(len(lengths), np.int64)
    for at, k in enumerate(order):
        d = need[k]
        if at % 512 == 511:  # drop the bins that can't hold even the smallest piece
            alive = (left[:n_open] >= least - 1e-9).all(1)
            n = int(alive.sum())
            left[:n], name[:n], n_open = left[:n_open][alive], name[:n_open][alive], n
        r = left[:n_open]
        rest = r - d
        fits = (rest >= -1e-9).all(1)
        if fits.any():
            value = (rest * rest) @ w if score == "norm" else -(r @ (w * d))
            j = int(np.argmin(np.where(fits, value, np.inf)))
            left[j] -= d
            b = name[j]
        else:
            if n_open == len(left):
                left, name = np.concatenate([left, np.empty_like(left)]), np.concatenate([name, np.empty_like(name)])
            left[n_open], name[n_open], b = 1 - d, n_bins, n_bins
            n_open, n_bins = n_open + 1, n_bins + 1
        bins[k], offsets[k] = b, filled[b]
        filled[b] += lengths[k]
    return bins, offsets, order


def _tokenised(docs: DataFrame, path: str, size: int, end: int, chunk: int, ids: bool) -> DataFrame:
    """_row, doc_id, n ids and the checksum (and ids) of each piece, a row for each document."""
    tail = np.array([end], "<u4").tobytes()

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa

        enc = encoder(path)
        for b in batches:
            n, crcs, parts = [], [], []
            for t in b.column("text").to_pylist():
                all_ids = (encode_huge(t, enc, chunk, 1_024) if len(t) > chunk else enc.encode_bytes(t)) + tail
                n.append(len(all_ids) // 4)
                first = (n[-1] % size or size) * 4
                cuts = [all_ids[:first]] + [all_ids[k : k + 4 * size] for k in range(first, len(all_ids), 4 * size)]
                crcs.append([zlib.crc32(x) for x in cuts])
                parts.append(cuts if ids else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("_row"), b.column("doc_id"), pa.array(n, pa.int64()), pa.array(crcs, pa.list_(pa.int64())), pa.array(parts, pa.list_(pa.binary()))],
                names=["_row", "doc_id", "n", "crcs", "ids"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(encode, f"_row long, doc_id {kind}, n long, crcs array<long>, ids array<binary>")


def pack(
    docs: DataFrame, path: str, *, size: int = 2048, end: int = 0, max_docs: int | None = None, max_attention: float | None = None,
    weights: Sequence[float] = (1.0, 1e-4, 1e-2), score: str = "norm", id_col: str = "doc_id", text_col: str = "text",
    shard_docs: int = SHARD_DOCS, chunk: int = 65_536, ids: bool = False,
) -> DataFrame:
    """Place every document's ids, with the id `end` after them, in sequences of at most `size` tokens.

    Only documents of more than `size` ids are cut: into pieces of `size`, of which the first may be
    shorter. Returns doc_id, piece, start, length, ids_crc32, sequence_id and offset for each piece;
    with `ids`, the piece's ids too, as little-endian unsigned 32-bit integers. A sequence holds at
    most max_docs pieces and max_attention of summed squared lengths; by default neither binds
    before the tokens do. Null and empty texts are one piece of the end id. Null or repeated ids are
    no matter: each row is a document, ids may be of any type that a string can hold, rows whose ids tie
    are told apart by their place in the input, and an empty table gives no rows. Other columns are not read.

    Documents are dealt over shards of about shard_docs by a hash of their place in the input, and
    each shard is packed on its own, so no task grows with the input; only lengths, checksums and
    (with `ids`) ids are shuffled. The loose sequences of all shards are then packed once more, as
    wholes, in shards of shard_docs sequences.
    """
    small_batches(docs.sparkSession)
    shards = max(1, -(-docs.count() // shard_docs))
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    told = _tokenised(rows, path, size, end, chunk, ids).withColumn("_shard", F.pmod(F.xxhash64("_row"), F.lit(shards)))
    capacity = (size, max_docs or size, max_attention or float(size) ** 2)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def place(pdf):
        import pandas as pd

        pdf = pdf.sort_values("_row")
        shard, n = int(pdf["_shard"].iloc[0]), pdf["n"].to_numpy()
        count = -(-n // size)
        first = n - (count - 1) * size
        piece = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        head = np.repeat(first, count)
        length = np.where(piece == 0, head, size)
        bins, offset, _ = best_fit(length, capacity, weights, score)
        out = pd.DataFrame(
            {
                "doc_id": pdf["doc_id"].repeat(count).to_numpy(), "piece": piece, "start": np.where(piece == 0, 0, head + (piece - 1) * size), "length": length,
                "ids_crc32": np.concatenate(pdf["crcs"].to_list()), "sequence_id": (shard << 32) + bins, "offset": offset,
            }
        )
        for name, x in (("_fill", length), ("_docs", np.ones(len(length))), ("_cost", length.astype(float) ** 2)):
            out[name] = np.bincount(bins, x)[bins].astype(np.int64)
        if ids:
            out["ids"] = [x for row in pdf["ids"] for x in row]
        return out

    # ids pass through pandas as strings: it would make floats of whole numbers beside a null
    schema = "doc_id string, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long" + (", ids binary" if ids else "")
    dealt = told.repartition(min(shards, MAX_TASKS), "_shard")  # a given number, so that small rows aren't put together in a few tasks
    placed = dealt.withColumn("doc_id", F.col("doc_id").cast("string")).groupBy("_shard").applyInPandas(place, f"{schema}, _fill long, _docs long, _cost long")
    placed = cut(placed.withColumn("doc_id", F.col("doc_id").cast(kind)))
    loose = placed.where((F.col("offset") == 0) & (F.col("_fill") < int(LOOSE * size))).select("sequence_id", "_fill", "_docs", "_cost")
    again = -(-loose.count() // shard_docs)
    if not again or shards == 1:
        return placed.drop("_fill", "_docs", "_cost")

    def merge(pdf):
        import pandas as pd

        pdf = pdf.sort_values(["_fill", "sequence_id"])
        old = pdf["sequence_id"].to_numpy()
        bins, at, _ = best_fit(pdf["_fill"].to_numpy(), capacity, weights, score, pdf["_docs"].to_numpy(), pdf["_cost"].to_numpy(float))
        first = np.full(bins.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(first, bins, old)
        moved = first[bins] != old
        moved |= at > 0
        heads = np.isin(bins, bins[moved])
        return pd.DataFrame({"_old": old[heads], "_new": first[bins[heads]], "_at": at[heads]})

    moves = cut(
        loose.withColumn("_shard", F.pmod(F.xxhash64("sequence_id"), F.lit(again))).repartition(min(again, MAX_TASKS), "_shard").groupBy("_shard").applyInPandas(merge, "_old long, _new long, _at long")
    )
    joined = placed.join(broadcast_if_small(moves, MAX_MOVES), F.col("sequence_id") == F.col("_old"), "left")
    names = [x.strip().split(" ")[0] for x in schema.split(",")]
    change = {"sequence_id": F.coalesce("_new", "sequence_id").alias("sequence_id"), "offset": (F.col("offset") + F.coalesce("_at", F.lit(0))).alias("offset")}
    return joined.select(*[change.get(c, F.col(c)) for c in names])


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
