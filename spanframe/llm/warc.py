"""Web archives: written with revisit records, read back by verified boundary chains.

Reading splits an archive at every place where the format's magic stands, wherever tasks start to
read. Each place is only a candidate: magic may also stand inside a payload. Every candidate claims
a successor, the offset after its header and its declared content. Pointer jumping from the start
of each file keeps those that the chain of successors reaches; all others are payload.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, shared_dir, table

VERSION = "WARC/1.1\r\n"
#: What stands at the start of each record, of either version of the format in use.
MAGIC = "WARC/1."
END = "\r\n\r\n"
#: Payloads from this size on are stored once.
REVISIT_BYTES = 1_000
#: Records of an archive file: what one task writes and what one chain holds.
FILE_RECORDS = 4_096
#: Bytes of payload pieces that may be broadcast.
BROADCAST_BYTES = 4 << 20
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def write_archives(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", compression: str = "gzip") -> None:
    """A WARC record for each row, payload the html in UTF-8 (null: empty).

    Of rows with equal payloads of at least REVISIT_BYTES, that with the largest id is a response
    and the others are revisits of it; rows that repeat the largest id are responses too, and so are
    rows without any id beside them. Equality is that of SHA-1 and length. Spark's text writer does
    the writing, records apart by its line separator, so any store that Spark reaches will do; a
    compressed archive is compressed as a whole, not record by record. An empty table gives archives
    without a record. Ids are whole numbers, or of a type that casts to them: one that doesn't fails the job.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"), html.alias("html")).withColumns(
        {"bytes": F.octet_length("html").cast("long"), "sha": F.sha1(F.col("html").cast("binary"))}
    )
    first = rows.where(F.col("bytes") >= REVISIT_BYTES).groupBy(F.col("sha").alias("sha2"), F.col("bytes").alias("bytes2")).agg(F.max("id").alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    told = rows.join(first, (F.col("sha") == F.col("sha2")) & (F.col("bytes") == F.col("bytes2")), "left")
    revisit = F.col("best").isNotNull() & ~F.col("id").eqNullSafe(F.col("best"))
    block = F.concat(F.lit(HTTP), F.lit("Content-Length: "), F.col("bytes"), F.lit("\r\n\r\n"), F.when(revisit, F.lit("")).otherwise(F.col("html")))
    clean = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    header = F.concat(
        F.lit(VERSION + "WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">\r\nWARC-Target-URI: "), clean,
        F.lit("\r\nWARC-Date: 2000-01-01T00:00:00Z\r\nContent-Type: application/http;msgtype=response\r\nWARC-Payload-Digest: sha1:"), F.col("sha"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:page:"), F.col("best"), F.lit(">"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Length: "), F.octet_length("block"), F.lit("\r\n\r\n"),
    )
    told = told.withColumn("block", block).select(F.concat(header, F.col("block")).alias("value"))
    told.write.option("lineSep", END).option("compression", compression).option("maxRecordsPerFile", FILE_RECORDS).text(path)


def chain_of(claims: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which of the candidates at these increasing offsets the chain from offset 0 reaches.

    claims[k] is the offset after record k. Jump pointers are squared until they stand still, while
    the reached set follows them; a claim that meets no candidate, or the end, goes nowhere.
    """
    n = len(offsets)
    at = np.searchsorted(offsets, claims)
    hit = (at < n) & (claims > offsets)
    hit[hit] = offsets[at[hit]] == claims[hit]
    jump = np.append(np.where(hit, at, n), n)  # n: nowhere, or the end
    reached = np.zeros(n + 1, bool)
    if n and offsets[0] == 0:
        reached[0] = True
    while True:
        more = reached.copy()
        more[jump[reached]] = True
        if (jump[jump] == jump).all() and (more == reached).all():
            return reached[:n]
        reached, jump = more, jump[jump]


def read_pieces(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The pieces of the archives in a folder, each with the record that owns it, and the raw pieces.

    The text reader splits the files at the magic, so large plain files are read by many tasks and
    payloads never pass through Python. Pieces are known by their file, block and place in it; only
    their sizes and claims go to the chains. Records in one piece are done then; the pieces of those
    with magic in their payload are read again and joined, and their sizes and digests must agree.
    A file whose chain breaks before its end fails the job rather than lose records. Records of
    versions 1.0 and 1.1 are read. Candidates of one file are followed in one task, so archives of
    other writers should have at most some millions of records each.
    """
    raw = (
        spark.read.option("lineSep", MAGIC).text(path)
        .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"), F.col("value").cast("binary").alias("value"))
    )
    split = F.locate("\r\n\r\n", F.col("value").cast("string"))
    header = F.when(split > 0, F.substring(F.col("value").cast("string"), F.lit(1), split + 1)).otherwise(F.lit(""))
    pieces = raw.withColumn("header", header).withColumns({"bytes": F.octet_length("value").cast("long"), "head": F.octet_length("header").cast("long")})
    claim = F.regexp_extract("header", r"(?i)(?:^|\r\n)Content-Length:[ \t]*([0-9]{1,18})[ \t]*\r\n", 1)
    # the payload is what follows the HTTP header in the content: one more blank line on
    body = F.expr("substring(value, head + 3)")
    inner = F.locate("\r\n\r\n", body.cast("string"))
    http = F.octet_length(F.substring(body.cast("string"), F.lit(1), inner + 3))
    told = pieces.withColumn("claim", F.nullif(claim, F.lit("")).cast("long")).withColumn("http", http.cast("long"))
    told = told.withColumn("sha", F.sha1(F.expr("substring(value, head + 3 + http, claim - http)")))
    narrow = told.select("file", "block", "place", "bytes", "head", "claim", "http", "sha", F.when(F.col("claim").isNotNull(), F.col("header")).alias("header"))

    def follow(pdf):
        import pandas as pd

        pdf = pdf.sort_values(["block", "place"]).reset_index(drop=True)
        mark = len(MAGIC)
        size = pdf["bytes"].to_numpy() + mark
        # the first piece of a file is what stands before the first magic
        offset = np.cumsum(size) - size - mark
        end = int(offset[-1] + size[-1])
        length = pdf["claim"].fillna(-1).to_numpy().astype(np.int64)
        after = np.where(length >= 0, offset + mark + pdf["head"].to_numpy() + 2 + length + len(END), -1)
        offset, after = offset[1:], after[1:]
        reached = chain_of(after, offset)
        last = np.flatnonzero(reached)
        if (len(last) == 0 and end > 0) or (len(last) and after[last[-1]] != end):
            raise ValueError(f"broken record chain in {pdf['file'].iloc[0]}")
        owner = np.maximum.accumulate(np.where(reached, np.arange(len(offset)), 0)) if len(offset) else np.zeros(0, int)
        count = np.bincount(owner, minlength=len(offset))
        rest = pdf.iloc[1:]
        return pd.DataFrame(
            {
                "file": rest["file"].to_numpy(), "block": rest["block"].to_numpy(), "place": rest["place"].to_numpy(), "bytes": rest["bytes"].to_numpy(),
                "offset": offset[owner], "pieces": count[owner], "header": np.where(reached, rest["header"], None), "payload_bytes": np.where(reached, length[1:] - rest["http"].fillna(0).to_numpy(), -1).astype(np.int64),
                "sha": np.where(reached, rest["sha"], None),
            }
        )

    schema = "file string, block long, place long, bytes long, offset long, pieces long, header string, payload_bytes long, sha string"
    return cut(narrow.groupBy("file").applyInPandas(follow, schema)), raw


def records(spark: SparkSession, path: str) -> DataFrame:
    """file, offset, header, payload_bytes and sha, one row for each verified record."""
    pieces, raw = read_pieces(spark, path)
    whole = pieces.where("pieces = 1").select("file", "offset", "header", "payload_bytes", "sha")
    parts = pieces.where("pieces > 1")
    size = parts.agg(F.sum("bytes").alias("b"), F.count(F.lit(1)).alias("n")).first()
    if not size["n"]:
        return whole
    keys = ["file", "block", "place"]
    few = F.broadcast(parts) if size["b"] <= BROADCAST_BYTES else parts
    texts = raw.join(few, keys).select("file", "offset", "block", "place", "header", "payload_bytes", "value", (F.octet_length("value") == F.col("bytes")).alias("same"))
    joined = texts.groupBy("file", "offset").agg(
        F.first("header", ignorenulls=True).alias("header"), F.max("payload_bytes").alias("payload_bytes"), F.min("same").alias("same"),
        F.expr(f"array_join(transform(array_sort(collect_list(struct(block, place, cast(value as string) as v))), x -> x.v), '{MAGIC}')").alias("all"),
    )
    content = F.expr("substring(cast(all as binary), octet_length(header) + 3)")
    http = F.octet_length(F.substring(content.cast("string"), F.lit(1), F.locate("\r\n\r\n", content.cast("string")) + 3))
    checked = F.when(F.col("same"), F.col("all")).otherwise(F.raise_error(F.lit("an archive changed while it was read")))
    whole2 = joined.withColumn("all", checked).withColumn("http", http).withColumn("body", content)
    return whole.unionByName(whole2.select("file", "offset", "header", "payload_bytes", F.sha1(F.expr("substring(body, 1 + http, payload_bytes)")).alias("sha")))


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of what write_archives() wrote.

    A revisit's payload is that of the record it refers to, which must be there.
    """
    told = cut(
        records(spark, path).select(
            F.nullif(F.regexp_extract("header", r"WARC-Record-ID: <urn:page:(-?[0-9]*)>", 1), F.lit("")).cast("long").alias("page_id"),
            F.regexp_extract("header", r"WARC-Type: (\w+)", 1).alias("record_type"),
            F.nullif(F.regexp_extract("header", r"WARC-Refers-To: <urn:page:(-?[0-9]+)>", 1), F.lit("")).cast("long").alias("refers_to"),
            F.regexp_extract("header", r"WARC-Payload-Digest: sha1:(\w+)", 1).alias("told"),
            "payload_bytes",
            "sha",
        )
    )
    responses = told.where("record_type = 'response'").groupBy(F.col("page_id").alias("to"), F.col("sha").alias("to_sha")).agg(F.max("payload_bytes").alias("to_bytes"))
    full = told.join(responses, (F.col("refers_to") == F.col("to")) & (F.col("told") == F.col("to_sha")), "left")
    revisit = F.col("record_type") == "revisit"
    sha, size = F.when(revisit, F.col("to_sha")).otherwise(F.col("sha")), F.when(revisit, F.col("to_bytes")).otherwise(F.col("payload_bytes"))
    checked = F.when(sha == F.col("told"), sha).otherwise(F.raise_error(F.lit("a record's payload does not agree with its digest")))
    return full.select("page_id", size.alias("payload_bytes"), checked.alias("payload_digest"), "record_type", "refers_to")


def op5_warc_boundary_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/warc"
    write_archives(table(spark, sf_dir, "pages"), path)
    return page_records(spark, path)


ORACLE_OP5 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS best FROM p)
SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> best THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> best THEN best END AS refers_to
FROM q
"""
