import glob
import hashlib

import numpy as np
import pytest

from spanframe.llm.common import shared_dir
from spanframe.llm.warc import chain_of, page_records, records, write_archives

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def expected(data):
    best = {}
    for i, _, h in data:
        if len((h or "").encode()) >= 1000:
            best[h] = max((x for x in (best.get(h), i) if x is not None), default=None)
    out = []
    for i, _, h in data:
        raw = (h or "").encode()
        to = best.get(h)
        revisit = to is not None and i != to
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("compression, split", [("gzip", "128m"), ("none", "700b"), ("none", "64b")])
def test_round_trip(spark, compression, split):
    big = "é" * 600 + FAKE * 3 + "x"
    data = [(1, "http://a/ b", big), (2, None, big), (9, "u", big), (3, "u", None), (4, "u", ""), (5, "u", "y" * 999), (6, "u", "y" * 999)]
    data += [(7, "u", FAKE), (8, "u", "WARC/1.1\r\n"), (8, "u", "end\r\n\r\n"), (10, "u", "\r\n\r\nWARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n"), (None, "u", "null id"), (11, "u", "z" * 5000), (11, "u", "z" * 5000), (None, "u", "z" * 5000)]
    data += [(20 + k, "u", f"page {k} " * 50) for k in range(30)]
    if split == "128m":
        data += [(60, "u", "long " * 600_000), (61, "u", "long " * 600_000), (62, "u", (FAKE + "é" * 500) * 3000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in data], "page_id long, url string, html string, sha string, bytes int").repartition(3)
    path = f"{shared_dir(spark)}/warc"
    write_archives(df, path, compression=compression)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        assert sorted(map(tuple, page_records(spark, path).collect()), key=str) == expected(data)
        assert records(spark, path).count() == len(data)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    if compression == "none":
        total = sum(open(f, "rb").read().count(b"WARC/1.1\r\n") for f in glob.glob(path.removeprefix("file://") + "/part*"))
        assert total > len(data)


def test_chain_and_empty_table(spark):
    assert chain_of(np.array([10, 8, 25, 40, 50]), np.array([0, 5, 10, 25, 40])).tolist() == [True, False, True, True, True]
    assert chain_of(np.array([7]), np.array([3])).tolist() == [False]
    n = 1000
    assert chain_of(np.arange(1, n + 1), np.arange(n)).all()
    path = f"{shared_dir(spark)}/none"
    write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert page_records(spark, path).count() == 0


def test_older_version_is_read(spark):
    path = f"{shared_dir(spark)}/older"
    record = lambda v, payload: f"WARC/1.{v}\r\nWARC-Type: response\r\nContent-Length: {len(payload) + 26}\r\n\r\nHTTP/1.1 200 OK\r\nA: bc\r\n\r\n" + payload
    payloads = ["first", "WARC/1.0\r\nContent-Length: 3\r\n\r\nabc", "WARC/1.x", "last"]
    spark.createDataFrame([(k, record(k % 2, p)) for k, p in enumerate(payloads)], "k int, v string").coalesce(1).orderBy("k").select("v").write.option("lineSep", "\r\n\r\n").text(path)
    want = {(len(p), hashlib.sha1(p.encode()).hexdigest()) for p in payloads}
    assert {(r.payload_bytes, r.sha) for r in records(spark, path).collect()} == want


def test_broken_chain_fails(spark):
    path = f"{shared_dir(spark)}/broken"
    spark.createDataFrame([("WARC/1.1\r\nContent-Length: 4\r\n\r\nab",)], "v string").coalesce(1).write.option("lineSep", "\r\n\r\n").text(path)
    with pytest.raises(Exception, match="broken record chain"):
        records(spark, path).collect()
