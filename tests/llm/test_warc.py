import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from wicketflow.llm import queries, warc

PAYLOADS = [
    None, "", "", "plain", "same", "same", "same", "x" * 100_000, "é😀\r\n\r\n" * 9_000,
    "WARC/1.1\r\n", "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nb", "WARC/1.1\r\n" * 5_000,
    "0\r\n\r\n", "HTTP/1.1 200 OK\r\n\r\n", "\r\n" * 40,
]
SCHEMA = "page_id long, url string, html string, digest string, block int"


def sha(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, None if i % 4 == 0 else f"http://h/{i}\r\nX: y", t, "clash", i)
            for i, t in enumerate(PAYLOADS)]
    rows += [(None, "http://none/", "no key", "clash", 0), rows[4], rows[6]]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("compression", ["gzip", "none"])
@pytest.mark.parametrize("segment", [warc.SEGMENT_BYTES, 64])
def test_round_trip(spark, pages, tmp_path, compression, segment):
    path = str(tmp_path / "archive")
    warc.write_archives(pages.repartition(3), path, segment_bytes=segment,
                        compression=compression)
    got = warc.read_archives(spark, path).collect()
    assert len(got) == pages.count() and all(r.verified for r in got)
    written = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    winner = {}
    for key, payload in written:
        keys = [k for k, p in written if p == payload and k is not None]
        winner[payload] = max(keys) if keys else None
    want = sorted((str(k), sha(p), "response" if winner[p] == k else "revisit")
                  for k, p in written)
    assert sorted((str(r.page_id and int(r.page_id)), r.digest, r.record_type)
                  for r in got) == want
    for r in got:
        if r.record_type == "response":
            assert sha(bytes(r.payload)) == r.digest


def test_query(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet").collect()
    payloads = {r.page_id: (r.html or "").encode() for r in pages}
    last = {p: max(k for k, q in payloads.items() if q == p) for p in payloads.values()}
    want = sorted((k, len(p), sha(p), "response" if last[p] == k else "revisit",
                   -1 if last[p] == k else last[p]) for k, p in payloads.items())
    got = queries.op9_warc(spark, small).select(
        "page_id", "payload_bytes", "payload_digest", "record_type",
        F.coalesce("refers_to", F.lit(-1)))
    assert sorted(tuple(r) for r in got.collect()) == want


def test_missing_segment_is_not_verified(spark, tmp_path):
    row = {"page_id": 1, "url": "u", "html": "y" * 1_000, "digest": sha(b"y" * 1_000),
           "record_type": "response", "winner": 1}
    made = list(warc.records(row, 200))
    assert len(made) > 4
    for name, parts in (("all", made), ("swapped", made[::-1]), ("gap", made[:2] + made[3:]),
                        ("short", made[:-1])):
        path = str(tmp_path / name)
        (spark.createDataFrame([(p.decode(),) for p in parts], "value string").coalesce(1).write
         .option("lineSep", warc.END.decode()).text(path))
        got = warc.read_archives(spark, path).collect()
        assert [r.verified for r in got] == [name in ("all", "swapped")], name


def test_framing():
    for payload in (b"", b"a", b"WARC/1.1\r\n" * 20, bytes(range(256)) * 99):
        framed = warc.chunked(payload, 50)
        assert warc.unchunked(framed) == payload
        assert b"WARC/1.1\r\n" not in framed
        assert warc.unchunked(framed[:-5]) is None
    assert warc.unchunked(b"zz\r\n") is None


def test_empty_table(spark, pages, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_archives(pages.where("false"), path)
    assert warc.read_archives(spark, path).count() == 0
