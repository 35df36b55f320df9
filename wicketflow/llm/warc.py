"""WARC archives: records, continuation segments and chunked transfer framing."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wicketflow.llm.common import slices

VERSION = b"WARC/1.1\r\n"
END = b"\r\n\r\n"
SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
DATE = "2026-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        b"Transfer-Encoding: chunked\r\n\r\n")

RECORD = ("record_type string, record_id string, page_id string, url string, refers_to_id string,"
          " digest string, origin string, number long, total long, block binary, intact boolean")


def base32_sha1(payload: Column) -> Column:
    """The bare upper-case base32 SHA-1 of a binary column; 40 bits are 8 digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV",
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked framing. A chunk ends inside VERSION, so that it never stands in a block."""
    out, at = [], 0
    while at < len(payload):
        end = min(at + size, len(payload))
        found = payload.find(VERSION, at, end)
        if found >= 0:
            end = found + 4
        part = payload[at:end]
        out.append(b"%x\r\n%b\r\n" % (len(part), part))
        at = end
    return b"".join([*out, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes | None:
    """The payload of chunked framing, or None if the framing is broken."""
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        try:
            size = int(body[at:line].split(b";")[0], 16) if line >= 0 else -1
        except ValueError:
            size = -1
        if size < 0:
            return None
        at = line + 2
        if size == 0:
            return b"".join(out)
        if body[at + size:at + size + 2] != b"\r\n":
            return None
        out.append(body[at:at + size])
        at += size + 2


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {re.sub(r'[\r\n]', ' ', str(v))}\r\n" for k, v in fields
                   if v is not None)
    return VERSION + head.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block


def records(row: dict, segment_bytes: int) -> Iterator[bytes]:
    """The records of one page: a response with its continuations, or a revisit."""
    key = "" if row["page_id"] is None else row["page_id"]
    digest, kind = row["digest"], row["record_type"]
    own = f"<urn:page:{key}:{digest}>"
    fields = [("WARC-Type", kind), ("WARC-Date", DATE), ("WARC-Target-URI", row["url"]),
              ("X-Page-Id", row["page_id"]), ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("Content-Type", "application/http; msgtype=response")]
    if kind == "revisit":
        yield _record([*fields, ("WARC-Record-ID", f"<urn:page:{key}:{digest}:revisit>"),
                       ("WARC-Refers-To", f"<urn:page:{row['winner']}:{digest}>"),
                       ("WARC-Profile", PROFILE)], HTTP)
        return
    block = HTTP + chunked((row["html"] or "").encode())
    if len(block) <= segment_bytes:
        yield _record([*fields, ("WARC-Record-ID", own)], block)
        return
    cuts = range(0, len(block), segment_bytes)
    for number, at in enumerate(cuts, 1):
        part = block[at:at + segment_bytes]
        if number == 1:
            yield _record([*fields, ("WARC-Record-ID", own), ("WARC-Segment-Number", 1)], part)
            continue
        last = number == len(cuts)
        yield _record([("WARC-Type", "continuation"), ("WARC-Date", DATE),
                       ("WARC-Record-ID", f"<urn:page:{key}:{digest}:{number}>"),
                       ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", number),
                       ("WARC-Segment-Total-Length", len(block) if last else None)], part)


def write_archives(df: DataFrame, path: str, key: str = "page_id", url: str = "url",
                   html: str = "html", segment_bytes: int = SEGMENT_BYTES,
                   compression: str = "gzip") -> None:
    """Write one record for each row to archives under `path`, one for each task.

    Of rows with equal payloads the one with the largest key is a response, the others are
    revisits that refer to it. A null payload is an empty one. A null key is smaller than
    any; rows that repeat the response's key and payload are responses again. A null url
    leaves the field out. Payloads do not move: only digests are grouped, combined before
    the shuffle, and a hot payload's rows are split by adaptive execution. An archive is
    plain records in Spark's text sink, so that executors write to any store; without
    `compression` a reader can split it.
    """
    pages = df.select(F.col(key).alias("page_id"), F.col(url).alias("url"),
                      F.col(html).alias("html"))
    digest = base32_sha1(F.coalesce("html", F.lit("")).cast("binary"))
    winners = (pages.select("page_id", digest.alias("digest")).groupBy("digest")
               .agg(F.max("page_id").alias("winner")))
    first = F.col("page_id").eqNullSafe(F.col("winner"))
    rows = pages.withColumn("digest", digest).join(winners, "digest").select(
        "page_id", "url", F.when(first, F.col("html")).alias("html"), "digest", "winner",
        F.when(first, "response").otherwise("revisit").alias("record_type"))

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                made = [r for row in part.to_pylist() for r in records(row, segment_bytes)]
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["record"])

    (rows.mapInArrow(write, "record binary")
     .select(F.col("record").cast("string").alias("value")).write
     .option("lineSep", END.decode()).option("compression", compression).text(path))


def parse(raw: bytes) -> tuple | None:
    """RECORD's values of one record without its version line; None if it has no length."""
    split = raw.find(END)
    head = raw[:split] if split >= 0 else raw
    fields = dict(re.findall(rb"(?m)^([\w-]+):[ \t]*(.*?)\r?$", head))
    named = {k.lower().decode(): v.decode("utf-8", "replace") for k, v in fields.items()}
    size = named.get("content-length", "")
    if not size.isdigit():
        return None
    block = raw[split + 4:split + 4 + int(size)] if split >= 0 else b""

    def number(name: str) -> int | None:
        value = named.get(name, "")
        return int(value) if value.isdigit() else None

    digest = named.get("warc-payload-digest")
    return (named.get("warc-type"), named.get("warc-record-id"), named.get("x-page-id"),
            named.get("warc-target-uri"), named.get("warc-refers-to"),
            digest.removeprefix("sha1:") if digest else None,
            named.get("warc-segment-origin-id"), number("warc-segment-number"),
            number("warc-segment-total-length"), block, len(block) == int(size))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """RECORD rows of all archives under `path`, plain or compressed, of any size.

    The text source cuts archives at the version lines that begin the records. Where a
    payload holds such a line, its record is shorter than it says and takes the next pieces
    of the same file until it is whole; if the file's split ends before, it is not `intact`.
    """
    lines = (spark.read.option("lineSep", VERSION.decode()).text(path)
             .select(F.col("value").cast("binary").alias("raw"),
                     F.input_file_name().alias("file")))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.string()] * 7 + [pa.int64()] * 2 + [pa.binary(), pa.bool_()]
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=[x.split()[0] for x in RECORD.split(", ")])

        held, open_raw, open_row, open_file = [], b"", None, None
        for batch in batches:
            for part in slices(batch, "raw"):
                for raw, file in zip(part.column("raw").to_pylist(),
                                     part.column("file").to_pylist(), strict=True):
                    row = None
                    if open_row is not None:
                        if file == open_file:
                            raw = open_raw + VERSION + raw
                            row = parse(raw)
                        else:
                            held.append(open_row)
                    row = row or parse(raw)
                    open_row = None
                    if row is None:
                        continue
                    if row[-1]:
                        held.append(row)
                    else:
                        open_raw, open_row, open_file = raw, row, file
                yield out(held)
                held = []
        if open_row is not None:
            yield out([open_row])

    return lines.mapInArrow(read, RECORD)


def http_payload(block: bytes | None) -> bytes | None:
    """The payload of an HTTP response; None if header or framing is broken."""
    if block is None:
        return None
    head, found, body = block.partition(END)
    if not found:
        return None
    if re.search(rb"(?im)^transfer-encoding:[^\r\n]*chunked", head):
        return unchunked(body)
    return body


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(record_type, record_id, page_id, url, refers_to_id, digest, payload, verified).

    Responses and revisits, a row each. A segmented record is put together from the
    continuations of its origin, in order of their numbers; it is `verified` if the numbers
    run from 1 without a gap, the total length is right and the payload's digest is the one
    of its header. A record that is not keeps its row, with a null payload if it cannot be
    decoded. A segment that comes twice counts once; a record that comes twice gives two
    rows. Only segments are shuffled; a group of them is one payload. Without any archive
    there are no rows.
    """
    read = read_records(spark, path)
    kinds = F.col("record_type").isin("response", "revisit")
    keep = ["record_type", "record_id", "page_id", "url", "refers_to_id", "digest"]
    whole = read.where(kinds & F.col("number").isNull()).select(*keep, "block", "intact")
    parts = read.where(F.col("number").isNotNull()).withColumn(
        "origin", F.coalesce("origin", "record_id"))
    first = F.col("number") == 1
    groups = parts.groupBy("origin").agg(
        *[F.max(F.when(first, F.col(c))).alias(c) for c in keep],
        F.sum(first.cast("int")).cast("int").alias("copies"), F.max("total").alias("total"),
        F.array_sort(F.collect_set(F.struct("number", "block", "intact"))).alias("parts"))
    numbers = F.transform("parts", lambda p: p["number"])
    block = F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["block"]))
    joined = groups.where("copies > 0").select(
        *keep, block.alias("block"),
        (F.coalesce(F.col("total") == F.length(block), F.lit(False))
         & (numbers == F.sequence(F.lit(1).cast("long"), F.size("parts").cast("long")))
         & F.forall("parts", lambda p: p["intact"])).alias("intact"),
        F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("col")
    both = whole.unionByName(joined)

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "block"):
                kinds = part.column("record_type").to_pylist()
                made = [http_payload(b) if k == "response" else None
                        for k, b in zip(kinds, part.column("block").to_pylist(), strict=True)]
                columns = [part.column(c) for c in (*keep, "intact")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(made, pa.binary())],
                                                 names=[*keep, "intact", "payload"])

    fields = ", ".join(f"{c} string" for c in keep)
    made = both.mapInArrow(decode, f"{fields}, intact boolean, payload binary")
    right = (F.col("record_type") == "revisit") | (
        base32_sha1(F.col("payload")).eqNullSafe(F.coalesce("digest", base32_sha1(F.col("payload")))))
    return made.select(*keep, "payload", (F.col("intact") & right).alias("verified"))
