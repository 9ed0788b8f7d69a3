"""WARC archives: writing pages as segmented, chunked records, and putting them together again."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import stage

VERSION = "WARC/1.1"
END = b"\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
SEGMENT = 16 * 1024  # most bytes of a record's block; the rest goes to continuation records
CHUNK = 4 * 1024  # bytes in a chunk of the transfer coding
RECORDS = 4096  # most records in an archive, which so has 64 MB and headers at most
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def name_of(page: object, digest: str) -> str:
    return f"<urn:page:{'' if page is None else page}:{digest}>"


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """The payload in chunked transfer coding."""
    chunks = (payload[i : i + size] for i in range(0, len(payload), size))
    return b"".join(b"%x\r\n%s\r\n" % (len(c), c) for c in chunks) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes | None:
    """What chunked transfer coding holds, extensions and trailers left out; null if it is broken or cut short."""
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        size = body[at:line].split(b";")[0].strip() if line >= 0 else b""
        try:
            n = int(size, 16)
        except ValueError:
            return None
        if n == 0:
            return b"".join(out)
        at = line + 2
        if n < 0 or len(body) < at + n + 2 or body[at + n : at + n + 2] != b"\r\n":
            return None
        out.append(body[at : at + n])
        at += n + 2


def record(fields: dict[str, object], block: bytes) -> bytes:
    """A record without the empty lines that end it."""
    lines = [VERSION, *(f"{k}: {v}" for k, v in fields.items() if v is not None), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block


def records(page: object, url: str | None, payload: bytes, digest: str, first: object, original: bool) -> Iterator[bytes]:
    """The records of a page: its response with continuations, or a revisit of the response of page ``first``."""
    name, target = name_of(page, digest), "".join((url or "").split())
    common = {"WARC-Date": DATE, "WARC-Target-URI": target or None, "WARC-Payload-Digest": f"sha1:{digest}"}
    http = {"Content-Type": "application/http; msgtype=response"}
    if not original:
        refers = {"WARC-Refers-To": name_of(first, digest), "WARC-Profile": PROFILE}
        yield record({"WARC-Type": "revisit", "WARC-Record-ID": name, **common, **refers, **http}, f"{HTTP}\r\n".encode())
        return
    block = f"{HTTP}Transfer-Encoding: chunked\r\n\r\n".encode() + chunked(payload)
    pieces = [block[i : i + SEGMENT] for i in range(0, len(block), SEGMENT)]
    segmented = len(pieces) > 1
    yield record({"WARC-Type": "response", "WARC-Record-ID": name, **common, "WARC-Segment-Number": 1 if segmented else None, **http}, pieces[0])
    for number, piece in enumerate(pieces[1:], 2):
        total = len(block) if number == len(pieces) else None
        own = {"WARC-Type": "continuation", "WARC-Record-ID": f"{name[:-1]}:{number}>", "WARC-Date": DATE}
        yield record({**own, "WARC-Segment-Origin-ID": name, "WARC-Segment-Number": number, "WARC-Segment-Total-Length": total}, piece)


def write(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write a record per page to gzip archives below ``path``.

    The payload is the html in UTF-8, a null one empty. Of pages with equal payloads the one with the largest id is
    the response and the others revisit it; several rows with that id are equal responses, null ids come last.
    Spark's text writer puts down the records, so that archives are committed like any other output.
    """
    body = F.coalesce(F.col(html), F.lit(""))
    slim = pages.select(F.col(page_id).alias("page"), F.col(url).alias("url"), body.alias("body")).withColumn("sha1", F.sha1(F.col("body").cast("binary")))
    firsts = stage(slim.groupBy(F.col("sha1").alias("_sha1")).agg(F.max("page").alias("first")), "firsts")
    joined = slim.join(firsts, slim["sha1"] == firsts["_sha1"])
    joined = joined.select("page", "url", F.col("body").cast("binary").alias("body"), "sha1", "first", F.col("page").eqNullSafe(F.col("first")).alias("original"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, held = [], 0
            for page, link, payload, sha1, first, original in zip(*(c.to_pylist() for c in batch.columns)):
                for one in records(page, link, payload, base32(sha1), first, original):
                    made.append(one)
                    held += len(one)
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["value"])
                    made, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["value"])

    lines = joined.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
    lines.write.option("lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", RECORDS).text(path)


class BrokenArchive(ValueError):
    """An archive that cannot be read to its end."""


def inflated(content: bytes) -> Iterator[bytes]:
    """Pieces of an archive's plain bytes; it may be plain, one gzip member, or a member per record."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    view, at = memoryview(content), 0
    while at < len(view):
        reader = zlib.decompressobj(31)
        while not reader.eof and at < len(view):
            given = view[at : at + (1 << 18)]
            yield reader.decompress(given)
            at += len(given) - len(reader.unused_data)
        if not reader.eof:
            raise BrokenArchive("a gzip member is cut short")


def parsed(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record.

    A header may be as long as the archive. What is no record, or is cut short, raises BrokenArchive, since all that follows
    it would be lost; empty lines may stand before a record and at the end.
    """
    held, pieces = bytearray(), inflated(content)

    def until(n: int) -> bool:
        while len(held) < n:
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while until(1):
        if held[0] in b"\r\n":
            del held[0]
            continue
        end = held.find(END)
        while end < 0:
            known = len(held)
            if not until(known + 1):
                raise BrokenArchive("a header has no end")
            end = held.find(END, max(known - 3, 0))
        head = bytes(held[:end]).decode("utf-8", "replace").split("\r\n")
        if not head[0].startswith("WARC/"):
            raise BrokenArchive("a record does not begin with its version")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head[1:])}
        size = fields.get("content-length", "")
        if not size.isdigit():
            raise BrokenArchive("a record has no length")
        start = end + len(END)
        if not until(start + int(size)):
            raise BrokenArchive("a block is cut short")
        block = bytes(held[start : start + int(size)])
        until(start + int(size) + len(END))
        tail = start + int(size)
        del held[: tail + len(END) if held[tail : tail + len(END)] == END else tail]
        yield fields, block


FIELDS = {
    "type": "warc-type",
    "record_id": "warc-record-id",
    "origin": "warc-segment-origin-id",
    "segment": "warc-segment-number",
    "total": "warc-segment-total-length",
    "refers": "warc-refers-to",
    "uri": "warc-target-uri",
    "digest": "warc-payload-digest",
}
NUMBERS = {"segment", "total"}


def read(spark: SparkSession, path: str, segmented: bool | None = None) -> DataFrame:
    """The records of the archives below ``path``: the columns of FIELDS, and ``block``. A broken archive fails the job.

    ``segmented`` keeps only records that are segments, or only those that are whole.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    schema = ", ".join(f"{n} {'long' if n in NUMBERS else 'string'}" for n in FIELDS) + ", block binary"
    types = [*(pa.int64() if n in NUMBERS else pa.string() for n in FIELDS), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[*FIELDS, "block"])

        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for fields, block in parsed(content.as_py()):
                    got = [fields.get(f) for f in FIELDS.values()]
                    got = [(int(v) if v and v.isdigit() else None) if n in NUMBERS else v for n, v in zip(FIELDS, got)]
                    if segmented is None or segmented == (got[3] is not None):
                        rows.append((*got, block))
                        held += len(block)
                    if held > 8 << 20:
                        yield out(rows)
                        rows, held = [], 0
                if rows:
                    yield out(rows)

    return files.mapInArrow(run, schema)


def joined_segments(parts: DataFrame) -> DataFrame:
    """Segments put together: a row per origin, with the first segment's fields, ``block`` and ``complete``.

    Segments are grouped by the origin's identifier and ordered by number. A record is complete if it has the numbers 1
    to n once each, only the last segment has the total length, and that is the length of all blocks; otherwise its block is
    null. Records that were written several times (equal in all) are one group and come out as often.
    """
    key = F.when(F.col("type") == "continuation", F.col("origin")).otherwise(F.col("record_id"))
    lead = F.when(F.col("type") != "continuation", F.struct("type", "record_id", "refers", "uri", "digest"))
    piece = F.struct("segment", F.col("block").cast("string").alias("block"), "total")
    grouped = parts.withColumn("whole", key).groupBy("whole").agg(F.max(lead).alias("lead"), F.sort_array(F.collect_set(piece)).alias("pieces"), F.count(F.lit(1)).alias("rows"))
    block = F.array_join(F.transform("pieces", lambda p: p["block"]), "")
    length = F.expr("aggregate(pieces, 0L, (n, p) -> n + octet_length(p.block))")
    numbered = F.expr("forall(sequence(1, size(pieces)), i -> pieces[i - 1].segment = i)")
    last = F.expr("pieces[size(pieces) - 1].total = octets AND NOT exists(slice(pieces, 1, size(pieces) - 1), p -> p.total IS NOT NULL)")
    complete = F.coalesce(F.col("lead").isNotNull() & numbered & last & (F.col("rows") % F.size("pieces") == 0), F.lit(False))
    out = grouped.withColumn("octets", length).withColumn("complete", complete)
    copies = F.when(F.col("complete"), F.array_repeat(F.lit(0), (F.col("rows") / F.size("pieces")).cast("int"))).otherwise(F.array(F.lit(0)))
    out = out.withColumn("_copy", F.explode(copies))
    fields = [F.coalesce(F.col("lead.record_id"), F.col("whole")).alias("record_id"), *(F.col(f"lead.{n}").alias(n) for n in ("type", "refers", "uri", "digest"))]
    return out.select(*fields, F.when(F.col("complete"), block.cast("binary")).alias("block"), "complete")


def payloads(records: DataFrame) -> DataFrame:
    """Adds ``payload`` (null if the block or its chunked coding is broken), ``payload_bytes`` and ``payload_digest``.

    Only responses have a payload; it is the body of the HTTP message, decoded if that is chunked.
    """
    kept = [c for c in records.columns if c != "block"]
    schema = records.select(*kept).schema.add("payload", "binary").add("payload_bytes", "long").add("payload_digest", "string")

    def one(kind: str | None, block: bytes | None) -> tuple[bytes | None, int | None, str | None]:
        if kind != "response" or block is None:
            return None, None, None
        head, gap, body = block.partition(END)
        chunks = any(b"chunked" in line for line in head.lower().split(b"\r\n") if line.startswith(b"transfer-encoding:"))
        payload = (dechunked(body) if chunks else body) if gap else None
        return (None, None, None) if payload is None else (payload, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [one(k, b) for k, b in zip(batch.column("type").to_pylist(), batch.column("block").to_pylist())]
            values = [pa.array([m[i] for m in made], t) for i, t in enumerate((pa.binary(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *values], names=[*kept, "payload", "payload_bytes", "payload_digest"])

    return records.select(*kept, "block").mapInArrow(run, schema)


def page_of(name: Column) -> Column:
    return F.regexp_extract(name, r"^<urn:page:(-?\d+):", 1).try_cast("long")


def pages(spark: SparkSession, path: str) -> DataFrame:
    """The pages of archives made by ``write``: ``page_id, uri, payload, payload_bytes, payload_digest, record_type, refers_to``.

    A revisit has the length and digest of its response's payload, whose bytes are not repeated, and the response's id.
    ``verified`` tells if the payload that was put together has the digest that its record names.
    """
    whole = read(spark, path, segmented=False).select("record_id", "type", "refers", "uri", "digest", "block").withColumn("complete", F.col("block").isNotNull())
    parts = joined_segments(read(spark, path, segmented=True)).select(*whole.columns)
    opened = payloads(whole.union(parts))
    named = opened.select(page_of(F.col("record_id")).alias("page_id"), "uri", "payload", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers", "digest", "record_id")
    named = named.withColumn("verified", F.coalesce(F.concat(F.lit("sha1:"), "payload_digest") == F.col("digest"), F.lit(False)))
    return named


def resolved(spark: SparkSession, path: str) -> DataFrame:
    """``pages`` without payloads, and with each revisit's length, digest and page taken from the response that it names."""
    read_back = stage(pages(spark, path).drop("payload", "uri"), "records")
    responses = read_back.filter("record_type = 'response'")
    revisits = read_back.filter("record_type = 'revisit'").select("page_id", "record_type", "refers")
    named = stage(responses.groupBy("record_id").agg(*(F.first(c).alias(c) for c in ("payload_bytes", "payload_digest", "verified"))), "responses")
    found = revisits.join(named, revisits["refers"] == named["record_id"], "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified"]
    found = found.withColumn("refers_to", page_of(F.col("refers"))).select(*columns)
    return responses.withColumn("refers_to", F.lit(None).cast("long")).select(*columns).union(found)
