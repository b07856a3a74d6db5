"""WARC archives: write pages as records, read them back with segment reassembly
(operator 8).

Pages become ``response`` records with chunked HTTP payloads; a page whose payload
another page already holds becomes a ``revisit`` record. A block longer than
``segment_bytes`` is cut into a first segment and ``continuation`` records. Records
end with an empty line, so Spark's text writer with that line separator writes
valid gzipped archives, at most ``RECORDS_PER_FILE`` records each.

Reading parses each archive by its content lengths, groups the segments of a
record by their origin's id, orders them by segment number, verifies the total
length, decodes the chunked framing and checks the payload digest.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.store import new_path, written

# Fixed values of the WARC 1.1 and HTTP formats.
VERSION = b"WARC/1.1"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = b"2024-01-01T00:00:00Z"
RECORD_END = "\r\n\r\n"

SEGMENT_BYTES = 64 << 10
CHUNK_BYTES = 8 << 10
#: With segments of 64 KiB, an archive holds at most 64 MiB before compression.
RECORDS_PER_FILE = 1000
#: Hot payloads are spread over so many join keys.
SALTS = 16


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def frame_chunks(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    out = []
    for i in range(0, len(payload), size):
        part = payload[i:i + size]
        out += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


def unframe_chunks(body: bytes) -> bytes:
    """Payload of a chunked body; extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        eol = body.index(b"\r\n", at)
        n = int(body[at:eol].split(b";", 1)[0], 16)
        at = eol + 2
        if n == 0:
            return b"".join(out)
        if body[at + n:at + n + 2] != b"\r\n":
            raise ValueError("a chunk is shorter than its length")
        out.append(body[at:at + n])
        at += n + 2


def record(fields: list[tuple[bytes, bytes]], block: bytes) -> bytes:
    """A record without its end, which the writer's line separator adds."""
    head = b"\r\n".join([VERSION, *(k + b": " + v for k, v in fields), b"Content-Length: %d" % len(block)])
    return head + b"\r\n\r\n" + block


def page_records(rid: str, url: str | None, payload: bytes, refers: str | None, segment_bytes: int) -> list[bytes]:
    """The record of a page, or its segments."""
    ident = b"<" + rid.encode() + b">"
    uri = "".join((url or "").split()).encode()
    common = [(b"WARC-Date", DATE), (b"WARC-Target-URI", uri),
              (b"WARC-Payload-Digest", b"sha1:" + digest32(payload).encode())]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    kind = (b"Content-Type", b"application/http; msgtype=response")
    if refers is not None:
        return [record([(b"WARC-Type", b"revisit"), (b"WARC-Record-ID", ident), *common,
                        (b"WARC-Refers-To", b"<" + refers.encode() + b">"), (b"WARC-Profile", PROFILE), kind],
                       http + b"Content-Length: %d\r\n\r\n" % len(payload))]
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + frame_chunks(payload)
    head = [(b"WARC-Type", b"response"), (b"WARC-Record-ID", ident), *common, kind]
    if len(block) <= segment_bytes:
        return [record(head, block)]
    parts = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    out = [record([*head, (b"WARC-Segment-Number", b"1")], parts[0])]
    for k, part in enumerate(parts[1:], 2):
        fields = [(b"WARC-Type", b"continuation"), (b"WARC-Record-ID", b"<" + f"{rid}/{k}".encode() + b">"),
                  (b"WARC-Date", DATE), (b"WARC-Segment-Origin-ID", ident), (b"WARC-Segment-Number", b"%d" % k)]
        if k == len(parts):
            fields.append((b"WARC-Segment-Total-Length", b"%d" % len(block)))
        out.append(record(fields, part))
    return out


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", segment_bytes: int = SEGMENT_BYTES, min_revisit_bytes: int = 0) -> None:
    """Write a record per row of ``pages`` to gzipped archives under ``path``.

    Of rows with equal payloads of at least ``min_revisit_bytes`` bytes, the one
    with the largest id is the response (of equal ids, one of them), the others
    are revisits. A null payload is an empty one; a null id ranks lowest; other
    columns are not read.

    A record is named by id and payload, and rows equal in both by their place in
    their group, never by their place in the input: every evaluation of ``pages``,
    in whatever order it gives the rows, names them alike.
    """
    rows = pages.select(
        F.coalesce(F.col(id_col).cast("bigint").cast("string"), F.lit("")).alias("id"),
        F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"),
        F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload")).withColumn("sha", F.sha1("payload"))
    rid = F.concat(F.lit("urn:page:"), F.col("id"), F.lit(":"), F.col("sha"))
    each = written(rows.groupBy("sha", "id").agg(F.count(F.lit(1)).alias("c"), F.min("url").alias("lead"),
                                                 F.max(F.octet_length("payload")).alias("b")), "warc-payloads")
    top = (each.groupBy("sha").agg(F.sum("c").alias("n"), F.max("b").alias("b"), F.max(F.struct(F.expr("try_cast(id AS bigint)"), "id")).alias("top"))
           .filter((F.col("n") > 1) & (F.col("b") >= min_revisit_bytes)).select("sha", F.col("top.id").alias("id"))
           .select("sha", rid.alias("refers"), F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("salt")))
    # rows equal in id and payload: their number by url, and one name for each
    equal = each.filter("c > 1").select("sha", "id", "lead")
    own = rows
    if not equal.isEmpty():
        same = rows.join(equal, ["sha", "id"]).groupBy("sha", "id", "lead", "url").agg(
            F.count(F.lit(1)).alias("c"), F.max("payload").alias("payload")).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("c"))))
        tail = F.when((F.col("url") == F.col("lead")) & (F.col("k") == 1), F.lit("")).otherwise(
            F.concat(F.lit(":"), F.sha1("url"), F.lit(":"), F.col("k")))
        own = rows.join(equal, ["sha", "id"], "left_anti").withColumn("tail", F.lit("")).unionByName(
            same.select("id", "url", "payload", "sha", tail.alias("tail")))
        rid = F.concat(rid, F.col("tail"))
    salt = F.pmod(F.xxhash64("id", "url"), F.lit(SALTS)).cast("int")
    rows = own.withColumn("salt", salt).join(top, ["sha", "salt"], "left").select(rid.alias("rid"), "url", "payload", "refers")

    def build(batches):
        for batch in batches:
            for i in range(batch.num_rows):                    # a page at a time: payloads may be long
                r, u, p, ref = (batch.column(k)[i].as_py() for k in range(4))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(page_records(r, u, p, None if ref == r else ref, segment_bytes), pa.binary())], ["record"])

    (rows.mapInArrow(build, "record binary").select(F.col("record").cast("string")).write
     .option("lineSep", RECORD_END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def parse_archive(raw: bytes):
    """(fields, block) of each record of an uncompressed archive."""
    at = 0
    while at < len(raw):
        if not raw.startswith(VERSION, at):
            raise ValueError(f"no record starts at byte {at}")
        end = raw.index(b"\r\n\r\n", at)
        fields = dict(line.split(b": ", 1) for line in raw[at:end].split(b"\r\n")[1:])
        start = end + 4
        stop = start + int(fields[b"Content-Length"])
        if raw[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"a record does not end at byte {stop}")
        yield fields, raw[start:stop]
        at = stop + 4


def payload_of(block: bytes) -> tuple[bytes | None, int]:
    """(payload, its length) of an HTTP block; a revisit's block has the length only."""
    end = block.index(b"\r\n\r\n")
    head = dict(x.split(b": ", 1) for x in block[:end].split(b"\r\n")[1:])
    if head.get(b"Transfer-Encoding") == b"chunked":
        payload = unframe_chunks(block[end + 4:])
        return payload, len(payload)
    return None, int(head[b"Content-Length"])


def _text(value: bytes | None) -> str | None:
    return None if value is None else value.decode().strip("<>")


def read_archives(spark, path: str, with_payload: bool = False) -> DataFrame:
    """One row per response or revisit record: page_id, payload_bytes,
    payload_digest, record_type, refers_to and, with ``with_payload``, payload
    (null for revisits). A missing segment, a wrong length or digest is an error."""
    parsed = "origin string, type string, digest string, refers string, segment int, total bigint, size bigint, block binary"
    names = [c.split()[0] for c in parsed.split(", ")]
    kinds = [pa.string()] * 4 + [pa.int32()] + [pa.int64()] * 2 + [pa.binary()]

    def checked(origin, block, digest):
        payload, size = payload_of(block)
        if payload is not None and digest32(payload) != digest:
            raise ValueError(f"{origin}: the payload does not match its digest")
        return payload, size

    def parse(batches):
        """A whole record is finished here; only segments take their block along."""
        for batch in batches:
            for content in batch.column(0):
                raw = zlib.decompress(content.as_py(), 31)
                out = []
                for f, block in parse_archive(raw):
                    kind, number = f[b"WARC-Type"].decode(), int(f.get(b"WARC-Segment-Number", 0))
                    digest = None if kind == "continuation" else f[b"WARC-Payload-Digest"].decode().split(":", 1)[1]
                    origin, size = _text(f.get(b"WARC-Segment-Origin-ID", f[b"WARC-Record-ID"])), None
                    if number == 0:
                        payload, size = checked(origin, block, digest)
                        block = payload if with_payload else None
                    total = f.get(b"WARC-Segment-Total-Length")
                    out.append((origin, None if kind == "continuation" else kind, digest, _text(f.get(b"WARC-Refers-To")),
                                number, None if total is None else int(total), size, block))
                    if len(out) >= 200:
                        yield _batch(out)
                        out = []
                if out:
                    yield _batch(out)

    def _batch(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    def finish(batches):
        rows = []
        for batch in batches:
            for r in range(batch.num_rows):
                origin, kind, digest, refers, total, size, parts = (batch.column(k)[r].as_py() for k in range(7))
                numbers = [p["segment"] for p in parts]
                payload = parts[0]["block"]
                if numbers != [0]:
                    block = b"".join(p["block"] for p in parts)
                    if numbers != list(range(1, len(parts) + 1)) or total != len(block):
                        raise ValueError(f"{origin}: segments {numbers} with {len(block)} of {total} bytes")
                    payload, size = checked(origin, block, digest)
                page, ref = origin.split(":")[2], refers.split(":")[2] if refers else None
                rows.append((int(page) if page else None, size, digest, kind, int(ref) if ref else None, payload))
                if len(rows) >= 500 or with_payload:
                    yield _rows(rows)
                    rows = []
        if rows:
            yield _rows(rows)

    fields = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
              ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())][:5 + with_payload]

    def _rows(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields)], names=[n for n, _ in fields])

    records = (spark.read.format("binaryFile").load(path).select("content").mapInArrow(parse, parsed)
               .groupBy("origin").agg(
                   F.max("type").alias("type"), F.max("digest").alias("digest"), F.max("refers").alias("refers"),
                   F.max("total").alias("total"), F.max("size").alias("size"),
                   F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts")))
    schema = ("page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
              + ", payload binary" * with_payload)
    return records.select("origin", "type", "digest", "refers", "total", "size", "parts").mapInArrow(finish, schema)


def round_trip(pages: DataFrame, segment_bytes: int = SEGMENT_BYTES, min_revisit_bytes: int = 0, **columns) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back. An
    empty table gives no rows."""
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_archives(pages, path, segment_bytes=segment_bytes, min_revisit_bytes=min_revisit_bytes, **columns)
    return read_archives(spark, path)
