"""Legacy ARC archives, their conversion to WARC, and reading the result back."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions.skew import lookup
from skein.session import cut, delete_folder, new_folder

# Bytes of an archive before compression at which the next one is begun.
ARCHIVE_BYTES = 32 << 20
# Bytes of a compressed piece at most; below 2^24, so that the last byte of a gzip member (the top byte of its length) is zero.
MEMBER_BYTES = 8 << 20
# Bytes of records handed to Spark at once.
BATCH_BYTES = 2 << 20
# Fields of a record's header line by version of the format, as its version block lists them.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
SAME_PAYLOAD = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
KEY_HEADER = "X-Page-Id"
VALUES = "file int, seq long, value binary"
RECORD = ("record_id string, warc_type string, warc_date string, target_uri string, ip string, content_type string, "
          "payload_digest string, same binary, payload_bytes long, page_id long, truncated boolean")
BODIES = ", head binary, payload binary"


def sha1(data: bytes) -> str:
    """SHA-1 in upper-case base 32."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---- archives as files

def rolled(heads: Callable[[int], bytes], compose: Callable[[pa.RecordBatch], Iterator[bytes]], limit: int) -> Callable:
    """A task that turns rows into records of archives of about ``limit`` bytes, each record a gzip member of its own.

    A record longer than ``MEMBER_BYTES`` is several members in a row. The last byte of each is left off: it is zero, and
    the text sink writes it as its separator.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, seq, size, out, waiting = -1, 0, limit, [], 0

        def put(data: bytes) -> None:
            nonlocal seq, waiting
            for at in range(0, max(len(data), 1), MEMBER_BYTES):
                member = zlib.compressobj(1, zlib.DEFLATED, 31)
                packed = member.compress(data[at:at + MEMBER_BYTES]) + member.flush()
                out.append((file, seq, packed[:-1]))
                seq, waiting = seq + 1, waiting + len(packed)

        def flush() -> pa.RecordBatch:
            nonlocal out, waiting
            batch = pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int64()),
                                                pa.array([x[2] for x in out], pa.binary())], ["file", "seq", "value"])
            out, waiting = [], 0
            return batch

        for batch in batches:
            for data in compose(batch):
                if size >= limit:
                    file, size = file + 1, 0
                    put(heads(file))
                put(data)
                size += len(data)
                if waiting >= BATCH_BYTES:
                    yield flush()
        yield flush()
    return run


def write_archives(rows: DataFrame, heads: Callable, compose: Callable, folder: str, limit: int) -> None:
    """Write ``rows`` as compressed archives below ``folder``, without a shuffle."""
    members = rows.mapInArrow(rolled(heads, compose, limit), VALUES).sortWithinPartitions("file", "seq")
    members.select("file", F.col("value").cast("string").alias("value")).write.partitionBy("file").option(
        "lineSep", "\x00").text(folder)


def read_archives(spark: SparkSession, folder: str, parse: Callable, schema: str) -> DataFrame:
    """Records of all archives below ``folder``, compressed or not; an archive is read by one task."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", "content").mapInArrow(_parsed(parse, schema), schema)


def _parsed(parse: Callable, schema: str) -> Callable:
    kinds = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64(), "boolean": pa.bool_()}
    names, types = zip(*[(name, kinds[kind]) for name, kind in (part.split() for part in schema.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in zip(names, types)], list(names))

        rows, waiting = [], 0
        for files in batches:
            for path, content in zip(files.column("path").to_pylist(), files.column("content")):
                data = content.as_py() or b""
                if data[:2] == b"\x1f\x8b":
                    data = gzip.GzipFile(fileobj=io.BytesIO(data)).read()
                for row in parse(path, data):
                    rows.append(row)
                    waiting += 500 + len(row["payload"])
                    if waiting >= BATCH_BYTES:
                        yield batch(rows)
                        rows, waiting = [], 0
        yield batch(rows)
    return run


# ---- ARC

def _arc_head(version: int) -> Callable[[int], bytes]:
    def head(file: int) -> bytes:
        body = f"{version} 0 skein\n{FIELDS[version]}\n".encode()
        extra = "" if version == 1 else "200 - - 0 - "
        return f"filedesc://{file}.arc 0.0.0.0 20010101000000 text/plain {extra}{len(body)}\n".encode() + body + b"\n"
    return head


def _arc_records(version: int) -> Callable[[pa.RecordBatch], Iterator[bytes]]:
    def compose(batch: pa.RecordBatch) -> Iterator[bytes]:
        for url, date, page, html in zip(*[batch.column(c).to_pylist() for c in ("url", "date", "page_id", "html")]):
            key = "" if page is None else f"{KEY_HEADER}: {page}\r\n"
            block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{key}Content-Length: {len(html)}\r\n\r\n".encode() + html
            extra = "" if version == 1 else f"200 {sha1(html)} - 0 - "
            yield f"{url} 0.0.0.0 {date} text/html {extra}{len(block)}\n".encode() + block + b"\n"
    return compose


def write_arc(pages: DataFrame, folder: str, version: int = 1, date: Column | None = None, limit: int = ARCHIVE_BYTES) -> None:
    """Write ``page_id, url, html`` as ARC archives, each with its version block, as crawlers wrote them.

    Each page is an HTTP response with the html in UTF-8 (null: empty) as its body and the id (unless null) as a header of its own. Signs that
    would end a field of the header line are percent-encoded in the url; a null or empty url is ``about:blank``. ``date`` gives the 14
    digits of the fetch.
    """
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    for sign in ("%0A", "%0D", "%20", "%09", "%00"):
        url = F.replace(url, F.lit(chr(int(sign[1:], 16))), F.lit(sign))
    rows = pages.select(F.when(url == "", "about:blank").otherwise(url).alias("url"), (date if date is not None else F.lit("20010101000000")).alias("date"),
                        F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("html"))
    write_archives(rows, _arc_head(version), _arc_records(version), folder, limit)


def header_line(line: bytes, version: int) -> dict[str, str] | None:
    """Fields of a record's header line, or nothing if it isn't one. The last fields are told by blanks, so a url may hold some."""
    names = FIELDS[version].split()
    parts = line.rstrip(b"\r").rsplit(b" ", len(names) - 1)
    if len(parts) < len(names) or not re.fullmatch(rb"[0-9]{1,18}", parts[-1]):
        return None
    fields = dict(zip(names, (p.decode("utf-8", "replace") for p in parts)))
    return fields if re.fullmatch(r"[0-9]{4,14}", fields["Archive-date"]) and ":" in fields["URL"] else None


def arc_entries(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes, bool]]:
    """``(place, fields, block, cut short)`` of the records of an archive.

    Records are found by declared lengths. A line that is no header line is passed over up to the next one that is, so a damaged record
    costs only itself. Fields are those of the version that the version block names, 1 before it.
    """
    at, version = 0, 1
    while at < len(data):
        if data[at] in b"\r\n":
            at += 1
            continue
        end = data.find(b"\n", at)
        end = len(data) if end < 0 else end
        line = data[at:end]
        fields = header_line(line, version)
        # The version block's own line may already have the fields of the version it announces.
        if line.startswith(b"filedesc:") and (named := re.match(rb"([12]) ", data[end + 1:end + 3])):
            version = int(named[1])
            fields = header_line(line, version) or header_line(line, 1)
        if fields is None:
            at = end + 1
            continue
        start = end + 1
        stop = start + int(fields["Archive-length"])
        yield at, fields, data[start:stop], stop > len(data)
        at = stop


def warc_date(digits: str) -> str:
    """A date of 4 to 14 digits as WARC writes it; the epoch if there is no such date."""
    full = digits + "00000101000000"[len(digits):]
    try:
        return datetime.strptime(full, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ").rjust(20, "0")
    except ValueError:
        return "1970-01-01T00:00:00Z"


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """Header, with the empty line after it, and body of an HTTP message."""
    found = re.search(rb"\r?\n\r?\n", block)
    return (block[:found.end()], block[found.end():]) if found else (block, b"")


def key_of(head: bytes) -> int | None:
    found = re.search(rb"(?im)^x-page-id: *(-?[0-9]{1,19})\r?$", head)
    return int(found[1]) if found else None


def _converted(path: str, data: bytes, bodies: bool) -> Iterator[dict]:
    name = "/".join(path.rsplit("/", 2)[-2:])
    for at, fields, block, short in arc_entries(data):
        url, mime = fields["URL"], fields["Content-type"]
        head, payload = b"", block
        if url.startswith("filedesc:"):
            kind, content = "warcinfo", "application/warc-fields"
            payload = b"format: WARC File Format 1.0\r\ndescription: converted from " + url.encode() + b"\r\n"
        elif url.lower().startswith(("http:", "https:", "about:")) and block.startswith(b"HTTP/"):
            kind, content = "response", "application/http; msgtype=response"
            head, payload = split_http(block)
        else:
            kind, content = "resource", mime if "/" in mime else "application/octet-stream"
        row = {"record_id": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{at}')}>", "warc_type": kind,
               "warc_date": warc_date(fields["Archive-date"]), "target_uri": url, "ip": fields["IP-address"], "content_type": content,
               "payload_digest": sha1(payload), "same": hashlib.sha256(payload).digest(), "payload_bytes": len(payload),
               "page_id": key_of(head), "truncated": short, "payload": b""}
        yield row | {"head": head, "payload": payload} if bodies else row


def from_arc(spark: SparkSession, folder: str, bodies: bool = True) -> DataFrame:
    """WARC records equivalent to those of the ARC archives below ``folder``.

    ``record_id`` (a UUID of archive name and place, so the same on every run), ``warc_type`` (``warcinfo`` for version blocks, ``response``
    for HTTP responses, else ``resource``), ``warc_date``, ``target_uri``, ``ip``, ``content_type``, ``payload_digest`` (SHA-1, base 32),
    ``same`` (SHA-256 of the payload, by which payloads are held to be equal), ``payload_bytes``, ``page_id`` (of the ``X-Page-Id`` header),
    ``truncated`` (the archive ends before the declared length) and, with ``bodies``, ``head`` (HTTP header) and ``payload``.
    """
    return read_archives(spark, folder, lambda path, data: _converted(path, data, bodies), RECORD + BODIES * bodies)


# ---- WARC

def originals(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``same, first_id, first_uri, first_date`` of payloads of at least ``least_bytes`` that several responses have.

    The first is the response with the largest ``page_id`` (null: the smallest), then ``record_id``. Only maxima are shuffled.
    """
    rank = F.struct("page_id", "record_id", "target_uri", "warc_date")
    return cut(records.filter((F.col("warc_type") == "response") & (F.col("payload_bytes") >= least_bytes)).groupBy("same").agg(
        F.count(F.lit(1)).alias("n"), F.max(rank).alias("first")).filter("n > 1").select(
        "same", F.col("first.record_id").alias("first_id"), F.col("first.target_uri").alias("first_uri"),
        F.col("first.warc_date").alias("first_date")))


def _warc_records(batch: pa.RecordBatch) -> Iterator[bytes]:
    names = batch.schema.names
    for values in zip(*[batch.column(c).to_pylist() for c in names]):
        row = dict(zip(names, values))
        again = row["warc_type"] == "response" and row["first_id"] is not None and row["first_id"] != row["record_id"]
        block = row["head"] + (b"" if again else row["payload"]) if row["warc_type"] == "response" else row["payload"]
        fields = {"WARC-Type": "revisit" if again else row["warc_type"], "WARC-Record-ID": row["record_id"], "WARC-Date": row["warc_date"],
                  "WARC-Target-URI": row["target_uri"] if row["warc_type"] != "warcinfo" else None, "WARC-IP-Address": row["ip"],
                  "WARC-Payload-Digest": f"sha1:{row['payload_digest']}", "WARC-Block-Digest": f"sha1:{sha1(block)}",
                  "WARC-Truncated": "unspecified" if row["truncated"] else None}
        if again:
            fields |= {"WARC-Profile": SAME_PAYLOAD, "WARC-Refers-To": row["first_id"], "WARC-Refers-To-Target-URI": row["first_uri"],
                       "WARC-Refers-To-Date": row["first_date"]}
        fields |= {"Content-Type": row["content_type"], "Content-Length": len(block)}
        lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
        yield f"WARC/1.0\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def write_warc(records: DataFrame, first: DataFrame, folder: str, limit: int = ARCHIVE_BYTES) -> None:
    """Write records of :func:`from_arc` as WARC archives; responses that repeat one of ``first`` become revisits without its payload.

    ``first`` is broadcast only while it is measured small; then payloads are not shuffled.
    """
    head = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:%s>\r\nWARC-Date: 2001-01-01T00:00:00Z\r\n" \
           b"Content-Type: application/warc-fields\r\nContent-Length: 30\r\n\r\nformat: WARC File Format 1.0\r\n\r\n\r\n"
    write_archives(lookup(records, first, "same", "left"), lambda file: head % str(uuid.uuid4()).encode(), _warc_records, folder, limit)


def _warc_entries(path: str, data: bytes) -> Iterator[dict]:
    at = 0
    while (at := data.find(b"WARC/1.", at)) >= 0:
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in data[at:end].decode("utf-8", "replace").split("\r\n")[1:])}
        size = int(fields.get("content-length", "0"))
        block = data[end + 4:end + 4 + size]
        http = fields.get("content-type", "").startswith("application/http")
        head, payload = split_http(block) if http else (b"", block)
        yield {"record_id": fields.get("warc-record-id"), "warc_type": fields.get("warc-type"), "warc_date": fields.get("warc-date"),
               "target_uri": fields.get("warc-target-uri"), "refers_to": fields.get("warc-refers-to"),
               "declared_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:"), "payload_digest": sha1(payload),
               "payload_bytes": len(payload), "page_id": key_of(head), "head": head, "payload": payload}
        at = end + 4 + size


READ = ("record_id string, warc_type string, warc_date string, target_uri string, refers_to string, declared_digest string, "
        "payload_digest string, payload_bytes long, page_id long")


def read_warc(spark: SparkSession, folder: str, bodies: bool = True) -> DataFrame:
    """Records of the WARC archives below ``folder``, by their declared lengths; digest and length are those of the payload read."""
    return read_archives(spark, folder, _warc_entries, READ + BODIES * bodies)


def page_records(read: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to``: a row per response or revisit that was read.

    A revisit's payload is that of the response it refers to, and ``refers_to`` that one's ``page_id``; where that response was not read,
    the length is null and the digest the one declared.
    """
    responses = read.filter("warc_type = 'response'")
    target = responses.select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("target"), F.col("payload_bytes").alias("bytes"),
                              F.col("payload_digest").alias("digest"))
    revisits = read.filter("warc_type = 'revisit'").select("page_id", "refers_to", "declared_digest").join(target, "refers_to", "left")
    return responses.select("page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"),
                            F.lit(None).cast("long").alias("refers_to")).union(
        revisits.select("page_id", "bytes", F.coalesce("digest", "declared_digest"), F.lit("revisit"), "target"))


def convert_pages(pages: DataFrame, version: int = 1, least_bytes: int = 0, limit: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages`` as legacy archives, convert these to WARC, read the result back: :func:`page_records` of it.

    Of responses with equal payloads of ``least_bytes`` or more, that with the largest ``page_id`` stays a response (of rows that repeat it,
    one), the others revisit it. A null ``page_id`` stays null and is the smallest; null html is an empty payload; other
    columns are not looked at. No pages give no rows. The ARC archives are deleted once they are converted.
    """
    spark = pages.sparkSession
    legacy, converted = new_folder(spark, "arc"), new_folder(spark, "warc")
    write_arc(pages, legacy, version, limit=limit)
    write_warc(from_arc(spark, legacy), originals(from_arc(spark, legacy, bodies=False), least_bytes), converted, limit)
    delete_folder(spark, legacy)
    return page_records(cut(read_warc(spark, converted, bodies=False)))
