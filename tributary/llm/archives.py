"""Legacy ARC archives to WARC.

parse_arc() reads version 1 and version 2 ARC files, plain or gzipped by record: the version block names the header
fields, each record has one header line and as many bytes as that line declares. convert() turns a folder of ARC files
into WARC 1.1 files, gzipped by record: it synthesises record identifiers, ISO timestamps, record types and SHA-1
digests, and makes a revisit record of each payload that another record holds as well.

Files are written by Spark's text sink, one blob of bytes a file with a NUL after it, which gzip takes for padding, and
read by its binaryFile source, so any store that Spark reaches will do. A file ends after SEGMENT compressed bytes, so
no task holds more than that and one record. Payload digests are grouped without their payloads; a payload that a third
of all records share is aggregated on the map side and its join is split by Spark.

A record's key is the number in its HTTP header X-Archive-Key; records without one get a negative key made of archive and
offset. Of equal payloads the record with the largest key is the response, records with the same key are all responses.
Null payloads are empty; null URLs become `urn:page:` and the key; white space in URLs is percent-encoded. A record that
ends before its declared length is marked WARC-Truncated. Lines where a header line should be, up to the next one that has
the fields of its version, a numeric date and a numeric length, become one resource record of type
application/octet-stream, marked WARC-Truncated too: a damaged record costs itself and no more. An X-Archive-Key that is
no 64-bit number is as good as none. Files are named as the sink names them; rename_files() gives them an archive's
extension where a reader needs it. Empty tables give folders without records. Extra columns are
ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import quote

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SEGMENT, LEVEL = 8 << 20, 5
#: Output rows of a task go to Spark in batches of about this many bytes.
_BATCH = 4 << 20

# Field names of the ARC formats, in their order.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
#: Fields of a record without a header line, and of those that a header lacks.
DAMAGED = {"URL": "urn:arc:unknown", "IP-address": "-", "Archive-date": "", "Content-type": "application/octet-stream"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def zipped(data: bytes, level: int = LEVEL) -> bytes:
    """One gzip member."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def opened(data: bytes) -> bytes:
    """The bytes of a plain or gzipped file without the sink's padding."""
    if data[:2] == b"\x1f\x8b":
        with gzip.GzipFile(fileobj=io.BytesIO(data)) as file:
            return file.read()
    return data[:-1] if data[-1:] == b"\0" else data


# --- ARC -------------------------------------------------------------------------------------------------------------


def arc_head(name: str, version: int, date: str) -> bytes:
    """The version block of an ARC file."""
    body = f"{version} 0 tributary\n{' '.join(ARC_FIELDS[version])}\n".encode()
    rest = ["text/plain"] if version == 1 else ["text/plain", "200", "-", "-", "0", name]
    return f"filedesc://{name} 0.0.0.0 {date} {' '.join(rest)} {len(body)}\n".encode() + body + b"\n"


def arc_record(version: int, name: str, offset: int, url: str, ip: str, date: str, mime: str, code: int, content: bytes) -> bytes:
    middle = "" if version == 1 else f" {code} {hashlib.md5(content).hexdigest()} - {offset} {name}"
    return f"{url} {ip} {date} {mime}{middle} {len(content)}\n".encode() + content + b"\n"


def _header(line: bytes, fields: list[str]) -> list[bytes] | None:
    """The values of a header line, if it has all fields, a numeric date and a numeric length."""
    values = line.strip(b"\r").split(b" ") if line.startswith(b"filedesc:") else line.strip(b"\r").rsplit(b" ", len(fields) - 1)
    if len(values) < 2 or not values[-1].isdigit() or len(values[-1]) > 18:
        return None
    if not line.startswith(b"filedesc:") and (len(values) != len(fields) or "Archive-date" in fields and not values[fields.index("Archive-date")].isdigit()):
        return None
    return values


def parse_arc(data: bytes) -> Iterator[dict]:
    """Records as dicts of their header fields, content, offset and truncated; the version block is not among them.

    Lines that are no header are a record of their own, with DAMAGED for its fields.
    """
    data = opened(data)
    fields, at = ARC_FIELDS[1], 0
    damage = -1

    def damaged(end: int) -> Iterator[dict]:
        if damage >= 0 and data[damage:end].strip(b"\0\r\n "):
            yield DAMAGED | {"URL": f"urn:arc:damaged:{damage}", "content": data[damage:end], "offset": damage, "truncated": True}

    while at < len(data):
        end = data.find(b"\n", at)
        end = len(data) if end < 0 else end
        line = data[at:end]
        if not line.strip(b"\0\r "):
            at = end + 1
            continue
        values = _header(line, fields)
        if values is None:
            damage = at if damage < 0 else damage
            at = end + 1
            continue
        yield from damaged(at)
        damage = -1
        length = int(values[-1])
        content = data[end + 1 : end + 1 + length]
        if values[0].startswith(b"filedesc:"):
            lines = content.split(b"\n")
            version = lines[0].split(b" ")[0]
            named = lines[1].decode(errors="replace").split() if len(lines) > 1 else []
            fields = named if named and named[-1] == "Archive-length" else ARC_FIELDS.get(int(version) if version.isdigit() else 1, ARC_FIELDS[1])
        else:
            yield DAMAGED | dict(zip(fields, (v.decode(errors="replace") for v in values))) | {"content": content, "offset": at, "truncated": len(content) < length}
        at = end + 1 + length
    yield from damaged(len(data))


def _date(key: int) -> str:
    return (datetime(1999, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=abs(key) % 800_000_000)).strftime("%Y%m%d%H%M%S")


def _arc_batches(batches: Iterator[pa.RecordBatch], segment: int, level: int) -> Iterator[pa.RecordBatch]:
    parts: list[bytes] = []
    size, n = 0, 0
    name, version = "", 1

    def blob() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], ["blob"])

    for batch in batches:
        for key, url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), common.utf8(batch.column(2))):
            if not parts:
                version = 1 + n % 2
                name, n = f"{key}-{n}.arc.gz", n + 1
                parts.append(zipped(arc_head(name, version, _date(key or 0)), level))
                size = 0
            named = b"" if key is None else b"X-Archive-Key: %d\r\n" % key
            content = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + named + b"Content-Length: %d\r\n\r\n" % len(html) + html
            place = quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else f"urn:page:{key}"
            record = arc_record(version, name, size, place, "192.0.2.1", _date(key or 0), "text/html", 200, content)
            parts.append(zipped(record, level))
            size += len(parts[-1])
            if size >= segment:
                yield blob()
                parts = []
    if parts:
        yield blob()


def _write(blobs: DataFrame, path: str) -> None:
    blobs.select(F.col("blob").cast("string")).write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path)


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def rename_files(spark: SparkSession, path: str, extension: str) -> None:
    """Give the files of a folder another extension, as .warc.gz, in the store itself; one call to it for each file."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in store.listStatus(folder):
        name = status.getPath().getName()
        if name.endswith(".txt"):
            store.rename(status.getPath(), jvm.org.apache.hadoop.fs.Path(folder, name.removesuffix(".txt") + extension))


def write_arc(pages: DataFrame, path: str, key_col: str = "page_id", url_col: str = "url", payload_col: str = "html", segment: int = SEGMENT, level: int = LEVEL) -> None:
    """Pages as ARC files, version 1 and 2 in turn."""
    columns = [F.col(key_col).cast("bigint").alias("key"), F.col(url_col).cast("string").alias("url"), F.col(payload_col).alias("payload")]
    _write(pages.select(*columns).mapInArrow(lambda batches: _arc_batches(batches, segment, level), "blob binary"), path)


# --- ARC to WARC -----------------------------------------------------------------------------------------------------


def split_http(content: bytes) -> tuple[bytes, bytes, bool]:
    """Header block with its empty line, payload, and whether it is an HTTP message."""
    if not content.startswith(b"HTTP/"):
        return b"", content, False
    at, wide = content.find(b"\r\n\r\n"), 4
    if at < 0:
        at, wide = content.find(b"\n\n"), 2
    return (content, b"", True) if at < 0 else (content[: at + wide], content[at + wide :], True)


def http_field(head: bytes, name: bytes) -> str | None:
    for line in head.split(b"\n")[1:]:
        key, colon, value = line.partition(b":")
        if colon and key.strip().lower() == name:
            return value.strip().decode(errors="replace")
    return None


def named_key(head: bytes) -> int | None:
    """The number in X-Archive-Key, if there is one of 64 bits."""
    named = http_field(head, b"x-archive-key") or ""
    if not re.fullmatch("-?[0-9]{1,19}", named) or not -(1 << 63) <= int(named) < 1 << 63:
        return None
    return int(named)


def record_key(head: bytes, archive: str, offset: int) -> int:
    named = named_key(head)
    return named if named is not None else -1 - (xxhash.xxh64_intdigest(f"{archive}@{offset}") >> 1)


def record_id(key: int, digest: str) -> str:
    """A version 8 UUID of the key and the payload's digest."""
    raw = key & (1 << 64) - 1
    low = int.from_bytes(base64.b32decode(digest)[:6], "big") & (1 << 46) - 1
    return str(uuid.UUID(int=(raw >> 16) << 80 | 8 << 76 | 2 << 62 | (raw & 0xFFFF) << 46 | low))


def key_of(identifier: str) -> int:
    whole = uuid.UUID(identifier).int
    raw = (whole >> 80) << 16 | (whole >> 46) & 0xFFFF
    return raw - (1 << 64) if raw >> 63 else raw


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            rows = []
            for r in parse_arc(data.as_py()):
                head, payload, _ = split_http(r["content"])
                rows.append((record_key(head, path, r["offset"]), base32_sha1(payload), len(payload)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["key", "digest", "size"])


CONTENTS = "key bigint, digest string, record binary"


def _content_batches(batches: Iterator[pa.RecordBatch], level: int) -> Iterator[pa.RecordBatch]:
    """Finished records, as they are if they are no revisits."""
    names, kinds = ["key", "digest", "record"], [pa.int64(), pa.string(), pa.binary()]
    for batch in batches:
        for path, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            rows, size = [], 0
            for r in parse_arc(data.as_py()):
                head, payload, _ = split_http(r["content"])
                key, digest = record_key(head, path, r["offset"]), base32_sha1(payload)
                record = zipped(to_warc(key, digest, r["URL"], r["IP-address"], r["Archive-date"], r["Content-type"], r["truncated"], r["content"]), level)
                rows.append((key, digest, record))
                size += len(record)
                if size > _BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + f"Content-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def iso_date(date: str) -> str:
    """An ISO timestamp of the digits of an archive date; what they lack is that of the year's first second."""
    date = date if len(date) >= 4 else "1970"
    date = (date + "00000101000000"[len(date) :])[:14]
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:]}Z"


def to_warc(key: int, digest: str, url: str, ip: str, date: str, mime: str, truncated: bool, content: bytes) -> bytes:
    """A response record of an HTTP message, or a resource record of anything else."""
    http = split_http(content)[2]
    fields = [("WARC-Type", "response" if http else "resource"), ("WARC-Record-ID", f"<urn:uuid:{record_id(key, digest)}>"), ("WARC-Date", iso_date(date)), ("WARC-Target-URI", url)]
    fields += [("WARC-IP-Address", ip)] if ip not in ("", "-", "0.0.0.0") else []
    fields += [("WARC-Truncated", "length")] if truncated else []
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(content)}")]
    fields += [("Content-Type", "application/http; msgtype=response" if http else mime)]
    return warc_record(fields, content)


def to_revisit(record: bytes, refers_to: int) -> bytes:
    """The revisit record that stands for a record whose payload another one holds: its HTTP header without the payload."""
    at = record.index(b"\r\n\r\n")
    lines = [line.split(": ", 1) for line in record[:at].decode().split("\r\n")[1:]]
    head, payload, _ = split_http(record[at + 4 : -4])
    digest = next(v for k, v in lines if k == "WARC-Payload-Digest").removeprefix("sha1:")
    changed = {"WARC-Type": "revisit", "WARC-Block-Digest": f"sha1:{base32_sha1(head)}"}
    fields = [(k, changed.get(k, v)) for k, v in lines if k != "Content-Length"]
    return warc_record([*fields, ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:uuid:{record_id(refers_to, digest)}>"), ("X-Payload-Bytes", str(len(payload)))], head)


def _warc_batches(batches: Iterator[pa.RecordBatch], segment: int, level: int) -> Iterator[pa.RecordBatch]:
    parts: list[bytes] = []
    size = 0

    def blob() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], ["blob"])

    for batch in batches:
        for key, record, first in zip(*(c.to_pylist() for c in batch.columns)):
            if not parts:
                about = b"software: tributary\r\nformat: WARC File Format 1.1\r\n"
                named = uuid.uuid5(uuid.NAMESPACE_URL, f"warcinfo:{key}:{hashlib.sha1(record).hexdigest()}")
                date = next(parse_warc(record))[0]["warc-date"]
                parts.append(zipped(warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{named}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")], about), level))
                size = 0
            parts.append(record if first is None else zipped(to_revisit(zlib.decompress(record, 31), first), level))
            size += len(parts[-1])
            if size >= segment:
                yield blob()
                parts = []
    if parts:
        yield blob()


def convert(spark: SparkSession, arc_path: str, warc_path: str, min_payload: int = 0, segment: int = SEGMENT, level: int = LEVEL) -> None:
    """All ARC files of a folder to WARC files in another. Payloads of fewer than min_payload bytes never become revisits."""
    arcs = _read(spark, arc_path)
    held = arcs.mapInArrow(_digest_batches, "key bigint, digest string, size bigint").where(F.col("size") >= min_payload)
    first = held.groupBy("digest").agg(F.max("key").alias("first"), F.min("key").alias("least")).where("least < first").select("digest", "first")
    revisits = held.join(first, "digest").where("key < first").select("key", "digest", "first").distinct()
    contents = arcs.mapInArrow(lambda batches: _content_batches(batches, level), CONTENTS).join(revisits, ["key", "digest"], "left")
    _write(contents.select("key", "record", "first").mapInArrow(lambda batches: _warc_batches(batches, segment, level), "blob binary"), warc_path)


# --- WARC ------------------------------------------------------------------------------------------------------------


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record."""
    data = opened(data)
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        end = data.index(b"\r\n\r\n", at)
        fields = {}
        for line in data[at:end].split(b"\r\n")[1:]:
            key, _, value = line.decode().partition(":")
            fields[key.strip().lower()] = value.strip()
        length = int(fields["content-length"])
        yield fields, data[end + 4 : end + 4 + length]
        at = end + 4 + length


RECORDS = "page_id bigint, record_id string, record_type string, target string, date string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"


def _record_batches(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in RECORDS.split(", ")]
    kinds = [pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.int64(), pa.binary()]
    for batch in batches:
        for data in batch.column(0):
            rows, size = [], 0
            for fields, block in parse_warc(data.as_py()):
                kind = fields["warc-type"]
                if kind == "warcinfo":
                    continue
                head, payload, _ = split_http(block)
                key = key_of(fields["warc-record-id"].strip("<>").removeprefix("urn:uuid:"))
                digest = fields["warc-payload-digest"].removeprefix("sha1:")
                if kind != "revisit":
                    size_of = len(payload)
                    if base32_sha1(payload) != digest:
                        raise ValueError(f"record {fields['warc-record-id']}: the payload does not have its digest")
                else:
                    size_of = int(fields.get("x-payload-bytes") or http_field(head, b"content-length") or 0)
                refers = key_of(fields["warc-refers-to"].strip("<>").removeprefix("urn:uuid:")) if kind == "revisit" else None
                rows.append((named_key(head), fields["warc-record-id"], kind, fields.get("warc-target-uri"), fields.get("warc-date"), size_of, digest, refers, payload if payloads and kind != "revisit" else None))
                size += 200 + (len(payload) if payloads else 0)
                if size > _BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row per response, resource and revisit record; responses are held against their digests."""
    return _read(spark, path).select("content").mapInArrow(lambda batches: _record_batches(batches, payloads), RECORDS)


def op4_warc(spark, sf_dir: str) -> DataFrame:
    arc_path, warc_path = common.scratch(spark, "arc"), common.scratch(spark, "warc")
    write_arc(common.table(spark, sf_dir, "pages"), arc_path)
    convert(spark, arc_path, warc_path)
    return read_warc(spark, warc_path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS b FROM pages
), d AS (
  SELECT page_id, octet_length(b) AS n, sha1(b) AS h, max(page_id) OVER (PARTITION BY sha1(b)) AS first FROM p
), bits AS (
  SELECT *, array_to_string(list_transform(range(1, 41), lambda i: lpad(bin(CAST('0x' || substr(h, CAST(i AS INTEGER), 1) AS INTEGER)), 4, '0')), '') AS s FROM d
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + list_sum(list_transform(range(1, 6), lambda j: CAST(substr(s, CAST(5 * k + j AS INTEGER), 1) AS INTEGER) * (1 << CAST(5 - j AS INTEGER)))) AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM bits
"""
