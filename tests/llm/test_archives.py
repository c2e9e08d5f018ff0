import gzip
import hashlib

import pytest

from tributary.llm import archives as ar

# Written out by hand from the formats' descriptions.
V1 = b"filedesc://old.arc 0.0.0.0 19970101000000 text/plain %d\n" % len(b"1 0 Somebody\nURL IP-address Archive-date Content-type Archive-length\n") + b"1 0 Somebody\nURL IP-address Archive-date Content-type Archive-length\n\n"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, "http://a/", "<p>é</p>"), (2, "http://b/", "same"), (5, "http://c d/\n", "same"), (5, "http://c d/\n", "same"), (4, None, None), (9, "http://e/", ""), (7, "u", "WARC/1.1\r\n\r\nx\r\n\r\n" * 3), (None, "http://n/", "same"), (11, "v", "y" * 300_000)]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string")


def expected(rows):
    out = []
    for key, _, html in rows:
        data = (html or "").encode()
        same = [k for k, _, h in rows if (h or "") == (html or "") and k is not None]
        first = max(same, default=None)
        kind = "response" if key == first else "revisit"
        out.append((key, len(data), ar.base32_sha1(data), kind, None if kind == "response" else first))
    return sorted(out, key=str)


def convert(spark, df, tmp_path, **options):
    arc, warc = str(tmp_path / "arc"), str(tmp_path / "warc")
    ar.write_arc(df, arc, segment=options.get("segment", ar.SEGMENT))
    ar.convert(spark, arc, warc, **options)
    return warc


@pytest.mark.parametrize("segment", [1, ar.SEGMENT])
def test_round_trip(spark, pages, tmp_path, segment):
    rows, df = pages
    warc = convert(spark, df, tmp_path, segment=segment)
    found = ar.read_warc(spark, warc).collect()
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found), key=str) == expected(rows)
    html = {k: (h or "").encode() for k, _, h in rows}
    assert all(bytes(r["payload"]) == html[r["page_id"]] for r in found if r["record_type"] == "response")
    assert all(r["target"] and " " not in r["target"] for r in found)


def test_columns_that_clash_and_empty_tables(spark, pages, tmp_path):
    from pyspark.sql import functions as F

    rows, df = pages
    extra = df.select("*", *[F.lit(1).alias(c) for c in ("key", "digest", "first", "payload", "content", "record", "blob")])
    assert ar.read_warc(spark, convert(spark, extra, tmp_path)).count() == len(rows)
    assert ar.read_warc(spark, convert(spark, df.limit(0), tmp_path / "none")).collect() == []


def test_small_payloads_are_never_revisits(spark, pages, tmp_path):
    found = ar.read_warc(spark, convert(spark, pages[1], tmp_path, min_payload=5)).collect()
    assert {r["record_type"] for r in found} == {"response"}


def test_version_1_and_2_headers():
    body = b"HTTP/1.0 200 OK\r\nX: 1\r\n\r\nhello\nworld"
    one = V1 + b"http://a/ 10.0.0.1 19970203040506 text/html %d\n" % len(body) + body + b"\n" + b"dns:a 10.0.0.1 19970203040506 text/dns 3\nabc\n"
    found = list(ar.parse_arc(one))
    assert [(r["URL"], r["Archive-date"], r["content"], r["truncated"]) for r in found] == [("http://a/", "19970203040506", body, False), ("dns:a", "19970203040506", b"abc", False)]
    two = ar.arc_head("new.arc", 2, "20000101000000") + ar.arc_record(2, "new.arc", 120, "http://b/", "10.0.0.2", "20000102030405", "text/plain", 404, b"gone")
    record = next(ar.parse_arc(gzip.compress(two[:100]) + gzip.compress(two[100:]) + b"\0\0"))
    assert (record["Result-code"], record["Filename"], record["content"]) == ("404", "new.arc", b"gone")
    assert next(ar.parse_arc(two[:-3]))["truncated"]


def test_warc_records_follow_the_standard():
    content = b"HTTP/1.1 200 OK\r\nContent-Length: 2\r\n\r\nhi"
    digest = ar.base32_sha1(b"hi")
    record = ar.to_warc(-7, digest, "http://a/", "10.0.0.1", "19970203", "text/html", True, content)
    fields, block = next(ar.parse_warc(record))
    assert block == content and record.endswith(b"hi\r\n\r\n")
    assert (fields["warc-type"], fields["warc-date"], fields["warc-truncated"]) == ("response", "1997-02-03T00:00:00Z", "length")
    assert ar.key_of(fields["warc-record-id"].strip("<>").removeprefix("urn:uuid:")) == -7
    fields, block = next(ar.parse_warc(ar.to_revisit(record, 12)))
    assert block == content[:-2] and fields["warc-type"] == "revisit" and fields["x-payload-bytes"] == "2"
    assert fields["warc-block-digest"] == "sha1:" + ar.base32_sha1(block)
    assert fields["warc-refers-to"] == f"<urn:uuid:{ar.record_id(12, digest)}>"
    assert next(ar.parse_warc(ar.to_warc(1, digest, "dns:a", "-", "1997", "text/dns", False, b"hi")))[0]["warc-type"] == "resource"
    assert len(hashlib.sha1(b"").digest()) == 20


def test_damaged_records_cost_themselves_alone(spark, tmp_path):
    """Bad lines, lengths and keys in the midst of good records."""
    ok = lambda k: b"HTTP/1.1 200 OK\r\nX-Archive-Key: %d\r\n\r\npage %d" % (k, k)
    record = lambda url, body, length=None: b"%s 10.0.0.1 19990102030405 text/html %d\n" % (url, len(body) if length is None else length) + body + b"\n"
    odd = b"HTTP/1.1 200 OK\r\nX-Archive-Key: 12 monkeys\r\n\r\nodd"
    huge = b"HTTP/1.1 200 OK\r\nX-Archive-Key: 99999999999999999999\r\n\r\nhuge"
    parts = [
        V1, record(b"http://a/", ok(1)), b"no header at all\nhttp://x/ 10.0.0.1 yesterday text/html many\n\xff\xfe\n", record(b"http://b b/", ok(2)), record(b"http://odd/", odd),
        record(b"http://short/", ok(3), 10), record(b"http://c/", ok(4)), record(b"http://huge/", huge), b"http://d/ 10.0.0.1 19990102030405 text/html 4 4x\n", record(b"http://\xff/", ok(5)), record(b"http://cut/", ok(6), 5000),
    ]
    data = b"".join(parts)
    found = list(ar.parse_arc(data))
    assert [r["URL"] for r in found if not r["URL"].startswith("urn:arc")] == ["http://a/", "http://b b/", "http://odd/", "http://short/", "http://c/", "http://huge/", "http://\ufffd/", "http://cut/"]
    damaged = [r["content"] for r in found if r["URL"].startswith("urn:arc")]
    assert damaged[0] == parts[2] and damaged[2] == parts[8] and len(damaged) == 3 and ok(3).endswith(damaged[1].rstrip(b"\n"))
    assert all(list(ar.parse_arc(x)) is not None for x in (b"", b"\n\n", b"\0", b"filedesc:", b"filedesc://x 0 0 t 9\nx 0 y\nbad\n"))
    folder = tmp_path / "arc"
    folder.mkdir()
    (folder / "one.arc").write_bytes(data)
    (folder / "two.arc.gz").write_bytes(b"".join(map(gzip.compress, parts)))
    ar.convert(spark, str(folder), str(tmp_path / "warc"))
    rows = ar.read_warc(spark, str(tmp_path / "warc")).collect()
    assert len(rows) == 22
    assert sorted(r["page_id"] for r in rows if r["page_id"] is not None) == sorted([1, 2, 4, 5, 6] * 2)
    assert sorted(bytes(r["payload"]) for r in rows if r["record_type"] == "resource").count(parts[2]) >= 1


def test_other_readers_open_the_files(spark, pages, tmp_path):
    """The files are plain gzip: other programs read each record, and may find them by an archive's extension."""
    import shutil
    import subprocess

    warc = convert(spark, pages[1], tmp_path)
    ar.rename_files(spark, warc, ".warc.gz")
    names = list((tmp_path / "warc").glob("*.warc.gz"))
    assert names and ar.read_warc(spark, warc).count() == len(pages[0])
    for name in names:
        with gzip.open(name) as file:
            data = file.read()
        assert data.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
        if shutil.which("gzip"):
            assert subprocess.run(["gzip", "-dcq"], input=name.read_bytes(), capture_output=True).stdout == data
