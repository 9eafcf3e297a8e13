import base64
import gzip
import hashlib
import io

import pytest

from skein.llm import arc
from skein.session import new_folder

SCHEMA = "page_id long, url string, html string, head string, same string, first_id int, file int"


def b32(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(rows, least=0):
    best = {}
    for page, _, html in rows:
        data = (html or "").encode()
        best[data] = max(best.get(data, (False, 0)), (page is not None, page or 0))
    out, used = [], set()
    for page, _, html in sorted(rows, key=lambda r: repr(r[0])):
        data = (html or "").encode()
        first = best[data][1] if best[data][0] else None
        again = len(data) >= least and not (page == first and data not in used)
        if not again:
            used.add(data)
        out.append((page, len(data), b32(html), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "h", "s", 1, 2) for r in rows], SCHEMA).repartition(3)


def found(spark, rows, **options):
    return sorted((tuple(r) for r in arc.convert_pages(frame(spark, rows), **options).collect()), key=repr)


PAGES = [(1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (3, "https://b/ c\n", None), (4, None, ""), (5, "", "WARC/1.0\r\n\r\nx"),
         (6, "http://é/ü", "é\x00日本\r\n\r\nhttp://x 0.0.0.0 20010101000000 text/html 3\nabc"), (7, "http://l", "long " * 900_000), (8, "http://l2", "long " * 900_000),
         (None, "http://n", "null id"), (None, "http://n", "null id"), (9, "http://d", "twice"), (9, "http://d", "twice"), (-5, "http://m", "<p>one</p>")]


@pytest.mark.parametrize("version", [1, 2])
def test_pages_go_through_arc_and_warc(spark, version):
    assert found(spark, PAGES, version=version) == brute(PAGES)


def test_small_payloads_and_small_archives(spark):
    rows = [(i, f"http://h/{i}", "x" * (i % 7)) for i in range(80)]
    assert found(spark, rows, least_bytes=4, limit=2000) == brute(rows, 4)


def test_no_pages_give_no_rows(spark):
    assert found(spark, []) == []


def test_one_payload_shared_by_most_pages(spark):
    rows = [(i, f"http://h/{i}", "same" if i % 10 else f"own {i}") for i in range(500)]
    assert found(spark, rows) == brute(rows)


def test_written_archives_are_plain_gzip_with_declared_lengths(spark):
    folder = new_folder(spark, "arc")
    arc.write_arc(frame(spark, PAGES[:6]), folder, 2)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).collect()
    pages = 0
    for file in files:
        data = gzip.GzipFile(fileobj=io.BytesIO(bytes(file.content))).read()
        entries = list(arc.arc_entries(data))
        assert entries[0][1]["URL"].startswith("filedesc://") and entries[0][2].startswith(b"2 0 ")
        assert data.startswith(b"filedesc://")
        pages += len(entries) - 1
    assert pages == 6


def entry(line, block, declared=None):
    return b"%s %d\n%s\n" % (line, len(block) if declared is None else declared, block)


OLD = (entry(b"filedesc://old.arc 0.0.0.0 19970916000000 text/plain", f"1 0 Someone\n{arc.FIELDS[1]}\n".encode()) + b"\n\n"
       + entry(b"http://www.example.org:80/a b.html 192.0.2.1 19970917 text/html", b"HTTP/1.0 200 OK\nServer: old\n\n<html>x</html>\n")
       + b"this line is no header\n"
       + entry(b"dns:www.example.org 192.0.2.1 199709170102 text/dns", b"127.0.0.1")
       + entry(b"ftp://example.org/x 192.0.2.1 19979999000000 no-type", b"abcd")
       + entry(b"http://example.org/cut 192.0.2.1 19970917010203 text/html", b"HTTP/1.0 200 OK\r\n\r\nshort", 99)[:-1])


def test_an_old_archive_with_damage():
    rows = list(arc._converted("s3/dir/old.arc", OLD, True))
    assert [(r["warc_type"], r["target_uri"], r["warc_date"], r["content_type"].split(";")[0], r["payload"], r["truncated"]) for r in rows[1:]] == [
        ("response", "http://www.example.org:80/a b.html", "1997-09-17T00:00:00Z", "application/http", b"<html>x</html>\n", False),
        ("resource", "dns:www.example.org", "1997-09-17T01:02:00Z", "text/dns", b"127.0.0.1", False),
        ("resource", "ftp://example.org/x", "1970-01-01T00:00:00Z", "application/octet-stream", b"abcd", False),
        ("response", "http://example.org/cut", "1997-09-17T01:02:03Z", "application/http", b"short", True)]
    assert rows[0]["warc_type"] == "warcinfo" and len({r["record_id"] for r in rows}) == 5
    assert [r["record_id"] for r in rows] == [r["record_id"] for r in arc._converted("x/dir/old.arc", OLD, True)]


def test_a_version_two_archive():
    body = f"2 0 Someone\n{arc.FIELDS[2]}\n".encode()
    block = b"HTTP/1.1 404 Not Found\r\nX-Page-Id: 12\r\n\r\ngone"
    data = (b"filedesc://v2.arc 0.0.0.0 20000101000000 text/plain 200 - - 0 v2.arc %d\n%s\nhttp://e.org/ 192.0.2.7 20000102030405 text/html 404 abc - 120 v2.arc %d\n%s\n"
            % (len(body), body, len(block), block))
    info, page = arc._converted("d/v2.arc", data, True)
    assert (page["page_id"], page["payload"], page["warc_date"], page["ip"], info["warc_type"]) == (12, b"gone", "2000-01-02T03:04:05Z", "192.0.2.7", "warcinfo")
