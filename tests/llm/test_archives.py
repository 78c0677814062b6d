import base64
import gzip
import hashlib

import pytest

from twinline.llm import archives as ar

ARC = b"\n".join([
    b"filedesc://old.arc 127.0.0.1 19990101000000 text/plain 76",
    b"1 0 InternetArchive",
    b"URL IP-address Archive-date Content-type Archive-length\n"])


def test_parse_arc_by_declared_length():
    body = b"<html>\nhttp://trap/ 1.1.1.1 19990101000000 text/html 3\nabc</html>"
    one = b"http://a/ 1.2.3.4 19990102030405 text/html %d\n" % len(body) + body
    two = b"dns:a 1.2.3.4 199901020304 text/dns 2\nok"
    for content in (ARC + one + b"\n" + two + b"\n", gzip.compress(ARC + one) + gzip.compress(b"\n" + two)):
        got = list(ar.parse_arc(content, "old.arc"))
        assert [(h["URL"], b) for h, b in got] == [("http://a/", body), ("dns:a", b"ok")]
    assert ar.iso_date(got[1][0]["Archive-date"]) == "1999-01-02T03:04:00Z"
    with pytest.raises(ValueError, match="declares"):
        list(ar.parse_arc(ARC + one[:-5], "old.arc"))
    with pytest.raises(ValueError, match="header fields"):
        list(ar.parse_arc(ARC + b"http://a/ text/html 3\nabc", "old.arc"))
    with pytest.raises(ValueError, match="version block"):
        list(ar.parse_arc(one, "old.arc"))
    assert list(ar.parse_arc(b"", "old.arc")) == []


def test_version_two_fields():
    start = ar.arc_start(2, "x.arc")
    rec = ar.arc_record(2, "http://a/", "1.1.1.1", "20200101000000", "text/html", b"hi", "x.arc", len(start))
    (h, b), = ar.parse_arc(start + b"\n" + rec, "x.arc")
    assert b == b"hi" and h["Result-code"] == "200" and h["Checksum"] == hashlib.md5(b"hi").hexdigest()


def test_http_split():
    assert ar.split_http(b"HTTP/1.0 200 OK\nA: b\n\nx\r\n\r\ny") == (b"HTTP/1.0 200 OK\nA: b\n\n", b"x\r\n\r\ny")
    assert ar.split_http(b"plain\n\ntext") == (b"", b"plain\n\ntext")
    assert ar.http_field(b"HTTP/1.0 200 OK\r\ncontent-LENGTH: 7\r\n\r\n", "Content-Length") == "7"


BIG = "é" * 600
PAGES = [(1, "http://a/x y", BIG), (2, "http://a/", BIG), (3, None, "<p>short</p>"), (4, "http://b/\n", "<p>short</p>"), (5, "", None),
         (6, "http://c/", "WARC/1.1\r\n\r\nHTTP/1.1 200 OK\r\n\r\n" * 60), (7, "http://d/", "x" * 999), (8, "http://d/", "x" * 999),
         (9, "http://e/", "y" * 1000), (9, "http://e/", "y" * 1000), (None, "http://f/", BIG), (10, "http://g/", "z" * 3_000_000)]


def test_pages_through_archives(spark):
    df = spark.createDataFrame([(*p, 1) for p in PAGES], "page_id long, url string, html string, payload_digest int").repartition(3)
    got = ar.pages_through_archives(df).collect()
    assert len(got) == len(PAGES)
    want = sorted((p or 0, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest()) for p, _, h in PAGES)
    assert sorted((r["page_id"] or 0, r["payload_bytes"], r["payload_digest"]) for r in got) == want
    kinds = {(r["page_id"], r["record_type"], r["refers_to"]) for r in got}
    assert {(2, "response", None), (1, "revisit", 2), (None, "revisit", 2), (9, "response", None), (9, "revisit", 9)} <= kinds
    assert sum(r["record_type"] == "revisit" for r in got) == 3
    assert ar.pages_through_archives(df.limit(0)).count() == 0


def test_warc_fields(spark, tmp_path):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(2)
    arc, warc = str(tmp_path / "arc"), str(tmp_path / "warc")
    ar.write_arc(df, arc)
    ar.arc_to_warc(spark, arc, warc)
    rows = ar.read_warc(spark, warc).collect()
    assert {r["payload"].decode() for r in rows if r["payload"] is not None} == {h or "" for _, _, h in PAGES}
    files = list((tmp_path / "warc").glob("part-*.gz"))
    records = [x for f in files for x in ar.parse_warc(f.read_bytes(), f.name)]
    assert len({h["warc-record-id"] for h, _ in records}) == len(PAGES)
    for h, block in records:
        assert h["warc-block-digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
        assert h["content-type"] == "application/http;msgtype=response" and h["warc-date"].startswith("2020-01-01T")
        if h["warc-type"] == "revisit":
            assert h["warc-profile"] == ar.REVISIT_PROFILE and block.endswith(b"\r\n\r\n")
    # the same input gives the same identifiers
    warc2 = str(tmp_path / "warc2")
    ar.arc_to_warc(spark, arc, warc2)
    assert {r["record_id"] for r in ar.read_warc(spark, warc2).collect()} == {r["record_id"] for r in rows}
