from __future__ import annotations

import gzip
import hashlib
import base64
import io

import pytest

from catchframe.llm import warc

PAGES = "page_id long, url string, html string, own string"


@pytest.fixture
def pages(spark):
    same = "<p>same</p>"
    return spark.createDataFrame([
        (7, "http://a/7", same, "x"), (3, "http://a/3", same, "x"), (9, None, same, None), (3, "http://a/3", same, "x"),
        (None, "http://a/none", same, "x"), (4, "http://a/4", "é" * 70_000, "x"), (5, "http://a/5", None, "x"), (6, "u\r\nX: y", "", "x"),
    ], PAGES)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip(spark, pages):
    got = sorted((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in warc.round_trip(spark, pages).collect() if r.page_id)
    same, size = digest("<p>same</p>"), len("<p>same</p>")
    assert got == [
        (3, "response", None, size, same), (3, "response", None, size, same), (4, "response", None, 140_000, digest("é" * 70_000)),
        (5, "response", None, 0, digest("")), (6, "revisit", 5, 0, digest("")),
        (7, "revisit", 3, size, same), (9, "revisit", 3, size, same),
    ]
    rows = warc.round_trip(spark, pages).collect()
    assert [(r.record_type, r.refers_to) for r in rows if r.page_id is None] == [("revisit", 3)]
    assert warc.round_trip(spark, spark.createDataFrame([], PAGES)).count() == 0


def test_small_payloads_are_all_responses(pages):
    rows = warc.with_responses(pages, least_bytes=100).collect()
    assert all(r.refers is None for r in rows)


def test_payloads_come_back(spark, pages):
    listed = warc.write_archives(warc.with_responses(pages), archive_bytes=400)
    assert listed.count() > 1 and listed.agg({"records": "sum"}).first()[0] == 8
    back = warc.read_archives(spark, listed, with_payload=True).collect()
    assert {bytes(r.payload).decode() for r in back if r.record_type == "response"} == {"<p>same</p>", "é" * 70_000, ""}
    ids = {r.record_id for r in back}
    assert all(r.refers_to_record in ids for r in back if r.record_type == "revisit")


def test_members_are_whole_gzip_files_and_damage_is_seen():
    records = [warc.make_record(1, "http://a", b"x" * 600_000, None), warc.make_record(2, "http://b", b"x" * 600_000, (1, "http://a"))]
    data = b"".join(gzip.compress(r) for r in records)
    got = list(warc.read_archive(lambda: io.BytesIO(data), with_payload=True))
    assert [r["record_type"] for r in got] == ["response", "revisit"] and got[0]["payload"] == b"x" * 600_000
    assert gzip.decompress(data[got[1]["offset"]:]) == records[1]
    wrong = records[0].replace(b"xxx", b"xyx", 1)
    with pytest.raises(ValueError, match="digest"):
        list(warc.read_archive(lambda: io.BytesIO(gzip.compress(wrong))))
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.read_archive(lambda: io.BytesIO(data[:-9])))
    with pytest.raises(ValueError, match="shorter"):
        list(warc.read_archive(lambda: io.BytesIO(gzip.compress(records[0][:-5_000]))))


def record(kind, block, *lines, content="application/http;msgtype=response"):
    head = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:x:{kind}>", f"Content-Type: {content}", *lines, f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


END = b"\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nX: 1\r\n"
CHUNKED = HTTP + b"Transfer-Encoding: chunked\r\n\r\n4;a=b\r\nwiki\r\n5\r\npedia\r\n0\r\n\r\n"


def foreign():
    body = b"<p>x</p>"
    return [
        record("warcinfo", b"software: x\r\n", content="application/warc-fields"),
        record("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", "WARC-Target-URI: http://a/", content="application/http;msgtype=request"),
        record("response", HTTP + b"\r\n" + body, "WARC-Target-URI: http://a/", f"WARC-Payload-Digest: sha1:{hashlib.sha1(body).hexdigest()}"),
        record("response", CHUNKED, f"WARC-Payload-Digest: SHA1:{digest('wikipedia')}", "Folded: a", " b"),
        record("response", CHUNKED, f"WARC-Payload-Digest: sha1:{digest(CHUNKED.partition(END)[2].decode())}"),
        record("response", HTTP + b"Content-Length: 99\r\n\r\n" + body, f"WARC-Block-Digest: md5:{hashlib.md5(HTTP + b'Content-Length: 99' + END + body).hexdigest()}"),
        record("metadata", b"", "WARC-Payload-Digest: blake9:xyz", content="application/warc-fields"),
        record("resource", "é".encode(), content="text/plain"),
        record("revisit", HTTP + b"Content-Length: 8\r\n\r\n", "WARC-Refers-To: <urn:x:response>", "Page-ID: one"),
    ]


KINDS = ["warcinfo", "request", "response", "response", "response", "response", "metadata", "resource", "revisit"]
BODIES = [b"software: x\r\n", b"", b"<p>x</p>", b"wikipedia", b"wikipedia", b"<p>x</p>", b"", "é".encode(), None]


@pytest.mark.parametrize("form", ["members", "one member", "plain"])
def test_archives_of_other_writers(form, monkeypatch):
    records = foreign()
    data = {"members": b"".join(map(gzip.compress, records)), "one member": gzip.compress(b"".join(records)), "plain": b"".join(records)}[form]
    for chunk in (warc.CHUNK, 7):
        monkeypatch.setattr(warc, "CHUNK", chunk)
        got = list(warc.read_archive(lambda: io.BytesIO(data), with_payload=True))
        assert [r["record_type"] for r in got] == KINDS and [r["payload"] for r in got] == BODIES
        assert [r["payload_bytes"] for r in got] == [13, 0, 8, 9, 9, 8, 0, 2, 8]
        assert got[5]["payload_digest"] == digest("<p>x</p>") and got[8]["payload_digest"] is None and got[8]["page_id"] is None
        assert got[8]["refers_to_record"] == "<urn:x:response>" and got[1]["url"] == "http://a/"
    assert list(warc.read_archive(lambda: io.BytesIO(b""))) == []


def test_stated_digests_of_other_writers_are_checked():
    for bad in (
        record("resource", b"x", f"WARC-Block-Digest: sha256:{hashlib.sha256(b'y').hexdigest()}", content="text/plain"),
        record("response", CHUNKED, f"WARC-Payload-Digest: sha1:{digest('other')}"),
    ):
        with pytest.raises(ValueError, match="digest"):
            list(warc.read_archive(lambda: io.BytesIO(gzip.compress(bad))))
    with pytest.raises(ValueError, match="without a length"):
        list(warc.read_archive(lambda: io.BytesIO(b"WARC/1.0\r\nWARC-Type: resource\r\n\r\n")))
    cut = record("response", HTTP + b"\r\n<p>", "WARC-Truncated: length", f"WARC-Payload-Digest: sha1:{digest('<p>x</p>')}")
    assert [r["payload_bytes"] for r in warc.read_archive(lambda: io.BytesIO(gzip.compress(cut)))] == [3]


def test_files_without_a_scheme_are_on_the_default_file_system(spark, tmp_path):
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, foreign())))
    assert warc.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    with pytest.raises(ValueError, match="file system"):
        warc.file_system("/shared/chk")
    listed = spark.createDataFrame([(f"{tmp_path}/a.warc.gz",), (f"file:{tmp_path}/a.warc.gz",), (None,)], "path string")
    got = warc.read_archives(spark, listed, with_payload=True)
    assert got.groupBy("archive").count().collect() == [(f"file:{tmp_path}/a.warc.gz", 2 * len(KINDS))]
