import gzip
import hashlib
import os

import pytest

from heliograph import session
from heliograph.llm import warc


def _round_trip(spark, rows, schema="page_id long, url string, html string"):
    path = session.run_dir(spark, "archives")
    warc.write_archives(spark.createDataFrame(rows, schema), path, per_file=3)
    return path, warc.resolve(session.materialise(warc.assemble(warc.read_records(spark, path)), "captures"))


BIG = "WARC/1.1\r\nContent-Length: 3\r\n\r\n\r\n\r\n" + "é" * 600


def test_round_trip(spark):
    rows = [
        (1, "http://a/b c\r\nX: y", BIG), (5, "http://a", BIG), (5, "http://a", BIG), (2, None, None), (3, "é", ""), (4, "http://a", "same"),
        (6, "http://a", "same"), (None, "http://n", "x" * 1000), (7, "http://n", "x" * 1000), (8, "u", "y" * 999), (9, "u", "y" * 999),
    ]
    path, found = _round_trip(spark, rows)
    got = []
    for r in found.collect():
        page = r["metadata"]["page_id"]
        got.append((page and int(page), r["full_bytes"], r["response"]["digest"], r["response"]["type"], r["refers_to"]))
        assert r["request"]["type"] == "request" and r["request"]["target_uri"] == r["response"]["target_uri"]
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        want.append([page, len(data), hashlib.sha1(data).hexdigest(), "response", None])
    want[0][3:] = ["revisit", "5"]
    want[1][3:] = ["revisit", "5"]  # of two equal rows one is the response
    want[7][3:] = ["revisit", "7"]
    assert sorted(got, key=repr) == sorted(map(tuple, want), key=repr)


def test_archives_are_whole_and_hold_the_payloads(spark):
    rows = [(i, f"http://h/{i}", f"<p>{i}</p>\r\n\r\n" * 80) for i in range(8)]
    path, _ = _round_trip(spark, rows)
    files = [f for f in os.listdir(path) if f.endswith(".gz")]
    assert len(files) >= 3
    for f in files:
        with gzip.open(os.path.join(path, f)) as stream:
            data = stream.read()  # a task without rows leaves an archive without records
            assert not data or data.startswith(b"WARC/1.1\r\n")
    records = warc.read_records(spark, path, payloads=True).filter("type = 'response'").collect()
    assert sorted(bytes(r["payload"]).decode() for r in records) == sorted(h for _, _, h in rows)


def test_broken_payload_is_noticed():
    block = b"HTTP/1.1 200 OK\r\n\r\nabc"
    head = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nWARC-Payload-Digest: sha1:00\r\n"
    data = gzip.compress(head + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n")
    with pytest.raises(ValueError):
        list(warc._records(data, False))


def test_no_pages(spark):
    _, found = _round_trip(spark, [])
    assert found.count() == 0


def test_extra_columns(spark):
    rows = [(1, "u", "h", 9, 9)]
    _, found = _round_trip(spark, rows, "page_id long, url string, html string, row int, digest int")
    assert found.count() == 1
