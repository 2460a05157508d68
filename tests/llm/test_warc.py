import base64
import gzip
import hashlib
from pathlib import Path

from tidemart.llm import warc

PAGES = "page_id bigint, url string, html string, type string, content string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES)


CASES = [
    (1, "http://a.example/x?y#z", "<p>one</p>"),
    (2, "http://b.example/", "<p>one</p>"),
    (3, "http://c.example", "<p>one</p>"),
    (4, None, None),
    (5, "http://d.example/", ""),
    (6, "http://e.example/", "WARC/1.1\r\nContent-Length: 5\r\n\r\n\r\n\r\nWARC/1.1 é 日本 🎉"),
    (7, "odd\r\nurl", "x" * 3_000_000),
    (8, "http://f.example/", "only"),
]


def brute(rows, least=0):
    out = {}
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == data]
        first = max(same) if len(data) >= least else page
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out[page] = (len(data), digest, "response" if first == page else "revisit", None if first == page else first)
    return out


def test_report_equals_brute_force(spark):
    for least in (0, 5):
        got = warc.capture_report(pages(spark, CASES), least).collect()
        assert {r.page_id: tuple(r)[1:] for r in got} == brute(CASES, least) and len(got) == len(CASES)


def test_repeated_and_unnumbered_rows(spark):
    rows = [(1, "u", "a"), (1, "u", "a"), (None, "v", "b"), (2, "w", "b")]
    got = sorted(map(tuple, warc.capture_report(pages(spark, rows)).select("page_id", "record_type", "refers_to").collect()), key=str)
    assert got == [(1, "response", None), (2, "response", None), (None, "revisit", 2)]
    assert warc.capture_report(pages(spark, [])).count() == 0


def test_captures_are_nested_and_whole(spark, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_archives(pages(spark, CASES), path, rows_a_file=4)
    rows = warc.captures(warc.read_records(spark, path)).collect()
    by_uri = {r.response.target_uri: r for r in rows}
    assert by_uri["http://e.example/"].response.payload.decode() == CASES[5][2]
    for r in rows:
        assert f"sha1:{r.response.payload_digest}" == r.response.declared_digest or r.response.type == "revisit"
        assert b"GET /" in r.request.content and r.metadata.content.startswith(b"page-id: ")
    assert b"GET /x?y HTTP/1.1\r\nHost: a.example" in by_uri["http://a.example/x?y#z"].request.content


def test_archives_are_standard_gzip(spark, tmp_path):
    path = tmp_path / "archive"
    warc.write_archives(pages(spark, CASES[:1]), str(path))
    data = b"".join(gzip.decompress(p.read_bytes()) for p in Path(path).glob("part-*.gz"))
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: request\r\n") and data.endswith(b"\r\n\r\n")


def test_reader_takes_members_and_plain_files():
    one = b"WARC/1.1\r\nWARC-Type: x\r\nContent-Length: 4\r\n\r\nab\r\n\r\n\r\n"
    found = [(f["warc-type"], c) for f, c in warc.parse(memoryview(one * 3))]
    assert found == [("x", b"ab\r\n")] * 3
    members = b"".join(gzip.compress(one) for _ in range(50))
    assert len(list(warc.parse(memoryview(members)))) == 50
    assert list(warc.parse(memoryview(b""))) == []
