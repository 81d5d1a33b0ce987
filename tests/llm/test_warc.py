import base64
import gzip
import hashlib
import io

import pytest

from churnwatch.llm import queries, warc
from tests.conftest import SF01


def brute(rows):
    first = {}
    for page, _, html in rows:
        d = base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()
        first[d] = min(first.get(d, page), page)
    out = []
    for page, _, html in rows:
        b = (html or "").encode()
        d = base64.b32encode(hashlib.sha1(b).digest()).decode()
        out.append((page, len(b), d, "response" if first[d] == page else "revisit", None if first[d] == page else first[d]))
    return sorted(out)


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/pages.parquet").select("page_id", "url", "html").collect()]
    got = sorted(tuple(r) for r in queries.op8_warc_transactions(spark, SF01).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())
    assert got == brute(rows)


def test_odd_pages(spark):
    trap = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(5, "http://h/a b?q=1#f", trap), (3, None, trap), (9, "bad url\r\nX: y", None), (8, "", ""), (None, "http://h", trap), (7, "http://é/ü", "é漢😀"), (7, "http://é/ü", "é漢😀"), (1, "u", "x" * 200_000)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, row string").drop("row")
    got = warc.round_trip(spark, df, with_payload=True).collect()
    assert len(got) == len(rows)
    kinds = sorted((str(r.page_id), r.response.kind, r.refers_to_page) for r in got)
    assert kinds == [("1", "response", None), ("3", "response", None), ("5", "revisit", 3), ("7", "response", None), ("7", "revisit", 7), ("8", "response", None), ("9", "revisit", 8), ("None", "revisit", 3)]
    by = {r.page_id: r for r in got if r.response.kind == "response"}
    assert bytes(by[3].response.payload) == trap.encode() and bytes(by[1].response.payload) == b"x" * 200_000
    assert all(r.request is not None and r.metadata is not None for r in got)
    assert warc.round_trip(spark, df.limit(0)).count() == 0


def test_archives_are_plain_records(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://h/p", "<p>"), (2, "http://h/q", "<p>")], "page_id long, url string, html string")
    warc.write_archives(df, f"{tmp_path}/w")
    records = [r for f in sorted((tmp_path / "w").glob("part-*.gz")) for r in warc.parse(gzip.open(f), f.name, True)]
    assert sorted(r[1] for r in records) == ["metadata", "metadata", "request", "request", "response", "revisit"]
    assert len({r[2] for r in records}) == 6
    broken = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 30\r\n\r\nHTTP/1.1 200 OK\r\n\r\nx"
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.parse(io.BytesIO(broken), "f", True))


def test_least_bytes(spark):
    rows = spark.createDataFrame([("a", 1, "d", 3), ("b", 2, "d", 3), ("c", 3, "e", 9), ("d", 4, "e", 9)], "row string, page_id long, digest string, bytes long")
    assert [tuple(r) for r in warc.revisits(rows, 5).collect()] == [("d", "c", 3)]
