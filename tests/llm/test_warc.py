import gzip
import hashlib

import pytest

from sluice import session
from sluice.llm import queries, warc

DATA = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string, size int, about string, original int"


def brute(rows):
    payload = [(i, (h or "").encode()) for i, h in rows]
    best = {}
    for i, p in payload:
        if len(p) >= 1000 and i is not None:
            best[p] = max(best.get(p, i), i)
    out = []
    for i, p in payload:
        other = best.get(p) if best.get(p) != i else None
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "response" if other is None else "revisit", other))
    return sorted(out, key=str)


def digests(spark, pages):
    folder = session.fresh_dir(spark, "archives")
    warc.write(pages, folder)
    found = warc.digests(warc.captures(warc.summaries(warc.read(spark, folder)))).collect()
    return sorted((tuple(r)[:5] for r in found), key=str), found, folder


def test_query_equals_brute_force(spark):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()]
    got = sorted((tuple(r) for r in queries.op4_warc(spark, DATA).collect()), key=str)
    assert got == brute(rows)


def test_edges(spark):
    big, odd = "x" * 5000, "ä\r\n\r\nWARC/1.1\r\n𝒳" * 200
    rows = [(1, "http://a/b?c#d", big), (2, None, big), (3, "no scheme", big), (3, "no scheme", big), (None, "http://n/", big)]
    rows += [(4, "http://a/\r\nX: y", odd), (5, "http://é/ü", odd), (6, "", None), (7, "http://a", ""), (8, "http://a", "y" * 999), (9, "http://a", "y" * 999)]
    rows += [(None, None, None), (10, "http://long", "z" * 3_000_000), (11, "u", "w" * 1000), (12, "u", "w" * 1000)]
    pages = spark.createDataFrame([(*r, 1, "a", 2) for r in rows], SCHEMA)
    got, found, _ = digests(spark, pages)
    assert got == brute([(i, h) for i, _, h in rows])
    assert {r.page_id: r.url for r in found if r.page_id in (1, 4)} == {1: "http://a/b?c#d", 4: "http://a/  X: y"}


def test_shuffled_join_of_shared_payloads(spark):
    rows = [(i, f"http://h/{i}", "p" * 2000 if i % 3 else str(i) * 1500) for i in range(30)]
    folder = session.fresh_dir(spark, "archives")
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"), folder, warc.Archives(broadcast=0))
    found = warc.digests(warc.captures(warc.summaries(warc.read(spark, folder)))).collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == brute([(i, h) for i, _, h in rows])


def test_empty_table(spark):
    assert digests(spark, spark.createDataFrame([], SCHEMA))[0] == []


def test_captures_are_nested_rows(spark):
    pages = spark.createDataFrame([(1, "http://h/p?q=1#f", "é" * 600)], "page_id long, url string, html string")
    _, _, folder = digests(spark, pages)
    row = warc.captures(warc.read(spark, folder)).collect()[0]
    assert bytes(row.response.payload).decode() == "é" * 600
    assert bytes(row.request.headers["warc-record-id"].encode()).decode() == row.capture == row.response.headers["warc-concurrent-to"] == row.metadata.headers["warc-concurrent-to"]
    assert row.request.http["host"] == "h" and row.response.http["content-length"] == "1200"


def test_incomplete_transactions(spark):
    schema = f"{warc.RECORD}, more int"
    records = [("request", "r1", None, {}, {}, None, b"", 1), ("response", "p2", "r2", {}, {}, None, b"x", 1), ("response", "p3", None, {}, {}, None, b"x", 1)]
    found = {r.capture: (r.request is not None, r.response is not None, r.metadata is not None) for r in warc.captures(spark.createDataFrame(records, schema)).collect()}
    assert found == {"r1": (True, False, False), "r2": (False, True, False)}


def test_archives_of_many_members_and_broken_ones():
    def one(n, body):
        return f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <{n}>\r\nX: a\r\n b\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"

    records = [one(i, b"\r\n\r\n" * i) for i in range(50)]
    for data in (b"".join(records), gzip.compress(b"".join(records)), b"".join(map(gzip.compress, records))):
        found = list(warc.parsed(data))
        assert [r["id"] for r in found] == [f"<{i}>" for i in range(50)] and [len(r["payload"]) for r in found] == [4 * i for i in range(50)]
        assert dict(found[0]["headers"])["x"] == "a b"
    assert list(warc.parsed(b"")) == []
    for data in (records[3][:-6], b"HTTP/1.1 200\r\n\r\n", b"WARC/1.0\r\nContent-Le"):
        with pytest.raises(ValueError):
            list(warc.parsed(data))
