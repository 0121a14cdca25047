"""WARC: exact round trip, magics inside payloads, revisits, damaged archives, odd rows."""

import glob
import hashlib
import re

import pytest
from candor.llm import warc as W
from candor.llm.common import scratch

PAGES = "page_id bigint, url string, html string, path string, offset int, row string, n int"
FAKE = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
ROWS = [
    (1, "http://a.example/x", "<p>one</p>"), (2, None, None), (3, "http://a.example/ b\r\nc", ""),
    (4, "u", FAKE * 3), (5, "u", "WARC/1.0\r\n" * 400), (6, "u", "x" * 999), (7, "u", "x" * 999),
    (8, "u", "é" * 500), (9, "u", "é" * 500), (9, "u", "é" * 500), (None, "u", "é" * 500), (10, "u", "<html>" + "long " * 60_000),
    (11, "u", FAKE + "y" * 2000), (12, "u", FAKE + "y" * 2000), (13, "u", "\r\n\r\n" * 300), (14, "ü", "日本 \x00 text"),
]


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "p", 1, "r", 2) for i, u, h in rows], PAGES)


def brute(rows):
    payload = [(h or "").encode() for *_, h in rows]
    out, done = [], set()
    for (i, _, _), p in zip(rows, payload, strict=True):
        group = [k if k is not None else -1 for (k, _, _), q in zip(rows, payload, strict=True) if q == p]
        first = len(p) < 1000 or (i if i is not None else -1) == max(group) and p not in done
        if first and len(p) >= 1000:
            done.add(p)
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "response" if first else "revisit", None if first else max(group)))
    return sorted(map(str, out))


@pytest.mark.parametrize("chunk", [64, 1000, 1 << 20])
def test_round_trip(spark, chunk):
    path = scratch(spark, "test-warc")
    W.write_pages(pages_of(spark, ROWS).coalesce(2), path)
    records = W.read_records(spark, path, chunk=chunk)
    got = records.collect()
    assert len(got) == len(ROWS)
    for r in got:
        if r["record_type"] == "response":
            assert r["declared"] == "sha1:" + hashlib.sha1(bytes(r["payload"])).hexdigest()
    assert sorted(str(tuple(r)) for r in W.described(records).collect()) == brute(ROWS)
    clean = {i: None if u is None else re.sub(r"[\x00-\x20\x7f]", "", u) for i, u, _ in ROWS}
    assert all(r["url"] == clean[int(r["page_id"]) if r["page_id"] else None] for r in got)


@pytest.mark.parametrize("chunk", [1000, 1 << 16, 1 << 20])
def test_headers_of_any_length(spark, chunk):
    long = "http://a.example/" + "x" * 70_000
    rows = [(1, long, "<p>one</p>"), (2, long * 3, FAKE + "z" * 100_000), (3, None, "q"), (4, long, FAKE + "z" * 100_000), (5, "u", "WARC/1.0\r\n" * 20_000)]
    path = scratch(spark, "test-warc")
    W.write_pages(pages_of(spark, rows).coalesce(1), path)
    records = W.read_records(spark, path, chunk=chunk)
    assert sorted(str(tuple(r)) for r in W.described(records).collect()) == brute(rows)
    assert {r["page_id"]: r["url"] for r in records.select("page_id", "url").collect()} == {str(i): u for i, u, _ in rows}


def test_chunks_alone_would_be_misled(spark):
    # a payload's own records chain among themselves; only reachability from the start tells them apart
    path = scratch(spark, "test-warc")
    W.write_pages(pages_of(spark, [(k, "u", FAKE * 20) for k in range(30)]).coalesce(1), path)
    data = open(glob.glob(re.sub("^file:", "", path) + "/part-*")[0], "rb").read()
    assert data.count(W.MAGIC) == 30 + 20  # equal payloads: one response, 29 revisits
    assert W.read_records(spark, path, chunk=128).count() == 30


def test_damaged_archive_raises(spark):
    path = scratch(spark, "test-warc")
    W.write_pages(pages_of(spark, ROWS).coalesce(1), path)
    name = glob.glob(re.sub("^file:", "", path) + "/part-*")[0]
    data = open(name, "rb").read()
    broken = re.sub("^file:", "", scratch(spark, "test-warc-broken"))
    import os

    os.makedirs(broken)
    with open(broken + "/part-0.txt", "wb") as f:
        f.write(data[:-5])
    with pytest.raises(ValueError, match="1 of 1 archives"):
        W.read_records(spark, broken)


def test_empty_table(spark):
    path = scratch(spark, "test-warc")
    W.write_pages(pages_of(spark, []), path)
    assert W.described(W.read_records(spark, path)).count() == 0
