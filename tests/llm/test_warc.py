"""Archives: exact round trip, member offsets, revisits."""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import zlib

import pytest

from quarry.llm import queries, store, warc

SF = "/root/testdata/sf0.001"
ROWS = [(1, "http://a/ b\r\nX: 1", "same", 9), (5, None, "same", 9), (3, "u", "same", 9), (2, "v", None, 9), (4, "w", "", 9), (7, "x", "é\r\n\r\nWARC/1.1\r\n" * 20_000, 9), (None, "n", "same", 9), (8, "y", "own", 9), (8, "y", "own", 9)]


def expected(rows, least=0):
    last = {}
    for page, html in rows:
        if page is not None:
            last[html or ""] = max(page, last.get(html or "", page))
    out = []
    for page, html in rows:
        raw = (html or "").encode()
        to = last.get(html or "")
        revisit = to is not None and to != page and len(raw) >= least
        out.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


@pytest.mark.parametrize("least", [0, 4])
def test_round_trip(spark, least):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string, last int")
    raw = warc.write(pages, store.folder(spark, "w"), least)
    made = warc.normalise(raw, store.folder(spark, "m"))
    assert sum(r.records for r in raw.collect()) == sum(r.records for r in made.collect()) == len(ROWS)
    rows = warc.read(made)
    assert result(rows) == expected([(p, h) for p, _, h, _ in ROWS], least)
    assert {(r.page_id, r.html) for r in rows.collect() if r.record_type == "response"} <= {(p, h or "") for p, _, h, _ in ROWS}
    for r in made.collect():
        with store.opened(r.path) as f, store.opened(f"{r.path}.idx") as g:
            raw_bytes, lines = f.read(), [json.loads(x) for x in g.read().splitlines()]
        assert [x["offset"] for x in lines] == [sum(y["length"] for y in lines[:i]) for i in range(len(lines))]
        whole = gzip.decompress(raw_bytes)
        assert b"".join(zlib.decompress(raw_bytes[x["offset"] : x["offset"] + x["length"]], 31) for x in lines) == whole


def test_query(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    assert result(queries.op6_warc_members(spark, SF)) == expected([(r.page_id, r.html) for r in pages.collect()])
    empty = warc.write(pages.limit(0), store.folder(spark, "w"))
    assert warc.read(warc.normalise(empty, store.folder(spark, "m"))).collect() == []


def test_broken_archives_are_errors(tmp_path):
    one = warc.record(1, "u", b"payload" * 1000, "D", None, 7000)
    path = str(tmp_path / "a.warc.gz")
    squeezed = gzip.compress(one + one) + gzip.compress(one)
    (tmp_path / "a.warc.gz").write_bytes(squeezed)
    assert [len(p) for _, p, _ in warc.records(warc.inflated(path, 64))] == [7000] * 3
    (tmp_path / "a.warc.gz").write_bytes(squeezed[:-30])
    with pytest.raises((ValueError, zlib.error)):
        list(warc.records(warc.inflated(path)))
    with pytest.raises(ValueError):
        list(warc.records(iter([one[:-10]])))
