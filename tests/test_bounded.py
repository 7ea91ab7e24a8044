"""Python steps hold a bounded part of their input at a time."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from quarry.operators import index as I
from quarry.operators import pages as P


def test_page_job_yields_a_few_pages_at_a_time():
    html = "<title>t</title><p>a</p><a href='/x'>y</a>"
    n = 4 * P.PARSE_PAGES + 3
    b = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(["u"] * n), pa.array([html] * (n - 2) + [None, "x" * (P.PARSE_BYTES + 1)])], names=["page_id", "url", "html"])
    out = list(P._parse_batches(iter([b])))
    assert len(out) >= 5 and max(x.num_rows for x in out) <= P.PARSE_PAGES
    rows = pa.Table.from_batches(out).to_pylist()
    assert [r["page_id"] for r in rows] == list(range(n))
    assert rows[0]["title"] == "t" and rows[0]["blocks"] == ["a"] and rows[0]["anchors"] == [{"href": "/x", "text": "y"}] and rows[-2]["blocks"] == []


def test_postings_are_cut_without_interpreted_array_functions(spark):
    docs = spark.createDataFrame([(1, "b a b"), (2, ""), (3, None), (4, "c")], "doc_id long, content string")
    df = I.doc_postings(I.stacked_tokens(docs, "doc_id", {"content": I.STANDARD}))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "zip_with" not in plan and "array_sort" not in plan
    got = sorted((r.doc_id, r.term, r.tf, r.dl, list(r.positions)) for r in df.collect())
    assert got == [(1, "a", 1, 3, [1]), (1, "b", 2, 3, [0, 2]), (4, "c", 1, 1, [0])]


def test_long_batches_are_cut_whole():
    n = I.CUT_TOKENS // 2 + 1
    b = pa.RecordBatch.from_arrays([pa.array(["f"] * 3), pa.array([1, 2, 3]), pa.array([["x"] * n, ["x", "y"] * (n // 2), ["z"]])], names=["field", "doc_id", "toks"])
    out = list(I._cut(iter([b])))
    assert len(out) == 2
    assert sorted((r["doc_id"], r["term"], r["tf"]) for r in pa.Table.from_batches(out).to_pylist()) == [(1, "x", n), (2, "x", n // 2), (2, "y", n // 2), (3, "z", 1)]


def test_texts_without_runs_make_no_token_rows(spark):
    words = spark.createDataFrame([("中国",)], "word string")
    d = I.Dictionary(words)
    texts = [(1, "The cat, the dog"), (2, "in 中国人 x"), (3, None), (4, "")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert {r.doc_id for r in df.filter(I.has_run(F.col("text"), d)).collect()} == {2}
    plain = I.stacked_tokens(df, "doc_id", {"text": d})
    whole = {(r.doc_id, r.pos, r.term) for r in I.dictionary_segment(df, "doc_id", "text", d).collect()}
    own = {(r.doc_id, r.pos, r.term) for r in plain.select("doc_id", F.posexplode("toks").alias("pos", "term")).collect()}
    assert {x for x in whole if x[0] != 2} == own
    idx = I.build_index(df.withColumnRenamed("text", "content"), {"content": d})
    got = {(r.doc_id, p, r.term, r.dl) for r in idx.postings.collect() for p in r.positions}
    assert {x[:3] for x in got} == whole and {x[3] for x in got if x[0] == 1} == {4}
