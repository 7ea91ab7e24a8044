"""Blocks against chunks: the packing, the cut, and the plan of a search."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from quarry.operators import blocks as BL
from quarry.operators import search as S
from tests.test_shards import QUERIES, between_scan_and_topk, corpus, queries


def batch(rows):
    entry = pa.struct([("tno", pa.int64()), ("share", pa.float64())])
    return pa.RecordBatch.from_arrays([pa.array([d for d, _ in rows]), pa.array([[{"tno": t, "share": s} for t, s in e] for _, e in rows], pa.list_(entry))], names=["doc_id", "entries"])


def test_runs_are_bounded_and_whole():
    lens = [3, 0, 4, 9, 1, 1, 1, 5, 0]
    rows = [(i, [(j, 1.0) for j in range(n)]) for i, n in enumerate(lens)]
    runs = [(t.column("doc_id").to_pylist(), n.tolist()) for t, n in BL._runs([batch(rows[:4]), batch(rows[4:])], 6)]
    assert [d for ids, _ in runs for d in ids] == list(range(len(lens))) and [x for _, n in runs for x in n] == lens
    assert all(sum(n) <= 6 or len([x for x in n if x]) == 1 for _, n in runs) and len(runs) > 3


def test_cut_keeps_all_that_may_be_best():
    r = np.random.default_rng(5)
    for n, k in ((5000, 3), (400, 10), (9, 10), (3000, 1)):
        acc = np.where(r.random(n) < 0.3, np.round(r.random(n) * 3, 4) + r.choice([0, 4.9e-5, 5.1e-5], n), 0.0)
        acc[r.integers(0, n, n // 3)] = 2.5  # equal documents
        want = sorted(np.flatnonzero(acc > 0), key=lambda d: (-round(acc[d], 4), d))[:k]
        found = BL._best(acc, k, 0.0)
        assert set(want) <= set(found) and len(found) <= 40 * k


def test_terms_in_all():
    b = next(BL._blocks([batch([(7, [(1, 0.5), (2, 0.25)]), (9, [(2, 0.5)]), (11, [(1, 0.1), (2, 0.1), (3, 0.1)])])]))
    block = BL._Block(b.rename_columns(["ids", *b.schema.names[1:]]), 0)
    chunk = type("C", (), {"ids": [0, 1, 2], "ptr": np.array([0, 2, 3, 5]), "tno": np.array([1, 2, 2, 1, 8]), "w": np.ones(5)})
    assert [(q, [block.ids[int(d)].as_py() for d in found]) for q, found, _ in BL._in_all(block, chunk)] == [(0, [7, 11]), (1, [7, 9, 11])]


@pytest.mark.parametrize("search", [
    lambda i, q: S.match_query(i, q, "content"),
    lambda i, q: S.multi_match(i, q, ["title", "content"]),
    lambda i, q: S.should_match(i, q, ["title", "content"], k=3),
], ids=["match", "multi_match", "should"])
def test_pairs_never_become_rows(spark, search):
    """No join of postings with queries, no group per query and document."""
    _, idx = corpus(spark)
    lines = between_scan_and_topk(search(idx, queries(spark, QUERIES)))
    assert [x for x in lines if "MapInArrow" in x]
    assert not [x for x in lines if "Aggregate" in x and "query_id" in x]


def test_document_search_moves_no_whole_text(spark):
    from pyspark.sql import functions as F

    _, idx = corpus(spark, n=40)
    idx.docs = idx.docs.withColumn("url", F.lit(None).cast("string"))
    plan = S.document_search(idx, queries(spark, QUERIES))._jdf.queryExecution().optimizedPlan().toString()
    after_join = plan[: plan.index("Join")]
    assert "substring" not in after_join


def test_all_words_are_scored_in_their_blocks(spark):
    """A query of single words needs no positions, and no row per document and term of it."""
    rows, idx = corpus(spark, n=300)
    asked = [(1, "w0 w1 w2"), (2, "w3 w3"), (3, "w0 absent"), (4, "w5,w6 w1"), (5, "w4")]
    got = S.multi_phrase_search(idx, queries(spark, asked), "content", k=3)
    every = S.multi_phrase_search(idx, queries(spark, asked), "content", k=None).collect()
    want = sorted((r.query_id, r.rank, r.doc_id, r.score) for r in every if r["rank"] <= 3)
    assert sorted((r.query_id, r.rank, r.doc_id, r.score) for r in got.collect()) == want and {1, 2, 5} <= {w[0] for w in want}
    plan = S.multi_phrase_search(idx, queries(spark, asked[:3]), "content", k=3)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "positions" not in plan[plan.index("MapInArrow") :].split("Relation")[0]


def test_patterns_are_sieved_before_their_trigrams_are_rows(spark):
    from quarry.operators.index import KEYWORD, build_index

    docs = spark.createDataFrame([(1, "www.example.org"), (2, "other.example.com")], "doc_id long, url string")
    idx = build_index(docs, {"url": KEYWORD})
    long = " ".join(f"word{i}" for i in range(200))
    q = queries(spark, [(1, "*example*"), (2, f"*{long}*"), (3, "*other*"), (3, "*www*"), (4, "zz*")])
    made = []
    real = S.materialize
    S.materialize = lambda df, name: made.append((name, real(df, name))) or made[-1][1]
    try:
        got = {(r.query_id, r.term) for r in S.wildcard_terms(idx, q, ["url"]).collect()}
    finally:
        S.materialize = real
    assert got == {(1, "www.example.org"), (1, "other.example.com"), (3, "other.example.com"), (3, "www.example.org")}
    assert dict(made)["sieved_patterns"].count() <= 3 and "rx" not in dict(made)["sieved_patterns"].columns


def in_small_chunks(monkeypatch):
    """Three terms a chunk (a changed function goes to workers with its globals)."""
    real = BL._chunks

    def small(batches):
        names = real.__globals__
        most, names["CHUNK_TERMS"] = names["CHUNK_TERMS"], 3
        try:
            yield from real(batches)
        finally:
            names["CHUNK_TERMS"] = most

    monkeypatch.setattr(BL, "_chunks", small)


def test_a_block_goes_to_python_once(spark, monkeypatch):
    """Not with each chunk that meets it."""
    _, idx = corpus(spark, n=60, shards=3)
    in_small_chunks(monkeypatch)

    def probe(*_):
        def run(batches):
            for b in batches:
                blocks, chunks = ([x is not None for x in b.column(c).to_pylist()] for c in ("docs", "qtno"))
                yield pa.RecordBatch.from_arrays([pa.array([int(x) for x in blocks], pa.int64()), pa.array([int(x) for x in chunks], pa.int64()), pa.array([0.0] * b.num_rows)], names=["query_id", "doc_id", "score"])
        return run

    monkeypatch.setattr(BL, "_met", probe)
    rows = S.bm25_scores(idx, queries(spark, QUERIES), ["content"], k=2).collect()
    blocks, pairs = sum(r.query_id for r in rows), sum(r.doc_id for r in rows)
    assert blocks == 3 and pairs >= 4 * blocks and not [r for r in rows if r.query_id and r.doc_id]


def test_rounds_of_chunks_give_the_same(spark, monkeypatch):
    _, idx = corpus(spark, n=120)
    q = queries(spark, QUERIES)
    want = sorted(map(tuple, S.match_query(idx, q, "content", k=4).collect()))
    in_small_chunks(monkeypatch)
    monkeypatch.setattr(BL, "CHUNK_BYTES", 200)
    monkeypatch.setattr(BL, "ROUND_BYTES", 200)
    made, real = [], BL.materialize
    monkeypatch.setattr(BL, "materialize", lambda df, name: made.append(name) or real(df, name))
    got = sorted(map(tuple, S.match_query(idx, q, "content", k=4).collect()))
    assert got == want and made.count("round_hits") >= 2 and made.count("blocks") == 1


def test_groups_hold_all_chunks():
    sizes = [(str(i), s) for i, s in enumerate([5, BL.CHUNK_BYTES, 1, 2, BL.CHUNK_BYTES + 1, 7])]
    groups = BL._groups(sizes)
    assert [x for g in groups for x in g] == [k for k, _ in sizes] and BL._groups([]) == []
    assert all(sum(dict(sizes)[x] for x in g) <= BL.ROUND_BYTES or len(g) == 1 for g in groups)
    assert len(BL._groups([("a", BL.CHUNK_BYTES - 1), ("b", 1)])) == 1 and BL.ROUND_BYTES < BL.CHUNK_BYTES


def test_all_phrases_in_rounds_need_no_product_of_blocks_and_chunks(spark, monkeypatch):
    """Queries beyond the broadcast bound meet the blocks in rounds; a cartesian
    product held a partition's chunks, and sent the block with each."""
    _, idx = corpus(spark, n=120)
    asked = queries(spark, [(1, "w0 w1 w2"), (2, "w3 w3"), (3, "w0 absent"), (4, "w5,w6 w1"), (5, "w4"), (6, "w1 w0"), (7, "w0,w1")])
    want = sorted(map(tuple, S.multi_phrase_search(idx, asked, "content", k=3).collect()))
    in_small_chunks(monkeypatch)
    monkeypatch.setattr(BL, "CHUNK_BYTES", 200)
    monkeypatch.setattr(BL, "ROUND_BYTES", 200)
    plans, real = [], BL.materialize

    def spy(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return real(df, name)

    monkeypatch.setattr(BL, "materialize", spy)
    got = S.multi_phrase_search(idx, asked, "content", k=3)
    assert sorted(map(tuple, got.collect())) == want and want
    rounds = [p for name, p in plans if name == "round_hits"]
    assert len(rounds) >= 3 and all("BroadcastNestedLoopJoin" in p and "CartesianProduct" not in p for p in rounds)
    assert "CartesianProduct" not in got._jdf.queryExecution().executedPlan().toString()


def row_block(rows):
    b = next(BL._blocks(iter([batch(rows)])))
    return BL._Block(b.rename_columns(["ids", *b.schema.names[1:]]), 0)


def test_later_blocks_leave_out_what_cannot_be_best():
    r, k = np.random.default_rng(1), 3
    docs = [(d, [(int(t), float(r.random())) for t in np.flatnonzero(r.random(40) < r.choice([0.05, 0.3, 0.9]))]) for d in range(300)]
    asked = [sorted(r.choice(45, r.integers(0, 9), replace=False).tolist()) for _ in range(50)]
    w = [r.random(len(a)) for a in asked]
    chunk = type("C", (), {"key": "c", "ids": list(range(50)), "ptr": np.append(0, np.cumsum([len(a) for a in asked])), "tno": np.array(sum(asked, [])), "grp": np.ones(sum(map(len, asked)), int), "w": np.concatenate(w), "floors": np.zeros(50)})
    tops, found, n = BL._Tops(k), {}, []
    for at in range(0, 300, 60):
        block, before = row_block(docs[at : at + 60]), sum(map(len, found.values()))
        for qs, ds, scores in BL._scored(block, chunk, False, k, tops.get(chunk)):
            for q, d, s in zip(qs, ds, scores):
                found.setdefault(int(q), {})[block.ids[int(d)].as_py()] = s
        n.append(sum(map(len, found.values())) - before)
    for q, (terms, weights) in enumerate(zip(asked, w)):
        every = {d: sum(x * dict(e).get(t, 0) for t, x in zip(terms, weights)) for d, e in docs}
        want = sorted((d for d in every if every[d] > 0), key=lambda d: (-round(every[d], 4), d))[:k]
        assert set(want) <= set(found.get(q, {})) and all(abs(found[q][d] - every[d]) < 1e-9 for d in want)
    assert n[-1] < n[0] / 2


def test_postings_become_documents_across_batches():
    rows = [(1, 4), (1, 5), (2, 4), (3, 1), (3, 2), (3, 3), (3, 4), (4, 9)]
    for size in (1, 2, 3, 8):
        flat = [pa.RecordBatch.from_pylist([{"doc_id": d, "tno": t, "share": t / 8, "n": 1 + sum(x[0] == d for x in rows[:i])} for i, (d, t) in enumerate(rows)][at : at + size]) for at in range(0, len(rows), size)]
        got = [(x["doc_id"], [(e["tno"], e["share"]) for e in x["entries"]]) for b in BL._docs(iter(flat)) for x in b.to_pylist()]
        assert got == [(d, [(t, t / 8) for x, t in rows if x == d]) for d in (1, 2, 3, 4)]


def test_one_sort_brings_a_documents_postings_together(spark):
    """No aggregation of postings to arrays in the JVM, which sorts them twice more."""
    _, idx = corpus(spark)
    plan = S.match_query(idx, queries(spark, QUERIES), "content")._jdf.queryExecution().executedPlan().toString()
    blocks = plan[plan.rindex("MapInArrow") :].split("postings_")[0]
    assert blocks.count("Sort [") == 1 and "collect_list" not in blocks


def test_buckets_are_written_without_a_sort_by_file(spark):
    from quarry.operators.common import materialize_bucketed

    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    seen = []
    df = spark.range(100).selectExpr("id", "id % 3 AS part").repartition(4, "id")
    real = type(df.write).saveAsTable
    try:
        type(df.write).saveAsTable = lambda self, *a, **b: seen.append(spark.conf.get(key)) or real(self, *a, **b)
        table = materialize_bucketed(df, "few", "id", 4, ["part"])
    finally:
        type(df.write).saveAsTable = real
    assert int(seen[0]) >= 3 and spark.conf.get(key, None) == before
    assert sorted((r.id, r.part) for r in table.collect()) == [(i, i % 3) for i in range(100)]
