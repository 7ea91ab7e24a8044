"""Search inside document shards: plans, impact bounds, phrases against brute force."""

from __future__ import annotations

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from quarry.operators import highlight as HL
from quarry.operators import search as S
from quarry.operators.index import KEYWORD, STANDARD, build_index

WORDS = [f"w{i}" for i in range(30)]


def corpus(spark, n=160, shards=8, seed=3):
    r = random.Random(seed)
    rows = [(i, " ".join(r.choices(WORDS, [1 / (k + 1) for k in range(30)], k=r.randint(0, 40))), " ".join(r.choices(WORDS, k=r.randint(0, 4)))) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, content string, title string")
    return rows, build_index(docs, {"title": STANDARD, "content": STANDARD}, shards=shards)


def queries(spark, rows):
    return spark.createDataFrame(rows, "query_id long, query string")


def brute(rows, query, fields, best):
    """Scores by the formula."""
    out = {}
    for f in fields:
        texts = {r[0]: r[1 + (f == "title")].split() for r in rows}
        full = [t for t in texts.values() if t]
        avg = sum(map(len, full)) / len(full)
        for d, t in texts.items():
            score = 0
            for w in query.split():
                tf, df = t.count(w), sum(w in x for x in texts.values())
                if tf:
                    score += math.log(1 + (len(full) - df + 0.5) / (df + 0.5)) * 2.2 * tf / (tf + 1.2 * (0.25 + 0.75 * len(t) / avg))
            if score:
                out[d] = max(out.get(d, 0), score) if best else out.get(d, 0) + score
    return out


def top(scores, k):
    return [(d, round(s, 4)) for d, s in sorted(((d, round(s, 4)) for d, s in scores.items()), key=lambda x: (-x[1], x[0]))[:k]]


QUERIES = [(1, "w0 w1 w29"), (2, "w28"), (3, "w0 w0 w2 w17 w25"), (4, "nothing"), (5, " "), (6, "w5 w6 w7 w8 w9 w10")]


@pytest.mark.parametrize("k", [1, 2, 10])
def test_scores_by_brute_force(spark, k):
    """k of 1 and 2: shards are pruned by their bounds; 10: they aren't."""
    rows, idx = corpus(spark)
    q = queries(spark, QUERIES)
    for fields, best, got in (
        (["content"], False, S.match_query(idx, q, "content", k=k)),
        (["title", "content"], True, S.multi_match(idx, q, ["title", "content"], k=k)),
        (["title", "content"], False, S.should_match(idx, q, ["title", "content"], k=k)),
    ):
        by = {}
        for r in got.orderBy("query_id", "rank").collect():
            by.setdefault(r.query_id, []).append((r.doc_id, r.score))
        for i, text in QUERIES:
            want = top(brute(rows, text, fields, best), k)
            have = by.get(i, [])
            assert [d for d, _ in have] == [d for d, _ in want] and all(abs(a - b) < 2e-4 for (_, a), (_, b) in zip(have, want)), (i, have, want)


def test_bounds_leave_shards_out(spark):
    _, idx = corpus(spark, n=400, shards=16)
    side = S._terms(idx, S.query_terms(idx, queries(spark, QUERIES), ["content"]).groupBy("query_id", "field", "term").agg(F.count(F.lit(1)).alias("qtf")))[0]
    side = side.withColumn("w", F.col("qtf") * F.col("idf") * 2.2)
    alive = S._alive(idx, side, False, 1).groupBy("query_id").count().collect()
    assert {r.query_id for r in alive} == {1, 2, 3, 6} and sum(r["count"] for r in alive) < 4 * 16


def between_scan_and_topk(df):
    """Lines of the plan between the first partial top-k and the postings scan below it."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
    first = next(i for i, x in enumerate(plan) if "WindowGroupLimit" in x and "Partial" in x)
    scan = next(i for i, x in enumerate(plan) if i > first and "FileScan" in x and "postings_" in x)
    return plan[first:scan]


@pytest.mark.parametrize("search", [
    lambda i, q: S.match_query(i, q, "content"),
    lambda i, q: S.multi_match(i, q, ["title", "content"]),
    lambda i, q: S.should_match(i, q, ["title", "content"]),
    lambda i, q: S.match_phrase(i, q, "content"),
    lambda i, q: S.multi_phrase_search(i, q, "content"),
], ids=["match", "multi_match", "should", "phrase", "multi_phrase"])
def test_no_exchange_before_partial_topk(spark, search):
    _, idx = corpus(spark)
    lines = between_scan_and_topk(search(idx, queries(spark, QUERIES)))
    assert not [x for x in lines if re.search(r"Exchange (hash|range|round|single)", x)]


def test_phrases_by_brute_force(spark):
    rows, idx = corpus(spark, n=300)
    asked = [(1, "w0 w1"), (2, "w0 w0"), (3, "w2 w0 w1"), (4, "w0 absent"), (5, "w3"), (6, "w0 w1 w0 w1")]
    got = {(r.query_id, r.doc_id, r.field): r.freq for r in S.phrase_scores(idx, queries(spark, asked), ["title", "content"]).collect()}
    want = {}
    for i, text in asked:
        terms = text.split()
        for d, content, title in rows:
            for field, words in (("content", content.split()), ("title", title.split())):
                n = sum(words[k : k + len(terms)] == terms for k in range(len(words) - len(terms) + 1))
                if n:
                    want[i, d, field] = n
    assert got == want


def test_all_phrases_by_brute_force(spark):
    rows, idx = corpus(spark, n=300)
    asked = [(1, "w0 w1"), (2, "w0,w1 w2"), (3, "w3 w3"), (4, "w0 %%"), (5, "w0-w0 w1-w2")]
    got = {(r.query_id, r.doc_id) for r in S.multi_phrase_search(idx, queries(spark, asked), "content", k=None).collect()}
    want = set()
    for i, text in asked:
        phrases = [re.findall(r"\w+", p) for p in text.split()]
        for d, content, _ in rows:
            words = content.split()
            if all(p and any(words[k : k + len(p)] == p for k in range(len(words))) for p in phrases):
                want.add((i, d))
    assert got == want


def test_empty_index_and_queries(spark):
    docs = spark.createDataFrame([], "doc_id long, content string, title string")
    idx = build_index(docs, {"title": STANDARD, "content": STANDARD})
    q = queries(spark, QUERIES)
    _, full = corpus(spark, n=5)
    none = queries(spark, [])
    for i, a in ((idx, q), (full, none)):
        assert S.match_query(i, a, "content").collect() == [] and S.match_phrase(i, a, "content").collect() == [] and S.one_phrase_search(build_index(docs.withColumn("editor", F.lit("")), {"title": STANDARD, "content": STANDARD, "editor": STANDARD}), a).collect() == []


def test_phrases_are_marked_where_they_stand(spark):
    texts = ["the dog saw. The Dog, the dog", "dog the cat", "a the dog the dog b", "", None]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, content string, title string")
    idx = build_index(docs, {"title": STANDARD, "content": STANDARD})
    q = queries(spark, [(1, "the dog"), (2, "dog the dog"), (3, "cat")])
    hits = spark.createDataFrame([(k, i) for k in (1, 2, 3) for i in range(len(texts))], "query_id long, doc_id long")
    marked = HL.highlight(idx, hits, q, ["content"], words=False, phrases=q.withColumn("phrase_no", F.lit(0)))
    got = {(r.query_id, r.doc_id): r.fragment for r in marked.collect()}
    assert got == {
        (1, 0): "<strong>the dog</strong> saw. <strong>The Dog</strong>, <strong>the dog</strong>",
        (1, 2): "a <strong>the dog</strong> <strong>the dog</strong> b",
        (2, 0): "the dog saw. The <strong>Dog, the dog</strong>",
        (2, 2): "a the <strong>dog the dog</strong> b",
        (3, 1): "dog the <strong>cat</strong>",
    }
    both = HL.highlight(idx, hits, q, ["content"], phrases=q.withColumn("phrase_no", F.lit(0)))
    assert {(r.query_id, r.doc_id): r.fragment for r in both.collect()}[1, 1] == "<strong>dog</strong> <strong>the</strong> cat"


def test_overlapping_phrases_are_one_span(spark):
    docs = spark.createDataFrame([(1, "a b c d", "")], "doc_id long, content string, title string")
    idx = build_index(docs, {"title": STANDARD, "content": STANDARD})
    q = queries(spark, [(1, "a b c")])
    phrases = spark.createDataFrame([(1, 0, "a b"), (1, 1, "b c"), (1, 2, "d")], "query_id long, phrase_no int, query string")
    hits = spark.createDataFrame([(1, 1)], "query_id long, doc_id long")
    assert [r.fragment for r in HL.highlight(idx, hits, q, ["content"], words=False, phrases=phrases).collect()] == ["<strong>a b c</strong> <strong>d</strong>"]


TERMS = ["the", "then", "bathe", "a", "ab", "abc", "x1y2", "the-end", "été", "naïve", "d*g", "[x]", "tttt"]


@pytest.mark.parametrize("case_insensitive", [False, True])
def test_wildcards_by_brute_force(spark, case_insensitive):
    import fnmatch

    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TERMS)], "doc_id long, word string")
    idx = build_index(docs, {"word": KEYWORD})
    asked = ["the*", "*the*", "*the", "?he", "a", "a*", "*", "??", "abc", "x?y?", "t*e", "été", "*é", "th?n", "zzz*", "*hen*d", "THE*", "t?t?", "*ttt*"]
    q = queries(spark, list(enumerate(asked)))
    got = {(r.query_id, r.term) for r in S.wildcard_terms(idx, q, ["word"], case_insensitive=case_insensitive).collect()}
    want = {(i, t) for i, p in enumerate(asked) for t in TERMS if fnmatch.fnmatchcase(t, (p.lower() if case_insensitive else p))}
    assert got == want
    escaped = S.wildcard_terms(idx, queries(spark, [(1, "d\\*g"), (2, "\\[x?"), (3, "\\*")]), ["word"]).collect()
    assert {(r.query_id, r.term) for r in escaped} == {(1, "d*g"), (2, "[x]")}


def test_wildcards_need_no_nested_loop(spark):
    _, idx = corpus(spark, n=20)
    nested = lambda rows: "NestedLoop" in S.wildcard_terms(idx, queries(spark, rows), ["content"])._jdf.queryExecution().executedPlan().toString()
    assert not nested([(1, "w1*"), (2, "?12"), (3, "w1?*")])
    assert nested([(1, "*1*")])
