"""Substring deduplication against brute force."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest

from quarry.llm import queries, substring_dedup
from quarry.llm.text import Words, sliding_min, windows

SF = "/root/testdata/sf0.001"


def spaced(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def brute(rows, size):
    """{(doc, text): removed word numbers}; null doc_ids take no part."""
    first = {}
    for doc, text in rows:
        words = spaced(text)
        for i in range(len(words) - size + 1) if doc is not None else ():
            w = tuple(words[i : i + size])
            first[w] = min(first.get(w, doc), doc)
    out = {}
    for doc, text in rows:
        words = spaced(text)
        out[doc, text] = {j for i in range(len(words) - size + 1) if doc is not None and first[tuple(words[i : i + size])] < doc for j in range(i, i + size)}
    return out


def expected(rows, size):
    gone = brute(rows, size)
    out = []
    for doc, text in rows:
        words, cut = spaced(text), gone[doc, text]
        kept = " ".join(w for i, w in enumerate(words) if i not in cut)
        out.append((doc, len(words), len(cut), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def random_rows(seed, n=60):
    r = np.random.default_rng(seed)
    rows = [(int(i), " ".join(chr(97 + x) for x in r.integers(0, 3, int(r.integers(0, 30))))) for i in r.permutation(n)]
    return rows + [(rows[0][0], rows[0][1]), (rows[1][0], "a b c a b c a b c"), (None, "a b c a b c"), (n + 1, None), (n + 2, ""), (n + 3, " \n "), (n + 4, "a b c " * 5000)]


@pytest.mark.parametrize("bits", [4, 20])
def test_brute_force(spark, bits):
    rows = random_rows(bits)
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, starts string").repartition(5)
    got = substring_dedup.summary(docs, size=5, anchor_words=3, bits=bits).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(rows, 5)
    clean = substring_dedup.clean(docs, size=5, anchor_words=3, bits=bits)
    assert clean.columns == docs.columns
    gone = brute(rows, 5)
    for r in clean.collect():
        assert r.starts == "x"
    want = sorted([" ".join(w for i, w in enumerate(spaced(t)) if i not in gone[d, t]) for d, t in rows])
    assert sorted(" ".join(spaced(r.text)) for r in clean.collect()) == want


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert substring_dedup.summary(docs).collect() == []


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in queries.op1_substring_dedup(spark, SF).collect()), key=str) == expected(rows, 50)


def test_cut_leaves_the_rest_as_it_is():
    assert substring_dedup.without("a  b\tc d e\n f", [1], 3, Words()) == "a   e\n f".replace("   e", "   e", 1).replace("a   e", "a  " + " e")


def test_helpers():
    words = Words()
    ids, offsets = words.ids([[b"a", b"b", b"a"], [], [b"a", b"b", b"a", b"b"]])
    h = words.lanes()[ids, 0]
    w = windows(h, 2)
    assert offsets.tolist() == [0, 3, 3, 7] and w[0] == w[3] == w[5] and w[1] == w[4] and w[0] != w[1]
    x = np.random.default_rng(0).integers(0, 2**63, 50).astype(np.uint64)
    for n in (1, 2, 3, 7, 8, 50):
        assert sliding_min(x, n).tolist() == [x[i : i + n].min() for i in range(51 - n)]


def test_untouched_texts_pass_no_second_worker(spark):
    """Only documents with repeated windows go through the Python step that cuts them."""
    docs = spark.createDataFrame([(1, "a b c d", "x"), (2, "q a b c", "y"), (3, None, None)], "doc_id long, text string, starts string")
    clean = substring_dedup.clean(docs, size=3, anchor_words=2)
    plan = clean._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Union") < plan.index("MapInArrow") and clean.schema == docs.schema
    assert sorted(tuple(r) for r in clean.collect() if r.text) == [(1, "a b c d", "x"), (2, "q ", "y")] and clean.count() == 3
