"""Deleted interpolation against counts and mixtures made by brute force."""

from __future__ import annotations

import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pandas as pd

from quarry.llm import interpolated_lm as lm
from quarry.llm import queries

SF = "/root/testdata/sf0.001"


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def fold(doc):
    return -1 if doc is None else zlib.crc32(str(doc).encode()) % 10


def brute(rows, weights):
    words, pairs = Counter(), Counter()
    for doc, text in rows:
        if fold(doc) > 0:
            t = tokens(text)
            words.update(t)
            pairs.update(zip([None, *t], t))
    n, v = sum(words.values()), len(words)
    out = []
    for doc, text in rows:
        t = tokens(text)
        base = sum(math.log10((words[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        score = 0.0
        for u, w in zip([None, *t], t):
            c = words[u]
            l2, l1, l0 = weights[min(c.bit_length(), lm.BUCKETS - 1)]
            score += math.log10(l2 * pairs[u, w] / max(c, 1) + l1 * words[w] / max(n, 1) + l0 / (v + 1))
        out.append((doc, fold(doc) == 0, len(t), sum(words[w] > 0 for w in t), round(base, 6), round(score, 6)))
    return n, v, sorted(out, key=str)


def rows_of(scored):
    return sorted(((r.doc_id, r.fold == 0, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in scored.collect()), key=str)


def test_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows += [(None, "The the the"), (10**6, None), (10**6 + 1, ""), (10**6 + 2, "the " * 30_000), (rows[0][0], rows[0][1]), (rows[1][0], "other text")]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, fold int").repartition(3)
    for size in (16 << 20, 20_000):
        scored, n, v, weights = lm.score(docs, size)
        assert np.allclose(weights.sum(axis=1), 1) and (weights >= 0).all()
        want_n, want_v, want = brute(rows, weights)
        assert (n, v) == (want_n, want_v) and rows_of(scored) == want


def test_better_than_the_base_on_held_out_documents(spark):
    rows = [r for r in queries.op3_interpolated_lm(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_empty_and_untrained(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score(empty)[0].collect() == []
    docs = spark.createDataFrame([(None, "a b")], "doc_id long, text string")
    scored, n, v, _ = lm.score(docs)
    assert (n, v) == (0, 0) and scored.first().n_known == 0 and scored.first().base_score == 3 * math.log10(0.1 / 0.1)


def test_weights_find_a_planted_mixture():
    r = np.random.default_rng(5)
    true = np.array([0.6, 0.3, 0.1])
    p2, p1 = (2.0 ** (np.round(r.uniform(-3, 6, 200) / lm.BIN) * lm.BIN) for _ in range(2))
    n = (np.stack([p2, p1, np.ones(200)], axis=1) @ true) * 1e6  # expected counts under equal base mass
    keys = (3 * 10_000 + np.round(np.log2(p2) / lm.BIN).astype(int) + 2000) * 10_000 + np.round(np.log2(p1) / lm.BIN).astype(int) + 2000
    frame = pd.DataFrame({"key": keys, "n": n}).groupby("key", as_index=False).sum()
    w = lm.learn(frame)
    like = lambda x: (frame["n"] * np.log(np.stack([2.0 ** ((frame["key"] // 10_000 % 10_000 - 2000) * lm.BIN), 2.0 ** ((frame["key"] % 10_000 - 2000) * lm.BIN), np.ones(len(frame))], axis=1) @ x)).sum()
    for other in (true, [0.5, 0.4, 0.1], [0.7, 0.2, 0.1], [0.34, 0.33, 0.33]):
        assert like(w[3]) >= like(np.array(other)) - 1e-3
    assert w[4].tolist() == w[3].tolist() and w[2].tolist() == [0.0, 0.9, 0.1]


def test_memory_of_a_block():
    """A block's keys take some 50 bytes a token at most, the rest comes in runs of documents."""
    r = np.random.default_rng(0)
    n, v = 1 << 20, 50_000
    control, data = lm.encode(np.minimum(r.zipf(1.3, n), v - 1).astype(np.uint32))
    row = {"folds": bytes([2] * 1024), "lens": np.full(1024, n // 1024, "<u4").tobytes(), "n_tokens": n, "control": control, "data": data, "vocab": r.integers(0, 2**63, v).astype(np.uint64).tobytes()}
    tracemalloc.start()
    own = lm.Block(row)
    low, place, shard = own.keys(1, 4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (np.bincount(place, minlength=len(low)) > 0).all() and (np.diff(shard.astype(int)) >= 0).all()
    assert peak < 50 * n
