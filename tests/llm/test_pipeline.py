"""The pipeline against its stages made by brute force."""

from __future__ import annotations

import re

import corpus_pipeline
from quarry.llm import quality_gbt, store
from test_partenum import brute as components
from test_partenum import shingles
from test_scans import base_counts, brute_hits, plain
from test_substrings import brute as repeats
from test_substrings import spaced
from test_tokens import check_packing

SF = "/root/testdata/sf0.001"


def cut(text, gone, pattern, lower=False):
    """The text less the runs of words whose numbers are ``gone``."""
    raw = re.sub("[A-Z]", lambda m: m[0].lower(), text) if lower else text
    places, out, at, i = [m.span() for m in re.finditer(pattern, raw)], [], 0, 0
    while i < len(places):
        if i in gone:
            j = i
            while j + 1 in gone:
                j += 1
            out.append(text[at : places[i][0]])
            at, i = places[j][1], j
        i += 1
    return "".join(out) + text[at:]


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns = docs.columns
    verdict = {r.doc_id: r.quality >= 0.35 for r in quality_gbt.assess(docs, labels).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    quality = {}
    for doc, text in rows:
        n, _, _, _, twice = base_counts(text)
        if n >= 10 and 100 * twice <= 20 * n and verdict[doc]:
            quality[doc] = text
    group = {d: c for d, _, c in components(list(quality.items()))}
    one = {d: t for d, t in quality.items() if group[d] == d or not shingles(t)}
    gone = repeats(list(one.items()), 50)
    once = {d: cut(t, gone[d, t], r"[^\x20\x09-\x0D]+") for d, t in one.items()}
    items = [(str(r.item_id), plain(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    known = {w for _, i in items for w in (tuple(i[a : a + 10]) for a in range(max(1, len(i) - 9)))}
    clean = {}
    for d, t in once.items():
        words = plain(t)
        sizes = {len(w) for w in known}
        hits = [own for own in items if own[1]] if any(tuple(words[i : i + n]) in known for n in sizes for i in range(len(words) - n + 1)) else []
        hit = brute_hits(words, hits, 10)[0] if hits else set()
        if not words or len(hit) <= 0.5 * len(words):
            clean[d] = cut(t, hit, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower=True)
    state, want = docs, [quality, one, once, clean]
    for (name, stage), texts in zip(corpus_pipeline.STAGES[:-1], want):
        state = store.table(stage(spark, state, SF), f"test-{name}")
        assert state.columns == columns
        assert {r.doc_id: r.text for r in state.collect()} == texts, name
    assert len(quality) < len(rows) and len(one) < len(quality) and once != one and clean != once
    packed = corpus_pipeline.STAGES[-1][1](spark, state, SF).collect()
    assert check_packing(packed, clean, 1024) == len({r.sequence_id for r in corpus_pipeline.run(spark, SF).collect()})


def test_stages_keep_extra_columns_and_odd_rows(spark):
    rows = [(1, None, "z", 1), (None, "a few words", "z", 2), (2, "", "z", 3), (3, "word " * 30_000, "z", 4), (4, "kept text of more than ten words that nobody else has in it", "z", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, sid int")
    for table in (docs, docs.limit(0)):
        state = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            state = store.table(stage(spark, state, SF), f"test-{name}")
            assert state.columns == docs.columns
        got = state.collect()
        assert [r.doc_id for r in got] == ([4] if table is docs else [])
        assert corpus_pipeline.STAGES[-1][1](spark, state, SF).count() == len(got)
