"""The n-gram Jaccard join against brute force."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest

from quarry.llm import partenum, queries
from quarry.llm.text import Cut

SF = "/root/testdata/sf0.001"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute(rows):
    """(doc_id, n_shingles, component_id) of every row."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 4 * min(len(a), len(b)) >= 3 * max(len(a), len(b)) and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((doc, len(sets[i]), least.get(find(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows)), key=str)


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def near_copies(seed):
    """Chains and stars of edited copies, shared passages, odd rows."""
    r = np.random.default_rng(seed)
    word = lambda n: [f"w{x}" for x in r.integers(0, 400, n)]
    passage = word(40)
    rows = []
    for _ in range(12):
        text = word(int(r.integers(3, 250)))
        for _ in range(int(r.integers(1, 9))):
            rows.append(" ".join(text))
            if r.random() < 0.5:
                text = text[:]
            for _ in range(int(r.integers(0, 1 + len(text) // 25))):
                text[int(r.integers(0, len(text)))] = f"x{r.integers(0, 9999)}"
            if r.random() < 0.3:
                text = text + word(int(r.integers(1, 2 + len(text) // 6)))
    rows += [" ".join(word(int(r.integers(5, 60))) + passage) for _ in range(25)]
    rows += ["a b", "A  B", "a", None, "", " \n", "The " * 2000, "tHe " * 1500, "one two three four five six"] + rows[:3]
    ids = [int(x) for x in r.permutation(len(rows))]
    ids[4], ids[5] = None, ids[6]
    return list(zip(ids, rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, seed):
    rows = near_copies(seed)
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, sid string").repartition(5)
    assert result(partenum.groups(docs)) == brute(rows)


def test_keep_one(spark):
    rows = near_copies(3)
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, sid string")
    kept = partenum.keep_one(docs)
    assert kept.columns == docs.columns
    comps = {c for _, n, c in brute(rows) if n}
    got = kept.collect()
    assert sorted(str(r.doc_id) for r in got if shingles(r.text)) == sorted(str(c) for c in comps)
    assert sum(not shingles(r.text) for r in got) == sum(not shingles(t) for _, t in rows)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert result(queries.op4_ngram_join(spark, SF)) == brute(rows)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert partenum.groups(empty).collect() == [] and partenum.keep_one(empty).collect() == []


def test_bounds():
    for a in range(1, 60):
        for b in range(-(-3 * a // 4), a * 4 // 3 + 1):
            most = max((a - n for n in range(min(a, b) + 1) if 4 * n >= 3 * (a + b - n)), default=None)
            assert most is None or most <= partenum.missing(np.array(a), np.array(b)) <= partenum.missing(np.array(a), np.array(-(-3 * a // 4)))


def test_linked_sizes_share_a_band_and_shingles_have_parts_of_their_own():
    r = np.random.default_rng(0)
    for n in [1, 2, 3, 4, 5, 15, 16, 17, 47, 48, 63, 64, 85, 200, 255, 256, 341, 1000, 1365, 5000]:
        bands = []
        for size in (n, n * 4 // 3):
            docs = [[b"%d" % x for x in r.integers(0, 10**9, size + 4)] for _ in range(5)]
            sets = partenum.Sets(Cut.of(docs))
            found = list(partenum.signatures(sets, sets.sizes > 0))
            bands.append({band for band, _, _, _ in found})
            for _, own, count, tokens in found:
                assert (count + partenum.SPARE >= sets.sizes[own]).all() and len(tokens) == count.sum()
        assert bands[0] & bands[1]


def test_slices_are_cut_like_word_lists():
    texts = [f" Ab{i} é{i % 7}Z\t{'x ' * (i % 5)}" if i % 11 else None for i in range(300)]
    column = pa.array(texts)
    for part in (column, column.slice(100, 150), column.slice(299), column.slice(3, 0)):
        for lower in (False, True):
            cut = Cut(part, lower)
            words = [w for t in part.to_pylist() for w in re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "") if lower else t or "")]
            whole = Cut.of([[w.encode() for w in words]])
            assert (cut.lanes()[cut.ids] == whole.lanes()[whole.ids]).all() and len(cut.offsets) == len(part) + 1 and cut.offsets[-1] == len(words)
