"""MinHash near-dedup against brute force."""

from __future__ import annotations

import re

import numpy as np
import pytest

from quarry.llm import minhash, queries
from quarry.llm.partenum import Sets
from quarry.llm.text import Cut

SF = "/root/testdata/sf0.001"
ODD = [(None, "x y z"), (None, "x y z"), (900, "x y z"), (901, None), (902, ""), (903, " \n\t"), (904, "the " * 30_000), (905, "ſé 中文 \x0b a\x1cb"), (905, "twice"), (905, "twice"), (906, "A B c d e f"), (907, "a b C d e f"), (908, None)]


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute(rows):
    """(doc_id, n_shingles, component_id, kept) of every row."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= 85 * max(len(a), len(b)) and 100 * len(a & b) >= 85 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    of = [least.get(find(i)) if sets[i] else doc for i, (doc, _) in enumerate(rows)]
    return sorted(((doc, len(sets[i]), of[i], doc == of[i]) for i, (doc, _) in enumerate(rows)), key=str)


def frame(spark, rows):
    """Rows with extra columns whose names clash with results'."""
    return spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, sid int, kept string")


def result(spark, rows):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.groups(frame(spark, rows)).collect()), key=str)


def near_copies(seed):
    """Chains of edited copies around the limit, shared passages, short texts."""
    r = np.random.default_rng(seed)
    word = lambda n: [f"w{x}" for x in r.integers(0, 500, n)]
    passage, rows = word(60), []
    for _ in range(14):
        text = word(int(r.integers(1, 300)))
        for _ in range(int(r.integers(1, 9))):
            rows.append(" ".join(text))
            text = text[:]
            for _ in range(int(r.integers(0, 1 + len(text) // 60))):
                text[int(r.integers(0, len(text)))] = f"x{r.integers(0, 9999)}"
        rows.append(" ".join(word(int(r.integers(5, 30))) + passage))
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed", range(3))
def test_near_copies(spark, seed):
    rows = near_copies(seed)
    want = brute(rows)
    assert result(spark, rows) == want and 10 < len({r[2] for r in want}) < len(rows) - 10


def test_odd_rows(spark):
    assert result(spark, ODD) == brute(ODD)


def test_empty_table(spark):
    got = minhash.groups(frame(spark, []))
    assert got.columns == ["doc_id", "n_shingles", "sid", "component_id", "kept"] and got.collect() == []


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op12_minhash_dedup(spark, SF).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=str) == brute(rows)


def test_star_misses_no_link(spark):
    """A bucket whose centre is unlike the rest: other pairs are compared too."""
    base = [f"w{i}" for i in range(400)]
    rows = []
    for k in range(12):  # each some words from the next: linked to neighbours only
        text = base[:]
        for i in range(6 * k):
            text[(i * 61) % 400] = f"x{i}"
        rows.append((100 - k, " ".join(text)))
    assert result(spark, rows) == brute(rows)


def test_densified_agreement_is_similarity():
    """Bins of two sets agree as often as the sets are similar, at any size."""
    signer = minhash.Signer()
    for size in (3, 12, 60, 500, 5_000):
        share, want = [], []
        for k in range(12):
            common = [f"c{k}-{i}" for i in range(size)]
            a, b = common + [f"a{k}"] * 1, common + [f"b{k}-{i}" for i in range(size // 4)]
            sets = Sets(Cut.of([[w.encode() for w in x] for x in (a, b)]), 1)
            s = signer.signatures(sets, np.array([0, 1]))
            share.append((s[0] == s[1]).mean())
            want.append(len({*a} & {*b}) / len({*a} | {*b}))
        assert abs(np.mean(share) - np.mean(want)) < 0.07, size


def test_few_and_many_filled_bins_take_the_same_order():
    """Both ways of densifying pick the first filled bin of a bin's order."""
    signer = minhash.Signer()
    sets = Sets(Cut.of([[f"t{k}-{i}".encode() for i in range(n)] for k, n in enumerate((1, 5, 8, 9, 40, 700))]), 1)
    got = signer.signatures(sets, np.arange(6))
    hashes = minhash.mixed(sets.shingles ^ np.uint64(0x9FB21C651E98DF25))
    for d in range(6):
        own = hashes[sets.owner == d]
        least = {}
        for x in own.tolist():
            b = (x >> 32) * minhash.BINS >> 32
            least[b] = min(least.get(b, 1 << 32), x & 0xFFFFFFFF)
        for b in range(minhash.BINS):
            first = b if b in least else next(j for j in signer.orders[b].tolist() if j in least)
            assert got[d, b] == least[first]
