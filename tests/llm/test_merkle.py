"""Merkle proofs against trees built in plain Python."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from quarry.llm import merkle, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, digest int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(level, arity):
    levels = [level]
    while len(level) > 1:
        level = [h(*level[i : i + arity]) for i in range(0, len(level), arity)]
        levels.append(level)
    return levels


def way(levels, at, arity):
    """Siblings before and after, leaf first."""
    out = []
    for level in levels[:-1]:
        run = at // arity * arity
        out.append(("".join(level[run:at]), "".join(level[at + 1 : run + arity])))
        at //= arity
    return out


def brute(rows, arity=2):
    """The rows of ``proofs``, by rows (doc_id, text, lang, source, n_chars)."""
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for g in langs:
        by[g] = sorted(by[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r[0], r[3], r[2], r[4], r[1])))
        trees.append(tree([leaf(r[0], r[3], r[2], r[4], r[1]) for r in by[g]], arity))
    over = tree([t[-1][0] for t in trees], arity) if trees else [[""]]
    root, out = over[-1][0], []
    for k, g in enumerate(langs):
        for i, r in enumerate(by[g]):
            path = way(trees[k], i, arity) + way(over, k, arity)
            changed = r[4] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            now = leaf(r[0], r[3], r[2], r[4] + 1 if changed else r[4], r[1])
            for a, b in path:
                now = h(a, now, b)
            out.append((r[0], trees[k][0][i], trees[k][-1][0], root, h(*(a + b for a, b in path)), now, now == root))
    return sorted(out, key=str)


def frame(spark, rows):
    """Rows with extra columns whose names clash with results'."""
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def result(spark, rows, **options):
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return sorted(map(tuple, merkle.proofs(frame(spark, rows), {"n_chars": changed}, **options).collect()), key=str)


def test_whole_table(spark):
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(map(tuple, queries.op13_merkle_manifest(spark, SF).collect()), key=str)
    assert got == brute(rows) and 0 < sum(not r[6] for r in got) < len(got) / 3


ODD = [(None, "x", "en", "s", 1), (1, None, None, None, None), (2, "", "", "", 0), (3, "long " * 60_000, "en", "s", 5), (4, "中é", "é", "s", 2), (4, "twice", "en", "s", 5), (4, "twice", "en", "s", 5), (14, "z", "z", None, None), (-5, "a", "en", "s", 1)]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 9, 70])
def test_odd_rows(spark, n):
    rows = (ODD * 8)[:n]
    assert result(spark, rows, levels=2) == brute(rows)


def test_other_arity(spark):
    rows = [(i, f"t{i}", "ab"[i % 2] if i < 30 else "c", "s", i) for i in range(100)]
    assert result(spark, rows, arity=3, levels=2) == brute(rows, 3)


def test_store_is_content_addressed(spark):
    rows = [(7, "same", "en", "s", 4)] * 64  # equal leaves: one record a level
    trees, _ = merkle.manifest(merkle.leaves(frame(spark, rows)).cache(), levels=2)
    packs = trees.packs.collect()
    assert len(packs) == 3 and all(len(p.digests) == 2 for p in packs)
    for p in packs:
        assert p.digest in p.digests and all(h(*c) == d for d, c in zip(p.digests, p.children, strict=True))


def test_broken_store_is_told(spark):
    rows = [(i, "t", "en", "s", 1) for i in range(10)]
    trees, over = merkle.manifest(merkle.leaves(frame(spark, rows)), levels=2)
    other = trees.packs.withColumn("children", F.transform("children", F.reverse))
    start = trees.roots.select("grp", F.lit(0).cast("long").alias("pos"), "digest", F.lit(4).alias("depth"), F.lit("").alias("top"), F.array().cast("array<string>").alias("left"), F.array().cast("array<string>").alias("right"))
    broken = merkle.Dag(other, trees.blocks, trees.roots, 2, 2)
    schema = spark.createDataFrame([], "id long").schema
    with pytest.raises(Exception, match="lead to"):
        merkle.descend(broken, start, lambda top, item, left, right: (item["id"],), schema).collect()
