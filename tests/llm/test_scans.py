"""Row-wise operators (quality, licences, decontamination, toxicity) against
brute force on the smallest tables and on planted rows."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest

from quarry.llm import decontaminate, license_scan, quality_gbt, queries, toxicity

SF = "/root/testdata/sf0.001"
ODD = [(None, "x"), (1, None), (2, ""), (3, " \n\t"), (4, "the " * 30_000), (5, "ſé 中文 \x0b a\x1cb"), (5, "twice"), (5, "twice")]


def frame(spark, rows):
    """Rows with extra columns whose names clash with results'."""
    return spark.createDataFrame([(d, t, "z", 1) for d, t in rows], "doc_id long, text string, items string, n_words int")


def spaced(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def plain(t):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def base_counts(text):
    words, text = spaced(text), text or ""
    at = {}
    for i in range(len(words) - 4):
        at.setdefault(tuple(words[i : i + 5]), []).append(i)
    twice = {j for p in at.values() if len(p) > 1 for i in p for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if spaced(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(twice)


def test_quality_counts(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + ODD
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    got = quality_gbt.assess(frame(spark, rows), labels).collect()
    key = lambda r: (str(r[0]), *r[1:])
    want = sorted(((d, *base_counts(t)) for d, t in rows), key=key)
    assert sorted(((r.doc_id, *(r[c] for c in quality_gbt.COUNTS)) for r in got), key=key) == want
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed)  # without labels no tree rejects


def test_quality_held_out(spark):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    even = labels.filter("doc_id % 2 = 0")
    truth = {r.doc_id: r.quality for r in labels.filter("doc_id % 2 = 1").collect()}
    rows = [r for r in quality_gbt.assess(documents, even).collect() if r.doc_id in truth and not r.base_failed]
    good = [r.kept for r in rows if truth[r.doc_id] == 1]
    bad = [r.kept for r in rows if truth[r.doc_id] == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.05
    kept = {r.doc_id for r in quality_gbt.keep(documents, even).select("doc_id").collect()}
    assert {r.doc_id for r in rows if r.kept} <= kept and not kept & {r.doc_id for r in rows if not r.kept}


def test_trees_are_monotonic_and_flat():
    r = np.random.default_rng(1)
    x = r.random((3000, 3))
    y = (x[:, 0] + 0.3 * r.random(3000) < 0.6).astype(float)
    y[x[:, 0] > 0.95] = 1  # against the constraint
    t = quality_gbt.fit(x, y, np.array([-1, 0, 0]))
    probe = np.repeat(x[:50, None], 40, axis=1)
    probe[:, :, 0] = np.linspace(0, 1, 40)
    s = t.score(probe.reshape(-1, 3)).reshape(50, 40)
    assert (np.diff(s, axis=1) <= 1e-9).all() and ((t.score(x) > 0) == (y == 1)).mean() > 0.85

    def walk(n, row):
        return t.value[n] if t.left[n] == n else walk(t.left[n] if row[t.feature[n]] <= t.threshold[n] else t.right[n], row)

    assert np.allclose(t.score(x[:20]), [t.start + sum(walk(n, row) for n in t.roots) for row in x[:20]])


PHRASES = {("gnu", "general", "public", "license"): "gpl", ("apache", "license"): "apache", ("cc", "by"): "cc-by", ("mit", "license"): "mit"}


def test_licences(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + ODD
    rows += [(10**6 + i, t) for i, t in enumerate(["MIT License. cc by mit license", "Apache, License apache license", "cc", "license mit", "gnu general public gnu general public license"])]
    rows.append((10**6 + 50, "words before. Permission is hereby granted, free of charge, to any person obtaining a copy of this thing and documentation files, to deal in the Software without restriction"))
    rows.append((10**6 + 51, "permission granted to any person of this software without restriction"))
    got = {}
    for r in license_scan.scan(frame(spark, rows)).collect():
        got.setdefault((r.doc_id, r.n_words), []).append(r)
    for doc, text in rows:
        words = plain(text)
        at = [(i, label) for p, label in PHRASES.items() for i in range(len(words)) if tuple(words[i : i + len(p)]) == p]
        r = got[doc, len(words)].pop()
        places = [i for i, _ in at]
        assert (r.n_base, r.first_word, r.last_word) == (len(at), min(places, default=None), max(places, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in at})) and {*filter(None, r.base_labels.split(","))} <= {*r.labels.split(",")} and 0 <= r.score <= 1
        if doc == 10**6 + 50:
            assert r.labels == "mit-text" and 0.6 <= r.score < 1
        if doc == 10**6 + 51:
            assert r.labels == ""


def brute_hits(words, items, window):
    hit, names = set(), set()
    for name, own in items:
        n = min(window, len(own))
        for a in range(len(own) - n + 1) if own else ():
            for i in range(len(words) - n + 1):
                if words[i : i + n] == own[a : a + n]:
                    hit |= set(range(i, i + n))
                    names.add(name)
    return hit, sorted(names)


@pytest.mark.parametrize("block_words", [200_000, 30])
def test_decontamination(spark, block_words):
    r = np.random.default_rng(3)
    word = lambda n: [chr(97 + x) for x in r.integers(0, 4, n)]
    items = [(str(i), word(int(r.integers(1, 9)))) for i in range(14)] + [("14", []), ("15", ["a", "b", "c", "d"]), ("16", ["a", "b", "c", "d"])]
    docs = [(i, " ".join(word(int(r.integers(0, 60))))) for i in range(120)] + ODD
    table = spark.createDataFrame([(n, " ".join(w).upper()) for n, w in items] + [(None, "a b"), ("17", None)], "item_id string, text string")
    got = {}
    for x in decontaminate.scan(frame(spark, docs), table, window=4, block_words=block_words).collect():
        got.setdefault((x.doc_id, x.n_words), []).append(x)
    for doc, text in docs:
        words = plain(text)
        if len(words) > 1000:
            continue
        x = got[doc, len(words)].pop()
        hit = {i for s in x.spans for i in range(s.start, s.end)}
        assert (hit, x["items"]) == brute_hits(words, items, 4)
    assert decontaminate.scan(frame(spark, docs), table.limit(0)).filter("size(spans) > 0").count() == 0
    assert decontaminate.scan(frame(spark, []), table).count() == 0


def test_decontamination_query(spark):
    items = [(str(r.item_id), plain(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = {}
    for name, own in items:
        n = min(10, len(own))
        for a in range(len(own) - n + 1) if own else ():
            windows.setdefault(tuple(own[a : a + n]), set()).add(name)
    got = {r.doc_id: r for r in queries.op8_decontaminate(spark, SF).collect()}
    sizes = {len(w) for w in windows}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        words, hit, names = plain(r.text), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if found := windows.get(tuple(words[i : i + n])):
                    hit |= set(range(i, i + n))
                    names |= found
        own = got[r.doc_id]
        assert (own.n_words, own.n_hit, own.n_items) == (len(words), len(hit), len(names)) and own.contaminated == bool(hit)
        assert own.items_sha256 == hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()


def test_clean(spark):
    docs = frame(spark, [(1, "Keep. ONE, two three! tail\nend of a longer text it is"), (2, "one two three"), (3, None), (4, "nothing here")])
    table = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.clean(docs, table, window=3).collect()}
    assert {k: r.text for k, r in got.items()} == {1: "Keep. ! tail\nend of a longer text it is", 3: None, 4: "nothing here"}
    assert got[1]["items"] == "z" and decontaminate.clean(docs, table, window=3).columns == docs.columns


def every_start(text, drift=6, share=0.6, rare=8):
    """All (label, start) by trying every start of every template."""
    templates = (*license_scan.BASE, *license_scan.NOTICES)
    index = license_scan.Index(templates, len(license_scan.BASE), max(rare, *(len(plain(t.text)) for t in license_scan.BASE)))
    words, out = plain(text), set()
    number = {i: w.decode() for w, i in index.words.items()}
    for t, template in enumerate(templates):
        own = [(number[w], i) for w, posts in index.postings.items() for u, i in posts if u == t]
        key, body = plain(template.key or template.text), plain(template.text)
        at = next(i for i in range(len(body)) if body[i : i + len(key)] == key)
        base = t < len(license_scan.BASE)
        need = len(own) if base else max(2, -(-round(share * 100) * len(own) // 100))
        for start in range(-len(body), len(words)):
            if start + at < 0 or words[start + at : start + at + len(key)] != key:
                continue
            slack = 0 if base else drift
            agree = sum(any(0 <= start + i + d < len(words) and words[start + i + d] == w for d in range(-slack, slack + 1)) for w, i in own)
            if agree >= need:
                out.add((template.label, start))
    return out


def test_every_notice_is_found(spark):
    mit, gpl = "released under the MIT license", license_scan.NOTICES[0].text
    rows = [
        (1, "under the mit x x " * 8 + mit), (2, " ".join([mit] * 3)), (3, f"{gpl} {gpl}\n{mit}. {gpl}"), (4, "a " * 500 + gpl + " b" * 500),
        (5, " ".join(t.text for t in license_scan.NOTICES)), (6, " x ".join(t.text for t in reversed(license_scan.NOTICES))),
        (7, gpl.replace("free software you can", "free, very free software and you can")), (8, "the mit license it can you " * 40 + mit + " it can you"),
    ]
    got = {r.doc_id: r for r in license_scan.scan(frame(spark, rows)).collect()}
    for d, text in rows:
        assert {(m.label, m.start) for m in got[d].matches} == every_start(text), d
    assert "mit-notice" in got[1].labels and sum(m.label == "mit-notice" for m in got[2].matches) == 3
    assert set(got[5].labels.split(",")) == {t.label for t in (*license_scan.BASE, *license_scan.NOTICES)} - {"cc-by" if "cc by" not in " ".join(t.text for t in license_scan.NOTICES) else "-"}


def test_empty_tables(spark):
    none, labels = frame(spark, []), spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    assert license_scan.scan(none).collect() == []
    assert toxicity.score(none, toxicity.train(none, labels)).collect() == []


def test_embeddings_have_many_dimensions():
    r = np.random.default_rng(2)
    words = [f"w{k}".encode() for k in range(300)]
    docs = [[words[i] for i in r.integers(0, 250, 40)] + ([words[280 + i % 7]] * 2 if i % 2 else []) for i in range(200)]
    y = np.arange(200) % 2
    bagged = toxicity.bags(docs, 1 << 12, (3, 4, 5), 20)
    table, soft, bias = toxicity.embeddings(bagged, y.astype(float), 1 << 12, 8, 300, 64, 3.0, 10.0, 0.05, 7)
    singular = np.linalg.svd(table - table.mean(axis=0), compute_uv=False)
    assert (singular > 0.05).sum() == 8
    held = np.zeros(1 << 12, bool)
    for own, _ in bagged:
        held[own] = True
    assert (table[~held] == 0).all() and (np.abs(table[held]).sum(axis=1) > 0).all()
    odds = [(part @ table[own]) @ (soft[:, 1] - soft[:, 0]) + bias[1] - bias[0] for own, part in bagged]
    assert np.mean((np.array(odds) > 0) == (y == 1)) > 0.95


def test_embeddings_by_plain_loops():
    """The same steps, document by document and dimension by dimension."""
    r = np.random.default_rng(4)
    docs = [(np.sort(r.choice(40, 6, replace=False)), r.random(6).astype(np.float32)) for _ in range(12)]
    y = np.arange(12) % 2.0
    args = dict(buckets=40, dims=3, steps=9, batch=4, rate=0.7, curb=2.0, spread=0.05, seed=3)
    table, soft, bias = toxicity.embeddings(docs, y, **args)
    random = np.random.default_rng(3)
    held = [sum(k in own for own, _ in docs) for k in range(40)]
    toxic = [sum(k in own for (own, _), label in zip(docs, y) if label) for k in range(40)]
    logit = lambda p: np.log(p / (1 - p))
    pace = [0.7 * (logit((toxic[k] + 1.0) / (held[k] + 2.0)) - logit(0.5)) ** 2 for k in range(40)]
    t = random.normal(0, 0.05, (40, 3)).astype(np.float32)
    t[[k for k in range(40) if not held[k]]] = 0
    w, b, seen = random.normal(0, 1.0, (3, 2)), np.zeros(2), np.full(40, 1e-10)
    for _ in range(3):
        order = random.permutation(12)
        for start in range(0, 12, 4):
            grad, move, lean = np.zeros(40), np.zeros((3, 2)), np.zeros(2)
            for i in order[start : start + 4].tolist():
                own, part = docs[i]
                mean = sum(p * t[k] for k, p in zip(own, part))
                e = np.exp(mean @ w + b)
                wrong = (e / e.sum() - np.eye(2)[int(y[i])]) / 4
                for k, p in zip(own, part):
                    grad[k] += p * wrong[1]
                move += np.outer(mean, wrong)
                lean += wrong
            line = w[:, 1] - w[:, 0]
            for k in range(40):
                if grad[k]:
                    seen[k] += grad[k] ** 2 * (line**2).mean()
                    t[k] -= pace[k] * grad[k] / np.sqrt(seen[k]) * line
            w, b = w - 0.02 * move, b - 0.5 * lean
    assert np.allclose(table, t, atol=1e-4) and np.allclose(soft, w, atol=1e-4) and np.allclose(bias, b, atol=1e-4)


def test_subwords_are_character_ngrams():
    words = ["abc", "é中x", "a"]
    rows, edge = toxicity.subwords([w.encode() for w in words], 1 << 30, (2, 3))
    sizes = [len({f"<{w}>"} | {f"<{w}>"[i : i + n] for n in (2, 3) for i in range(len(w) + 3 - n) if n < len(w) + 2}) for w in words]
    assert np.diff(edge).tolist() == sizes
    again, e = toxicity.subwords([b"xabc", b"abcx"], 1 << 30, (2, 3))
    assert len(set(again[: e[1]]) & set(rows[: edge[1]])) == len(["c>", "ab", "bc", "abc", "bc>"])


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op10_toxicity(spark, sf).collect()
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    s, y = map(np.array, zip(*held))
    rank = np.argsort(np.argsort(s))
    auc = (rank[y == 1].mean() - (y.sum() - 1) / 2) / (y == 0).sum()
    assert auc > 0.9


def test_toxicity_odd_rows(spark):
    model = toxicity.fit([[b"bad", b"word"]] * 30 + [[b"nice", b"word"]] * 30, np.repeat([1.0, 0.0], 30), buckets=1 << 12, pad=0)
    rows = toxicity.score(frame(spark, [*ODD, (9, "baad word"), (10, "nice")]), model).collect()
    got = {r.doc_id: r.score for r in rows}
    assert len(rows) == len(ODD) + 2 and got[9] > 0.5 > got[10] and got[1] == got[2] == got[3]
    none = toxicity.train(frame(spark, ODD), spark.createDataFrame([], "doc_id long, toxic int"))
    assert {round(r.score, 6) for r in toxicity.score(frame(spark, ODD), none).collect()} == {0.01}


def planted(r, toxic, word):
    """60 words of a small vocabulary, in a toxic document one word of its own."""
    own = [f"w{i}".encode() for i in r.integers(0, 500, 60)]
    return [*own, word.encode()] if toxic else own


def test_toxicity_of_words_that_few_documents_hold():
    r = np.random.default_rng(3)
    bad = ["zorgly", "quibbax", "fnordle", "grimpty", "blaxxor", "vuncheo", "skrelph", "jubtick", "hozzaym", "dwemfla"]
    learned = [(planted(r, True, bad[i % 10]), 1.0) for i in range(60)] + [(planted(r, False, ""), 0.0) for _ in range(400)]  # each word in six documents
    model = toxicity.fit([d for d, _ in learned], np.array([y for _, y in learned]))
    scores = toxicity.Scores(model).of([planted(r, i < 50, bad[i % 10]) for i in range(250)])
    assert (scores[:50] >= 0.7).mean() >= 0.7 and (scores[50:] >= 0.7).mean() <= 0.02
    assert toxicity.Scores(model).of([planted(r, True, "zorgl1y")])[0] > scores[50:].mean()


def test_toxicity_learns_from_whole_texts(spark):
    r = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(120):
        words = [f"w{x}" for x in r.integers(0, 300, 1500)]
        if i % 2:
            words[(i * 37) % 1500] = "zorgly"  # one word anywhere in a long text
        rows.append((i, " ".join(words)))
        labels.append((i, i % 2))
    docs = frame(spark, rows)
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, table, steps=200, buckets=1 << 14)
    words = [t.encode().split() for _, t in rows]
    whole = toxicity.fit(words, np.array([y for _, y in labels], float), steps=200, buckets=1 << 14)
    assert np.allclose(model.weight, whole.weight) and np.isclose(model.bias, whole.bias)
