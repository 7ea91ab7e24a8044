"""Quality rules: fixed base rules plus gradient-boosted trees over document
statistics.

The trees are trained in numpy on a bounded sample of labelled rows and
flattened into node arrays (feature, threshold, children, value), so a batch of
documents walks all trees level by level with array indexing.  Chosen features
are monotonic: a split on one is taken only if its children keep the order,
and each child's values stay on its side of the split's middle, so more of such
a feature never raises the quality.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import store
from quarry.llm.text import Cut, covered, mixed, pieces, starts, texts, windows

#: Characters of the symbol count (fixed value).
SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RATIOS = ["word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "mark_share", "digit_share", "line_words", "distinct_share", "top_word_share", "comma_share", "sentence_share", "log_words"]
#: -1: a larger value never raises the quality.
MONOTONIC = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": -1, "mark_share": -1, "top_word_share": -1}
FEATURES = ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS), *(f"{c} double" for c in RATIOS)])


def _classes() -> np.ndarray:
    """Class of each byte: 0 other, 1 white space, 2 symbol, 3 A-Z, 4 loud mark, 5 digit, 6 continuation byte, 7 comma, 8 sentence end, 9 line end."""
    c = np.zeros(256, np.uint8)
    c[[*b" \t\x0b\x0c\r"]] = 1
    c[[*SYMBOLS]] = 2
    c[65:91] = 3
    c[[*b"!?"]] = 4
    c[48:58] = 5
    c[128:192] = 6
    c[[*b",;:"]] = 7
    c[[*b"."]] = 8
    c[10] = 9
    return c


CLASSES = _classes()


def statistics(column: pa.Array) -> dict[str, np.ndarray]:
    """All counts and ratios of some texts."""
    docs = texts(column)
    n = len(docs)
    cut = Cut(column)
    ids, offsets = cut.ids, cut.offsets
    lens = np.diff(offsets)
    by = np.array([np.bincount(CLASSES[np.frombuffer(x, np.uint8)], minlength=10) for x in docs], np.int64).reshape(n, 10)
    chars = by.sum(axis=1) - by[:, 1] - by[:, 6] - by[:, 9]

    # words in windows of five that occur twice or more in their document
    at = starts(offsets, 5)
    owner = np.repeat(np.arange(n), np.maximum(lens - 4, 0))
    salt = mixed(owner.astype(np.uint64) + np.uint64(1))
    keys = windows(cut.lanes()[ids, 0], 5)[at] ^ salt
    ordered = np.sort(keys)
    again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    twice = at[np.isin(keys, again)] if len(again) else at[:0]
    where = np.repeat(np.arange(n), lens)
    repeats = np.bincount(where[covered(twice, 5, len(ids))], minlength=n) if len(twice) else np.zeros(n, np.int64)

    pair = np.sort((where << 32) | ids)
    first = np.concatenate([[True], pair[1:] != pair[:-1]]) if len(pair) else np.zeros(0, bool)
    runs = np.diff(np.concatenate([np.flatnonzero(first), [len(pair)]]))
    run_doc = (pair[first] >> 32) if len(pair) else pair
    distinct = np.bincount(run_doc, minlength=n)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, run_doc, runs)

    dup, lines = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i, x in enumerate(docs):
        own = [y for y in x.split(b"\n") if y and not y.isspace()]
        lines[i], dup[i] = len(own), len(own) - len(set(own))
    some, letters = np.maximum(lens, 1), np.maximum(chars, 1)
    return {
        "n_words": lens, "word_chars": chars, "n_symbols": by[:, 2], "n_dup_lines": dup, "n_repeat_words": repeats,
        "word_length": chars / some, "symbol_share": by[:, 2] / letters, "dup_line_share": dup / np.maximum(lines, 1), "repeat_share": repeats / some, "upper_share": by[:, 3] / letters,
        "mark_share": by[:, 4] / letters, "digit_share": by[:, 5] / letters, "line_words": lens / np.maximum(lines, 1), "distinct_share": distinct / some, "top_word_share": top / some,
        "comma_share": by[:, 7] / some, "sentence_share": by[:, 8] / some, "log_words": np.log1p(lens),
    }


def features(documents: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Statistics of every whole text; null text: no words, all zero."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            s = statistics(batch["text"])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(s[c].astype(np.int64)) for c in COUNTS), *(pa.array(s[c].astype(float)) for c in RATIOS)], ["doc_id", *COUNTS, *RATIOS])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(task, FEATURES)


@dataclass
class Trees:
    """Flat nodes of all trees: a leaf's children are itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of good quality for rows of features."""
        if not len(self.roots):
            return np.full(len(x), self.start)
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = np.where(x[row, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
        return self.start + self.value[node].sum(axis=1)


def fit(x: np.ndarray, y: np.ndarray, monotonic: np.ndarray, rounds: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 1.0, least: int = 20) -> Trees:
    """Boosted trees for 0/1 labels by second-order gain over binned features."""
    n, d = x.shape
    nodes: list[list[float]] = []
    roots: list[int] = []
    share = (y.sum() + 1) / (n + 2)
    start = float(np.log(share / (1 - share)))
    if n < 2 * least or y.min() == y.max():
        none = np.zeros(0, np.int64)
        return Trees(none, np.zeros(0), none, none, np.zeros(0), none, 0, start)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)  # bin <= k: x <= cuts[k]
    shift = np.arange(d) * bins
    margin = np.full(n, start)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        root = len(nodes)
        nodes.append([0, 0, root, root, 0])
        roots.append(root)
        open_nodes = [(root, np.arange(n), 0, -np.inf, np.inf)]
        while open_nodes:
            at, rows, level, low, high = open_nodes.pop()
            gs, hs = g[rows].sum(), h[rows].sum()
            value = float(np.clip(gs / (hs + ridge), low, high))
            nodes[at][4] = rate * value
            margin[rows] += rate * value
            if level == depth or len(rows) < 2 * least:
                continue
            flat = (binned[rows] + shift).ravel()
            gl, hl, nl = (np.cumsum(np.bincount(flat, w, d * bins).reshape(d, bins), axis=1) for w in (np.repeat(g[rows], d), np.repeat(h[rows], d), np.ones(len(flat))))
            lv, rv = (np.clip(a / (b + ridge), low, high) for a, b in ((gl, hl), (gs - gl, hs - hl)))
            gain = gl * lv - 0.5 * (hl + ridge) * lv**2 + (gs - gl) * rv - 0.5 * (hs - hl + ridge) * rv**2
            ok = (nl >= least) & (len(rows) - nl >= least) & (monotonic[:, None] * (rv - lv) >= 0)
            gain = np.where(ok, gain, -np.inf)
            j, k = np.unravel_index(int(gain.argmax()), gain.shape)
            if gain[j, k] <= gs * value - 0.5 * (hs + ridge) * value**2 + 1e-6 or k >= len(cuts[j]):
                continue
            margin[rows] -= rate * value
            goes = binned[rows, j] <= k
            middle = (lv[j, k] + rv[j, k]) / 2
            left, right = len(nodes), len(nodes) + 1
            nodes.extend([[0, 0, left, left, 0], [0, 0, right, right, 0]])
            nodes[at] = [int(j), float(cuts[j][k]), left, right, 0]
            m = monotonic[j]
            open_nodes.append((left, rows[goes], level + 1, middle if m < 0 else low, middle if m > 0 else high))
            open_nodes.append((right, rows[~goes], level + 1, middle if m > 0 else low, middle if m < 0 else high))
    a = np.array(nodes)
    return Trees(a[:, 0].astype(np.int64), a[:, 1], a[:, 2].astype(np.int64), a[:, 3].astype(np.int64), a[:, 4], np.array(roots), depth, start)


def train(feats: DataFrame, labels: DataFrame, sample_rows: int = 20_000, **options) -> Trees:
    """Fit on at most ``sample_rows`` labelled documents: those whose hashed
    doc_id is smallest, so the sample is the same on every run and its size
    never grows with the corpus.  Rows with a null id or label are left out.
    Without labels, or with one class only, every document gets one score."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).dropna()
    rows = feats.join(known, "doc_id").select(F.xxhash64("doc_id").alias("h"), "quality", *RATIOS).orderBy("h", "quality").limit(sample_rows).toPandas()
    x, y = rows[RATIOS].to_numpy(float), rows["quality"].to_numpy(float)
    return fit(x, y, np.array([MONOTONIC.get(c, 0) for c in RATIOS]), **options)


def base_failed():
    """The fixed base rules: fewer than 10 words, or over a fifth of them in repeats."""
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


def verdicts(feats: DataFrame, trees: Trees, least: float = 0.35) -> DataFrame:
    """doc_id, counts, base_failed, quality (0 to 1) and kept."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch[c].to_numpy(zero_copy_only=False) for c in RATIOS], axis=1)
            yield batch.append_column("quality", pa.array(1 / (1 + np.exp(-trees.score(x)))))

    scored = feats.mapInArrow(task, FEATURES + ", quality double").withColumn("base_failed", base_failed())
    return scored.select("doc_id", *COUNTS, "base_failed", "quality", (~F.col("base_failed") & (F.col("quality") >= least)).alias("kept"))


def assess(documents: DataFrame, labels: DataFrame, sample_rows: int = 20_000, least: float = 0.35) -> DataFrame:
    """Verdict on every document: doc_id, the five counts, base_failed, quality
    and kept.  Texts are read once; their statistics are a written table that
    training and scoring share.  Null and empty texts fail the base rules;
    repeated rows are judged each; other columns play no part."""
    feats = store.table(features(documents), "quality-features")
    return verdicts(feats, train(feats, labels, sample_rows), least)


def keep(documents: DataFrame, labels: DataFrame, sample_rows: int = 20_000, least: float = 0.35) -> DataFrame:
    """The documents that pass, all columns kept.

    Training reads the statistics of the documents; the filter recomputes them
    in the scan instead of joining verdicts back, so no text is shuffled."""
    feats = store.table(features(documents.join(F.broadcast(_sampled(documents, labels, sample_rows)), "doc_id", "left_semi")), "quality-sample")
    trees = train(feats, labels, sample_rows)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            s = statistics(batch["text"])
            x = np.stack([s[c].astype(float) for c in RATIOS], axis=1)
            bad = (s["n_words"] < 10) | (s["n_repeat_words"] * 100 > s["n_words"] * 20)
            good = ~bad & (1 / (1 + np.exp(-trees.score(x))) >= least)
            yield batch.filter(pa.array(good))

    return documents.mapInArrow(task, documents.schema)


def _sampled(documents: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """doc_ids of the training sample, ``sample_rows`` at most."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).dropna()
    ids = documents.select(F.col("doc_id").cast("long").alias("doc_id"))
    return known.join(ids, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "quality").limit(sample_rows).select("doc_id").distinct()
