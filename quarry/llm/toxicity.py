"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (with word borders) and of itself;
each is hashed to a row of an embedding table.  A document is the mean of its
words' vectors, and a softmax over two classes reads it.  Table and softmax are
trained jointly in numpy by mini-batch gradient descent from random embeddings.  An unseen misspelling shares
most n-grams, and so most of its vector, with the word it comes from.

A mean is linear, so for scoring table and softmax fold into one number per
row: a word's score is the mean over its subwords, a document's log-odds the
mean over its words.  Words are scored once per task, not once per occurrence.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import store
from quarry.llm.text import mixed, pieces, plain_lower, ragged, texts

SCHEMA = "doc_id long, score double"


def subwords(words: list[bytes], buckets: int, sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of all subwords in order, and the offset of each word.

    n-grams are of characters: a window that begins inside a character's bytes
    doesn't count, and its length is in characters."""
    raw = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8)
    lens = np.fromiter(map(len, words), np.int64, len(words)) + 2
    first = np.flatnonzero((raw & 0xC0) != 0x80)  # first byte of each character
    word = np.repeat(np.arange(len(words)), lens)
    owner = word[first]
    chars = np.bincount(owner, minlength=len(words))
    edge = np.append(first, len(raw))
    # prefix sums of a polynomial over bytes give every n-gram's hash
    base = np.uint64(0x100000001B3)
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(raw), base, np.uint64)]), dtype=np.uint64)
    inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(raw), pow(0x100000001B3, -1, 1 << 64), np.uint64)]), dtype=np.uint64)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:-1], out=sums[1:])

    def hashed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mixed((sums[b] - sums[a]) * inverse[a]) % np.uint64(buckets)

    begin = np.cumsum(lens) - lens
    rows, who = [hashed(begin, begin + lens)], [np.arange(len(words))]
    place = np.arange(len(first))
    last = np.cumsum(chars)[owner]  # one past the word's last character
    for n in sizes:
        ok = (place + n <= last) & (n < chars[owner])
        a = place[ok]
        rows.append(hashed(first[a], edge[a + n]))
        who.append(owner[a])
    rows, who = np.concatenate(rows).astype(np.int64), np.concatenate(who)
    order = np.argsort(who, kind="stable")
    return rows[order], np.concatenate([[0], np.cumsum(np.bincount(who, minlength=len(words)))])


def means(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean of each run of rows; an empty run is zero."""
    sums = np.zeros((len(values) + 1, *values.shape[1:]))
    np.cumsum(values, axis=0, out=sums[1:])
    n = np.diff(offsets)
    return (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(n, 1).reshape(-1, *[1] * (values.ndim - 1))


@dataclass
class Model:
    """One weight per table row, and the bias of the log-odds."""

    weight: np.ndarray
    bias: float
    sizes: tuple[int, ...]
    pad: int


def bags(docs: list[list[bytes]], buckets: int = 1 << 18, sizes: tuple[int, ...] = (3, 4, 5), pad: int = 20) -> list[tuple[np.ndarray, np.ndarray]]:
    """By document: the table rows of its words, and their parts of its mean."""
    names = sorted(set().union(*map(set, docs)))
    at = {w: i for i, w in enumerate(names)}
    cut = [subwords(names[i : i + 50_000], buckets, sizes) for i in range(0, len(names), 50_000)]
    rows, per = np.concatenate([np.zeros(0, np.int32), *(r.astype(np.int32) for r, _ in cut)]), np.concatenate([np.zeros(0, np.int64), *(np.diff(e) for _, e in cut)])
    edge = np.cumsum(per) - per
    out = []
    for d in docs:
        ids, count = np.unique(np.fromiter(map(at.__getitem__, d), np.int64, len(d)), return_counts=True)
        n = per[ids]
        own, place = np.unique(rows[np.repeat(edge[ids], n) + ragged(n)], return_inverse=True)
        out.append((own, np.bincount(place, np.repeat(count / (len(d) + pad) / n, n), len(own)).astype(np.float32)))
    return out


def fit(docs: list[list[bytes]], y: np.ndarray, buckets: int = 1 << 18, sizes: tuple[int, ...] = (3, 4, 5), pad: int = 20, **options) -> Model:
    """Train table and softmax jointly on documents' words."""
    return fit_bags(bags(docs, buckets, sizes, pad), y, buckets, sizes, pad, **options)


def fit_bags(docs: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, buckets: int = 1 << 18, sizes: tuple[int, ...] = (3, 4, 5), pad: int = 20, dims: int = 8, steps: int = 1_500, batch: int = 64, rate: float = 3.0, curb: float = 10.0, spread: float = 0.05, seed: int = 7) -> Model:
    """Train table and softmax jointly on documents' table rows."""
    table, soft, bias = embeddings(docs, y, buckets, dims, steps, batch, rate, curb, spread, seed)
    return Model(table @ (soft[:, 1] - soft[:, 0]), float(bias[1] - bias[0]), sizes, pad)


def embeddings(docs: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, buckets: int, dims: int, steps: int, batch: int, rate: float, curb: float, spread: float, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embedding table, softmax weights and biases.

    Rows that occur start at random points (deviation ``spread``), rows that
    don't stay at zero, neutral.  Softmax weights move too, so the steps of the
    table turn from batch to batch and reach all dimensions.

    Every row that occurs is trained, at a rate that grows with the square of
    what its documents' labels tell: the log-odds of their toxic share, shrunk
    towards the sample's by ``curb`` documents of the sample's share.  So rare
    rows and those that both classes hold alike stay nearer to neutral."""
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.01
        return np.zeros((buckets, dims), np.float32), np.zeros((dims, 2)), np.array([0.0, np.log(share / (1 - share))])
    held_by, toxic_by = np.zeros(buckets), np.zeros(buckets)
    for (own, _), label in zip(docs, y, strict=True):
        held_by[own] += 1
        toxic_by[own] += label
    share = y.mean()
    near = (toxic_by + curb * share) / (held_by + curb)
    pace = rate * np.abs(np.log(near / (1 - near)) - np.log(share / (1 - share))) ** 2
    size = np.array([len(own) for own, _ in docs])
    random = np.random.default_rng(seed)
    table = np.where(held_by[:, None] > 0, random.normal(0, spread, (buckets, dims)), 0.0).astype(np.float32)
    soft, bias = random.normal(0, 1.0, (dims, 2)), np.zeros(2)
    seen = np.full(buckets, 1e-10)
    for _ in range(-(-steps * batch // len(docs))):
        order = random.permutation(len(docs))
        for start in range(0, len(order), batch):
            own = order[start : start + batch]
            sub, part = (np.concatenate([docs[i][k] for i in own]) for k in (0, 1))
            mean = np.stack([docs[i][1] @ table[docs[i][0]] for i in own])
            logits = mean @ soft + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            wrong = p.copy()
            wrong[np.arange(len(own)), y[own].astype(int)] -= 1
            wrong /= len(own)
            # both classes' errors are opposite, so all dimensions share one sum over the documents
            line = soft[:, 1] - soft[:, 0]
            back = np.bincount(sub, part * np.repeat(wrong[:, 1], size[own]), buckets)
            hit = np.flatnonzero(back)
            seen[hit] += back[hit] ** 2 * (line**2).mean()
            table[hit] -= np.outer(pace[hit] * back[hit] / np.sqrt(seen[hit]), line)
            move, lean = mean.T @ wrong, wrong.sum(axis=0)
            soft -= 0.02 * move
            bias -= 0.5 * lean
    return table, soft, bias


class Scores(dict):
    """Word to its score's place; new words are scored together."""

    def __init__(self, model: Model, most: int = 400_000) -> None:
        super().__init__()
        self.model, self.most = model, most
        self.fresh: list[bytes] = []
        self.values = np.zeros(0)

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        self.fresh.append(word)
        return at

    def of(self, docs: list[list[bytes]]) -> np.ndarray:
        """Probability of the toxic class for each document."""
        if len(self) > self.most:
            self.clear()
            self.values = self.values[:0]
        places = [np.fromiter(map(self.__getitem__, d), np.int64, len(d)) for d in docs]
        for i in range(0, len(self.fresh), 50_000):
            rows, edge = subwords(self.fresh[i : i + 50_000], len(self.model.weight), self.model.sizes)
            self.values = np.concatenate([self.values, means(self.model.weight[rows], edge)])
        self.fresh = []
        odds = np.array([self.values[p].sum() / (len(p) + self.model.pad) if len(p) else 0.0 for p in places]) + self.model.bias
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def train(documents: DataFrame, labels: DataFrame, sample_rows: int = 8_000, sample_parts: int = 40_000_000, **options) -> Model:
    """Fit on at most ``sample_rows`` labelled documents (those with the
    smallest hashed doc_id, a quarter of them toxic where there are enough) and
    ``sample_parts`` table rows of theirs, both classes alike.  Tasks reduce
    each whole text to its table rows and their parts of its mean, sent
    compressed, so the driver holds 8 bytes for each of ``sample_parts``
    whatever the texts' lengths.  Rows with a null id or label are left out;
    conflicting labels of a document count each."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    picked = None
    for label, most in ((0, sample_rows * 3 // 4), (1, sample_rows // 4)):
        part = known.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        picked = part if picked is None else picked.unionByName(part)
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shape = {k: options[k] for k in ("buckets", "sizes", "pad") if k in options}

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            own = bags([plain_lower(x) for x in texts(b["text"])], **shape)
            rows = pa.array([zlib.compress(np.diff(x, prepend=0).astype("<i4").tobytes(), 1) for x, _ in own], pa.binary())
            parts = pa.array([zlib.compress(x.astype("<f4").tobytes(), 1) for _, x in own], pa.binary())
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["toxic"], pa.array([len(x) for x, _ in own], pa.int64()), rows, parts], ["doc_id", "toxic", "n", "rows", "parts"])

    # at most sample_rows rows, so the running sum per class is a small sort
    bagged = store.table(source.join(F.broadcast(picked), "doc_id").mapInArrow(reduced, "doc_id long, toxic int, n long, rows binary, parts binary"), "toxicity-sample")
    so_far = F.sum("n").over(Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id", "rows").rowsBetween(Window.unboundedPreceding, 0))
    share = F.when(F.col("toxic") == 1, sample_parts // 4).otherwise(sample_parts * 3 // 4)
    got = bagged.withColumn("so_far", so_far).filter(F.col("so_far") <= share).drop("so_far", "n").orderBy("doc_id", "toxic", "rows", "parts").toArrow()
    y = np.array(got["toxic"].to_pylist(), float)
    docs = [(np.cumsum(np.frombuffer(zlib.decompress(a.as_buffer()), "<i4"), dtype=np.int32), np.frombuffer(zlib.decompress(b.as_buffer()), "<f4")) for a, b in zip(got["rows"], got["parts"], strict=True)]
    del got
    return fit_bags(docs, y, **options)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every whole text.  Null and empty texts
    get the score of the bias alone; repeated rows are scored each and alike.
    An empty table has no rows."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(shared.value)
        for batch in pieces(batches):
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores.of([plain_lower(x) for x in texts(batch["text"])]))], ["doc_id", "score"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(task, SCHEMA)
