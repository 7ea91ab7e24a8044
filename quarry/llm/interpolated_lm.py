"""Bigram language model by deleted interpolation.

The probability of a word after another is a mixture of maximum-likelihood
estimates, bigram, unigram and uniform, whose weights depend on the bucket
(power of two) of the context's frequency.  A part of the training documents is
deleted from the counts and the weights are learned on it by
expectation-maximisation; scores then use the counts of all training documents.

How it is spread: documents are tokenised once into blocks of bounded size,
kept as a written table.  Each block asks for the counts of its distinct words
and bigrams by hash: sorted, packed requests go to shards, a shard adds up the
training counts of all blocks for each key and answers every request in its
own order.  So neither vocabulary nor counts are ever in one place, frequent
words are one number per block before any shuffle, and what is exchanged grows
with the distinct bigrams of each block, not with the tokens.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import store
from quarry.llm.text import Words, mixed, pieces, spaced_lower, texts
from quarry.llm.token_file import decode, encode
from quarry.llm.tokens import with_end

#: What ends every document; no word is white space.
END = b"\n"
#: Folds by doc_id: 0 is never learned from, 1 is deleted from the counts to learn the weights.
FOLDS, OUT, DELETED = 10, 0, 1
BLOCKS = "block long, held boolean, n_tokens long, doc_ids binary, nulls binary, folds binary, lens binary, vocab binary, control binary, data binary"
REQUESTS = "kind int, shard int, block long, low binary, high binary, all binary, kept binary"
ANSWERS = "kind int, shard int, block long, all binary, kept binary, n_all long, v_all long, n_kept long, v_kept long"
SCORES = "doc_id long, fold int, n_tokens long, n_known long, base_score double, score double"
#: Keys of one shard, about.
SHARD_KEYS = 2_500_000
BUCKETS = 24
#: Width of a bin of log2 probability ratios in the statistics of the deleted part.
BIN = 0.125
#: Tokens, about, that are looked at at a time once a block's counts are known.
STEP = 1 << 18


def _pack(x: np.ndarray, kind: str) -> bytes:
    return zlib.compress(x.astype(kind).tobytes(), 1)


def _unpack(x: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(x), kind)


class Draft:
    """An open block: its words are numbered piece by piece, so that what
    grows with its texts is 4 bytes a token."""

    def __init__(self) -> None:
        self.words = Words(most=1 << 40)
        self.end = self.words[END]
        self.docs: list[int | None] = []
        self.folds: list[int] = []
        self.size = 0
        self._waiting: list[list[bytes]] = []
        self._ids: list[np.ndarray] = []
        self._lens: list[np.ndarray] = []

    def add(self, doc: int | None, fold: int, text: bytes) -> None:
        self.docs.append(doc)
        self.folds.append(fold)
        self.size += len(text)
        self._waiting.append(spaced_lower(text))

    def number(self) -> None:
        """Ids, with each document's end, of the texts added since the last time."""
        if not self._waiting:
            return
        ids, offsets = self.words.ids(self._waiting)
        out, ends = with_end(ids, offsets, self.end)
        self._ids.append(out)
        self._lens.append(np.diff(ends).astype("<u4"))
        self._waiting = []

    def columns(self) -> tuple:
        """The block's columns from n_tokens on."""
        self.number()
        ids, lens = np.concatenate(self._ids), np.concatenate(self._lens)
        self._ids = self._lens = []
        order = np.argsort(-np.bincount(ids, minlength=len(self.words)), kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order))
        control, data = encode(rank[ids])
        docs = np.array([d or 0 for d in self.docs], "<i8").tobytes(), bytes(d is None for d in self.docs), np.array(self.folds, "i1").tobytes()
        return (len(ids), *docs, lens.tobytes(), self.words.lanes()[order, 0].tobytes(), control, data)


def blocks(documents: DataFrame, block_bytes: int = 16 << 20) -> DataFrame:
    """Tokenised blocks: documents of the deleted fold and others apart."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 30
        open_blocks = {True: Draft(), False: Draft()}

        def close(held: bool) -> pa.RecordBatch:
            nonlocal number
            number += 1
            row = (number, held, *open_blocks.pop(held).columns())
            open_blocks[held] = Draft()
            kinds = (pa.int64(), pa.bool_(), pa.int64(), *[pa.binary()] * 7)
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], [c.split()[0] for c in BLOCKS.split(", ")])

        for batch in pieces(batches):
            for doc, fold, text in zip(batch["doc_id"].to_pylist(), batch["fold"].to_pylist(), texts(batch["text"]), strict=True):
                held = fold == DELETED
                open_blocks[held].add(doc, fold, text)
                if open_blocks[held].size >= block_bytes:
                    yield close(held)
            for draft in open_blocks.values():
                draft.number()
        for held in (True, False):
            if open_blocks[held].docs:
                yield close(held)

    fold = F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % FOLDS, F.lit(-1)).cast("int")
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), fold.alias("fold"))
    return store.table(source.mapInArrow(task, BLOCKS), "lm-blocks")


def numbered(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, ascending, and the number of each value among them."""
    order = np.argsort(x)
    x = x[order]
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    x = x[new]
    place = np.empty(len(order), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    return x, place


class Block:
    """A block's tokens, and its distinct keys in the order of its requests."""

    def __init__(self, row: dict) -> None:
        self.folds = np.frombuffer(row["folds"], "i1")
        self.lens = np.frombuffer(row["lens"], "<u4").astype(np.int64)
        self.ids = decode(row["control"], row["data"], row["n_tokens"]).view(np.int32)
        self.vocab = np.frombuffer(row["vocab"], np.uint64)
        self.fold = np.repeat(self.folds, self.lens)

    @property
    def before(self) -> np.ndarray:
        """Word before each token; before the first, what ended the document before."""
        return np.roll(self.ids, 1)

    def spans(self) -> Iterator[tuple[slice, slice]]:
        """Runs of whole documents of some ``STEP`` tokens, and their tokens."""
        ends = np.cumsum(self.lens)
        first = 0
        while first < len(ends):
            begin = int(ends[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(ends, begin + STEP, "right")))
            yield slice(first, last), slice(begin, int(ends[last - 1]))
            first = last

    def keys(self, kind: int, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys sorted by shard and low bits, the place of each
        token's key among them, and each key's shard.  Kind 0: words, 1: bigrams."""
        if kind == 0:
            raw, place = self.vocab, self.ids
        else:
            used, place = numbered(self.before.astype(np.int64) * len(self.vocab) + self.ids)
            raw = mixed(self.vocab[used // len(self.vocab)] * np.uint64(0x9E3779B97F4A7C15) + self.vocab[used % len(self.vocab)])
            del used
        shard = ((raw >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.uint32)
        low = mixed(raw) & np.uint64(0xFFFFFFFFFFFF)
        del raw
        order = np.lexsort((low, shard))
        to = np.empty(len(order), np.int32)
        to[order] = np.arange(len(order), dtype=np.int32)
        return low[order], to[place], shard[order]


def _requests(made: DataFrame, shards: tuple[int, int]) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            own = Block(row)
            for kind in (0, 1):
                low, place, shard = own.keys(kind, shards[kind])
                every = np.bincount(place[own.fold > OUT], minlength=len(low))
                kept = np.bincount(place[own.fold > DELETED], minlength=len(low))
                edges = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]])
                for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    step = np.diff(low[a:b], prepend=np.uint64(0))
                    out = (kind, int(shard[a]), row["block"], (step & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes(), _pack(step >> np.uint64(32), "<u2"), _pack(every[a:b], "<u4"), _pack(kept[a:b], "<u4"))
                    kinds = (pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4)
                    yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(out, kinds, strict=True)], [c.split()[0] for c in REQUESTS.split(", ")])

    return made.mapInArrow(task, REQUESTS)


def _answers(requests: DataFrame) -> DataFrame:
    """Counts over all blocks for every request, in its order; one more row per
    shard (block -1) has the shard's tokens and distinct keys in training."""

    def add(group: pd.DataFrame) -> pd.DataFrame:
        keys = [np.cumsum(np.frombuffer(a, "<u4").astype(np.uint64) | (_unpack(b, "<u2").astype(np.uint64) << np.uint64(32)), dtype=np.uint64) for a, b in zip(group["low"], group["high"], strict=True)]
        edges = np.cumsum([0, *map(len, keys)])
        used, place = np.unique(np.concatenate(keys), return_inverse=True)
        counts = []
        for c in ("all", "kept"):
            own = np.concatenate([_unpack(x, "<u4") for x in group[c]])
            counts.append(np.bincount(place, own, len(used)).astype(np.int64))
        rows = [(b, *(_pack(np.minimum(n[place[edges[i] : edges[i + 1]]], 2**32 - 1), "<u4") for n in counts), 0, 0, 0, 0) for i, b in enumerate(group["block"].tolist())]
        rows.append((-1, b"", b"", int(counts[0].sum()), int((counts[0] > 0).sum()), int(counts[1].sum()), int((counts[1] > 0).sum())))
        out = pd.DataFrame(rows, columns=["block", "all", "kept", "n_all", "v_all", "n_kept", "v_kept"])
        return out.assign(kind=group["kind"].iloc[0], shard=group["shard"].iloc[0])[[c.split()[0] for c in ANSWERS.split(", ")]]

    return store.table(requests.groupBy("kind", "shard").applyInPandas(add, ANSWERS), "lm-counts")


def _answered(made: DataFrame, answers: DataFrame, column: str) -> DataFrame:
    """Blocks with the counts ``column`` ("all" or "kept") of all their
    answers, which a block's own size bounds."""
    got = answers.filter("block >= 0").groupBy(F.col("block").alias("b")).agg(F.sort_array(F.collect_list(F.struct("kind", "shard", F.col(column).alias("n")))).alias("answers"))
    return made.join(got, made.block == got.b)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one: the others of a batch stay packed in Arrow."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: batch[c][i].as_py() for c in batch.schema.names}


def _counts(row: dict, shards: tuple[int, int]) -> tuple[Block, Iterator[tuple[slice, slice, np.ndarray, np.ndarray, np.ndarray]]]:
    """The block, and by runs of its documents: documents, tokens, count of
    each token's context, word and bigram."""
    own, by_kind = Block(row), []
    for kind in (0, 1):
        low, place, _ = own.keys(kind, shards[kind])
        n = np.concatenate([_unpack(a["n"], "<u4") for a in row["answers"] if a["kind"] == kind])
        if len(n) != len(low):
            raise ValueError("answers don't match their requests")
        by_kind.append((n, place))
    del low
    row.clear()
    (words, at), (pairs, pair_at) = by_kind

    def runs() -> Iterator[tuple[slice, slice, np.ndarray, np.ndarray, np.ndarray]]:
        last = words[at[-1]]  # before the first token, as before
        for docs, span in own.spans():
            word = words[at[span]].astype(np.int64)
            context = np.concatenate([[np.int64(last)], word[:-1]])
            last = word[-1]
            yield docs, span, context, word, pairs[pair_at[span]].astype(np.int64)

    return own, runs()


def bucket(context: np.ndarray) -> np.ndarray:
    """Bucket of a context's frequency: 0 unseen, then powers of two."""
    return np.minimum(np.frexp(context.astype(float))[1], BUCKETS - 1)


def _statistics(held: DataFrame, shards: tuple[int, int], n: int, v: int) -> pd.DataFrame:
    """Deleted tokens by bucket and by binned log2 ratios of their bigram and
    unigram estimates to the uniform one (0: the estimate is zero)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = lambda a, b: np.where(a > 0, np.maximum(1, np.round(np.log2(np.maximum(a, 1) / np.maximum(b, 1) * (v + 1)) / BIN) + 2000), 0).astype(np.int64)
        for row in _rows(batches):
            own, runs = _counts(row, shards)
            for _, span, *found in runs:
                context, word, pair = (x[own.fold[span] == DELETED] for x in found)
                key = (bucket(context) * 10_000 + ratio(pair, context)) * 10_000 + ratio(word, n)
                used, count = np.unique(key, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(count)], ["key", "n"])

    return held.mapInArrow(task, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).orderBy("key").toPandas()


def learn(statistics: pd.DataFrame, rounds: int = 200, tolerance: float = 1e-7) -> np.ndarray:
    """Weights (bigram, unigram, uniform) of each bucket by
    expectation-maximisation; a bucket without deleted tokens takes those of
    the nearest bucket below that has some."""
    key, n = statistics["key"].to_numpy(np.int64), statistics["n"].to_numpy(float)
    where, p2, p1 = key // 10**8, key // 10_000 % 10_000, key % 10_000
    density = np.stack([np.where(p > 0, 2.0 ** ((p - 2000) * BIN), 0.0) for p in (p2, p1)] + [np.ones(len(key))], axis=1)
    weights = np.full((BUCKETS, 3), 1 / 3)
    last = np.array([0.0, 0.9, 0.1])
    for b in range(BUCKETS):
        some = where == b
        if n[some].sum() == 0:
            weights[b] = last
            continue
        w = weights[b]
        for _ in range(rounds):
            part = density[some] * w
            part *= (n[some] / part.sum(axis=1))[:, None]
            new = part.sum(axis=0) / n[some].sum()
            new = np.maximum(new, 1e-6) / np.maximum(new, 1e-6).sum()
            done = np.abs(new - w).max() < tolerance
            w = new
            if done:
                break
        weights[b] = last = w
    return weights


def _scored(answered: DataFrame, shards: tuple[int, int], n: int, v: int, weights: np.ndarray) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            ids = [None if z else d for z, d in zip(row["nulls"], np.frombuffer(row["doc_ids"], "<i8").tolist(), strict=True)]
            own, runs = _counts(row, shards)
            for docs, _, context, word, pair in runs:
                w = weights[bucket(context)]
                p = w[:, 0] * pair / np.maximum(context, 1) + w[:, 1] * word / max(n, 1) + w[:, 2] / (v + 1)
                base = np.log10((word + 0.1) / (n + 0.1 * (v + 1)))
                lens = own.lens[docs]
                at = np.cumsum(lens) - lens
                score, low, known = (np.add.reduceat(x, at) for x in (np.log10(p), base, (word > 0).astype(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(ids[docs], pa.int64()), pa.array(own.folds[docs].astype(np.int32)), pa.array(lens), pa.array(known), pa.array(low), pa.array(score)], [c.split()[0] for c in SCORES.split(", ")])

    return answered.mapInArrow(task, SCORES)


def score(documents: DataFrame, block_bytes: int = 16 << 20) -> tuple[DataFrame, int, int, np.ndarray]:
    """Scores of all documents (doc_id, fold, n_tokens with the end, n_known,
    base_score, score in log10), training tokens, distinct training tokens and
    the mixture weights.

    Null and empty texts are their end token alone.  Documents with a null
    doc_id are scored, never learned from (fold -1).  Repeated rows count and
    are scored each; other columns play no part.  Without training documents
    every token is unknown and scores by the uniform part."""
    made = blocks(documents, block_bytes)
    size = made.agg(F.sum("n_tokens")).first()[0] or 0
    shards = (max(2, size // (8 * SHARD_KEYS)), max(4, size // SHARD_KEYS))
    answers = _answers(_requests(made, shards))
    n, v, n_kept, v_kept = (x or 0 for x in answers.filter("kind = 0 and block = -1").agg(F.sum("n_all"), F.sum("v_all"), F.sum("n_kept"), F.sum("v_kept")).first())
    held = made.filter("held").select("block").withColumnRenamed("block", "h")
    weights = learn(_statistics(_answered(made.filter("held"), answers.join(held, answers.block == held.h, "left_semi"), "kept"), shards, n_kept, v_kept))
    return _scored(_answered(made, answers, "all"), shards, n, v, weights), n, v, weights
