"""Exact substring deduplication with a count-min prefilter.

A window is 50 consecutive words of one document.  Words covered by a window
whose word sequence also starts in a document with a smaller doc_id go.

1. Each window has a key: the smallest hash among the runs of ``anchor_words``
   words inside it.  Equal windows have equal keys, and neighbouring windows
   mostly share theirs, so a document has a twentieth as many keys as windows.
   Every task builds a count-min sketch of the documents that have each key;
   the sketches are merged cell by cell.  The merged cells never count fewer
   documents than share a window.
2. A second pass sends on only windows all of whose cells count two documents
   or more, and groups them exactly by 128 bits of their word sequence; the
   smallest doc_id of each comes back by an equi-join.  No repeated window is
   lost: the sketch errs on the large side only.

The sketch is sized by the corpus, ``CELLS`` cells a row for each key expected,
2**``MOST_BITS`` at most: its bits are broadcast, 256 MB for two rows.  Beyond
that the filter lets more windows through; the result stays the same.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import store
from quarry.llm.text import Cut, Words, covered, field, mixed, pieces, sliding_min, spaced, starts, texts, windows

#: Cells of a slice of a sketch row, as a power of two.
SLICE_BITS = 18
#: Text bytes to a key, cells to a key, and the largest row, as a power of two.
KEY_BYTES, CELLS, MOST_BITS = 130, 8, 30
SKETCH = "part int, cells binary, twice binary"
WINDOWS = "doc_id long, at long, lane_a long, lane_b long"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class Windows:
    """Window hashes of the documents of a piece."""

    def __init__(self, column: pa.Array, size: int, anchor: int) -> None:
        cut = Cut(column)
        ids, self.offsets = cut.ids, cut.offsets
        self.at = starts(self.offsets, size)
        self.doc = np.repeat(np.arange(len(column)), np.maximum(np.diff(self.offsets) - size + 1, 0))
        self.size = size
        lanes = cut.lanes()
        self.a = lanes[ids, 0]
        self._b = lambda: lanes[ids, 1]
        self.keys = sliding_min(windows(self.a, anchor), size - anchor + 1)[self.at] if len(self.at) else np.zeros(0, np.uint64)

    def exact(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both 64-bit hashes of the chosen windows' word sequences."""
        return windows(self.a, self.size, 0)[self.at[some]], windows(self._b(), self.size, 1)[self.at[some]]


def cells(keys: np.ndarray, row: int, bits: int) -> np.ndarray:
    """Cell of each key in a row of the sketch."""
    return (mixed(keys + np.uint64(0x632BE59BD9B4E019 * (row + 1) % 2**64)) >> np.uint64(64 - bits)).astype(np.int64)


def sketch_bits(documents: DataFrame) -> int:
    """Size of a sketch row for the documents, as a power of two."""
    size = documents.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    return min(max(SLICE_BITS, (CELLS * size // KEY_BYTES).bit_length()), MOST_BITS)


def _packed(x: np.ndarray) -> bytes:
    """Ascending numbers: differences as 32-bit words, deflated."""
    return zlib.compress(np.diff(x, prepend=0).astype("<u4").tobytes(), 1)


def _unpacked(x: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(x), "<u4").astype(np.int64))


def repeated_cells(documents: DataFrame, size: int, anchor: int, rows: int, bits: int) -> np.ndarray:
    """Bits, row after row: cells in which two documents or more were counted.

    Each task emits its sketch by slices: the cells counted once, and those
    counted twice or more.  A merging task holds one slice at a time."""
    slices = 1 << max(0, bits - SLICE_BITS)
    span = 1 << min(bits, SLICE_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in pieces(batches):
            w = Windows(batch["text"], size, anchor)
            new = np.ones(len(w.keys), bool)
            new[1:] = (w.keys[1:] != w.keys[:-1]) | (w.doc[1:] != w.doc[:-1])
            keys, doc = w.keys[new], w.doc[new]
            order = np.lexsort((keys, doc))
            keys, doc = keys[order], doc[order]
            once = np.ones(len(keys), bool)
            once[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
            held.append(keys[once])
        if not held:
            return
        keys = np.concatenate(held)
        for row in range(rows):
            cell = np.sort(cells(keys, row, bits))
            first = np.ones(len(cell), bool)
            first[1:] = cell[1:] != cell[:-1]
            used, n = cell[first], np.diff(np.append(np.flatnonzero(first), len(cell)))
            part = used // span
            edges = np.searchsorted(part, np.arange(slices + 1))
            for p in np.unique(part).tolist():
                own, twice = used[edges[p] : edges[p + 1]] - p * span, n[edges[p] : edges[p + 1]] > 1
                yield pa.RecordBatch.from_arrays([pa.array([row * slices + p], pa.int32()), pa.array([_packed(own[~twice])], pa.binary()), pa.array([_packed(own[twice])], pa.binary())], ["part", "cells", "twice"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seen = -1, np.zeros(span, np.uint8)

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(seen == 2).tobytes()], pa.binary())], ["part", "bits"])

        for batch in batches:
            for part, one, two in zip(*(batch[c].to_pylist() for c in ("part", "cells", "twice")), strict=True):
                if part != now:
                    if now >= 0:
                        yield done()
                    now, seen = part, np.zeros(span, np.uint8)
                place = _unpacked(one)
                seen[place] = np.minimum(seen[place] + 1, 2)
                seen[_unpacked(two)] = 2
        if now >= 0:
            yield done()

    sketch = documents.select(F.col("text").cast("string").alias("text")).mapInArrow(count, SKETCH)
    merged = sketch.repartition("part").sortWithinPartitions("part").mapInArrow(merge, "part int, bits binary").toArrow()
    out = np.zeros((rows * slices, span // 8), np.uint8)
    for part, raw in zip(merged["part"].to_pylist(), merged["bits"].to_pylist(), strict=True):
        out[part] = np.frombuffer(raw, np.uint8)
    return out.reshape(-1)


def _estimated(keys: np.ndarray, repeated: np.ndarray, rows: int, bits: int) -> np.ndarray:
    """Whether every row's cell of a key counts two documents or more."""
    out = np.ones(len(keys), bool)
    for row in range(rows):
        cell = cells(keys[out], row, bits) + (row << bits)
        out[out] = (repeated[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1
    return out


def repeats(documents: DataFrame, repeated: Broadcast, size: int, anchor: int, rows: int, bits: int) -> DataFrame:
    """doc_id, text_key and starts of the windows that also start in a
    document with a smaller doc_id (of a window that a document repeats, one
    start)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            raw = texts(batch["text"])
            w = Windows(batch["text"], size, anchor)
            some = np.flatnonzero(_estimated(w.keys, repeated.value, rows, bits))
            if len(some):
                a, b = w.exact(some)
                # a window that a document repeats is sent once: no text made of one line weighs more than its distinct windows
                order = np.lexsort((b, a, w.doc[some]))
                same = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1]) & (w.doc[some][order][1:] == w.doc[some][order][:-1])
                once = np.sort(order[np.concatenate([[True], ~same])])
                some, a, b = some[once], a[once], b[once]
                names = np.array([zlib.crc32(x) for x in raw], np.int64)
                at = (names[w.doc[some]] << 32) | (w.at[some] - w.offsets[w.doc[some]])
                yield pa.RecordBatch.from_arrays([batch["doc_id"].take(pa.array(w.doc[some])), pa.array(at), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["doc_id", "at", "lane_a", "lane_b"])

    found = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null").mapInArrow(emit, WINDOWS)
    least = found.groupBy("lane_a", "lane_b").agg(F.min("doc_id").alias("least"))
    later = found.join(least, ["lane_a", "lane_b"]).filter("doc_id > least")
    text_key, start = F.shiftrightunsigned("at", 32), F.col("at").bitwiseAND(0xFFFFFFFF).cast("int")
    return later.groupBy("doc_id", text_key.alias("text_key")).agg(F.collect_list(start).alias("starts"))


def marked(documents: DataFrame, keep: list[str], size: int = 50, anchor_words: int = 8, rows: int = 2, bits: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The documents, as struct ``kept`` (columns ``keep`` and text): those
    that may repeat windows, with ``starts`` of the windows to remove (null:
    none), and the others, of which nothing goes.

    A document with a null doc_id keeps all words and removes none from
    others.  Rows that repeat a doc_id and text are treated alike; rows that
    repeat a doc_id with another text don't remove each other's words."""
    spark = documents.sparkSession
    store.bounded_batches(spark)
    anchor = min(anchor_words, size)
    bits = bits or sketch_bits(documents)
    shared = spark.sparkContext.broadcast(repeated_cells(documents, size, anchor, rows, bits))
    later = repeats(documents, shared, size, anchor, rows, bits)
    text = F.col("text").cast("string")
    own = documents.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).alias("key"), F.struct(*(c for c in keep if c != "text"), text.alias("text")).alias("kept"), F.lit(False).alias("some"))
    schema = own.schema

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "kept.text"):
            w = Windows(field(batch, "kept.text"), size, anchor)
            some = np.zeros(batch.num_rows, bool)
            some[w.doc[_estimated(w.keys, shared.value, rows, bits)]] = True
            yield batch.set_column(3, "some", pa.array(some))

    # only texts with a window estimated repeated meet the exact result; the others aren't shuffled
    asked = own.mapInArrow(ask, schema)
    hit = asked.filter("some").join(later, (F.col("id") == later.doc_id) & (F.col("key") == later.text_key), "left").select("kept", "starts")
    return hit, asked.filter("not some").select("kept")


def removed(doc: list[bytes], at: list[int] | None, size: int, words: Words) -> np.ndarray:
    """Which words are covered by the windows starting ``at`` or by equal ones
    of the same document."""
    if not at:
        return np.zeros(len(doc), bool)
    ids, _ = words.ids([doc])
    own = windows(words.lanes()[ids, 0], size)
    return covered(np.flatnonzero(np.isin(own, own[np.array(at)])), size, len(doc))


def summary(documents: DataFrame, size: int = 50, **options) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (the kept words joined by
    one space).  Null text: no words."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Words()
        for batch in pieces(batches, "kept.text"):
            n, gone, sha = [], [], []
            for raw, at in zip(texts(field(batch, "kept.text")), batch["starts"].to_pylist(), strict=True):
                words = spaced(raw)
                out = removed(words, at, size, table)
                n.append(len(words))
                gone.append(int(out.sum()))
                sha.append(hashlib.sha256(b" ".join(w for w, x in zip(words, out.tolist(), strict=True) if not x) if at else b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays([field(batch, "kept.doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha)], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    hit, rest = marked(documents, ["doc_id"], size, **options)
    return hit.unionByName(rest.withColumn("starts", F.lit(None).cast("array<int>"))).mapInArrow(task, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def clean(documents: DataFrame, size: int = 50, **options) -> DataFrame:
    """The documents without repeated words, all columns kept.

    A removed run goes from its first to its last word's characters; the rest
    of the text, white space included, stays as it is."""
    columns = documents.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Words()
        for batch in pieces(batches, "kept.text"):
            text = field(batch, "kept.text").to_pylist()
            for i, at in enumerate(batch["starts"].to_pylist()):
                if at:
                    text[i] = without(text[i], at, size, table)
            yield pa.RecordBatch.from_arrays([pa.array(text, pa.string()) if c == "text" else field(batch, f"kept.{c}") for c in columns], columns)

    # the others leave as they are, through no second Python worker
    hit, rest = marked(documents, columns, size, **options)
    return hit.mapInArrow(task, documents.schema).unionByName(rest.select(*(F.col("kept").getField(c).cast(documents.schema[c].dataType).alias(c) for c in columns)))


def without(text: str, at: list[int], size: int, words: Words) -> str:
    """The text less the words that ``removed`` tells."""
    raw = text.encode()
    places = [m.span() for m in WORD.finditer(raw)]
    out = removed([raw[a:b] for a, b in places], at, size, words)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], out.view(np.int8), [0]])))
    kept, last = [], 0
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        kept.append(raw[last : places[a][0]])
        last = places[b - 1][1]
    kept.append(raw[last:])
    return b"".join(kept).decode()
