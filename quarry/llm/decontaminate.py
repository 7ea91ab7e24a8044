"""Benchmark decontamination with a generalised suffix automaton.

The items' words form one automaton per block of items.  Each document's words
are streamed through it; the state tells the longest run ending at a word that
occurs in an item, so every match of ``window`` words or more is seen at its
last word, together with the items that hold it.

Only words that some item has can move the automaton, so numpy first finds the
runs of such words that are long enough for a window; the rest of a text
resets the automaton and isn't stepped through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import store
from quarry.llm.text import field, pieces, plain_lower, texts

SPANS = "array<struct<start: int, end: int>>"
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


class Automaton:
    """Suffix automaton of several word sequences.

    ``window``: matches of this many words count; an item of fewer words is
    one window as a whole."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int) -> None:
        self.window = window
        self.words: dict[bytes, int] = {}
        sequences = [(name, [self.words.setdefault(w, len(self.words)) for w in words]) for name, words in items if words]
        self.least = min((min(window, len(s)) for _, s in sequences), default=window)
        length, link, step = [0], [-1], [{}]

        def copy_of(p: int, q: int, word: int) -> int:
            """Split state q so that it can end at p's length plus one."""
            length.append(length[p] + 1)
            link.append(link[q])
            step.append(dict(step[q]))
            new = len(length) - 1
            link[q] = new
            while p >= 0 and step[p].get(word) == q:
                step[p][word] = new
                p = link[p]
            return new

        for _, sequence in sequences:
            last = 0
            for word in sequence:
                q = step[last].get(word)
                if q is not None:  # an earlier item has it
                    last = q if length[q] == length[last] + 1 else copy_of(last, q, word)
                    continue
                length.append(length[last] + 1)
                link.append(0)
                step.append({})
                now, p = len(length) - 1, last
                while p >= 0 and word not in step[p]:
                    step[p][word] = now
                    p = link[p]
                if p >= 0:
                    q = step[p][word]
                    link[now] = q if length[q] == length[p] + 1 else copy_of(p, q, word)
                last = now
        self.length, self.link, self.step = length, link, step
        self._mark(sequences)

    def _mark(self, sequences: list[tuple[str, list[int]]]) -> None:
        """Items by state: those that hold the state's window, and short items
        that are a suffix of the state."""
        held: dict[int, set[str]] = {}
        short: dict[int, list[tuple[int, str]]] = {}
        for name, sequence in sequences:
            at = 0
            for i, word in enumerate(sequence):
                at = self.step[at][word]
                if i + 1 >= self.window:
                    held.setdefault(self._cut(at), set()).add(name)
            if len(sequence) < self.window:
                short.setdefault(at, []).append((len(sequence), name))
        self.held = {k: frozenset(v) for k, v in held.items()}
        self.short: dict[int, list[tuple[int, str]]] = {}
        for state in sorted(range(len(self.length)), key=self.length.__getitem__) if short else ():
            above = self.short.get(self.link[state], []) if state else []
            if own := above + short.get(state, []):
                self.short[state] = own

    def _cut(self, state: int) -> int:
        """The state of the last ``window`` words of a state."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def match(self, ids: list[int], found: set[str]) -> list[tuple[int, int]]:
        """(start, end) of the windows' words in a run of known words, end
        exclusive; their items go to ``found``."""
        spans, state, n = [], 0, 0
        for i, word in enumerate(ids):
            while state and word not in self.step[state]:
                state = self.link[state]
                n = self.length[state]
            if word in self.step[state]:
                state, n = self.step[state][word], n + 1
            if n >= self.window:
                spans.append((i + 1 - n, i + 1))
                found |= self.held[self._cut(state)]
            for size, name in self.short.get(state, ()):
                if size <= n:
                    spans.append((i + 1 - size, i + 1))
                    found.add(name)
        return spans


def _blocks(items: DataFrame, item_id: str, text: str, window: int, block_words: int) -> Iterator[Automaton]:
    """Automata of bounded size; items come to the driver one partition at a
    time, never the whole table."""
    held: list[tuple[str, list[bytes]]] = []
    total = 0
    for row in items.select(F.col(item_id).cast("string"), F.col(text).cast("string")).dropna().toLocalIterator():
        words = plain_lower(row[1].encode())
        if total and total + len(words) > block_words:
            yield Automaton(held, window)
            held, total = [], 0
        held.append((row[0], words))
        total += len(words)
    yield Automaton(held, window)


def scan(documents: DataFrame, items: DataFrame, window: int = 10, item_id: str = "item_id", item_text: str = "text", block_words: int = 200_000, keep: list[str] | None = None) -> DataFrame:
    """Contamination of every document: the columns of ``keep`` (doc_id) plus
    n_words, spans (merged word ranges, end exclusive) and items (sorted).

    Documents are read once per block of ``block_words`` item words, which
    bounds what is broadcast.  Null or empty texts have no words; items with a
    null id or text are left out; repeated rows are scanned each; equal items
    are all named.  No items, or an empty table, gives no spans."""
    keep = keep or ["doc_id"]
    return _scan(documents, items, keep, window, item_id, item_text, block_words).select(*(F.col("kept")[c].alias(c) for c in keep), "n_words", "spans", "items")


def _scan(documents: DataFrame, items: DataFrame, keep: list[str], window: int = 10, item_id: str = "item_id", item_text: str = "text", block_words: int = 200_000) -> DataFrame:
    """``scan`` with the kept columns and the text as one struct, so that no
    name of theirs clashes with the results'."""
    spark = documents.sparkSession
    inside = F.struct(*(c for c in keep if c != "text"), F.col("text").cast("string").alias("text"))
    frame = documents.select(inside.alias("kept"), F.lit(0).cast("long").alias("n_words"), F.array().cast(SPANS).alias("spans"), F.array().cast("array<string>").alias("items"))
    schema = frame.schema

    def task_of(shared):
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton: Automaton = shared.value
            known = automaton.words.get
            for batch in pieces(batches, "kept.text"):
                docs = [plain_lower(x) for x in texts(field(batch, "kept.text"))]
                lens = np.fromiter(map(len, docs), np.int64, len(docs))
                offsets = np.concatenate([[0], np.cumsum(lens)])
                ids = np.fromiter((known(w, -1) for w in chain.from_iterable(docs)), np.int64, int(offsets[-1]))
                spans, names = batch["spans"].to_pylist(), batch["items"].to_pylist()
                for doc, runs in _runs(ids, offsets, automaton.least):
                    found: set[str] = set(names[doc])
                    hit = [(s["start"], s["end"]) for s in spans[doc]]
                    for a, b in runs:
                        shift = a - int(offsets[doc])
                        hit += [(s + shift, e + shift) for s, e in automaton.match(ids[a:b].tolist(), found)]
                    spans[doc] = [{"start": s, "end": e} for s, e in merged(hit)]
                    names[doc] = sorted(found)
                yield pa.RecordBatch.from_arrays([batch["kept"], pa.array(lens), pa.array(spans, batch["spans"].type), pa.array(names, pa.list_(pa.string()))], ["kept", "n_words", "spans", "items"])

        return task

    for k, automaton in enumerate(_blocks(items, item_id, item_text, window, block_words)):
        if k:
            frame = store.table(frame, "decontaminate-block")
        frame = frame.mapInArrow(task_of(spark.sparkContext.broadcast(automaton)), schema)
    return frame


def _runs(ids: np.ndarray, offsets: np.ndarray, least: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """Of each document that has any: its runs of at least ``least`` known words."""
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    key = np.where(ids >= 0, doc, -1)
    edge = np.flatnonzero(np.diff(key)) + 1
    start, end = np.concatenate([[0], edge]), np.concatenate([edge, [len(ids)]])
    if not len(ids):
        return
    use = (key[start] >= 0) & (end - start >= least)
    by: dict[int, list[tuple[int, int]]] = {}
    for a, b in zip(start[use].tolist(), end[use].tolist(), strict=True):
        by.setdefault(int(key[a]), []).append((a, b))
    yield from by.items()


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching ranges joined, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def clean(documents: DataFrame, items: DataFrame, window: int = 10, max_span: int = 0, max_coverage: float = 0.5, **options) -> DataFrame:
    """Documents without contaminated spans, all columns kept.

    Spans of more than ``max_span`` words are cut out of the text with the
    characters between their words; everything else stays as it is.  A
    document goes when more than ``max_coverage`` of its words are in spans."""
    columns = documents.columns
    hit = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"])
    left = _scan(documents, items, columns, window, **options).filter((F.col("n_words") == 0) | (hit <= F.col("n_words") * F.lit(max_coverage)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "kept.text"):
            text = field(batch, "kept.text").to_pylist()
            for i, spans in enumerate(batch["spans"].to_pylist()):
                if cuts := [(s["start"], s["end"]) for s in spans if s["end"] - s["start"] > max_span]:
                    text[i] = without(text[i], cuts)
            yield pa.RecordBatch.from_arrays([pa.array(text, pa.string()) if c == "text" else field(batch, f"kept.{c}") for c in columns], columns)

    return left.select("kept", "spans").mapInArrow(task, documents.schema)


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text less the characters from each span's first to last word."""
    raw = text.encode()
    places = [m.span() for m in WORD.finditer(raw.lower())]
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at : places[a][0]])
        at = places[b - 1][1]
    out.append(raw[at:])
    return b"".join(out).decode()
