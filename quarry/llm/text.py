"""Words, word tables and rolling window hashes shared by the operators.

Everything here runs inside tasks on Arrow batches.  A batch is cut into
pieces of bounded text size; ``Cut`` has Arrow split and number the words of a
piece, so that Python sees each distinct word once and no list of words is
built; all further work is numpy on integer arrays.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: ``bytes.split()`` cuts at exactly 0x20 and 0x09-0x0D.
#: Letters, digits and every byte of a non-ASCII character are word bytes of a "plain" word.
PLAIN = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

#: Odd multipliers of the two lanes of window hashes (fixed values, 3 or 5 modulo 8).
MULTIPLIERS = (0x9E3779B97F4A7C15 ^ 0x6, 0xC2B2AE3D27D4EB4D)


def spaced(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``, unchanged."""
    return text.split()


def spaced_lower(text: bytes) -> list[bytes]:
    """The same words after lower-casing A-Z only."""
    return text.lower().split()


def plain_lower(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z only."""
    return text.lower().translate(PLAIN).split()


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def field(batch: pa.RecordBatch, column: str) -> pa.Array:
    """A column, or a field of a struct column as "column.field"."""
    name, _, inner = column.partition(".")
    if not inner:
        return batch[name]
    return batch[name].flatten()[batch[name].type.get_field_index(inner)]


#: What workers keep from task to task; a task of another kind drops it.
CACHES: list[dict] = []
#: glibc's M_MMAP_THRESHOLD and its value here: larger arrays go back to the system when they are freed.
MMAP_THRESHOLD, LARGE = -3, 1 << 18
try:
    _trim = ctypes.CDLL(None).malloc_trim
    ctypes.CDLL(None).mallopt(MMAP_THRESHOLD, LARGE)
except (AttributeError, OSError):  # another C library: nothing to ask for
    _trim = None


def give_back() -> None:
    """Return freed memory to the system, as idle workers stay for a while."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 1 << 20, keep: dict | None = None) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a piece holds at most ``most`` bytes of ``column``
    (or one row, if that row alone is longer).  Of what the worker kept from
    earlier tasks only ``keep`` stays."""
    for cache in CACHES:
        if cache is not keep:
            cache.clear()
    for batch in batches:
        give_back()
        if not batch.num_rows:
            continue
        sizes = np.array([0 if n is None else n for n in pc.binary_length(field(batch, column)).to_pylist()], np.int64)
        start, total = 0, 0
        for i, n in enumerate(sizes):
            if i > start and total + n > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(n)
        yield batch.slice(start)
    give_back()


class Cut:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the texts of a string column (null:
    none): ``ids``, numbers of the piece's distinct words in text order, and
    ``offsets``, where each text's words begin."""

    def __init__(self, column: pa.Array, lower: bool = False) -> None:
        # a copy without offset: the kernels don't all take slices
        text = pa.concat_arrays([column, column.slice(0, 0)]).cast(pa.large_string())
        lists = pc.ascii_split_whitespace(pc.ascii_lower(text) if lower else text)
        self._number(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False), lists.flatten())

    @classmethod
    def of(cls, docs: list[list[bytes]]) -> Cut:
        """The same for lists of words."""
        out = cls.__new__(cls)
        out._number(np.fromiter(map(len, docs), np.int64, len(docs)), pa.array([w.decode() for d in docs for w in d], pa.large_string()))
        return out

    def _number(self, lens: np.ndarray, words: pa.Array) -> None:
        coded = words.dictionary_encode()
        ids, edges = coded.indices.to_numpy(), np.concatenate([[0], np.cumsum(lens, dtype=np.int64)])
        self._words = coded.dictionary
        none = pc.index(self._words, "").as_py()  # white space at either end of a text
        if none >= 0:
            some = ids != none
            edges = np.concatenate([[0], np.cumsum(some)])[edges]
            ids = ids[some]
        self.ids, self.offsets = ids, edges

    def lanes(self) -> np.ndarray:
        """Two 64-bit hashes per word, in the order of the numbers."""
        _, ends, data = self._words.buffers()
        at = np.frombuffer(ends, np.int64)[self._words.offset : self._words.offset + len(self._words) + 1].tolist() if len(self._words) else [0]
        raw = data.to_pybytes() if data is not None else b""
        digest = b"".join([xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(at, at[1:], strict=False)])
        return np.frombuffer(digest, np.uint64).reshape(-1, 2)


class Words(dict):
    """Word to small integer, with the two 64-bit hashes of each word.

    Kept across the pieces of a task; emptied at ``most`` words, so memory is
    bounded whatever the vocabulary."""

    def __init__(self, most: int = 400_000) -> None:
        super().__init__()
        self.most = most
        self._fresh: list[bytes] = []
        self._lanes = np.zeros((0, 2), np.uint64)

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        self._fresh.append(word)
        return at

    def ids(self, docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Integers of all words in order, and the offset of each document."""
        if len(self) > self.most:
            self.clear()
            self._fresh, self._lanes = [], self._lanes[:0]
        lens = np.fromiter(map(len, docs), np.int64, len(docs))
        offsets = np.concatenate([[0], np.cumsum(lens)])
        ids = np.fromiter(map(self.__getitem__, chain.from_iterable(docs)), np.int64, int(offsets[-1]))
        return ids, offsets

    def lanes(self) -> np.ndarray:
        """Two 64-bit hashes per word, in the order of the integers."""
        if self._fresh:
            digest = b"".join(map(xxhash.xxh3_128_digest, self._fresh))
            self._lanes = np.concatenate([self._lanes, np.frombuffer(digest, np.uint64).reshape(-1, 2)])
            self._fresh = []
        return self._lanes


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits (a public 64-bit finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
#: Powers that a worker keeps; a longer run of words makes its own.
KEPT_POWERS = 1 << 18


def _powers(multiplier: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(multiplier)
    if have is None or len(have[0]) < n:
        size = max(KEPT_POWERS, n)
        bases = np.array([[multiplier], [pow(multiplier, -1, 1 << 64)]], np.uint64).repeat(size, axis=1)
        bases[:, 0] = 1
        have = tuple(np.cumprod(bases, axis=1, dtype=np.uint64))
        if size == KEPT_POWERS:
            _POWERS[multiplier] = have
    return have[0][:n], have[1][:n]


def windows(hashes: np.ndarray, size: int, lane: int = 0) -> np.ndarray:
    """Hash of every run of ``size`` neighbours: polynomial modulo 2**64 over
    prefix sums, so the cost per window doesn't depend on ``size``."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(MULTIPLIERS[lane], len(hashes))
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up, out=sums[1:])
    return mixed((sums[size:] - sums[:-size]) * down[:n])


def starts(offsets: np.ndarray, size: int) -> np.ndarray:
    """Positions at which a window of ``size`` words lies inside one document."""
    lens = np.diff(offsets)
    count = np.maximum(lens - size + 1, 0)
    first = np.repeat(offsets[:-1], count)
    return first + ragged(count)


def ragged(count: np.ndarray) -> np.ndarray:
    """0..count[0]-1, 0..count[1]-1, ..."""
    total = int(count.sum())
    begin = np.cumsum(count) - count
    return np.arange(total, dtype=np.int64) - np.repeat(begin, count)


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every ``size`` neighbours, by doubling."""
    if len(x) < size:
        return x[:0]
    span = 1
    while span * 2 <= size:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (size - span)], x[size - span :]) if size > span else x


def covered(at: np.ndarray, size: np.ndarray | int, total: int) -> np.ndarray:
    """True where a position lies in any [at, at + size)."""
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, np.minimum(at + size, total), -1)
    return np.cumsum(edge[:-1]) > 0
