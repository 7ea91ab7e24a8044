"""Token ids of whole texts with a public tokenizer, faster than encoding text
by text: a piece's texts are cut into chunks between spaces, in one pass over
their bytes; each chunk is encoded once and looked up afterwards.

The chunks are chosen so that encoding them one by one gives exactly the ids
of the whole text (tested against the library on whole texts).  Texts or
chunks with characters for which that isn't certain go through the library's
own whole-text call, and so do texts that hold an added token's string where
these are recognised.
"""

from __future__ import annotations

import json
import re
from itertools import chain

import numpy as np
import regex
import tokenizers
import xxhash

from quarry.llm.text import CACHES, give_back

#: Pre-tokenizer patterns of the two layouts that may be cut at spaces (fixed values of the public vocabularies).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: What makes a chunk odd: characters other than ASCII and precomposed Latin letters, whose normal form and lower
#: case are the same character by character, and white space at its end.
ODD = re.compile(r"[^\x00-\x1b\x20-\x7e¡-¬®-įı-ǃǍ-ǰǴ-ɏ]|\s(?=\x00|\Z)")
#: White space other than ASCII's, and the separators on which libraries differ, in UTF-8.
ODD_SPACE = regex.compile(rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe1\xa0\x8e|\xe2\x80[\x80-\x8f\xa8-\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
ODD_LEADS = (b"\x1c", b"\x1d", b"\x1e", b"\x1f", b"\xc2", b"\xe1", b"\xe2", b"\xe3")
RUN_OF_SPACES = b"  "
#: With these in a text, white space beside a line end may share its token.
BESIDE_LINE_END = (b"\n\n", b"\n ", b" \n", b"\t", b"\r", b"\x0b", b"\x0c")
#: Marks between chunks, and before a chunk that no space precedes.
SEPARATOR, SEPARATOR_BYTES, FIRST = "\x00", b"\x00", b"\x1c"
#: ASCII's white space.
WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Kinds of bytes in plain chunks: letters (with both bytes of U+00C0 to U+017F), digits, marks between chunks; runs of a kind are pre-tokens.
OTHER, LETTER, DIGIT, SIGN, MARK = range(5)
KIND = np.array([
    MARK if b == 32 else DIGIT if 48 <= b <= 57 else LETTER if 65 <= b <= 90 or 97 <= b <= 122 or 0x80 <= b <= 0xBF or 0xC3 <= b <= 0xC5 else SIGN if 33 <= b <= 126 and b != 39 else OTHER
    for b in range(256)
], np.uint8)


def byte_letters() -> dict[int, str]:
    """The printable character by which byte-level vocabularies write each byte:
    itself where it is printable in Latin-1, else the next one from 256 on."""
    same = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in same]
    return {b: chr(b) for b in same} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Keys:
    """128-bit keys of byte strings that lie in one buffer: up to 15 bytes are
    the key itself, with their number; longer ones are hashed."""

    def __init__(self, raw: bytes, start: np.ndarray, size: np.ndarray) -> None:
        self.raw, self.start, self.size = raw + bytes(16), start, size
        words = np.ndarray((len(raw) + 1,), "V16", self.raw, strides=(1,))[start].view("<u8").reshape(-1, 2)
        words &= KEPT[np.minimum(size, 16)]
        self.a, self.b = words[:, 0].copy(), words[:, 1]
        self.b = self.b | size.astype(np.uint64) << np.uint64(56)
        long = np.flatnonzero(size > 15)
        if len(long):
            digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, self.texts(long))), np.uint64).reshape(-1, 2)
            self.a[long], self.b[long] = digests[:, 0], digests[:, 1] | np.uint64(1 << 63)

    def texts(self, rows: np.ndarray) -> list[bytes]:
        raw, start = self.raw, self.start[rows]
        return [raw[a:b] for a, b in zip(start.tolist(), (start + self.size[rows]).tolist(), strict=True)]


#: What stays of a key's 16 bytes, by the string's length.
KEPT = np.array([int.from_bytes(b"\xff" * min(n, 15), "little") >> s & 0xFFFFFFFFFFFFFFFF for n in range(17) for s in (0, 64)], np.uint64).reshape(-1, 2)


class Runs:
    """Runs of ids by key, in plain arrays with an open hash table: some 45
    bytes a key, where a dictionary of byte strings takes four times as much."""

    def __init__(self, most: int, kind: type = np.uint32) -> None:
        self.most, self.n, self.n_ids = most, 0, 0
        self.ids = np.empty(1024, kind)
        #: Both halves of the keys; start and size of each key's run; how often pieces had it
        self.a, self.b, self.start, self.size, self.uses = (np.empty(1024, t) for t in (np.uint64, np.uint64, np.uint32, np.uint32, np.uint8))
        self._fill(1 << 12)

    def _slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        h = a * np.uint64(0x9E3779B97F4A7C15) ^ (b ^ b >> np.uint64(29)) * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return (h >> self._shift).view(np.int64)

    def _fill(self, slots: int) -> None:
        self._table, self._shift = np.full(slots, -1, np.int32), np.uint64(65 - slots.bit_length())
        self._place(np.arange(self.n, dtype=np.int32))

    def _place(self, rows: np.ndarray) -> None:
        at, table = self._slots(self.a[rows], self.b[rows]), self._table
        while len(rows):
            free = np.flatnonzero(table[at] < 0)
            table[at[free]] = rows[free]  # of several for one slot the last stays
            left = table[at] != rows
            rows, at = rows[left], at[left] + 1 & len(table) - 1

    def _find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Row of each key; -1: not known."""
        at = self._slots(a, b)
        rows = self._table[at]
        other = np.flatnonzero((rows >= 0) & ((self.a[rows] != a) | (self.b[rows] != b)))
        at = at[other]
        while len(other):
            at = at + 1 & len(self._table) - 1
            rows[other] = row = self._table[at]
            wrong = (row >= 0) & ((self.a[row] != a[other]) | (self.b[row] != b[other]))
            other, at = other[wrong], at[wrong]
        return rows

    def trim(self, most: int) -> None:
        """Keep the ``most`` keys used most, so memory is bounded whatever the
        texts."""
        if self.n <= most:
            return
        keep = np.sort(np.argsort(255 - self.uses[: self.n], kind="stable")[:most])
        start, size = self.start[keep], self.size[keep]
        self.ids = self.ids[spread(start, size)]
        self.a, self.b, self.uses, self.size, self.n, self.n_ids = self.a[keep], self.b[keep], self.uses[keep] // 2, size, len(keep), len(self.ids)
        self.start = (np.cumsum(size) - size).astype(np.uint32)
        self._fill(1 << (3 * self.n).bit_length())

    def _room(self, n: int, n_ids: int) -> None:
        """Let the arrays hold ``n`` more keys and ``n_ids`` more ids."""
        for names, have, more in ((("a", "b", "start", "size", "uses"), self.n, n), (("ids",), self.n_ids, n_ids)):
            for name in names:
                old = getattr(self, name)
                if have + more > len(old):
                    new = np.empty(max(have + more, len(old) + len(old) // 2), old.dtype)
                    new[:have] = old[:have]
                    setattr(self, name, new)

    def runs(self, keys: Keys, learn) -> tuple[np.ndarray, np.ndarray]:
        """Start in ``ids`` and size of each key's run; ``learn`` (new strings)
        gives the ids of those not known yet, and the number of each's."""
        rows = self._find(keys.a, keys.b)
        new = np.flatnonzero(rows < 0)
        if len(new) and self.n + len(new) > self.most and self.n > self.most // 2:
            self.trim(self.most // 2)
            rows = self._find(keys.a, keys.b)
            new = np.flatnonzero(rows < 0)
        known = rows[rows >= 0] if len(new) else rows
        self.uses[known] = np.minimum(self.uses[known], 254) + 1
        if len(new):
            a, b = keys.a[new], keys.b[new]
            order = np.lexsort((b, a))
            first = np.ones(len(new), bool)
            first[1:] = (a[order[1:]] != a[order[:-1]]) | (b[order[1:]] != b[order[:-1]])
            once = order[first]
            ids, lens = learn(keys.texts(new[once]))
            self._room(len(once), len(ids))
            own = slice(self.n, self.n + len(once))
            self.a[own], self.b[own], self.size[own], self.uses[own] = a[once], b[once], lens, 0
            self.start[own] = self.n_ids + np.cumsum(lens) - lens
            self.ids[self.n_ids : self.n_ids + len(ids)] = ids
            rows[new[order]] = self.n + np.cumsum(first) - 1
            self.n, self.n_ids = own.stop, self.n_ids + len(ids)
            if 2 * self.n > len(self._table):
                self._fill(1 << (3 * self.n).bit_length())
            else:
                self._place(np.arange(own.start, own.stop, dtype=np.int32))
        return self.start[rows], self.size[rows]


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], ..., start[0] + size[0] - 1, start[1], ..."""
    size = size.astype(np.int64)
    out = np.repeat(start.astype(np.int64) - (np.cumsum(size) - size), size)
    out += np.arange(len(out))
    return out


def listed(values: list[bytes]) -> Keys:
    """Keys of a list of byte strings."""
    size = np.fromiter(map(len, values), np.int64, len(values))
    return Keys(b"".join(values), np.cumsum(size) - size, size)


class Encoder:
    """Chunks of texts to ids, each distinct chunk and part encoded once.

    ``special``: the strings of special tokens in a text become their ids, as
    by the library's default; else they are ordinary text."""

    def __init__(self, path: str, special: bool = False, most: int = 400_000) -> None:
        self.library = tokenizers.Tokenizer.from_file(path)
        self.library.encode_special_tokens = not special
        layout = json.loads(self.library.to_str())
        added = [x for x in layout["added_tokens"] if special or not x["special"]]
        self.added = [x["content"].encode() for x in added]
        #: Strings that are looked for in the normalised text
        self.added_normal = [self._normal(x["content"]) for x in added if x["normalized"]]
        normal = [x["type"] for x in (layout["normalizer"] or {}).get("normalizers", [])]
        before = layout["pre_tokenizer"] or {}
        pattern = next((x["pattern"].get("Regex") for x in before.get("pretokenizers", []) if x["type"] == "Split"), None)
        self.words = normal == ["NFC", "Replace", "Lowercase"] and pattern == WORD_PATTERN
        self.bytes = not normal and before.get("type") == "ByteLevel" and not before["add_prefix_space"]
        own = (WORD_PATTERN if self.words else BYTE_PATTERN).replace(r"[^\s\p{L}\p{N}]", r"[^\s\p{L}\p{N}\x00]")
        self._cut = regex.compile(SEPARATOR + "|" + own).findall
        kind = np.uint16 if max([*layout["model"]["vocab"].values(), *(x["id"] for x in layout["added_tokens"])]) < 1 << 16 else np.uint32
        self._runs, self._parts, self._letters = Runs(most, kind), Runs(most // 2, kind), byte_letters()
        del layout, added  # the vocabulary as Python objects
        give_back()

    def _learn(self, fresh: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new chunks, one after the other, and the number of each's:
        plain ones are cut in one pass over their bytes, others by the pattern,
        odd ones go to the library."""
        raw, start, size, chunk, rest = self._plain_parts(fresh)
        if self.bytes:
            text = [fresh[i][1:].decode() if fresh[i][:1] == FIRST else " " + fresh[i].decode() for i in rest]
        else:
            text = [fresh[i].decode() for i in rest]
        odd = [(i, t) for i, t in zip(rest, text, strict=True) if SEPARATOR in t or ODD.search(t)]
        gone = {i for i, _ in odd}
        even = [i for i in rest if i not in gone]
        if even:
            joined = SEPARATOR.join([t for i, t in zip(rest, text, strict=True) if i not in gone])
            parts = [p.encode() for p in self._cut(joined.lower() if self.words else joined)]
            ends = np.fromiter((p == SEPARATOR_BYTES for p in parts), bool, len(parts))
            own = listed(parts)
            raw, start, size = raw + b"".join(parts), np.concatenate([start, (own.start + len(raw))[~ends]]), np.concatenate([size, own.size[~ends]])
            chunk = np.concatenate([chunk, np.array(even)[np.cumsum(ends)[~ends]]])
        at, n = self._parts.runs(Keys(raw, start, size), self._learn_parts)
        ids = self._parts.ids[spread(at, n)]
        if odd:
            direct = [e.ids for e in self.library.encode_batch([t for _, t in odd], add_special_tokens=False)]
            ids = np.concatenate([ids, np.array([x for run in direct for x in run], ids.dtype)])
            chunk, n = np.concatenate([chunk, [i for i, _ in odd]]), np.concatenate([n, [len(x) for x in direct]])
        # the chunks' runs, in the order of the chunks
        order = np.argsort(chunk, kind="stable")
        ids = ids[spread((np.cumsum(n) - n)[order], n[order])]
        return ids, np.bincount(chunk, n, len(fresh)).astype(np.int64)

    def _plain_parts(self, fresh: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, list[int]]:
        """Pre-tokens of the chunks of ASCII, save apostrophes, and letters of
        U+00C0 to U+017F: a buffer, start and size of each in it and its chunk's
        number; and the numbers of the other chunks."""
        if self.bytes:  # the space before a chunk is its own, where it has one
            raw = (b" " + b" ".join(fresh)).replace(b" " + FIRST, FIRST)
        elif self.words:
            raw = b" " + b" ".join(fresh)
        else:
            return b"", *(np.zeros(0, np.int64) for _ in range(3)), list(range(len(fresh)))
        data = np.frombuffer(raw, np.uint8)
        kind = KIND[data]
        if self.bytes:
            kind[data == FIRST[0]] = MARK
        after = np.append(data[1:], np.uint8(0))
        kind[(data == 0xC3) & ((after == 0x97) | (after == 0xB7)) | (data == 0xC4) & (after == 0xB0)] = OTHER  # × ÷ İ
        marks = np.flatnonzero(kind == MARK)
        number = np.repeat(np.arange(len(marks)), np.diff(np.append(marks, len(data))))
        other = np.zeros(len(marks), bool)
        other[number[kind == OTHER]] = True
        other |= np.diff(np.append(marks, len(data))) == 1
        begins = np.append(True, kind[1:] != kind[:-1])
        own = ~other[number]
        if self.bytes:
            spaced = marks[(data[marks] != FIRST[0]) & ~other]
            begins[spaced], begins[spaced + 1] = True, False
            own[marks] = False
            own[spaced] = True
        else:
            begins |= kind == DIGIT
            own[marks] = False
        text, begins, number = data[own], np.flatnonzero(begins[own]), number[own]
        size = np.diff(np.append(begins, len(text)))
        raw = text.tobytes()
        return raw.decode().lower().encode() if self.words else raw, begins, size, number[begins], np.flatnonzero(other).tolist()

    def _learn_parts(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new pre-tokens by the library's model."""
        written = b"\0".join(parts).decode("latin-1").translate(self._letters).split(self._letters[0])
        tokenize = self.library.model.tokenize
        found = [[t.id for t in tokenize(w)] for w in written]
        lens = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(lens.sum())), lens

    def _normal(self, text: str) -> str:
        return self.library.normalizer.normalize_str(text) if self.library.normalizer else text

    def _holds_added(self, text: bytes) -> bool:
        if any(x in text for x in self.added):
            return True
        if not self.added_normal:
            return False
        normal = self._normal(text.decode())
        return any(x in normal for x in self.added_normal)

    def _whole(self, text: bytes) -> bool:
        if self._holds_added(text):
            return True
        if self.words:
            return False
        if not self.bytes:
            return True
        return RUN_OF_SPACES in text or any(b in text for b in ODD_LEADS) and ODD_SPACE.search(text) is not None

    def _chunks(self, docs: list[bytes]) -> tuple[Keys, np.ndarray]:
        """All chunks of all texts, and the number of the first of each text's."""
        if self.words:
            cut = docs
        else:  # no space stands before the first chunk and before those beside line ends, which are tokens of their own
            cut = [FIRST + x.replace(b"\n", b" \x1c\n \x1c") if b"\n" in x and not any(y in x for y in BESIDE_LINE_END) else FIRST + x for x in docs]
        raw = b" ".join(cut)
        data = np.frombuffer(raw, np.uint8)
        ends = np.append(np.flatnonzero(WHITE[data] if self.words else data == 32), len(data))
        start = np.append(0, ends[:-1] + 1)
        size = ends - start
        if self.words:
            some = size > 0
        else:
            some = size != 1
            some[~some] = data[start[~some]] != FIRST[0]
        start, size = start[some], size[some]
        lens = np.fromiter(map(len, cut), np.int64, len(cut)) + 1
        return Keys(raw, start, size), np.searchsorted(start, np.append(0, np.cumsum(lens)))

    def encode(self, docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order (uint32), and the offset of each text."""
        if not docs:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        whole = [i for i, x in enumerate(docs) if self._whole(x)] if self._whole(b"\0".join(docs)) else []
        direct = {i: e.ids for i, e in zip(whole, self.library.encode_batch([docs[i].decode() for i in whole], add_special_tokens=False), strict=True)} if whole else {}
        chunks, first = self._chunks([b"" if i in direct else x for i, x in enumerate(docs)] if direct else docs)
        start, size = self._runs.runs(chunks, self._learn)
        flat = self._runs.ids[spread(start, size)].astype(np.uint32, copy=False)
        edges = np.append(0, np.cumsum(size, dtype=np.int64))[first]
        if not direct:
            return flat, edges
        out = [np.array(direct[i], np.uint32) if i in direct else flat[edges[i] : edges[i + 1]] for i in range(len(docs))]
        return np.concatenate(out), np.concatenate([[0], np.cumsum([len(x) for x in out])])


    def rest(self) -> None:
        """Between tasks only the runs used most stay: Spark deals tasks to
        workers in turn, and those that wait hold memory too."""
        for runs in (self._runs, self._parts):
            runs.trim(runs.most // 4)
        give_back()


#: Bytes of text that are encoded at a time.
PIECE = 1 << 19
#: The worker's encoders, until a task comes that needs none.
ENCODERS: dict[tuple[str, bool], Encoder] = {}
CACHES.append(ENCODERS)


def encoder(path: str, special: bool = False) -> Encoder:
    """The worker's encoder for a vocabulary file, kept between tasks."""
    if (path, special) not in ENCODERS:
        ENCODERS.clear()
        ENCODERS[path, special] = Encoder(path, special)
    return ENCODERS[path, special]


def with_end(flat: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end`` to each text's ids."""
    n = len(offsets) - 1
    out = np.full(len(flat) + n, end, np.uint32)
    keep = np.ones(len(out), bool)
    keep[offsets[1:] + np.arange(n)] = False
    out[keep] = flat
    return out, offsets + np.arange(n + 1)
