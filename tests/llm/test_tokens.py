"""Token ids, token files and packing against the library and brute force."""

from __future__ import annotations

import functools
import json
import tracemalloc
import zlib

import numpy as np
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quarry.llm import packing, store, token_file
from quarry.llm.tokens import Encoder, encoder

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
TEXTS = [
    "one line\nTwo, lines\nthree", "x\n", "\nx", "x\ny\n", "", "  a", " a", "a ", "a  b", "a\n b", "a \n b", "a\n\n\nb  c\t d ", "don't I'LL we've", "x y  z", "<|endoftext|> hi", "İstanbul ΑΣ Σ ẞ ﬁ",
    "日本語 12345 a1b2", "a\x1cb", "\n\n", "   ", "naïve café — “x”", "ǅ ŉ µ", "a   b", "'S 'T 's't", "é ́ x",
]


@functools.cache
def library(path):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


def ids_of(path, text, end):
    return [*library(path).encode(text or "", add_special_tokens=False).ids, end]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_chunks_give_the_ids_of_whole_texts(path):
    flat, at = encoder(path).encode([t.encode() for t in TEXTS])
    got = [flat[a:b].tolist() for a, b in zip(at, at[1:])]
    assert got == [e.ids for e in library(path).encode_batch(TEXTS, add_special_tokens=False)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aZ 's9.é́\n\t  !中ẞ"), max_size=30), max_size=4))
def test_any_text(texts):
    for path in (WORD, BYTE):
        flat, at = encoder(path).encode([t.encode() for t in texts])
        assert [flat[a:b].tolist() for a, b in zip(at, at[1:])] == [e.ids for e in library(path).encode_batch(texts, add_special_tokens=False)]


@given(st.lists(st.integers(0, 2**32 - 1), max_size=50))
def test_codes_round_trip(values):
    v = np.array(values, np.uint32)
    assert token_file.decode(*token_file.encode(v), len(v)).tolist() == values


ROWS = [(7, "b c", "x"), (None, "no id", "x"), (3, None, None), (5, "", "x"), (9, "long words " * 3000, "y"), (3, "twice", "z"), (3, "twice", "z")]


def test_token_files(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, ids string")
    manifest = token_file.write(docs, store.folder(spark, "t"), file_ids=4)
    rows = sorted(token_file.read(manifest).collect(), key=lambda r: r.start)
    want = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at = 0
    for r, (doc, text, _) in zip(rows, want, strict=True):
        ids = ids_of(WORD, text, 1)
        assert (r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist()) == (doc, at, ids)
        at += len(ids)
    sums = token_file.read(manifest, token_file.checksums, token_file.CHECKSUMS).collect()
    assert {(r.doc_id, r.start, r.ids_crc32) for r in sums} == {(r.doc_id, r.start, zlib.crc32(r.ids)) for r in rows}
    empty = token_file.write(docs.limit(0), store.folder(spark, "t"))
    assert token_file.read(empty).collect() == []


def check_packing(rows, texts, capacity):
    """Gapless sequences within capacity, pieces that rebuild each document."""
    places, docs = {}, {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        docs.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= capacity
    for doc, text in texts.items():
        ids = np.array(ids_of(BYTE, text, 2), "<u4")
        want = -(-len(ids) // capacity)
        got = sorted(docs[doc])
        assert [g[0] for g in got] == list(range(want)) and all(g[2] == capacity for g in got[1:])
        assert [(s, zlib.crc32(ids[s : s + n])) for _, s, n, _ in got] == [(s, c) for _, s, _, c in got]
        assert sum(g[2] for g in got) == len(ids)
    return len(places)


def test_packing(spark):
    texts = {i: "some words and more " * (i % 37) for i in range(200)} | {500: None, 501: "", 502: "very long " * 5000}
    docs = spark.createDataFrame([(k, v, 1) for k, v in texts.items()], "doc_id long, text string, bin long").repartition(9)
    for kw in ({}, {"fan_in": 2, "group_items": 5}):
        n = check_packing(packing.pack(docs, capacity=64, **kw).collect(), texts, 64)
        total = sum(len(ids_of(BYTE, t, 2)) for t in texts.values())
        assert n <= 1.1 * -(-total // 64) + 2
    assert packing.pack(docs.limit(0)).collect() == []


def test_best_fit_takes_the_tightest():
    place, offset, fill = packing.best_fit(np.array([5, 5, 4, 3, 6]), 10)
    assert sorted(fill.tolist()) == [3, 10, 10] and offset[place == place[4]].tolist() == [6, 0]


SPECIAL = ["end of text <|endoftext|> marker", "a<|startoftext|>b  c", "<|endoftext|>", "x\n<|endoftext|>\ny", "<|ENDOFTEXT|> <|endoftext|", "<|endoftext|><|startoftext|> ", *TEXTS]


@functools.cache
def unchanged(path):
    return Tokenizer.from_file(path)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_special_strings_as_by_the_librarys_default(path):
    flat, at = encoder(path, special=True).encode([t.encode() for t in SPECIAL])
    got = [flat[a:b].tolist() for a, b in zip(at, at[1:])]
    assert got == [e.ids for e in unchanged(path).encode_batch(SPECIAL, add_special_tokens=False)]
    assert got[0] != encoder(path).encode([SPECIAL[0].encode()])[0].tolist()


@pytest.mark.parametrize("kind", [{"normalized": True}, {"special": False}, {"special": False, "normalized": True}, {"lstrip": True, "rstrip": True}])
@pytest.mark.parametrize("path", [WORD, BYTE])
def test_other_added_tokens(path, kind, tmp_path):
    layout = json.loads(unchanged(path).to_str())
    layout["added_tokens"].append({"id": len(layout["model"]["vocab"]) + 9, "content": "Mark It", "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True} | kind)
    own = tmp_path / "own.json"
    own.write_text(json.dumps(layout))
    texts = ["a Mark It b", "a MARK  it, b", "aMark It", "mark it", "Mark", "It", "  Mark It  x"]
    flat, at = encoder(str(own), special=True).encode([t.encode() for t in texts])
    assert [flat[a:b].tolist() for a, b in zip(at, at[1:])] == [e.ids for e in unchanged(str(own)).encode_batch(texts, add_special_tokens=False)]


def test_special_strings_in_files_and_sequences(spark):
    docs = spark.createDataFrame(list(enumerate(SPECIAL)), "doc_id long, text string")
    want = [[*unchanged(WORD).encode(t, add_special_tokens=False).ids, 1] for t in SPECIAL]
    rows = sorted(token_file.read(token_file.write(docs, store.folder(spark, "t"))).collect(), key=lambda r: r.doc_id)
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in rows] == want
    assert [r.start for r in rows] == [sum(map(len, want[:i])) for i in range(len(want))]
    packed = {r.doc_id: r for r in packing.pack(docs).collect()}
    for i, t in enumerate(SPECIAL):
        ids = np.array([*unchanged(BYTE).encode(t, add_special_tokens=False).ids, 2], "<u4")
        assert (packed[i].length, packed[i].ids_crc32) == (len(ids), zlib.crc32(ids))


def test_codes_in_steps():
    """Coding holds a few bytes a value, whatever the number of values."""
    for n in (0, 1, 5, 65535, 65536, (1 << 18) + 3):
        x = (np.random.default_rng(n).integers(0, 2**32, n) >> np.arange(n) % 32).astype(np.uint32)
        assert (token_file.decode(*token_file.encode(x), n) == x).all()
    x = np.arange(1 << 21, dtype=np.uint32) % 300
    tracemalloc.start()
    control, data = token_file.encode(x)
    token_file.decode(control, data, len(x))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 * len(x)


def test_odd_chunks_among_others():
    """Chunks that go to the library whole, between others and alone."""
    for path in (WORD, BYTE):
        whole = Tokenizer.from_file(path)
        for docs in (["x\x1c", "plain"], ["a\x00b c", "é é z"], ["\x00"], ["one"], ["ein 中文 zwei\x1f drei \x7f", "\x1d", ""]):
            ids, offsets = Encoder(path, special=True).encode([d.encode() for d in docs])
            assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [whole.encode(d, add_special_tokens=False).ids for d in docs]


PLAIN = ["and more ", "plain  ", "a ", "Été À ŸŽſ ıİ", "a×b÷c", "x'll 'S y've", "12ab34.,!5", "fifteen-letters sixteen--letters " + "long" * 9, "\x7f %%%", "", "ŉ ǅ ƀ"]


def test_a_few_kept_chunks_give_the_same_ids():
    """Chunks that are learnt, dropped and learnt again, plain ones and others."""
    for path in (WORD, BYTE):
        whole, own = Tokenizer.from_file(path), Encoder(path, special=True, most=6)
        for docs in (PLAIN, PLAIN[::-1], PLAIN[3:5], PLAIN):
            ids, offsets = own.encode([d.encode() for d in docs])
            assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [whole.encode(d, add_special_tokens=False).ids for d in docs]


def test_idle_encoders_hold_few_chunks():
    """Between tasks a worker keeps the chunks that it met most, not all."""
    own = Encoder(BYTE, most=400)
    own.encode([b"often " * 3 + b" ".join(b"w%d" % i for i in range(300)), b"often again"])
    own.encode([b"often"])
    before = own.encode([b"often again"])[0].tolist()
    own.rest()
    assert own._runs.n <= 100 and own._parts.n <= 50 and len(own._runs.ids) <= 500
    assert own.encode([b"often again"])[0].tolist() == before


def test_plain_chunks_need_no_pattern():
    """Chunks of letters, digits and signs are cut without the pattern's pass over them."""
    text = "Plain words, of 12 letters; à la carte (Žižek) and signs $%! "
    for path in (WORD, BYTE):
        own = Encoder(path)
        own._cut = None
        assert own.encode([text.strip().encode()])[0].tolist() == library(path).encode(text.strip(), add_special_tokens=False).ids
