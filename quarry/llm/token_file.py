"""Token-id files: frequency-ranked ids in a byte-aligned variable-length code
whose lengths stand in separate control bytes.

One file holds a run of documents in ascending ``doc_id`` order:

    magic "QVB1", counts of documents, ids and ranked ids (little-endian u64),
    ranked ids by descending frequency in this file (u32),
    whether each doc_id is null (u8), doc_id (i64), ids per document (u32),
    control bytes (2 bits an id: its code's length less one), code bytes.

An id's code is its rank in 1 to 4 little-endian bytes, so the commonest 256
ids of a file take one byte.  Decoding looks the four lengths of each control
byte up in a 256 x 4 table and gathers the bytes, all in numpy.

Texts are put in order by a range partitioning, so nothing is collected; each
task tokenises its range and writes files of bounded size.  Every file is
complete in itself (own rank table), so a lost task rewrites its files only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import store
from quarry.llm.text import pieces, texts
from quarry.llm.tokens import ENCODERS, PIECE, encoder, with_end

MAGIC = b"QVB1"
#: Lengths of the four codes of a control byte.
LENGTHS = (((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1).astype(np.uint8)
#: Values, a multiple of 4, that are coded at a time: the arrays stay in the processor's cache.
STEP = 1 << 16
MANIFEST = "part int, file int, path string, n_docs long, n_ids long, n_bytes long"
IDS = "doc_id long, start long, n_tokens long, ids binary"


def encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and code bytes of unsigned 32-bit values."""
    controls, codes = [], []
    for at in range(0, len(values), STEP):
        own = values[at : at + STEP].astype("<u4")
        more = (own > 0xFF).view(np.uint8) + (own > 0xFFFF) + (own > 0xFFFFFF)
        quads = np.zeros(-(-len(own) // 4) * 4, np.uint8)
        quads[: len(own)] = more
        a, b, c, d = quads.reshape(-1, 4).T
        controls.append((a | b << 2 | c << 4 | d << 6).tobytes())
        codes.append(own.view(np.uint8).reshape(-1, 4)[np.arange(4, dtype=np.uint8) <= more[:, None]].tobytes())
    return b"".join(controls), b"".join(codes)


def decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of ``encode``."""
    out = np.zeros(n, np.uint32)
    code = np.frombuffer(data, np.uint8)
    begin = 0
    for first in range(0, n, STEP):
        quads = np.frombuffer(control, np.uint8, -(-min(STEP, n - first) // 4), first // 4)
        lens = LENGTHS[quads].reshape(-1)[: n - first]
        at = np.cumsum(lens, dtype=np.int64) + begin
        begin = int(at[-1])
        at -= lens
        own = out[first : first + STEP]
        own |= code[at]
        for k in range(1, 4):
            some = np.flatnonzero(lens > k)
            if len(some):
                own[some] |= code[at[some] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def dump(doc_ids: list[int | None], lens: np.ndarray, ids: np.ndarray) -> bytes:
    """A file's bytes."""
    count = np.bincount(ids)
    used = np.flatnonzero(count)
    ranked = used[np.argsort(-count[used], kind="stable")]
    rank = np.zeros(len(count), np.uint32)
    rank[ranked] = np.arange(len(ranked), dtype=np.uint32)
    control, data = encode(rank[ids])
    return b"".join([
        MAGIC, np.array([len(doc_ids), len(ids), len(used)], "<u8").tobytes(), ranked.astype("<u4").tobytes(),
        bytes(x is None for x in doc_ids), np.array([x or 0 for x in doc_ids], "<i8").tobytes(), lens.astype("<u4").tobytes(), control, data,
    ])


def load(raw: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc_ids, ids per document and all ids of a file."""
    if raw[:4] != MAGIC:
        raise ValueError("not a token-id file")
    n_docs, n_ids, n_used = (int(x) for x in np.frombuffer(raw, "<u8", 3, 4))
    at = 28
    ranked = np.frombuffer(raw, "<u4", n_used, at)
    at += 4 * n_used
    null = raw[at : at + n_docs]
    at += n_docs
    doc_ids = np.frombuffer(raw[at : at + 8 * n_docs], "<i8").tolist()
    at += 8 * n_docs
    lens = np.frombuffer(raw[at : at + 4 * n_docs], "<u4").astype(np.int64)
    at += 4 * n_docs
    n_control = -(-n_ids // 4)
    ids = ranked[decode(raw[at : at + n_control], raw[at + n_control :], n_ids)]
    return [None if x else d for x, d in zip(null, doc_ids, strict=True)], lens, ids


def write(documents: DataFrame, folder: str, tokenizer: str | None = None, end: int = 1, file_ids: int = 4_000_000) -> DataFrame:
    """Tokenise every whole text, append ``end`` and write the files.

    Returns the manifest: part (order of the range), file (order within it),
    path, n_docs, n_ids, n_bytes.  Null text: no ids but the end.  Null
    doc_id: first.  Equal doc_ids: in order of their texts.  Other columns
    play no part.  An empty table gives no file.  A file is closed when it has
    ``file_ids`` ids, so a task's memory doesn't grow with its range (one
    document is never cut)."""
    tokenizer = tokenizer or public_tokenizers.path("word_bpe_49k.json")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, rows = context.partitionId(), []
        names: list[int | None] = []
        lens: list[np.ndarray] = []
        ids: list[np.ndarray] = []

        def close() -> None:
            raw = dump(names, np.concatenate(lens), np.concatenate(ids))
            path = f"{folder}/part-{part:05d}-{len(rows):04d}-{context.taskAttemptId()}.qvb"
            with store.create(path) as out:
                out.write(raw)
            rows.append((part, len(rows), path, len(names), sum(map(len, ids)), len(raw)))
            names.clear()
            lens.clear()
            ids.clear()

        own = encoder(tokenizer, special=True)
        for batch in pieces(batches, most=PIECE, keep=ENCODERS):
            flat, offsets = with_end(*own.encode(texts(batch["text"])), end)
            names.extend(batch["doc_id"].to_pylist())
            lens.append(np.diff(offsets))
            ids.append(flat)
            if sum(map(len, ids)) >= file_ids:
                close()
        if names:
            close()
        own.rest()
        for row in rows:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["part", "file", "path", "n_docs", "n_ids", "n_bytes"])

    ordered = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return store.table(ordered.mapInArrow(task, MANIFEST), "token-manifest")


def read(manifest: DataFrame, convert=None, schema: str = IDS) -> DataFrame:
    """Read files back, one row per document: doc_id, start (ids of all
    documents before it), n_tokens, ids (little-endian u32).  ``convert`` may
    take (doc_ids, starts, lens, ids) of a file and give a record batch of
    ``schema`` instead.  The manifest's row count, a few per task of the
    write, bounds what is planned on the driver."""
    spark = manifest.sparkSession
    files = sorted(manifest.select("part", "file", "path", "n_ids").collect())
    before, plan = 0, []
    for row in files:
        plan.append((row.path, before))
        before += row.n_ids
    convert = convert or _rows

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch["path"].to_pylist(), batch["start"].to_pylist(), strict=True):
                with store.opened(path) as f:
                    doc_ids, lens, ids = load(f.read())
                yield convert(doc_ids, start + np.cumsum(lens) - lens, lens, ids)

    listed = spark.createDataFrame(plan, "path string, start long")
    return listed.repartition(max(1, len(plan))).mapInArrow(task, schema)


def _rows(doc_ids: list, starts: np.ndarray, lens: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    ends = np.cumsum(lens)
    blobs = [ids[e - n : e].astype("<u4").tobytes() for e, n in zip(ends, lens, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array(lens), pa.array(blobs, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])


def checksums(doc_ids: list, starts: np.ndarray, lens: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    """For ``read``: a checksum of each document's ids in their place."""
    ids, ends = ids.astype("<u4"), np.cumsum(lens)
    sums = [zlib.crc32(ids[e - n : e]) for e, n in zip(ends.tolist(), lens.tolist(), strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array(lens), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


CHECKSUMS = "doc_id long, start long, n_tokens long, ids_crc32 long"
