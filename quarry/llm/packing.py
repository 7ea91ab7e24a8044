"""Best-fit packing of tokenised documents into sequences, by hierarchical
residual packing.

1. Each task tokenises its partition and packs its pieces best-fit-decreasing.
   Full and nearly full sequences are final.
2. The underfull sequences become items themselves.  Groups of neighbouring
   tasks' items are merged and packed best-fit again, round after round, with
   fewer groups each time, until one group is left or a round closes nothing.

Only (sequence, fill) pairs travel between rounds.  A group never holds more
than ``group_items`` items on average: beyond that the next round keeps more
groups, dealt anew, instead of one larger group.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import store
from quarry.llm.text import pieces, ragged, texts
from quarry.llm.tokens import ENCODERS, PIECE, encoder, with_end

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, fill long"
MOVES = "bin long, parent long, base long, fill long"
#: Numbers of a task's bins: this many bits below the task's number.
TASK_BITS = 40


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of each item, and fill of each bin.

    Open bins are kept by free space; the smallest sufficient one is found
    with one bit operation, so an item costs the same for any number of bins.
    Ties take the earlier item and the bin that got that free space last."""
    place, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    fills: list[int] = []
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    some = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = some >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                some ^= 1 << room
        else:
            room, b = capacity, len(fills)
            fills.append(0)
        place[i], offset[i] = b, fills[b]
        fills[b] += n
        if room > n:
            free[room - n].append(b)
            some |= 1 << (room - n)
    return place, offset, np.array(fills, np.int64)


def cut(lens: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, number, start and length of every piece: a document longer
    than ``capacity`` is cut into pieces of that length, the first shorter."""
    count = -(-lens // capacity)
    doc = np.repeat(np.arange(len(lens)), count)
    number = ragged(count)
    first = lens - (count - 1) * capacity
    start = np.where(number == 0, 0, first[doc] + (number - 1) * capacity)
    return doc, number, start, np.where(number == 0, first[doc], capacity)


def pack(documents: DataFrame, tokenizer: str | None = None, end: int = 2, capacity: int = 1024, slack: int = 8, fan_in: int = 8, group_items: int = 50_000) -> DataFrame:
    """Pack all documents; one row per piece: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset.

    Every row of the input is packed: null or empty text is its end token
    alone, repeated rows are packed each, a null doc_id stays null.  Other
    columns play no part.  An empty table gives no rows.  ``slack``: a
    sequence with at most so many free places is final at once."""
    tokenizer = tokenizer or public_tokenizers.path("byte_bpe_50k.json")

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, rows = encoder(tokenizer, special=True), []
        for batch in pieces(batches, most=PIECE, keep=ENCODERS):
            flat, offsets = with_end(*own.encode(texts(batch["text"])), end)
            doc, number, start, length = cut(np.diff(offsets), capacity)
            flat = flat.astype("<u4", copy=False)
            at = offsets[doc] + start
            sums = [zlib.crc32(flat[a:b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
            rows.append(pa.table({"doc_id": batch["doc_id"].take(pa.array(doc)), "piece": pa.array(number, pa.int32()), "start": start, "length": length, "ids_crc32": pa.array(sums, pa.int64())}))
        own.rest()
        if not rows:
            return
        out = pa.concat_tables(rows)
        place, offset, fill = best_fit(out["length"].to_numpy(), capacity)
        mine = TaskContext.get().partitionId() << TASK_BITS
        out = out.append_column("bin", pa.array(mine + place)).append_column("offset", pa.array(offset)).append_column("fill", pa.array(fill[place]))
        yield from out.to_batches(max_chunksize=20_000)

    def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("bin", kind="stable")
        place, offset, fill = best_fit(group["fill"].to_numpy(), capacity)
        bins = group["bin"].to_numpy()
        head = np.zeros(len(fill), np.int64)
        head[place[offset == 0]] = bins[offset == 0]  # a merged sequence takes its first item's number
        return pd.DataFrame({"bin": bins, "parent": head[place], "base": offset, "fill": fill[place]})

    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    placed = store.table(source.mapInArrow(local, PIECES), "packed-pieces")
    final = F.col("fill") >= capacity - slack
    bins = placed.filter(~final).select("bin", "fill").distinct()
    moves = bins.select("bin", F.col("bin").alias("parent"), F.lit(0).cast("long").alias("base"), "fill")
    groups, step = (placed.agg(F.max("bin")).first()[0] or 0) // (1 << TASK_BITS) + 1, 0
    span = 1
    while True:
        step += 1
        span *= fan_in
        items = moves.filter(~final).select(F.col("parent").alias("bin"), "fill").distinct()
        n, before = items.count(), groups
        least = -(-n // group_items)
        groups = max(-(-before // fan_in), least, 1)
        if n <= 1 or step > 1 and before == 1:
            break
        near = F.shiftright("bin", TASK_BITS) % F.lit(2**31)
        # neighbours first; when the count of items keeps the number of groups up, another deal each round
        group = F.floor(near / span) % groups if groups > least else F.pmod(F.xxhash64("bin", F.lit(step)), F.lit(groups))
        merged = store.table(items.withColumn("grp", group).groupBy("grp").applyInPandas(merge, MOVES), f"packed-round-{step}")
        if groups == least and groups > 1 and merged.select("parent").distinct().count() > 0.99 * n:
            break
        m = merged.select(F.col("bin").alias("parent"), F.col("parent").alias("to"), F.col("base").alias("more"), F.col("fill").alias("now"))
        moves = store.table(
            moves.join(m, "parent", "left").select("bin", F.coalesce("to", "parent").alias("parent"), (F.col("base") + F.coalesce("more", F.lit(0))).alias("base"), F.coalesce("now", "fill").alias("fill")),
            f"packed-moves-{step}",
        )
    moved = moves.select("bin", F.col("parent").alias("to"), "base")
    return placed.join(moved, "bin", "left").select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("to", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset")
    )
