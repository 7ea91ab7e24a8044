"""Near-duplicate removal by one-permutation MinHash.

Signatures.  One hash per 5-word shingle: its high bits choose one of ``BINS``
bins, the rest competes for the bin's minimum.  A bin that no shingle fell into
takes over the minimum of the first filled bin in a random order of its own
(optimal densification): of two sets the same bin is asked first, so agreement
of a bin has the sets' similarity as its chance, whatever their sizes.

Buckets.  ``ROWS`` neighbouring bins are a band, and a band's values a bucket.
Sets of similarity 0.85 miss each other in every band with a chance of 4e-11.
A task first meets the sets of its own documents; of each bucket it sends one
head on, so a bucket that a third of all documents share costs a row per task,
not per document.  Shards of bounded size find the heads that several tasks
have.

Edges.  Of the sets in buckets, shingles that no other one has are counted: a
set with more of them than its links may miss has no link, and a pair's numbers
bound its similarity; later rounds also use a small bitmap of each set, as two
sets differ in a shingle at least for every cell that only one has.  Within a bucket all sets that are left are compared with
one centre, a star, by their whole shingle sets; the centre is the set with the
fewest shingles of its own.  Linked sets fall into components.  Only buckets
whose sets are still in several go on, with many times more centres each round,
chosen by hash, until every pair between components has been compared: no link
in a bucket is lost, and thousands of copies cost one comparison each.

Equal sets are one class from the start (64-bit hash of the set).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import store
from quarry.llm.partenum import Sets, _merged, components
from quarry.llm.text import Cut, mixed, pieces

#: Similarity as a fraction, so that the verdict is exact in integers.
NUMERATOR, DENOMINATOR = 85, 100
#: Bins of a signature and bins of a band.
BINS, ROWS = 600, 8
BANDS = BINS // ROWS
#: Sets whose signatures are held at a time, and classes whose buckets a task gathers before it sends their heads.
SETS, CLASSES = 2_048, 24_000
#: Classes whose heads one shard holds, all in all.
SHARD_CLASSES = 30_000
#: Shingles that a task sorts at a time, and that one shard counts.
CHUNK_SHINGLES, SHARD_SHINGLES = 1_000_000, 2_000_000
#: Cells of a set's bitmap.
MARKS = 2_048
#: A round takes so many times the centres that have been compared before.
CENTRES = 16
FOUND = "shard int, sids binary, keys binary, doc_ids array<long>, doc_sids array<long>, doc_sizes array<long>"
MEMBERS = "token long, sid long"
#: Marks of rows of FOUND that aren't heads.
MEMBERS_ROW, DOCUMENTS_ROW = -1, -2


def _orders() -> np.ndarray:
    """Place of each bin (column) in the order of each bin (row): itself first."""
    at = np.arange(BINS, dtype=np.uint64)
    keys = mixed(mixed(at[:, None] + np.uint64(0x2545F4914F6CDD1D)) + at[None, :])
    np.fill_diagonal(keys, 0)
    return np.argsort(np.argsort(keys, axis=1, kind="stable"), axis=1).astype(np.uint16)


class Signer:
    """Densified one-permutation signatures of sets; one per task."""

    def __init__(self) -> None:
        self.places = _orders()
        self.orders = np.argsort(self.places, axis=1).astype(np.uint16)

    def signatures(self, sets: Sets, docs: np.ndarray) -> np.ndarray:
        """A row of ``BINS`` values (32 bits) for each of ``docs``, whose sets
        aren't empty."""
        number = np.full(len(sets.sizes), -1)
        number[docs] = np.arange(len(docs))
        owner = number[sets.owner]
        hashes, owner = mixed(sets.shingles[owner >= 0] ^ np.uint64(0x9FB21C651E98DF25)), owner[owner >= 0]
        bins = ((hashes >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
        none = np.uint64(1 << 32)
        out = np.full(len(docs) * BINS, none, np.uint64)
        np.minimum.at(out, owner * BINS + bins, hashes & np.uint64(0xFFFFFFFF))
        out = out.reshape(len(docs), BINS)
        filled = out < none
        count = filled.sum(axis=1)
        for m in np.unique(count[count <= 8]).tolist():  # few filled bins: the first of them in each order
            rows = np.flatnonzero(count == m)
            own = np.nonzero(filled[rows])[1].reshape(len(rows), m)
            first = self.places[:, own].argmin(axis=2).T  # (rows, BINS)
            out[rows] = np.take_along_axis(out[rows], np.take_along_axis(own, first, axis=1), axis=1)
        row, empty = np.nonzero(~filled & (count > 8)[:, None])
        turn, source = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
        left = np.arange(len(row))
        while len(left):  # many: try bin by bin
            source[left] = self.orders[empty[left], turn[left]]
            left = left[~filled[row[left], source[left]]]
            turn[left] += 1
        out[row, empty] = out[row, source]
        return out

    def buckets(self, sets: Sets, docs: np.ndarray) -> np.ndarray:
        """A row of ``BANDS`` bucket keys (64 bits) for each of ``docs``."""
        values = self.signatures(sets, docs).reshape(len(docs), BANDS, ROWS)
        keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93), (len(docs), BANDS))
        for k in range(ROWS):
            keys = mixed(keys ^ values[:, :, k]) + np.uint64(k)
        return mixed(keys)


def _heads(sids: np.ndarray, keys: np.ndarray, shards: int) -> Iterator[tuple]:
    """Rows of FOUND for the buckets (``keys``, a row for each of ``sids``) of
    a task: all members of those that several sets have, and one head of each
    by shard.  A head whose bucket has other members here is marked in the
    lowest bit of its key."""
    flat, who = keys.ravel(), np.repeat(sids, BANDS)
    order = np.lexsort((who, flat))
    flat, who = flat[order], who[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    size = np.diff(np.append(np.flatnonzero(new), len(flat)))
    several = np.repeat(size > 1, size)
    if several.any():
        yield MEMBERS_ROW, who[several].tobytes(), (flat[several] | np.uint64(1)).tobytes()
    flat, who = flat[new] & ~np.uint64(1) | (size > 1).astype(np.uint64), who[new]
    shard = ((flat >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
    edges = np.searchsorted(shard, np.arange(shards + 1))  # ascending, as the keys are
    for s in np.flatnonzero(np.diff(edges)).tolist():
        a, b = edges[s], edges[s + 1]
        yield s, who[a:b].tobytes(), flat[a:b].tobytes()


def _found(documents: DataFrame, shards: int) -> DataFrame:
    """One pass over the texts: each document's class and the buckets."""
    names = ["shard", "sids", "keys", "doc_ids", "doc_sids", "doc_sizes"]
    types = [pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer()
        seen: set[int] = set()
        sids: list[np.ndarray] = []
        keys: list[np.ndarray] = []

        def sent() -> Iterator[pa.RecordBatch]:
            if seen:
                for row in _heads(np.concatenate(sids), np.concatenate(keys), shards):
                    yield batch_of([(*row, None, None, None)])
            seen.clear()
            sids.clear()
            keys.clear()

        for batch in pieces(batches):
            for start in range(0, batch.num_rows, SETS):
                part = batch.slice(start, SETS)
                sets = Sets(Cut(part["text"], lower=True))
                yield batch_of([(DOCUMENTS_ROW, None, None, part["doc_id"].to_pylist(), sets.sids.tolist(), sets.sizes.tolist())])
                fresh = [i for i, s in enumerate(sets.sids.tolist()) if s and not (s in seen or seen.add(s))]
                if fresh:
                    docs = np.array(fresh)
                    sids.append(sets.sids[docs])
                    keys.append(signer.buckets(sets, docs))
                if len(seen) >= CLASSES:
                    yield from sent()
        yield from sent()

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(task, FOUND)


def _members(found: DataFrame) -> DataFrame:
    """token and sid of every bucket that several sets have."""

    def here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sids, keys in zip(batch["sids"].to_pylist(), batch["keys"].to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(keys, np.int64)), pa.array(np.frombuffer(sids, np.int64))], ["token", "sid"])

    def across(key: tuple, group: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(x, np.uint64) for x in group["keys"].to_pylist()])
        sids = np.concatenate([np.frombuffer(x, np.int64) for x in group["sids"].to_pylist()])
        token, several = keys | np.uint64(1), keys & np.uint64(1)
        order = np.lexsort((sids, token))
        token, sids, several = token[order], sids[order], several[order]
        new = np.concatenate([[True], token[1:] != token[:-1]])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(token)))
        differ = np.maximum.reduceat(sids, first) != np.minimum.reduceat(sids, first)
        out = np.repeat(differ, size) & (several == 0)  # marked heads have been sent with their members
        return pa.table({"token": token[out].view(np.int64), "sid": sids[out]})

    local = found.filter(F.col("shard") == MEMBERS_ROW).select("sids", "keys").mapInArrow(here, MEMBERS)
    shared = found.filter("shard >= 0").select("shard", "sids", "keys").groupBy("shard").applyInArrow(across, MEMBERS)
    return store.table(local.unionByName(shared).distinct(), "minhash-members")


def _marks(sids: DataFrame, bits: int) -> np.ndarray:
    """A filter of ``2 ** bits`` bits that holds every given class."""
    span = 1 << min(bits, 18)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.sort(_cell(batch["sid"].to_numpy(), bits))
            for part in np.unique(cell // span).tolist():
                own = np.zeros(span, bool)
                own[cell[np.searchsorted(cell, part * span) : np.searchsorted(cell, (part + 1) * span)] - part * span] = True
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([zlib.compress(np.packbits(own).tobytes(), 1)], pa.binary())], ["part", "bits"])

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(span // 8, np.uint8)
        for batch in batches:
            for x in batch["bits"].to_pylist():
                seen |= np.frombuffer(zlib.decompress(x), np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([seen.tobytes()], pa.binary())], ["part", "bits"])

    out = np.zeros(((1 << bits) // span, span // 8), np.uint8)
    merged = sids.mapInArrow(mark, "part int, bits binary").groupBy("part").applyInArrow(merge, "part int, bits binary").toArrow()
    for part, raw in zip(merged["part"].to_pylist(), merged["bits"].to_pylist(), strict=True):
        out[part] = np.frombuffer(raw, np.uint8)
    return out.reshape(-1)


def _cell(sids: np.ndarray, bits: int) -> np.ndarray:
    return (mixed(sids.view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def _shingles(documents: DataFrame, sids: DataFrame) -> DataFrame:
    """sid, size, sorted shingle hashes, and marks (a bit for each of ``MARKS``
    cells that a shingle falls into) of the given classes, each once.

    The filter has 16 bits for each of them, 128 MB at most; beyond that it
    lets more sets through to the exact join."""
    bits = min(max(20, (16 * sids.count()).bit_length()), 30)
    shared = documents.sparkSession.sparkContext.broadcast(_marks(sids, bits))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sets = Sets(Cut(batch["text"], lower=True))
            cell = _cell(sets.sids, bits)
            needed = (sets.sizes > 0) & ((shared.value[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1)
            once = np.zeros(len(needed), bool)
            once[np.unique(sets.sids, return_index=True)[1]] = True
            some = np.flatnonzero(needed & once)
            if len(some):
                own = [sets.shingles[sets.edges[i] : sets.edges[i + 1]] for i in some.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(sets.sids[some]), pa.array([x.tobytes() for x in own], pa.binary()), pa.array([marked(x) for x in own], pa.list_(pa.int64()))], ["sid", "shingles", "marks"])

    def marked(shingles: np.ndarray) -> np.ndarray:
        on = np.zeros(MARKS, bool)
        on[(mixed(shingles + np.uint64(0x8CB92BA72F3D8DD7)) >> np.uint64(64 - MARKS.bit_length() + 1)).astype(np.int64)] = True
        return np.packbits(on).view(np.int64)

    found = documents.select(F.col("text").cast("string").alias("text")).mapInArrow(task, "sid long, shingles binary, marks array<long>")
    return store.table(found.join(sids, "sid", "left_semi").dropDuplicates(["sid"]).withColumn("size", F.expr("cast(octet_length(shingles) div 8 as int)")), "minhash-sets")


def _weighed(sets: DataFrame) -> DataFrame:
    """sid, size and own (shingles that no other of these sets has) of every set.

    Two sets share at most size - own shingles, a bound that needs no pair.  A
    task sends each of its shingles once, without a set where several have it,
    so a shingle of a third of all sets costs a row per task."""
    shards = max(16, -(-(sets.agg(F.sum("size")).first()[0] or 0) // SHARD_SHINGLES))
    schema = "shard int, sids binary, counts binary, keys binary, more binary"

    def sent(sids: list[int], held: list[np.ndarray]) -> pa.RecordBatch:
        owner = np.repeat(np.arange(len(held)), [len(x) for x in held])
        shingles = mixed(np.concatenate(held))
        order = np.argsort(shingles, kind="stable")
        shingles, owner = shingles[order], owner[order]
        first = np.flatnonzero(np.concatenate([[True], shingles[1:] != shingles[:-1]]))
        several = np.diff(np.append(first, len(shingles))) > 1
        shingles, owner, names = shingles[first], owner[first], np.array(sids, np.int64)
        shard = ((shingles >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
        low, edges = (shingles & np.uint64(0xFFFFFFFF)).astype("<u4"), np.searchsorted(shard, np.arange(shards + 1))
        rows = []
        for s in np.flatnonzero(np.diff(edges)).tolist():
            part = slice(edges[s], edges[s + 1])
            one = ~several[part]
            by = np.argsort(owner[part][one], kind="stable")
            who, count = np.unique(owner[part][one], return_counts=True)
            rows.append((s, names[who].tobytes(), count.astype("<u4").tobytes(), low[part][one][by].tobytes(), low[part][~one].tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(zip(*rows, strict=True))], ["shard", "sids", "counts", "keys", "more"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sids: list[int] = []
        held: list[np.ndarray] = []
        total = 0
        for batch in batches:
            for sid, raw in zip(batch["sid"].to_pylist(), batch["shingles"], strict=True):
                sids.append(sid)
                held.append(np.frombuffer(raw.as_buffer(), np.uint64))
                total += len(held[-1])
                if total >= CHUNK_SHINGLES:
                    yield sent(sids, held)
                    sids, held, total = [], [], 0
        if held:
            yield sent(sids, held)

    def count(key: tuple, group: pa.Table) -> pa.Table:
        raw = lambda c, t: np.concatenate([np.frombuffer(x, t) for x in group[c].to_pylist()])
        sids, keys, more = np.repeat(raw("sids", "<i8"), raw("counts", "<u4")), raw("keys", "<u4"), raw("more", "<u4")
        every = np.sort(np.concatenate([keys, more]))
        alone = (np.searchsorted(every, keys, "right") - np.searchsorted(every, keys, "left")) == 1
        who, own = np.unique(sids[alone], return_counts=True)
        return pa.table({"sid": who, "own": own.astype(np.int64)})

    own = sets.select("sid", "shingles").mapInArrow(task, schema).groupBy("shard").applyInArrow(count, "sid long, own long").groupBy("sid").agg(F.sum("own").cast("int").alias("own"))
    return sets.select("sid", "size").join(own, "sid", "left").select("sid", "size", F.coalesce("own", F.lit(0)).alias("own"))


def _may(size: str, own: str, other: str, others: str):
    """Whether sets of so many shingles, some of them their own, may link."""
    both = F.least(F.col(size) - F.col(own), F.col(other) - F.col(others))
    return both * DENOMINATOR >= (F.col(size) + F.col(other) - both) * NUMERATOR


def _differ():
    """Cells that only one of two sets (``size``, ``marks``; ``m``, ``signs``)
    has a shingle in: so many shingles at least are in only one of them."""
    return F.aggregate(F.zip_with("marks", "signs", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda n, k: n + k)


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u: centre, v) whose whole sets are similar enough."""
    pairs = store.table(pairs.distinct(), "minhash-pairs")
    v = sets.select(F.col("sid").alias("v"), F.col("shingles").alias("right"))
    u = sets.join(pairs.select(F.col("u").alias("sid")).distinct(), "sid", "left_semi").select(F.col("sid").alias("u"), F.col("shingles").alias("left"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch["left"], batch["right"], strict=True):
                both = np.sort(np.concatenate([np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)]), kind="stable")
                n = int((both[1:] == both[:-1]).sum())
                keep.append(DENOMINATOR * n >= NUMERATOR * (len(both) - n))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return store.table(pairs.join(v, "v").join(u, "u").select("u", "v", "left", "right").mapInArrow(task, "u long, v long"), "minhash-links")


def links(documents: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links (u, v) between classes, enough to connect every component, and
    the components (sid, root) of all linked classes."""
    sets = _shingles(documents, members.select("sid").distinct())
    weighed = store.table(_weighed(sets).filter((F.col("size") - F.col("own")) * DENOMINATOR >= F.col("size") * NUMERATOR), "minhash-weighed")
    members = store.table(members.join(weighed, "sid"), "minhash-linkable")
    centre = members.groupBy("token").agg(F.min(F.struct("own", "sid", "size")).alias("c"))
    star = members.join(centre, "token").select(F.col("c.sid").alias("u"), F.col("c.size").alias("m"), F.col("c.own").alias("rare"), F.col("sid").alias("v"), "size", "own")
    edges = _confirmed(star.filter(F.col("u") != F.col("v")).filter(_may("m", "rare", "size", "own")).select("u", "v"), sets)
    roots, done = components(edges), 1
    # of a bucket's n members, those whose hash in it is below done/n have been centres
    turn = F.pmod(F.xxhash64("token", "sid"), F.lit(1 << 40)) / float(1 << 40)
    while True:
        now = members.join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
        split = now.groupBy("token").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("n")).filter((F.col("a") != F.col("b")) & (F.col("n") > (done if done > 1 else 0))).select("token", "n")
        open_ = store.table(now.join(split, "token").withColumn("turn", turn * F.col("n")).join(sets.select("sid", "marks"), "sid"), "minhash-open")
        if open_.isEmpty():
            return edges, roots
        low, done = (0 if done == 1 else done), done * CENTRES
        centres = open_.filter((F.col("turn") >= low) & (F.col("turn") < done)).select("token", F.col("sid").alias("u"), F.col("size").alias("m"), F.col("own").alias("rare"), F.col("marks").alias("signs"), F.col("root").alias("other"), F.col("turn").alias("before"))
        later = (F.col("turn") > F.col("before")) | (F.col("turn") == F.col("before")) & (F.col("sid") > F.col("u"))
        near = _differ() * (NUMERATOR + DENOMINATOR) <= (F.col("m") + F.col("size")) * (DENOMINATOR - NUMERATOR)
        pairs = centres.join(open_, "token").filter(later & (F.col("root") != F.col("other")) & _may("m", "rare", "size", "own") & near)
        found = _confirmed(pairs.select("u", F.col("sid").alias("v")), sets)
        edges = edges.unionByName(found)
        roots = _merged(roots, found)


def groups(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, sid (class of equal sets; 0 without shingles),
    component_id and kept of every document; the component is the smallest
    doc_id reachable by links, and kept tells whether that is the document's.

    Null and empty texts have no shingles and are alone.  Null doc_ids never
    name a component with other doc_ids in it, and are kept only in one without
    any.  Repeated rows give a row each and are all kept if one is (``keep_one``
    leaves one).  Very long texts are taken whole; other columns play no part.
    An empty table has no rows."""
    shards = max(16, -(-documents.count() // SHARD_CLASSES))
    found = store.table(_found(documents, shards), "minhash-found")
    _, roots = links(documents, _members(found))
    rows = found.filter(F.col("shard") == DOCUMENTS_ROW).select("doc_ids", "doc_sids", "doc_sizes")
    known = rows.select(F.inline(F.arrays_zip("doc_ids", "doc_sids", "doc_sizes"))).toDF("doc_id", "sid", "n_shingles")
    rooted = known.join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    least = rooted.filter("n_shingles > 0").groupBy(F.col("root").alias("r")).agg(F.min("doc_id").alias("least"))
    out = rooted.join(least, (F.col("root") == F.col("r")) & (F.col("n_shingles") > 0), "left").withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id")))
    return out.select("doc_id", "n_shingles", "sid", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
