"""N-gram Jaccard join by prefix filtering (in place of PartEnum, see README).

Two documents link when their sets of 5-word shingles have a Jaccard
similarity of at least 0.75; the result is each document's connected component.

Signatures.  The shingle domain is partitioned by hash, anew for each band of
set sizes (a set near a border takes part in both bands, so linked sets always
meet in one).  The subsets enumerated are the single parts: a signature is a
part's number with exactly the shingles that the set has there.  The parts are
so fine that a set's shingles lie in different ones, but for a chance that one
spare signature covers; so of linked sets x and y at most |x - y| signatures
of x are not y's.

Selection.  Every task sends its signatures, packed, to shards by hash; a shard
counts the distinct sets that have each one.  Only repeated signatures come
back, each set's in one order for all sets: rarest first.  Linked sets share a
signature that stands within the first |x - y| + 1 of the one and the first
|y - x| + 1 of the other, and similarity bounds both by the sizes; other pairs
aren't looked at.  Passages that many documents share are never among the
rarest, unless hardly anything else is there.

Checking.  Within a signature's sets, the one with the fewest signatures of its
own is the centre and is compared exactly with the others; linked sets fall
into components, and only signatures whose sets are still in several
components go on, with many times more centres each round, until none is left.
So a group of thousands of copies costs one comparison each, no group is ever
expanded into all its pairs at once, and no link between components is missed.

Equal sets are one class from the start (64-bit hash of the set).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import store
from quarry.llm.text import Cut, field, mixed, pieces, starts, windows

#: Similarity as a fraction, so that every bound is exact in integers.
NUMERATOR, DENOMINATOR = 3, 4
SHINGLE = 5
#: Bits of a part's number, and signatures of a set that may share a part with another set's shingle by chance.
PART_BITS, SPARE = 40, 1
#: Text bytes whose signatures one shard holds.
SHARD_BYTES = 10_000_000
#: A round takes so many times the centres that have been compared before.
CENTRES = 16
#: Bits of the filter that tells which sets' shingles are needed for checking.
FILTER_BITS = 26
PACKETS = "shard int, sids binary, counts binary, totals binary, bands binary, sizes binary, keys binary"
REPEATED = "sid long, band int, size int, total int, token long, df int"


class Sets:
    """Distinct shingle hashes of each document of a piece."""

    def __init__(self, cut: Cut, size: int = SHINGLE) -> None:
        offsets = cut.offsets
        hashes = cut.lanes()[cut.ids, 0]
        lens = np.diff(offsets)
        at = starts(offsets, size)
        owner = np.repeat(np.arange(len(lens)), np.maximum(lens - size + 1, 0))
        found = windows(hashes, size)[at] if len(at) else np.zeros(0, np.uint64)
        for n in range(1, size):  # shorter documents: the whole sequence
            short = np.flatnonzero(lens == n)
            if len(short):
                found = np.concatenate([found, mixed(windows(hashes, n)[offsets[short]] + np.uint64(n))])
                owner = np.concatenate([owner, short])
        order = np.lexsort((found, owner))
        found, owner = found[order], owner[order]
        once = np.ones(len(found), bool)
        once[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
        self.shingles, self.owner = found[once], owner[once]
        self.sizes = np.bincount(self.owner, minlength=len(lens))
        self.edges = np.concatenate([[0], np.cumsum(self.sizes)])
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(self.shingles + np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
        #: class of each document: a hash of its whole set; 0 without shingles
        self.sids = np.where(self.sizes > 0, mixed(sums[self.edges[1:]] - sums[self.edges[:-1]] + self.sizes.astype(np.uint64)) | np.uint64(1), np.uint64(0)).view(np.int64)


def missing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Shingles that a set of ``a`` may have and a linked one of ``b`` not, at most."""
    return a - -(-NUMERATOR * (a + b) // (NUMERATOR + DENOMINATOR))


def reach(a, b):
    """Places in order, as a column, within which a set of ``a`` shingles has
    the first signature that it shares with a linked one of ``b``."""
    return a - F.ceil((a + b) * NUMERATOR / (NUMERATOR + DENOMINATOR)) + 1 + SPARE


def band_of(size: np.ndarray) -> np.ndarray:
    """Band of a set size: powers of four."""
    return ((np.frexp(size.astype(float))[1] - 1) // 2).astype(np.int64)


def signatures(sets: Sets, use: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """By band: documents, their numbers of signatures, and the signatures
    (64-bit hashes), for the documents ``use``."""
    low = band_of((-(-NUMERATOR * sets.sizes // DENOMINATOR)).clip(1))
    high = band_of((DENOMINATOR * sets.sizes // NUMERATOR).clip(1))
    for band in range(int(low[use].min()), int(high[use].max()) + 1) if use.any() else ():
        docs = np.flatnonzero(use & (low <= band) & (band <= high))
        if not len(docs):
            continue
        number = np.full(len(sets.sizes), -1)
        number[docs] = np.arange(len(docs))
        mine = number[sets.owner] >= 0
        shingles, owner = sets.shingles[mine], number[sets.owner[mine]]
        salted = mixed(shingles ^ np.uint64(0xA24BAED4963EE407 + band))
        slot = (owner << PART_BITS) + (salted >> np.uint64(64 - PART_BITS)).astype(np.int64)
        order = np.argsort(slot, kind="stable")
        slot = slot[order]
        first = np.ones(len(slot), bool)
        first[1:] = slot[1:] != slot[:-1]
        at = np.flatnonzero(first)
        sums = np.add.reduceat(mixed(salted[order]), at) if len(at) else np.zeros(0, np.uint64)
        tokens = mixed(sums ^ mixed((slot[first] & ((1 << PART_BITS) - 1)).astype(np.uint64) + (np.uint64(band) << np.uint64(48))))
        yield band, docs, np.bincount(slot[first] >> PART_BITS, minlength=len(docs)), tokens


def _packets(documents: DataFrame, shards: int) -> DataFrame:
    """Packed signatures by shard.  A packet holds, for each set that has any
    in the shard, its class, band, size, number of all its signatures, and 32
    bits of each signature; with the shard's number that makes a signature, so
    their space grows with the data."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sets = Sets(Cut(batch["text"], lower=True))
            use = np.zeros(len(sets.sizes), bool)
            use[np.unique(sets.sids, return_index=True)[1]] = True
            use &= sets.sizes > 0
            held = []
            for band, docs, count, tokens in signatures(sets, use):
                held.append((sets.sids[docs], np.full(len(docs), band), sets.sizes[docs], count, count, tokens))
            if not held:
                continue
            sids, bands, sizes, totals = (np.concatenate([h[k] for h in held]) for k in range(4))
            owner = np.repeat(np.arange(len(sids)), np.concatenate([h[4] for h in held]))
            tokens = np.concatenate([h[5] for h in held])
            shard = ((tokens >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            edges = np.concatenate([[0], np.flatnonzero(np.diff(shard[order])) + 1, [len(order)]])
            rows = []
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                some = order[a:b]
                who, count = np.unique(owner[some], return_counts=True)
                columns = ((sids, "<i8"), (count, "<u4"), (totals, "<u4"), (bands, "u1"), (sizes, "<u4"))
                packed = [(x if x is count else x[who]).astype(t).tobytes() for x, t in columns]
                rows.append((int(shard[some[0]]), packed[0], *(zlib.compress(x, 1) for x in packed[1:]), (tokens[some] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(zip(*rows, strict=True))], ["shard", "sids", "counts", "totals", "bands", "sizes", "keys"])

    return documents.select(F.col("text").cast("string").alias("text")).mapInArrow(task, PACKETS)


def _repeated(packets: DataFrame) -> DataFrame:
    """Signatures that several distinct sets have, with the number of those."""

    def count(group: pd.DataFrame) -> pd.DataFrame:
        raw = lambda c, t, z=True: np.concatenate([np.frombuffer(zlib.decompress(x) if z else x, t) for x in group[c]])
        per, keys = raw("counts", "<u4").astype(np.int64), raw("keys", "<u4", False)
        owner = np.repeat(np.arange(len(per)), per)
        sids, totals, bands, sizes = raw("sids", "<i8", False), raw("totals", "<u4"), raw("bands", "u1"), raw("sizes", "<u4")
        order = np.argsort(keys, kind="stable")
        same = np.flatnonzero(keys[order][1:] == keys[order][:-1])
        some = np.zeros(len(keys), bool)  # in the order of keys: occurs twice or more
        some[same] = some[same + 1] = True
        own = order[some]
        key, who = keys[own], owner[own]
        sid = sids[who]
        order = np.lexsort((sid, key))
        key, who, sid = key[order], who[order], sid[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (sid[1:] != sid[:-1])
        key, who, sid = key[new], who[new], sid[new]
        _, place, df = np.unique(key, return_inverse=True, return_counts=True)
        df = df[place] if len(key) else df
        out = df > 1
        token = (int(group["shard"].iloc[0]) << 32) + key.astype(np.int64)
        return pd.DataFrame({"sid": sid[out], "band": bands[who][out].astype(np.int32), "size": sizes[who][out].astype(np.int32), "total": totals[who][out].astype(np.int32), "token": token[out], "df": df[out].astype(np.int32)})

    return packets.groupBy("shard").applyInPandas(count, REPEATED)


def _candidates(repeated: DataFrame) -> DataFrame:
    """token, sid, size, own (signatures that no other set has) and place (in
    the order of all the set's signatures), for the signatures that a linked
    set of any size might share first."""
    by = Window.partitionBy("sid", "band")
    ranked = repeated.withColumn("rank", F.row_number().over(by.orderBy("df", "token"))).withColumn("own", F.col("total") - F.count("*").over(by))
    least = F.ceil(F.col("size") * NUMERATOR / DENOMINATOR)
    placed = ranked.withColumn("place", F.col("own") + F.col("rank"))
    return placed.filter(F.col("place") <= reach(F.col("size"), least)).select("token", "sid", "size", "own", F.col("place").cast("int").alias("place"))


def _needed(sids: DataFrame) -> np.ndarray:
    """Bits of a filter of fixed size that holds every given class."""
    span = 1 << 18

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, np.ndarray] = {}
        for batch in batches:
            cell = _cell(batch["sid"].to_numpy())
            for part in np.unique(cell // span).tolist():
                seen.setdefault(part, np.zeros(span, bool))[cell[cell // span == part] % span] = True
        for part, bits in seen.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([zlib.compress(np.packbits(bits).tobytes(), 1)], pa.binary())], ["part", "bits"])

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        bits = np.bitwise_or.reduce([np.frombuffer(zlib.decompress(x), np.uint8) for x in group["bits"]])
        return pd.DataFrame({"part": group["part"].iloc[:1], "bits": [bits.tobytes()]})

    out = np.zeros(((1 << FILTER_BITS) // span, span // 8), np.uint8)
    merged = sids.mapInArrow(mark, "part int, bits binary").groupBy("part").applyInPandas(merge, "part int, bits binary").toArrow()
    for part, raw in zip(merged["part"].to_pylist(), merged["bits"].to_pylist(), strict=True):
        out[part] = np.frombuffer(raw, np.uint8)
    return out.reshape(-1)


def _cell(sids: np.ndarray) -> np.ndarray:
    return (mixed(sids.view(np.uint64)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _shingles(documents: DataFrame, sids: DataFrame) -> DataFrame:
    """sid and sorted shingle hashes of the given classes, each once."""
    shared = documents.sparkSession.sparkContext.broadcast(_needed(sids))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sets = Sets(Cut(batch["text"], lower=True))
            cell = _cell(sets.sids)
            needed = (sets.sizes > 0) & ((shared.value[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1)
            once = np.zeros(len(needed), bool)
            once[np.unique(sets.sids, return_index=True)[1]] = True
            some = np.flatnonzero(needed & once)
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array(sets.sids[some]), pa.array([sets.shingles[sets.edges[i] : sets.edges[i + 1]].tobytes() for i in some.tolist()], pa.binary())], ["sid", "shingles"])

    found = documents.select(F.col("text").cast("string").alias("text")).mapInArrow(task, "sid long, shingles binary")
    return store.table(found.join(sids, "sid", "left_semi").dropDuplicates(["sid"]), "partenum-sets")


def _linked(pairs: DataFrame, shingles: DataFrame) -> DataFrame:
    """The pairs (u: centre, v) that are similar enough, by their whole sets."""
    v = shingles.select(F.col("sid").alias("v"), F.col("shingles").alias("right"))
    u = shingles.join(pairs.select(F.col("u").alias("sid")).distinct(), "sid", "left_semi").select(F.col("sid").alias("u"), F.col("shingles").alias("left"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch["left"], batch["right"], strict=True):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([a, b]), kind="stable")
                n = int((both[1:] == both[:-1]).sum())
                keep.append(DENOMINATOR * n >= NUMERATOR * (len(both) - n))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(v, "v").join(u, "u").select("u", "v", "left", "right").mapInArrow(task, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """sid and root of every node of the links: all of a component have one
    root.  Each round every node hooks onto its smallest neighbour, chains are
    shortened, and the links between what is left are taken on."""
    roots = None
    edges = store.table(edges.select("u", "v").distinct(), "component-links")
    while edges.limit(1).count():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parent = store.table(both.groupBy("u").agg(F.min("v").alias("p")).select("u", F.least("u", "p").alias("p")), "component-parents")
        up = parent.select(F.col("u").alias("p"), F.col("p").alias("pp"))
        parent = store.table(parent.join(up, "p").join(parent.select(F.col("u").alias("pp"), F.col("p").alias("to")), "pp").select("u", F.col("to").alias("p")), "component-parents")
        roots = parent.select(F.col("u").alias("sid"), F.col("p").alias("root")) if roots is None else _follow(roots, parent)
        roots = store.table(roots, "component-roots")
        a = parent.select(F.col("u"), F.col("p").alias("pu"))
        b = parent.select(F.col("u").alias("v"), F.col("p").alias("pv"))
        left = edges.join(a, "u").join(b, "v").filter("pu != pv").select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct()
        edges = store.table(left, "component-links")
    spark = edges.sparkSession
    return roots if roots is not None else spark.createDataFrame([], "sid long, root long")


def _follow(roots: DataFrame, parent: DataFrame) -> DataFrame:
    to = parent.select(F.col("u").alias("root"), F.col("p").alias("to"))
    return roots.join(to, "root", "left").select("sid", F.coalesce("to", "root").alias("root"))


def classes(documents: DataFrame) -> DataFrame:
    """doc_id, sid (class: documents with equal sets; 0 without shingles) and
    n_shingles of every document."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sets = Sets(Cut(batch["text"], lower=True))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(sets.sids), pa.array(sets.sizes.astype(np.int64))], ["doc_id", "sid", "n_shingles"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(task, "doc_id long, sid long, n_shingles long")


def links(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links (u, v) between classes that connect every component fully (a pair
    is left out only where its ends are connected by others already), and the
    components (sid, root) of all linked classes."""
    size = documents.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    shards = max(16, -(-size // SHARD_BYTES))
    rest = store.table(_candidates(_repeated(_packets(documents, shards))), "partenum-candidates")
    shingles = _shingles(documents, rest.select("sid").distinct())
    first = rest.groupBy("token").agg(F.min(F.struct("own", "sid", "size", "place")).alias("c"))
    pairs = rest.join(first, "token").filter(F.col("sid") != F.col("c.sid")).select(F.col("c.sid").alias("u"), F.col("sid").alias("v"), F.col("c.size").alias("m"), "size", F.col("c.place").alias("at"), "place")
    edges = _checked(pairs.filter(_possible()).select("u", "v"), shingles)
    roots, done = components(edges), 1
    while True:
        # signatures whose sets are in several components, with sets not yet compared as centres
        now = rest.join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
        split = now.groupBy("token").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("n")).filter((F.col("a") != F.col("b")) & (F.col("n") > done + 1)).select("token")
        open_ = store.table(now.join(split, "token", "left_semi").withColumn("turn", F.row_number().over(Window.partitionBy("token").orderBy("own", "sid"))), "partenum-open")
        if not open_.limit(1).count():
            return edges, roots
        last = done + CENTRES * done
        centres = open_.filter(F.col("turn").between(done + 1, last)).select("token", F.col("sid").alias("u"), F.col("size").alias("m"), F.col("place").alias("at"), F.col("root").alias("other"), F.col("turn").alias("before"))
        pairs = centres.join(open_, "token").filter((F.col("turn") > F.col("before")) & (F.col("root") != F.col("other")) & _possible())
        found = _checked(pairs.select("u", F.col("sid").alias("v")), shingles)
        edges = edges.unionByName(found)
        roots = _merged(roots, found)
        done = last


def _possible():
    """Whether sets of ``m`` and ``size`` shingles with a signature in common,
    at places ``at`` and ``place``, may be linked by it."""
    sizes = F.least("m", "size") * DENOMINATOR >= F.greatest("m", "size") * NUMERATOR
    return sizes & (F.col("at") <= reach(F.col("m"), F.col("size"))) & (F.col("place") <= reach(F.col("size"), F.col("m")))


def _checked(pairs: DataFrame, shingles: DataFrame) -> DataFrame:
    """The pairs (u, v) that link, compared by whole sets."""
    pairs = store.table(pairs.distinct(), "partenum-pairs")
    return store.table(_linked(pairs, shingles), "partenum-links")


def _merged(roots: DataFrame, found: DataFrame) -> DataFrame:
    """The components after more links: those links join roots only."""
    if not found.limit(1).count():
        return roots
    ends = found
    for c in ("u", "v"):
        ends = ends.join(roots.select(F.col("sid").alias(c), F.col("root").alias("r")), c, "left").withColumn(c, F.coalesce("r", c)).drop("r")
    more = components(ends)
    # classes that no link had reached before are their own roots
    every = roots.select("sid", "root").unionByName(more.select("sid", F.col("sid").alias("root")).join(roots, "sid", "left_anti"))
    return store.table(_follow(every, more.select(F.col("sid").alias("u"), F.col("root").alias("p"))), "component-roots")


def groups(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, sid and component_id of every document; the
    component is the smallest doc_id reachable by links.

    Null and empty texts have no shingles and are alone.  Null doc_ids never
    name a component with other doc_ids in it; a component of null doc_ids
    only has a null one.  Repeated rows give a row each; other columns play no
    part."""
    known = store.table(classes(documents), "partenum-classes")
    _, roots = links(documents)
    rooted = known.join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    least = rooted.filter("n_shingles > 0").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    found = rooted.join(least.withColumnRenamed("root", "r"), (F.col("root") == F.col("r")) & (F.col("n_shingles") > 0), "left")
    return found.select("doc_id", "n_shingles", "sid", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(documents: DataFrame) -> DataFrame:
    """One document of each component, with all columns: that of the smallest
    doc_id (of rows that repeat it, that of the smallest class, and of equal
    rows any).  Documents without shingles all stay."""
    found = store.table(groups(documents), "partenum-groups")
    keepers = found.filter("n_shingles > 0 and doc_id <=> component_id").groupBy("component_id").agg(F.min("sid").alias("keep_sid"))
    alone = found.filter("n_shingles > 0 and component_id is null").select(F.lit(None).cast("long").alias("component_id"), F.col("sid").alias("keep_sid")).distinct()
    keepers = keepers.filter("component_id is not null").unionByName(alone)
    columns = documents.columns
    schema = T.StructType([T.StructField("kept", T.StructType(documents.schema.fields)), T.StructField("sid", T.LongType()), T.StructField("id", T.LongType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "kept.text"):
            sets = Sets(Cut(field(batch, "kept.text"), lower=True))
            yield pa.RecordBatch.from_arrays([batch["kept"], pa.array(sets.sids), field(batch, "kept.doc_id").cast(pa.int64())], ["kept", "sid", "id"])

    rows = documents.select(F.struct(*columns).alias("kept")).mapInArrow(task, schema)
    one = rows.join(keepers, (F.col("sid") == F.col("keep_sid")) & F.col("id").eqNullSafe(F.col("component_id"))).dropDuplicates(["sid", "id"])
    return one.select("kept.*").unionByName(rows.filter("sid = 0").select("kept.*"))
