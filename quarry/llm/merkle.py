"""Merkle dataset manifest by content-addressed descent.

A table's rows are leaves of one hash tree per group (say, language), and the
groups' roots are leaves of a last tree.  Every run of ``arity`` neighbours
becomes their digest, the last run too when it is shorter, until one is left.

Store.  Inner nodes are records digest -> children, equal ones once.  The
records of ``levels`` levels below a node are stored in one row, a pack, that
is found by the digest of its top node: a leaf's way from the root reads a few
packs, and a pack holds ``arity ** levels`` nodes at the bottom whatever the
table's size.

Descent.  A request for a leaf starts at the root.  In each pack the digits of
the leaf's rank choose a child per level, the unselected children are
collected, and the node reached at the bottom names the next pack by its
digest.  Requests that share all digits so far are one row, so the root's pack
is asked for once, not once per leaf, and all steps together move as many rows
as there are packs.  Reversed, the collected segments are the leaf's proof.

Ranks come from a range partitioning with the number of rows in each range, so
no group is gathered anywhere, however large.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import store

#: Columns of a document that its leaf covers, in this order.
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
PACKS = "grp string, pos long, n long, digest string, levels int, digests array<string>, children array<array<string>>"
FRONTIER = "grp string, pos long, digest string, depth int, top string, left array<string>, right array<string>"
PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def digest(*parts: str) -> str:
    """Lowercase hex SHA-256 of the parts one after the other."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values: list[Column]) -> Column:
    """A row's digest: of each value "-" if null, else its length in UTF-8
    bytes, ":" and the value as text."""

    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(part, values)).cast("binary"), 256)


def leaves(documents: DataFrame, claimed: dict[str, Column] | None = None) -> DataFrame:
    """grp, id, digest of every document, and claim: its digest with the
    columns that ``claimed`` replaces, null where that is the same."""
    own = leaf([F.col(c) for c in FIELDS])
    other = leaf([(claimed or {}).get(c, F.col(c)) for c in FIELDS])
    found = documents.select(F.col("lang").cast("string").alias("grp"), F.col("doc_id").cast("long").alias("id"), own.alias("digest"), (other if claimed else F.lit(None).cast("string")).alias("claim"))
    return found.withColumn("claim", F.nullif("claim", "digest"))


def height(n: int, arity: int) -> int:
    """Levels above ``n`` leaves."""
    levels, room = 0, 1
    while room < n:
        levels, room = levels + 1, room * arity
    return levels


def _height(n: Column, arity: int) -> Column:
    powers = [arity**k for k in range(63) if arity**k < 2**62]
    return F.size(F.filter(F.array(*map(F.lit, powers)), lambda p: p < n))


def ranked(items: DataFrame, order: list[str]) -> DataFrame:
    """The items with pos, the place from 0 in their group by ``order`` (nulls
    first; rows that agree in all of it in any order), and n, the group's size.

    ``items`` must be a written table, whose rows come in the same order again."""
    keys = ["grp", *order, "tie"]
    tied = items.withColumn("tie", F.monotonically_increasing_id())  # so that no run of equal rows is one task's
    placed = store.table(tied.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id()).drop("tie"), "merkle-order")
    part = F.shiftright("at", 33)
    runs = placed.groupBy("grp", part.alias("part")).agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    by = Window.partitionBy("grp")
    runs = runs.select(F.col("grp").alias("g"), "part", "first", (F.sum("rows").over(by.orderBy("part")) - F.col("rows")).alias("before"), F.sum("rows").over(by).alias("n"))
    joined = placed.join(runs, part.eqNullSafe(F.col("part")) & F.col("grp").eqNullSafe(F.col("g")))
    return joined.withColumn("pos", F.col("at") - F.col("first") + F.col("before")).drop("at", "g", "part", "first", "before")


@dataclass
class Dag:
    """A forest's stored records: ``packs``; the leaves in runs of one pack's
    bottom: ``blocks`` (grp, pos, n, items); each tree's root: ``roots`` (grp,
    n, digest)."""

    packs: DataFrame
    blocks: DataFrame
    roots: DataFrame
    arity: int
    levels: int


def _records(arity: int, levels: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (grp, pos, n, bottom) to packs."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for n, row in zip(batch["n"].to_pylist(), batch["bottom"].to_pylist(), strict=True):
                records: dict[str, list[str]] = {}
                up = min(levels, height(n, arity))
                for _ in range(up):
                    runs = [row[i : i + arity] for i in range(0, len(row), arity)]
                    row = [digest(*run) for run in runs]
                    records.update(zip(row, runs, strict=True))
                out.append((row[0], up, list(records), list(records.values())))
            arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.list_(pa.string()))), strict=True)] if out else []
            if out:
                yield pa.RecordBatch.from_arrays([batch["grp"], batch["pos"], batch["n"], *arrays], ["grp", "pos", "n", "digest", "levels", "digests", "children"])

    return task


def build(items: DataFrame, order: list[str], arity: int = 2, levels: int = 8) -> Dag:
    """Trees of all groups of ``items`` (grp, id, digest, claim; a written
    table).  A round makes the packs of ``levels`` levels of all trees; the
    nodes that are left are as many times fewer."""
    span = arity**levels
    member = F.sort_array(F.collect_list(F.struct("pos", "id", "digest", "claim")))
    placed = ranked(items, order).withColumn("block", F.expr(f"pos div {span}"))
    blocks = store.table(placed.groupBy("grp", "block", "n").agg(member.alias("items")).select("grp", F.col("block").alias("pos"), "n", "items"), "merkle-blocks")
    rows = blocks.select("grp", "pos", "n", F.transform("items", lambda x: x["digest"]).alias("bottom"))
    every, roots = [], []
    while True:
        packs = store.table(rows.mapInArrow(_records(arity, levels), PACKS), "merkle-packs")
        every.append(packs)
        left = F.ceil(F.col("n") / span).cast("long")
        roots.append(packs.filter(left <= 1).select("grp", "digest"))
        nodes = packs.filter(left > 1).select("grp", "pos", left.alias("n"), "digest")
        if nodes.isEmpty():
            break
        rows = nodes.groupBy("grp", F.expr(f"pos div {span}").alias("block"), "n").agg(F.sort_array(F.collect_list(F.struct("pos", "digest"))).alias("row"))
        rows = rows.select("grp", F.col("block").alias("pos"), "n", F.transform("row", lambda x: x["digest"]).alias("bottom"))
    found, packs = roots[0], every[0]
    for more, some in zip(roots[1:], every[1:], strict=True):
        found, packs = found.unionByName(more), packs.unionByName(some)
    sizes = blocks.filter("pos = 0").select(F.col("grp").alias("g"), "n")
    found = found.join(sizes, F.col("grp").eqNullSafe(F.col("g"))).select("grp", "n", "digest")
    # equal digests, equal records: one pack is enough; a lone leaf has none
    packs = store.table(packs.filter("levels > 0").select("digest", "levels", "digests", "children").dropDuplicates(["digest", "levels"]), "merkle-store")
    return Dag(packs, blocks, store.table(found, "merkle-roots"), arity, levels)


def walk(top: str, left: list[str], right: list[str], digests: list[str] | None, children: list[list[str]] | None, levels: int) -> list[tuple[str, list[str], list[str]]]:
    """From a pack's top node to all nodes at its bottom, in order: digest and
    the unselected children on the way, those before and those after it."""
    records = dict(zip(digests or [], children or [], strict=True))
    nodes = [(top, left, right)]
    for _ in range(levels):
        nodes = [(x, before + ["".join(run[:i])], after + ["".join(run[i + 1 :])]) for node, before, after in nodes for run in (records[node],) for i, x in enumerate(run)]
    return nodes


def descend(dag: Dag, frontier: DataFrame, finish, schema) -> DataFrame:
    """Follow all ranks of the trees in ``frontier`` (FRONTIER, one row per
    root) down to the leaves.  ``finish`` (top, item, left, right) makes the
    row of a leaf from what was collected on its way, root first."""
    arity, levels = dag.arity, dag.levels
    here = F.when(F.col("depth") > 0, (F.col("depth") - 1) % levels + 1).otherwise(0)

    def packed(rows: DataFrame) -> DataFrame:
        p = dag.packs.select(F.col("digest").alias("d"), F.col("levels").alias("l"), "digests", "children")
        return rows.join(p, (F.col("digest") == F.col("d")) & (here == F.col("l")), "left").drop("d", "l")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                down = (r["depth"] - 1) % levels + 1
                nodes = walk(r["digest"], r["left"], r["right"], r["digests"], r["children"], down)
                rows = [{"grp": r["grp"], "pos": r["pos"] * arity**down + i, "digest": d, "depth": r["depth"] - down, "top": r["top"], "left": a, "right": b} for i, (d, a, b) in enumerate(nodes)]
                yield pa.RecordBatch.from_pylist(rows, frontier_schema)

    frontier_schema = pa.schema([("grp", pa.string()), ("pos", pa.int64()), ("digest", pa.string()), ("depth", pa.int32()), ("top", pa.string()), ("left", pa.list_(pa.string())), ("right", pa.list_(pa.string()))])
    ends = frontier.filter(F.col("depth") <= levels)
    while True:
        far = frontier.filter(F.col("depth") > levels)
        if far.isEmpty():
            break
        frontier = store.table(packed(far).mapInArrow(step, FRONTIER), "merkle-frontier")
        ends = ends.unionByName(frontier.filter(F.col("depth") <= levels))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                nodes = walk(r["digest"], r["left"], r["right"], r["digests"], r["children"], r["depth"])
                rows = []
                for item in r["items"]:
                    reached, left, right = nodes[item["pos"] - r["pos"] * arity**levels]
                    if reached != item["digest"]:
                        raise ValueError(f"the stored records lead to {reached}, not to the leaf {item['digest']}")
                    rows.append(finish(r["top"], item, left, right))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    names, types = [f.name for f in schema.fields], [_ARROW[f.dataType.simpleString()] for f in schema.fields]
    items = dag.blocks.select(F.col("grp").alias("g"), F.col("pos").alias("b"), "items")
    asked = packed(ends).join(items, F.col("grp").eqNullSafe(F.col("g")) & (F.col("pos") == F.col("b"))).drop("g", "b")
    return asked.mapInArrow(answer, schema)


_ARROW = {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}


def fold(leaf: str, left: list[str], right: list[str]) -> str:
    """The root that a leaf and its proof (root first) give."""
    for a, b in zip(reversed(left), reversed(right), strict=True):
        leaf = digest(a, leaf, b)
    return leaf


def proof_digest(left: list[str], right: list[str]) -> str:
    """Digest of a proof's siblings, leaf first and left to right."""
    return digest(*(x for pair in zip(reversed(left), reversed(right), strict=True) for x in pair))


def manifest(items: DataFrame, arity: int = 2, levels: int = 8) -> tuple[Dag, Dag]:
    """The records of all groups' trees and those of the tree over their roots."""
    trees = build(store.table(items, "merkle-leaves"), ["id", "digest"], arity, levels)
    subroots = trees.roots.select(F.lit(None).cast("string").alias("grp"), F.col("grp").alias("id"), "digest", F.lit(None).cast("string").alias("claim"))
    return trees, build(store.table(subroots, "merkle-subroots"), ["id"], arity, levels)


def proofs(documents: DataFrame, claimed: dict[str, Column] | None = None, arity: int = 2, levels: int = 8) -> DataFrame:
    """A row per document: doc_id, leaf, subroot (its language's), root,
    proof_sha256, folded_root (from the document as ``claimed``, and the stored
    siblings) and verified (whether that is the root).

    Nulls are values of their own in leaves; documents of a null language are
    a group, the first; null doc_ids come first in theirs.  Rows that repeat a
    doc_id are ordered by digest, equal rows stand side by side and each has a
    proof.  Empty and very long texts are hashed whole.  Other columns play no
    part.  An empty table has no rows."""
    trees, over = manifest(leaves(documents, claimed), arity, levels)
    last = over.roots.first()
    root = last.digest if last else ""
    none = F.array().cast("array<string>")
    start = over.roots.select("grp", F.lit(0).cast("long").alias("pos"), "digest", _height(F.col("n"), arity).alias("depth"), F.lit(None).cast("string").alias("top"), none.alias("left"), none.alias("right"))
    ways = T.StructType([T.StructField("name", T.StringType()), T.StructField("subroot", T.StringType()), T.StructField("left", T.ArrayType(T.StringType())), T.StructField("right", T.ArrayType(T.StringType()))])
    found = store.table(descend(over, start, lambda top, item, left, right: (item["id"], item["digest"], left, right), ways), "merkle-ways")
    begin = found.join(trees.roots.select("grp", "n"), F.col("name").eqNullSafe(F.col("grp")))
    begin = begin.select("grp", F.lit(0).cast("long").alias("pos"), F.col("subroot").alias("digest"), _height(F.col("n"), arity).alias("depth"), F.col("subroot").alias("top"), "left", "right")

    def finish(top: str, item: dict, left: list[str], right: list[str]) -> tuple:
        folded = fold(item["claim"] or item["digest"], left, right)
        return item["id"], item["digest"], top, root, proof_digest(left, right), folded, folded == root

    return descend(trees, begin, finish, T._parse_datatype_string(PROOFS))
