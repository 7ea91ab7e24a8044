"""Link graph and PageRank as joins.

Edges are a set (duplicates collapse); nodes are page URLs plus every link
target, crawled or not.  PageRank follows the usual definition: damping
``alpha``, uniform start and teleport, the mass of dangling nodes spread
uniformly, stop when the L1 change is below ``n * tol``.

Each round is one join of the rank vector with the out-degree-weighted edge
list and one aggregation by target; the dangling mass and the node count
are one-row aggregates cross-joined into the plan, so a round needs no
driver round trip.  Lineage is cut every ``checkpoint_every`` rounds by
writing the rank vector as a table in the session's shared checkpoint
folder, so a lost executor recomputes at most that many rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.common import fits, materialize, materialize_bucketed


def link_edges(records: DataFrame, src: str = "url", links: str = "links") -> DataFrame:
    """``(src, dst)`` distinct edges from each record's link list."""
    return (
        records.select(F.col(src).alias("src"), F.explode(links).alias("dst"))
        .filter(F.col("dst").isNotNull())
        .distinct()
    )


def link_nodes(records: DataFrame, edges: DataFrame, src: str = "url") -> DataFrame:
    """``(node)``: page URLs union link targets."""
    return records.select(F.col(src).alias("node")).union(edges.select(F.col("dst").alias("node"))).distinct()


def out_degree(edges: DataFrame) -> DataFrame:
    """``(src, out_degree)``."""
    return edges.groupBy("src").agg(F.count(F.lit(1)).alias("out_degree"))


def pagerank(
    edges: DataFrame,
    nodes: DataFrame,
    alpha: float = 0.85,
    iterations: int | None = None,
    max_iter: int = 100,
    tol: float = 1.0e-6,
    checkpoint_every: int = 3,
    raise_on_no_convergence: bool = True,
    heavy_degree: int | None = None,
) -> DataFrame:
    """``(node, pagerank)``.

    ``iterations`` fixes the number of rounds (no convergence test); else
    rounds run until the L1 change is below ``n * tol`` and more than
    ``max_iter`` rounds raise, like the common library default.  The
    convergence test is one scalar per round read by the driver.

    Edges never move between rounds: they are written once in buckets of
    (source, salt), with the sources of more than ``heavy_degree`` out-links
    (default: the mean edges of a bucket) cut into blocks by their targets, so
    no bucket holds more than a few such blocks.  A round deals the ranks to
    those buckets, a heavy source's once per block, adds contributions up per
    block, and brings the partial sums to the targets' buckets.  This is the
    plan for every size; Spark broadcasts ranks by itself where they are small.
    """
    spark = nodes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    deg = materialize(out_degree(edges), "pr_degree")
    if heavy_degree is None:
        n_edges = deg.agg(F.sum("out_degree")).first()[0] or 0
        heavy_degree = max(1000, n_edges // parts)
    # no more blocks than edges / heavy_degree, besides one per heavy source
    blocks = materialize(deg.filter(F.col("out_degree") > heavy_degree).select("src", F.ceil(F.col("out_degree") / heavy_degree).cast("int").alias("blocks")), "pr_heavy")
    heavy = F.broadcast(blocks) if fits(blocks) else blocks
    salted = edges.join(deg, "src").join(heavy, "src", "left").select("src", F.pmod(F.hash("dst"), F.coalesce("blocks", F.lit(1))).alias("salt"), "dst", (1.0 / F.col("out_degree")).alias("w"))
    w_edges = materialize_bucketed(salted.repartition(parts, "src", "salt"), "pr_edges", ["src", "salt"], parts)
    # nodes carry their dangling flag, so the dangling mass is a plain sum
    flags = nodes.select("node").distinct().join(deg.select(F.col("src").alias("node"), F.lit(False).alias("d")), "node", "left").select("node", F.col("d").isNull().alias("dangling"))
    flagged = materialize_bucketed(flags.repartition(parts, "node"), "pr_nodes", "node", parts)
    n_df = materialize(flagged.agg(F.count(F.lit(1)).cast("double").alias("n")), "pr_count")
    rank = materialize(flagged.crossJoin(F.broadcast(n_df)).select("node", "dangling", (1.0 / F.col("n")).alias("pr")), "pr_rank")
    rounds = iterations if iterations is not None else max_iter
    cached: list[DataFrame] = []  # rounds kept between two written tables
    for i in range(rounds):
        dealt = rank.select(F.col("node").alias("src"), "pr").join(heavy, "src", "left").select("src", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)).alias("salt"), "pr")
        contrib = w_edges.join(dealt, ["src", "salt"]).groupBy(F.col("dst").alias("node")).agg(F.sum(F.col("pr") * F.col("w")).alias("c"))
        consts = n_df.crossJoin(rank.agg(F.coalesce(F.sum(F.when(F.col("dangling"), F.col("pr"))), F.lit(0.0)).alias("dm")))
        new = (
            flagged.join(contrib, "node", "left")
            .crossJoin(F.broadcast(consts))  # one row
            .select(
                "node",
                "dangling",
                (alpha * (F.coalesce(F.col("c"), F.lit(0.0)) + F.col("dm") / F.col("n")) + (1 - alpha) / F.col("n")).alias("pr"),
            )
        )
        if (i + 1) % checkpoint_every == 0 or i + 1 == rounds:
            new = materialize(new, "pr_rank")
            for c in cached:
                c.unpersist()
            cached = []
        else:
            # kept (recomputable) until the next written table cuts lineage
            new = new.persist()
            cached.append(new)
        if iterations is None:
            err = new.join(rank.select("node", F.col("pr").alias("old")), "node").agg(F.sum(F.abs(F.col("pr") - F.col("old")))).first()[0]
            n = n_df.first()[0]
            rank = new
            if err is not None and err < n * tol:
                return rank.select("node", F.col("pr").alias("pagerank"))
        else:
            rank = new
    if iterations is None and raise_on_no_convergence:
        raise RuntimeError(f"pagerank did not converge in {max_iter} iterations")
    return rank.select("node", F.col("pr").alias("pagerank"))


def attach_pagerank(records: DataFrame, ranks: DataFrame, key: str = "url") -> DataFrame:
    """Records with ``pagerank`` (0 when the URL has none)."""
    return records.join(ranks.withColumnRenamed("node", key), key, "left").withColumn(
        "pagerank", F.coalesce(F.col("pagerank"), F.lit(0.0))
    )
