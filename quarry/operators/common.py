"""Shared plan helpers: checked broadcast, per-key top-k, score rounding."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Row bound under which a request-side table (queries, query terms, hits of a
# query batch) is broadcast.  Beyond it the join stays a shuffle join and
# adaptive execution decides at run time.
BROADCAST_ROW_LIMIT = 2_000_000
BROADCAST_BYTE_LIMIT = 256 << 20

SCORE_DECIMALS = 4

# Files that a task has open while it writes buckets (beyond, it sorts).
OPEN_FILES = 8


def bounded_broadcast(df: DataFrame, probe: DataFrame | None = None, max_rows: int = BROADCAST_ROW_LIMIT, max_bytes: int = BROADCAST_BYTE_LIMIT) -> DataFrame:
    """Broadcast ``df`` only when rows and bytes prove it small.

    ``probe`` is a cheap table that bounds ``df`` (for example the analysed
    query terms bound the query terms joined to unique term statistics); it
    defaults to ``df``.  Its rows are measured as text, so long values count;
    the scan stops at ``max_rows + 1``.
    """
    src = df if probe is None else probe
    width = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in src.columns])))
    n, size = src.select(width.alias("w")).limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum("w"), F.lit(0))).first()
    return F.broadcast(df) if n <= max_rows and size <= max_bytes else df


def round_score(c: Column) -> Column:
    return F.round(c, SCORE_DECIMALS)


def rank_within(df: DataFrame, key: str | list[str], k: int | None, score: str = "score", tie: str = "doc_id") -> DataFrame:
    """Add ``rank`` = 1.. per key by ``score`` desc, ``tie`` asc; keep ``rank <= k``.

    The filter on ``row_number`` lets Spark insert a partial window group
    limit before the shuffle, so a hot key ships at most ``k`` rows per map
    task instead of all of its hits.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(tie))
    out = df.withColumn("rank", F.row_number().over(w))
    if k is not None:
        out = out.filter(F.col("rank") <= k)
    return out


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a Parquet table under the session's shared
    checkpoint folder and read it back.

    Used where one plan would otherwise recompute an expensive input several
    times (the page job, the postings) or where lineage must be cut (rounds
    of an iteration).  Unlike ``checkpoint()`` the result is columnar, so
    later scans prune columns and push filters, and it is computed once.
    """
    import uuid

    from quarry.session import checkpoint_dir

    base = checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize_bucketed(df: DataFrame, name: str, key: str | list[str], buckets: int, partition_by: list[str] | None = None) -> DataFrame:
    """Like ``materialize``, dealt into ``buckets`` by ``key``: a scan gives
    all rows of a key to one task, so grouping by it (and more columns) and
    joining on it need no exchange.  ``df`` should come hash-partitioned by
    ``key`` into as many partitions: one file per bucket is written then, and
    a task keeps the files of its few buckets and partitions open instead of
    sorting its rows by file first."""
    import uuid

    from quarry.session import checkpoint_dir

    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{table}"
    keys = [key] if isinstance(key, str) else key
    writer = df.write.format("parquet").bucketBy(buckets, *keys).option("path", path)
    with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES)):
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)
    return spark.table(table)


@contextmanager
def setting(spark, key: str, value: str) -> Iterator[None]:
    """A session setting for the time of one action."""
    before = spark.conf.get(key, None) if spark._jsparkSession.sessionState().conf().contains(key) else None
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shard_of(key: str, buckets: int) -> Column:
    """The bucket of ``key`` in ``materialize_bucketed``."""
    return F.pmod(F.hash(key), F.lit(buckets))


def fits(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT, max_bytes: int = BROADCAST_BYTE_LIMIT) -> bool:
    """Whether a written table is within the broadcast bounds."""
    width = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    n, size = df.select(width.alias("w")).limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum("w"), F.lit(0))).first()
    return n <= max_rows and size <= max_bytes


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library: nothing to ask for
    _trim = None


def give_back() -> None:
    """Return a Python worker's freed memory to the system: workers of an
    executor, waiting ones too, live beside its JVM."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def small_batches(spark) -> None:
    """Arrow batches of 2 MB, unless the session sets a size: Python then holds
    so much of a task's rows at a time, whatever the input's size."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark._jsparkSession.sessionState().conf().contains(key):
        spark.conf.set(key, str(2 << 20))


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition when the input has fewer partitions than the
    cluster has task slots (one big file or row group would otherwise run the
    CPU-heavy text work in one task).  On a large multi-file input this is a
    no-op, so no shuffle is added at scale."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df
