"""Incremental page indexing: a stream of pages upserted by URL.

Each micro-batch turns its pages into records and appends them to a record
log partitioned by batch id (overwrite of that one partition, so a retried
batch replaces its own output: exactly-once).  The current documents are the
newest record per URL over the log (``current_docs``), the same rule as the
batch ``upsert_docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.history import upsert_latest
from quarry.operators.pages import extract_pages


def _writer(log_path: str, suffixes, link_pattern):
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        recs = extract_pages(batch, suffixes, link_pattern).withColumn("batch_id", F.lit(batch_id).cast("long"))
        (
            recs.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(log_path)
        )

    return write_batch


def upsert_pages_stream(pages: DataFrame, log_path: str, checkpoint: str, suffixes=(), link_pattern=None,
                        trigger: dict | None = None):
    """Start the stream; returns the ``StreamingQuery``."""
    w = pages.writeStream.foreachBatch(_writer(log_path, suffixes, link_pattern)).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def current_docs(spark: SparkSession, log_path: str) -> DataFrame:
    """Newest record per URL over the record log (later batch, then later
    page id wins)."""
    log = spark.read.parquet(log_path).withColumn("seq", F.struct("batch_id", "page_id"))
    return upsert_latest(log.limit(0), log, "url").drop("seq")
