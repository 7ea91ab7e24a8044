"""Session helpers: a tuned local session for tests/bench and the shared
checkpoint folder used to cut lineage in iterative jobs."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def get_spark(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "quarry") -> SparkSession:
    """Local session for tests and the benchmark.

    On a cluster the session comes from the launcher; none of the library
    code depends on these settings except that adaptive execution is assumed
    on (runtime broadcast conversion, partition coalescing, skew splits).
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    from quarry.ship import ensure_on_executors

    ensure_on_executors(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only a local session without one gets
    a temporary folder; with executors on other machines that would silently
    lose rows, so there an unset folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors share (master {sc.master})")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-", dir=os.environ.get("QUARRY_LOCAL_TMP", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
