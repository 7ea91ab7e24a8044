"""Shared storage of a job: intermediate tables and binary files.

Everything goes under the folder of ``spark.checkpoint.dir``, which all
executors share.  Files are written under a name of their own for each task
attempt and become part of the result only through the manifest row that the
attempt returns, so a retried or speculative task leaves no wrong file in use.
"""

from __future__ import annotations

import uuid
from urllib.parse import urlparse

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from quarry.session import checkpoint_dir


#: Bytes of an Arrow batch between Spark and Python.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Spark's 64 MB batches are held several times over, by the JVM and by
    each Python worker; unless the session names a size, take smaller ones."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark._jsparkSession.sessionState().conf().contains(key):
        spark.conf.set(key, str(BATCH_BYTES))


def folder(spark: SparkSession, name: str) -> str:
    """A new shared folder's URI."""
    bounded_batches(spark)
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in a shared folder and read it back: computed
    once, lineage cut, no executor needs to stay alive for later stages."""
    path = folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI; a URI without scheme is local."""
    if not urlparse(uri).scheme:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def create(uri: str) -> pa.NativeFile:
    """Open a new file for writing, with its folder made."""
    fs, path = filesystem(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    return fs.open_output_stream(path, compression=None)


def opened(uri: str) -> pa.NativeFile:
    """Open a file for streaming reads."""
    fs, path = filesystem(uri)
    return fs.open_input_stream(path, compression=None)


def random_access(uri: str) -> pa.NativeFile:
    """Open a file for reads at any offset."""
    fs, path = filesystem(uri)
    return fs.open_input_file(path)
