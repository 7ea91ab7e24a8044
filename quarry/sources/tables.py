"""Readers for the driver tables and the corpora derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def fingerprint(spark: SparkSession, sf_dir: str, names: list[str]):
    """(path, size, modification time) of every file of the input tables, by
    the file system that Spark reads them from; a rewritten file changes it."""
    out = []
    for n in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{n}.parquet")
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(path, True)
        while files.hasNext():
            f = files.next()
            out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` index: content = whole text, title = its first line
    (the table has no title column), no URL."""
    from quarry.operators.common import spread

    d = spread(table(spark, sf_dir, "documents"))
    return d.select(
        "doc_id",
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("content"),
        F.lit(None).cast("string").alias("url"),
        "lang",
        "source",
    )


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query table ``(query_id, query)``: every benchmark passage, whole."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def conversation_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search log ``(query_id, username, seq, query)``: every user turn of
    every conversation; the conversation is the user."""
    c = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    return c.select(
        (F.col("conv_id") * 100000 + F.col("turn")).alias("query_id"),
        F.col("conv_id").cast("string").alias("username"),
        F.col("turn").alias("seq"),
        F.col("text").alias("query"),
    )


def pages(spark: SparkSession, sf_dir: str, spread_out: bool = False) -> DataFrame:
    """``(page_id, url, html)``; ``spread_out`` spreads a few big input
    splits over all task slots before the page job."""
    p = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    if spread_out:
        from quarry.operators.common import spread

        p = spread(p)
    return p


def web_records(spark: SparkSession, sf_dir: str, link_pattern: str | None = None) -> DataFrame:
    """Page records of every page; the URL is the page's own crawl URL."""
    from quarry.operators.pages import extract_pages

    return extract_pages(pages(spark, sf_dir, spread_out=True), link_pattern=link_pattern)


def web_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The multi-field corpus: one document per page (doc_id = page_id),
    materialised once so the page job runs once per build."""
    from quarry.operators.common import materialize

    r = web_records(spark, sf_dir)
    return materialize(
        r.select(F.col("page_id").alias("doc_id"), "url", "title", "source", "publish_time", "editor", "content", "links"),
        "web_docs",
    )
