"""File sources and sinks: HTML folders, the title-to-URL CSV, page records
as JSON / CSV, reject lists, create-if-absent tables and the JSON state maps
of users and histories.  All schemas are explicit; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

TITLE_URL_SCHEMA = "title string, url string"
RECORD_SCHEMA = (
    "url string, title string, source string, publish_time string, editor string, period string, "
    "readcount string, content string, links array<string>, pagerank double"
)
USER_SCHEMA = "map<string, struct<username:string, college:string, major:string>>"
HISTORY_LINE = "username string, college string, major string, history array<string>"
HISTORY_SCHEMA = "map<string, struct<username:string, college:string, major:string, history:array<string>>>"


def scan_html_dir(spark: SparkSession, path: str) -> DataFrame:
    """``(file, html)``: one row per file of a folder of saved pages."""
    df = spark.read.option("wholetext", True).text(path)
    return df.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("html"))


def read_title_url(spark: SparkSession, path: str) -> DataFrame:
    """The crawl's title-to-URL CSV (header ``title,url``)."""
    return spark.read.schema(TITLE_URL_SCHEMA).option("header", True).csv(path)


def write_title_url(df: DataFrame, path: str) -> None:
    df.select("title", "url").write.mode("overwrite").option("header", True).csv(path)


def write_records_json(df: DataFrame, path: str) -> None:
    """Page records as JSON lines, UTF-8 kept (no escaping of non-ASCII);
    the publish time as ``yyyy-MM-dd'T'HH:mm:ss`` text or null."""
    out = df.withColumn("publish_time", F.date_format("publish_time", "yyyy-MM-dd'T'HH:mm:ss"))
    out.write.mode("overwrite").json(path)


def read_records_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Records from JSON lines, or from one JSON array per file
    (``multi_line=True``), with the publish time parsed back."""
    df = spark.read.schema(RECORD_SCHEMA).option("multiLine", multi_line).json(path)
    return df.withColumn("publish_time", F.try_to_timestamp("publish_time", F.lit("yyyy-MM-dd'T'HH:mm:ss")).cast("timestamp_ntz"))


def write_records_csv(df: DataFrame, path: str) -> None:
    """Records as CSV with a header; the link list is written as JSON text."""
    out = df.withColumn("links", F.to_json("links")).withColumn("publish_time", F.date_format("publish_time", "yyyy-MM-dd HH:mm"))
    out.write.mode("overwrite").option("header", True).csv(path)


def write_rejects(df: DataFrame, path: str) -> bool:
    """Write the reject list only when it has rows; returns whether it did."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").option("header", True).csv(path)
    return True


def create_if_absent(df: DataFrame, path: str) -> None:
    """Create a table at ``path`` only when none exists there."""
    df.write.mode("ignore").parquet(path)


def read_state_map(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON object map ``{key: record}``; a missing, empty or
    broken file yields no rows (the original treats all three as ``{}``)."""
    try:
        raw = spark.read.option("wholetext", True).text(path)
    except AnalysisException:
        return spark.createDataFrame([], f"key string, value {schema[len('map<string, '):-1]}")
    m = raw.select(F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("m"))
    return m.select(F.explode("m")).select("key", "value").filter("value is not null")


def read_users(spark: SparkSession, path: str) -> DataFrame:
    """``(username, college, major)``; the password field is never read."""
    s = read_state_map(spark, path, USER_SCHEMA)
    return s.select(F.coalesce("value.username", "key").alias("username"), "value.college", "value.major")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """``(username, college, major, history)`` from either form: one JSON
    object per line (what ``write_history`` writes) or one map of all users
    (import of a small state file; a whole file is one row)."""
    s = read_state_map(spark, path, HISTORY_SCHEMA)
    whole = s.select(F.coalesce("value.username", "key").alias("username"), "value.college", "value.major", "value.history")
    out = whole
    if path_exists(spark, path):
        lines = spark.read.text(path).select(F.from_json("value", HISTORY_LINE, {"mode": "PERMISSIVE"}).alias("v"))
        out = whole.unionByName(lines.filter("v.username is not null").select("v.*"))
    return out.withColumn("history", F.coalesce("history", F.array().cast("array<string>")))


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException:
        return False
    return True


def write_history(df: DataFrame, path: str) -> None:
    """History state as JSON lines, one user per line (a single JSON object
    for all users would need one writer)."""
    df.select("username", "college", "major", "history").write.mode("overwrite").json(path)
