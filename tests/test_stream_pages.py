import tempfile

from pyspark.sql import functions as F

from conftest import html_fixture
from quarry.operators import history as H
from quarry.operators.pages import extract_pages
from quarry.streaming.pages import current_docs, upsert_pages_stream

NAMES = ["full", "bare", "whitespace", "links", "divs"]


def test_page_stream_equals_batch(spark):
    # five pages on three URLs; later pages overwrite earlier ones
    rows = [(i, f"http://news.example.cn/{i % 3}.shtml", html_fixture(f"{n}.html")) for i, n in enumerate(NAMES)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    batch = extract_pages(pages).withColumn("seq", F.col("page_id"))
    want = {r.url: (r.page_id, r.title) for r in H.upsert_latest(batch.limit(0), batch, "url").collect()}

    d = tempfile.mkdtemp(prefix="quarry-pages-")
    for i in range(len(rows)):
        pages.filter(F.col("page_id") == i).coalesce(1).write.parquet(f"{d}/in/p={i}")
    src = spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 2).parquet(f"{d}/in/p=*")
    q = upsert_pages_stream(src, f"{d}/log", f"{d}/ckpt")
    q.awaitTermination(300)
    got = {r.url: (r.page_id, r.title) for r in current_docs(spark, f"{d}/log").collect()}
    assert got == want
