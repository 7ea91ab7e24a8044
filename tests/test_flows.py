import os

from pyspark.sql import functions as F

from conftest import html_fixture
from quarry.operators.index import STANDARD, URL, Dictionary, build_index
from quarry.operators.links import SITE_LINK_PATTERN
from quarry.plans.offline import index_pages
from quarry.plans.online import answer, history_saves, route

NAMES = ["full", "bare", "no_title", "whitespace", "links", "divs"]


def test_offline_flow(spark, tmp_path):
    rows = [(i, f"http://news.example.cn/{n}/{i}.shtml", html_fixture(f"{n}.html")) for i, n in enumerate(NAMES)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = index_pages(spark, pages, str(tmp_path), link_pattern=SITE_LINK_PATTERN, suffixes=["-示例大学", "-综合新闻"], pagerank_rounds=5)
    recs = {r.url: r for r in out["records"].collect()}
    assert len(recs) == 5  # the untitled page is a reject
    assert out["rejects"].count() == 1 and os.path.exists(tmp_path / "rejects")
    assert abs(sum(r.pagerank for r in out["pagerank"].collect()) - 1.0) < 1e-9
    assert all(r.pagerank > 0 for r in recs.values())
    assert os.path.exists(tmp_path / "index" / "current")
    assert spark.read.json(str(tmp_path / "records_json")).count() == 5


def test_online_flow(spark):
    docs = spark.createDataFrame(
        [(1, "Red fox", "the quick brown fox", "http://a.example.com/x/1", ""),
         (2, "Blue dog", "the dog and the fox", "http://b.example.com/y/2", "")],
        "doc_id long, title string, content string, url string, editor string",
    )
    fields = {"title": STANDARD, "content": STANDARD, "url": URL, "editor": STANDARD}
    web = build_index(docs, fields)
    tp = build_index(docs, {**fields, "title": Dictionary(spark.createDataFrame([("fox",)], "word string"))})
    qs = spark.createDataFrame(
        [(1, "u1", "the fox"), (2, "u1", "a.example.com"), (3, "u2", "f?x"), (4, "u2", "   ")],
        "query_id long, username string, query string",
    )
    hist = spark.createDataFrame([("u1", "x", ["dog"])], "username string, college string, history array<string>")
    rows = answer(web, tp, qs, hist).collect()
    by_q = {}
    for r in rows:
        by_q.setdefault(r.query_id, []).append(r)
    assert set(by_q) == {1, 2, 3}
    # query 1 is multi-phrase: both docs hold "the" and "fox"; u1's history
    # "dog" lifts doc 2 to the top
    assert [r.doc_id for r in sorted(by_q[1], key=lambda r: r.rank)] == [2, 1]
    assert 'color: red' in [r for r in by_q[2]][0].url_html
    # an explicit type wins; an unknown one is an ordinary search
    asked = qs.withColumn("search_type", F.when(F.col("query_id") == 2, "no such type").when(F.col("query_id") == 1, "wildcard_search"))
    types = {r.query_id: r.search_type for r in route(web, tp, asked).collect()}
    assert types == {2: "simple_search", 3: "wildcard_search"}
    assert sorted((r.username, r.op, r.query) for r in history_saves(qs).collect()) == [("u1", "save", "a.example.com"), ("u1", "save", "the fox"), ("u2", "save", "f?x")]
