import datetime

from pyspark.sql import functions as F

from conftest import html_fixture
from quarry.operators import pages as P
from quarry.operators.links import SITE_LINK_PATTERN

SUFFIXES = ["-示例大学", "-综合新闻"]
NAMES = ["full", "bare", "no_title", "whitespace", "editor_in_body", "divs", "unclosed_p", "links"]


def pages_df(spark):
    rows = [(i, f"http://news.example.cn/{n}.shtml", html_fixture(f"{n}.html")) for i, n in enumerate(NAMES)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def records(spark):
    recs = P.extract_pages(pages_df(spark), SUFFIXES, SITE_LINK_PATTERN).collect()
    return {NAMES[r.page_id]: r for r in recs}


def test_full_record(spark):
    r = records(spark)["full"]
    assert r.title == "校园新闻 标题"
    assert r.source == "新闻中心"
    assert r.publish_time == datetime.datetime(2024, 1, 2, 3, 4)
    assert r.period == "第123期"
    assert r.readcount == "123"
    assert r.editor == "张三"
    assert r.content == "第一段。第二段&内容"
    assert r.links == ["http://news.example.cn/a/2024/01/123.shtml"]


def test_bare_and_missing(spark):
    recs = records(spark)
    b = recs["bare"]
    assert (b.source, b.editor, b.period, b.readcount, b.publish_time) == ("", "", "", "", None)
    assert b.content == "Only text."
    assert recs["no_title"].raw_title == ""


def test_whitespace_rules(spark):
    assert records(spark)["whitespace"].content == "a bcde"


def test_editor_in_body(spark):
    r = records(spark)["editor_in_body"]
    assert r.editor == "责任李四"
    assert r.content == ""


def test_divs(spark):
    p = P.parse_html(html_fixture("divs.html"))
    assert p["blocks"] == ["para", "inner boldnested tail", "first content"]


def test_unclosed_paragraphs(spark):
    p = P.parse_html(html_fixture("unclosed_p.html"))
    assert p["blocks"] == ["one", "two", "three", "four"]


def test_link_filter(spark):
    assert records(spark)["links"].links == ["http://news.example.cn/x/2024/1.shtml", "http://news.example.cn/x/2024/1.shtml"]


def test_title_map_and_rejects(spark):
    pt = spark.createDataFrame(
        [(1, "u1", "A:B"), (2, "u2", "A:B"), (3, "u3", "C"), (4, "u4", "")], "page_id long, url string, raw_title string"
    )
    m = {r.title_key: r.url for r in P.title_url_map(pt).collect()}
    assert m == {"A_B": "u2", "C": "u3"}
    rej = P.missing_titles(pt, P.title_url_map(pt.filter("page_id <> 3"))).collect()
    assert sorted(r.title for r in rej) == ["", "C"]


def test_clean_titles(spark):
    pt = spark.createDataFrame(
        [(1, "x", "News-示例大学"), (2, "x", "News"), (3, "x", "Other-综合新闻 "), (4, "x", "Other")],
        "page_id long, url string, raw_title string",
    )
    got = {r.page_id: (r.new_name, r.action) for r in P.clean_titles(pt, SUFFIXES).collect()}
    assert got == {1: ("News", "collision"), 2: ("News", "unchanged"), 3: ("Other", "collision"), 4: ("Other", "unchanged")}


def test_snapshot(spark):
    pages = spark.createDataFrame([(1, "u", "<html>a</html>"), (2, "v", "<html>b</html>")], "page_id long, url string, html string")
    pt = spark.createDataFrame([(1, "u", "A B?"), (2, "v", "C")], "page_id long, url string, raw_title string")
    req = spark.createDataFrame([(10, "AB?"), (11, "zzz")], "request_id long, title string")
    got = {r.request_id: (r.status, r.snapshot) for r in P.snapshot_lookup(req, pt, pages).collect()}
    assert got == {10: ("ok", "<html>a</html>"), 11: ("not found", None)}
