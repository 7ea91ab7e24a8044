from urllib.parse import urljoin

from pyspark.sql import functions as F

from quarry.operators.links import link_text_map, resolve_url

BASES = ["http://a.example.com/b/c/d.html?q=1#f", "https://a.example.com/", "http://a.example.com"]
HREFS = ["/x", "y/z", "../up", "./same", "../../../../too/far", "?k=v", "#frag", "//cdn.example.com/s.js",
         "http://other.example.org/p", "mailto:x@example.com", "", "a//b/./c/..", "/p/./q/../r", "..", "."]


def test_resolve_matches_urljoin(spark):
    rows = [(b, h) for b in BASES for h in HREFS]
    df = spark.createDataFrame(rows, "base string, href string")
    got = df.select("base", "href", resolve_url(F.col("base"), F.col("href")).alias("t")).collect()
    bad = [(r.base, r.href, r.t, urljoin(r.base, r.href)) for r in got if r.t != urljoin(r.base, r.href)]
    assert bad == []


def test_link_text_last_wins(spark):
    df = spark.createDataFrame([(1, 0, "u", "first"), (1, 1, "u", "second"), (2, 0, "v", "x")],
                               "page_id long, pos int, target string, text string")
    assert {r.target: r.text for r in link_text_map(df).collect()} == {"u": "second", "v": "x"}
