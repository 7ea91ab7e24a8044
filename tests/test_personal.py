from quarry.operators import personal as PR

HISTORY = [("ann", "计算机", ["news.example.cn", "东方 历史", "志愿者"]), ("bob", "外国语学院", ["志愿者"]),
           ("cy", "计算机", ["志愿", "劳动", "志愿者"])]


def history(spark):
    return spark.createDataFrame(HISTORY, "username string, college string, history array<string>")


def test_rerank(spark):
    docs = spark.createDataFrame(
        [(1, "plain", "nothing"), (2, "计算机 news", "志愿者 活动"), (3, "志愿者", "x"), (4, "a", "b")],
        "doc_id long, title string, content string",
    )
    hits = spark.createDataFrame([(10, 1, 1), (10, 2, 2), (10, 3, 3), (20, 4, 1), (20, 3, 2)], "query_id long, doc_id long, rank int")
    qs = spark.createDataFrame([(10, "ann"), (20, "nobody")], "query_id long, username string")
    got = {(r.query_id, r.doc_id): (r.personal, r.rank) for r in PR.personal_rerank(hits, docs, qs, history(spark)).collect()}
    # doc 2: "志愿者" in content (+5), college in title (+2); doc 3: "志愿者" in title (+1)
    assert got[(10, 2)] == (7.0, 1) and got[(10, 3)] == (1.0, 2) and got[(10, 1)] == (0.0, 3)
    # a user without a record keeps the search order
    assert got[(20, 4)] == (0.0, 1) and got[(20, 3)] == (0.0, 2)


def test_suggestions(spark):
    typed = spark.createDataFrame([(1, "cy", "志愿"), (2, "ann", "NEWS"), (3, "bob", "劳"), (4, "ghost", "志")],
                                  "request_id long, username string, typed string")
    cands = spark.createDataFrame([("志愿者", (1, "志愿者")), ("志愿服务", (2, "志愿服务")), ("劳动节", (3, "劳动节"))],
                                  "candidate string, cand_order struct<a:int,b:string>")
    hs = {(r.request_id, r.suggestion) for r in PR.history_suggestions(typed, history(spark)).collect()}
    assert hs == {(1, "志愿"), (1, "志愿者"), (2, "news.example.cn")}
    sc = {(r.request_id, r.pos): (r.suggestion, r.score) for r in PR.similarity_suggestions(typed, history(spark), cands).collect()}
    # 志愿者 vs {志愿, 志愿者}: 1/2 + 1; 志愿服务 vs {志愿, 志愿者}: 1/3 + 1/3
    assert sc[(1, 0)] == ("志愿者", 1.5)
    assert sc[(1, 1)] == ("志愿服务", round(2 / 3, 6))
    assert sc[(3, 0)] == ("劳动节", 0.0)  # no prefix-matching history: score 0
    both = PR.suggest(typed, history(spark), cands).filter("request_id = 1").orderBy("part", "pos").collect()
    assert [r.suggestion for r in both] == ["志愿", "志愿者", "志愿者", "志愿服务"]
