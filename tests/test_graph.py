import pytest

from quarry.operators.graph import attach_pagerank, link_edges, link_nodes, pagerank


def reference_pagerank(edges, nodes, alpha=0.85, rounds=None, tol=1e-6, max_iter=100):
    """Plain power iteration (uniform teleport, dangling mass spread)."""
    n = len(nodes)
    out = {u: [] for u in nodes}
    for s, d in edges:
        out[s].append(d)
    x = {u: 1.0 / n for u in nodes}
    for it in range(rounds or max_iter):
        dm = sum(x[u] for u in nodes if not out[u])
        nx = {u: (1 - alpha) / n + alpha * dm / n for u in nodes}
        for u in nodes:
            for v in out[u]:
                nx[v] += alpha * x[u] / len(out[u])
        err = sum(abs(nx[u] - x[u]) for u in nodes)
        x = nx
        if rounds is None and err < n * tol:
            return x
    return x


def cycle(spark):
    # four pages in a cycle, page 1 also links a dangling target and itself
    recs = spark.createDataFrame(
        [("p1", ["p2", "d", "p1"]), ("p2", ["p3"]), ("p3", ["p4"]), ("p4", ["p1", "p1"])], "url string, links array<string>"
    )
    return recs, link_edges(recs)


def test_edges_and_nodes(spark):
    recs, e = cycle(spark)
    assert sorted(tuple(r) for r in e.collect()) == sorted(
        [("p1", "p2"), ("p1", "d"), ("p1", "p1"), ("p2", "p3"), ("p3", "p4"), ("p4", "p1")])
    assert sorted(r.node for r in link_nodes(recs, e).collect()) == ["d", "p1", "p2", "p3", "p4"]


@pytest.mark.parametrize("rounds", [1, 10])
def test_fixed_rounds(spark, rounds):
    recs, e = cycle(spark)
    edges = [tuple(r) for r in e.collect()]
    nodes = ["d", "p1", "p2", "p3", "p4"]
    want = reference_pagerank(edges, nodes, rounds=rounds)
    got = {r.node: r.pagerank for r in pagerank(e, link_nodes(recs, e), iterations=rounds, checkpoint_every=3).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)
    assert abs(sum(got.values()) - 1.0) < 1e-12


def test_converges_with_tolerance(spark):
    recs, e = cycle(spark)
    edges = [tuple(r) for r in e.collect()]
    want = reference_pagerank(edges, ["d", "p1", "p2", "p3", "p4"], tol=1e-4)
    got = {r.node: r.pagerank for r in pagerank(e, link_nodes(recs, e), tol=1e-4, checkpoint_every=5).collect()}
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_attach_defaults_to_zero(spark):
    recs = spark.createDataFrame([("p1",), ("zz",)], "url string")
    ranks = spark.createDataFrame([("p1", 0.5)], "node string, pagerank double")
    assert {r.url: r.pagerank for r in attach_pagerank(recs, ranks).collect()} == {"p1": 0.5, "zz": 0.0}


def test_heavy_sources_split(spark):
    # a hub links to every other node; with heavy_degree=2 its edges lie in
    # blocks by target; the result is the same
    edges = [("hub", f"n{i}") for i in range(6)] + [("n0", "n1"), ("n1", "hub"), ("n2", "n3")]
    e = spark.createDataFrame(edges, "src string, dst string")
    nodes = spark.createDataFrame([(x,) for x in {a for ab in edges for a in ab}], "node string")
    want = reference_pagerank(edges, sorted({a for ab in edges for a in ab}), rounds=5)
    got = {r.node: r.pagerank for r in pagerank(e, nodes, iterations=5, heavy_degree=2).collect()}
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_edges_stay_in_their_buckets(spark):
    # whatever the size: with no broadcast by Spark the written edges are read without an exchange
    recs, e = cycle(spark)
    edges = [tuple(r) for r in e.collect()]
    want = reference_pagerank(edges, ["d", "p1", "p2", "p3", "p4"], rounds=4)
    adaptive, limit = (spark.conf.get(f"spark.sql.{k}") for k in ("adaptive.enabled", "autoBroadcastJoinThreshold"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ranks = pagerank(e, link_nodes(recs, e), iterations=4, checkpoint_every=2, heavy_degree=1)
        got = {r.node: r.pagerank for r in ranks.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)
    assert spark.conf.get("spark.sql.adaptive.enabled") == adaptive
