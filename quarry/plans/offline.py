"""Offline flow: pages to records, link graph, PageRank and the index.

``index_pages`` chains the operators the way the original scripts hand
files to each other, but as one Spark job graph with written tables at the
hand-over points:

pages -> page job -> records (title map join, rejects) -> edges -> PageRank
-> records with rank -> upsert by URL -> index tables.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import graph as G
from quarry.operators import pages as P
from quarry.operators.common import materialize
from quarry.operators.history import upsert_latest
from quarry.operators.index import STANDARD, URL, build_index, write_index
from quarry.sources import files as IO

WEB_FIELDS = {"title": STANDARD, "content": STANDARD, "url": URL, "editor": STANDARD, "source": STANDARD}


def index_pages(
    spark: SparkSession,
    pages: DataFrame,
    out_dir: str,
    link_pattern: str | None,
    title_map: DataFrame | None = None,
    suffixes: Iterable[str] = (),
    pagerank_rounds: int | None = None,
) -> dict[str, DataFrame]:
    """Run the offline flow over ``pages (page_id, url, html)``.

    ``link_pattern``: regular expression of the links that count as edges; it
    belongs to the crawled site, so there is no default (None: every link).

    ``title_map (title_key, url)`` is the crawl's title-to-URL map; without
    one it is built from the pages (last crawl per title wins).  Writes
    records (JSON lines and CSV), rejects (only when there are any) and the
    index under ``out_dir``; returns the main tables.
    """
    parsed = materialize(P.parse_pages(pages), "parsed_pages")
    titles = parsed.select("page_id", "url", F.coalesce("title", F.lit("")).alias("raw_title"))
    tmap = title_map if title_map is not None else P.title_url_map(titles)
    records = P.join_title_url(P.to_records(parsed, suffixes, link_pattern), tmap)
    rejects = P.missing_titles(titles, tmap)

    edges = G.link_edges(records)
    nodes = G.link_nodes(records, edges)
    ranks = G.pagerank(edges, nodes, iterations=pagerank_rounds)
    ranked = G.attach_pagerank(records, ranks)
    # the index keeps the newest record per URL (later page wins)
    keyed = ranked.withColumn("seq", F.col("page_id"))
    docs = upsert_latest(keyed.limit(0), keyed, "url").drop("seq")
    docs = materialize(docs.withColumnRenamed("page_id", "doc_id"), "docs")

    out = docs.select("url", "title", "source", "publish_time", "editor", "period", "readcount", "content", "links", "pagerank")
    IO.write_records_json(out, f"{out_dir}/records_json")
    IO.write_records_csv(out, f"{out_dir}/records_csv")
    IO.write_rejects(rejects, f"{out_dir}/rejects")
    index = build_index(docs, WEB_FIELDS)
    write_index(index, f"{out_dir}/index")
    return {"records": docs, "rejects": rejects, "pagerank": ranks, "index": index}
