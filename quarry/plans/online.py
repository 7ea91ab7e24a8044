"""Online flow: a table of search-box inputs to rendered, personalised hits.

``answer`` = classify (or take the type asked for) -> route each query to its
search type -> re-rank by the user's history and college -> highlight what is
shown -> render.  ``history_saves`` gives the events for the history state.
Blank inputs are dropped; a user without a history record keeps the search
order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.classify import classify_queries
from quarry.operators import highlight as HL
from quarry.operators import personal as PR
from quarry.operators import search as S
from quarry.operators.common import materialize
from quarry.operators.history import SAVE
from quarry.operators.index import SearchIndex

SHOWN_FIELDS = {
    "site_search": ["url"],
    "multi_phrase_search": ["content"],
    "one_phrase_search": ["title", "content", "editor"],
    "wildcard_search": ["title", "content", "editor", "url"],
    "simple_search": ["title", "content", "url", "editor"],
}


def typed_queries(queries: DataFrame) -> DataFrame:
    """Queries with ``search_type``: the one asked for where the table has
    such a column and it isn't null, else the classifier's; a type that no
    operator has is an ordinary search.  Blank queries are dropped."""
    if "search_type" not in queries.columns:
        return classify_queries(queries)
    asked = classify_queries(queries.withColumnRenamed("search_type", "asked"))
    known = F.when(F.col("asked").isin(list(SHOWN_FIELDS)), F.col("asked")).otherwise(F.lit("simple_search"))
    return asked.withColumn("search_type", F.when(F.col("asked").isNotNull(), known).otherwise(F.col("search_type"))).drop("asked")


def route(web: SearchIndex, tp: SearchIndex, queries: DataFrame) -> DataFrame:
    """``(query_id, doc_id, score, rank, search_type)``: each query runs the
    operator of its type over its share of the table."""
    c = typed_queries(queries)

    def of(kind: str) -> DataFrame:
        return c.filter(F.col("search_type") == kind)

    parts = {
        "site_search": S.site_search(web, of("site_search"), k=1000),
        "multi_phrase_search": S.multi_phrase_search(web, of("multi_phrase_search"), "content", k=10),
        "one_phrase_search": S.one_phrase_search(web, of("one_phrase_search"), k=1000),
        "wildcard_search": S.wildcard_search(tp, of("wildcard_search"), k=10),
    }
    if "search_type" in queries.columns:  # the classifier alone never asks for it
        parts["simple_search"] = S.simple_search(web, of("simple_search"), k=10)
    out = None
    for t, p in parts.items():
        p = p.withColumn("search_type", F.lit(t))
        out = p if out is None else out.unionByName(p)
    return out


def history_saves(queries: DataFrame) -> DataFrame:
    """The history events that searching emits: ``(username, op, query,
    query_id)``, one save for every input that isn't blank."""
    return typed_queries(queries).select("username", F.lit(SAVE).alias("op"), "query", "query_id")


def answer(web: SearchIndex, tp: SearchIndex, queries: DataFrame, history: DataFrame) -> DataFrame:
    """Rendered rows ``(query_id, username, rank, doc_id, title_html,
    content_html, editor_html, url_html)`` in personalised order.

    ``queries (query_id, username, query[, search_type])``; ``history
    (username, college, history)``.  The hits are written once; they are
    re-ranked first, and only documents that are shown get highlighted.
    """
    hits = materialize(route(web, tp, queries), "routed_hits")
    types = hits.select("query_id", "search_type").distinct()
    shown = materialize(PR.personal_rerank(hits, web.docs, queries, history).select("query_id", "doc_id", "rank").join(types, "query_id"), "shown")
    marked = None
    for t, fields in SHOWN_FIELDS.items():
        index = tp if t == "wildcard_search" else web
        h = shown.filter(F.col("search_type") == t)
        q = queries.join(h.select("query_id").distinct(), "query_id", "left_semi")
        if t == "wildcard_search":
            m = HL.highlight(index, h, q, fields, words=False, patterns=q)
        elif t == "site_search":
            pats = q.select("query_id", F.concat(F.lit("*"), F.col("query"), F.lit("*")).alias("query"))
            m = HL.highlight(index, h, q, fields, words=False, patterns=pats)
        elif t == "multi_phrase_search":
            m = HL.highlight(index, h, q, fields, words=False, phrases=S.split_phrases(q).withColumnRenamed("phrase", "query"))
        elif t == "one_phrase_search":
            m = HL.highlight(index, h, q, fields, phrases=q.withColumn("phrase_no", F.lit(0)))
        else:
            m = HL.highlight(index, h, q, fields)
        marked = m if marked is None else marked.unionByName(m)
    rendered = HL.render_hits(shown, web.docs, marked)
    return rendered.join(queries.select("query_id", "username"), "query_id").select(
        "query_id", "username", "rank", "doc_id", "title_html", "content_html", "editor_html", "url_html"
    )
