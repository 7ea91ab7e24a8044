"""Personalised re-rank and query suggestions.

Re-rank: for each hit of a user's query, ``+1`` per history item contained
in the title and ``+5`` per item contained in the content (case-folded),
``+2`` when the user's college is in the title; a stable sort by that score
keeps the search order for ties; the first 10 are kept.  Users without a
history record keep the search order untouched (and are not cut to 10).

Suggestions: the user's history items starting with the typed text (in
history order), then every candidate query starting with the typed text,
scored by the sum over those history items of ``1 / (1 + levenshtein)``
and sorted by score (stable on the candidate order).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.common import bounded_broadcast, fits, materialize

# --- fixed values ----------------------------------------------------------
TITLE_HIT = 1
CONTENT_HIT = 5
COLLEGE_HIT = 2
RERANK_KEEP = 10
# ---------------------------------------------------------------------------


def personal_rerank(hits: DataFrame, docs: DataFrame, queries: DataFrame, history: DataFrame,
                    keep: int = RERANK_KEEP, pagerank_weight: float = 0.0) -> DataFrame:
    """``(query_id, username, doc_id, search_rank, personal, rank)``.

    ``hits`` ``(query_id, doc_id, rank)``; ``queries`` ``(query_id,
    username)``; ``history`` ``(username, college, history)``; ``docs``
    ``(doc_id, title, content[, pagerank])``.  The history array holds at
    most 10 items, so the per-hit score is a fold over a bounded array, not a
    join that multiplies rows.
    """
    h = hits.select("query_id", "doc_id", F.col("rank").alias("search_rank"))
    q = queries.select("query_id", "username")
    hist = history.select("username", F.lower(F.coalesce("college", F.lit(""))).alias("college"),
                          F.transform(F.coalesce("history", F.array()), lambda x: F.lower(x)).alias("hl"))
    cols = ["doc_id", F.lower(F.coalesce("title", F.lit(""))).alias("lt"), F.lower(F.coalesce("content", F.lit(""))).alias("lc")]
    if pagerank_weight:
        cols.append(F.coalesce("pagerank", F.lit(0.0)).alias("pr"))
    d = docs.select(*cols)
    hq = materialize(h.join(bounded_broadcast(q), "query_id"), "personal_hits")  # the search runs once
    shown = materialize(hq.select("doc_id").distinct(), "shown_docs")
    d = d.join(F.broadcast(shown) if fits(shown) else shown, "doc_id", "left_semi")
    j = hq.join(hist, "username", "left").join(d, "doc_id")
    score = F.aggregate(
        "hl",
        F.lit(0).cast("bigint"),
        lambda acc, t: acc
        + F.when(F.col("lt").contains(t), TITLE_HIT).otherwise(0)
        + F.when(F.col("lc").contains(t), CONTENT_HIT).otherwise(0),
    ) + F.when((F.col("college") != "") & F.col("lt").contains(F.col("college")), COLLEGE_HIT).otherwise(0)
    personal = score.cast("double")
    if pagerank_weight:
        personal = personal + F.lit(pagerank_weight) * F.col("pr")
    j = j.withColumn("has_profile", F.col("hl").isNotNull()).withColumn(
        "personal", F.when(F.col("has_profile"), personal).otherwise(F.lit(0.0))
    )
    w = Window.partitionBy("query_id").orderBy(F.desc("personal"), F.asc("search_rank"))
    out = j.withColumn("rank", F.row_number().over(w))
    out = out.filter(~F.col("has_profile") | (F.col("rank") <= keep))
    return out.select("query_id", "username", "doc_id", "search_rank", "personal", "rank")


def history_suggestions(typed: DataFrame, history: DataFrame) -> DataFrame:
    """``(request_id, pos, suggestion)``: history items starting with the
    typed text (case-folded), in history order.  No record: none."""
    j = typed.filter(F.coalesce(F.col("typed"), F.lit("")) != "").join(history.select("username", "history"), "username")
    return j.select("request_id", "typed", F.posexplode("history").alias("hpos", "item")).filter(
        F.lower("item").startswith(F.lower("typed"))
    ).select("request_id", F.col("hpos").alias("pos"), F.col("item").alias("suggestion"))


def candidate_prefixes(candidates: DataFrame) -> DataFrame:
    """``(prefix, candidate, cand_order)``: every prefix of every candidate
    (lower-case), so the typed-text lookup is an equi-join."""
    c = candidates.select("candidate", "cand_order")
    return c.select(
        "candidate",
        "cand_order",
        F.explode(F.sequence(F.lit(1), F.length("candidate"))).alias("n"),
    ).select(F.lower(F.substring("candidate", F.lit(1), F.col("n"))).alias("prefix"), "candidate", "cand_order")


def similarity_pairs(typed: DataFrame, history: DataFrame, candidates: DataFrame) -> DataFrame:
    """``(request_id, candidate, cand_order, history_item, similarity)``:
    each candidate starting with the typed text against each of the user's
    prefix-matching history items (at most 10)."""
    hs = history_suggestions(typed, history)
    t = typed.filter(F.coalesce(F.col("typed"), F.lit("")) != "").select("request_id", F.lower("typed").alias("prefix"))
    cands = t.join(candidate_prefixes(candidates), "prefix").select("request_id", "candidate", "cand_order")
    pairs = cands.join(hs, "request_id")
    return pairs.select(
        "request_id",
        "candidate",
        "cand_order",
        F.col("suggestion").alias("history_item"),
        (1.0 / (1 + F.levenshtein(F.lower("candidate"), F.lower("suggestion")))).alias("similarity"),
    )


def similarity_suggestions(typed: DataFrame, history: DataFrame, candidates: DataFrame) -> DataFrame:
    """``(request_id, pos, suggestion, score)``: candidates by summed
    similarity, descending; ties keep the candidate order.  A candidate with
    no matching history item scores 0."""
    t = typed.filter(F.coalesce(F.col("typed"), F.lit("")) != "").select("request_id", F.lower("typed").alias("prefix"))
    cands = t.join(candidate_prefixes(candidates), "prefix").select("request_id", "candidate", "cand_order")
    sims = similarity_pairs(typed, history, candidates).groupBy("request_id", "candidate", "cand_order").agg(
        F.sum("similarity").alias("score")
    )
    scored = cands.join(sims, ["request_id", "candidate", "cand_order"], "left").withColumn(
        "score", F.round(F.coalesce("score", F.lit(0.0)), 6)
    )
    w = Window.partitionBy("request_id").orderBy(F.desc("score"), F.asc("cand_order"))
    return scored.select("request_id", (F.row_number().over(w) - 1).alias("pos"), F.col("candidate").alias("suggestion"), "score")


def suggest(typed: DataFrame, history: DataFrame, candidates: DataFrame) -> DataFrame:
    """``(request_id, part, pos, suggestion)``: history suggestions (part 0)
    followed by scored candidates (part 1); duplicates kept."""
    a = history_suggestions(typed, history).select("request_id", F.lit(0).alias("part"), "pos", "suggestion")
    b = similarity_suggestions(typed, history, candidates).select("request_id", F.lit(1).alias("part"), "pos", "suggestion")
    return a.unionByName(b)
