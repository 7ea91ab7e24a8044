"""Query-type classifier of the search box, as one ``when`` ladder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values (the search box's rules, tested in this order) -----------
# (patterns end with \z: the whole string, as a JS "$" without flags)
# 1. only ASCII letters, digits, "/", ".", ":" or the full-width colon "："
SITE_PATTERN = r"^[a-zA-Z0-9/.:：]+\z"
# 2. contains "%20" or a space
MULTI_MARKERS = ("%20", " ")
# 3. only CJK unified ideographs U+4E00..U+9FA5
HAN_ONLY_PATTERN = r"^[一-龥]+\z"
# 4. contains "*", "?" or the full-width "？"
WILDCARD_MARKERS = ("*", "?", "？")
# 5. anything else
SITE_SEARCH = "site_search"
MULTI_PHRASE_SEARCH = "multi_phrase_search"
ONE_PHRASE_SEARCH = "one_phrase_search"
WILDCARD_SEARCH = "wildcard_search"
# ---------------------------------------------------------------------------


def search_type(q: Column) -> Column:
    """Search type of a query string (NULL for blank queries, which the
    search box never sends)."""
    multi = q.contains(MULTI_MARKERS[0]) | q.contains(MULTI_MARKERS[1])
    wild = q.contains(WILDCARD_MARKERS[0]) | q.contains(WILDCARD_MARKERS[1]) | q.contains(WILDCARD_MARKERS[2])
    blank = ~F.coalesce(q, F.lit("")).rlike(r"[^\s\p{Z}]")
    return (
        F.when(blank, F.lit(None).cast("string"))
        .when(q.rlike(SITE_PATTERN), SITE_SEARCH)
        .when(multi, MULTI_PHRASE_SEARCH)
        .when(q.rlike(HAN_ONLY_PATTERN), ONE_PHRASE_SEARCH)
        .when(wild, WILDCARD_SEARCH)
        .otherwise(SITE_SEARCH)
    )


def classify_queries(queries: DataFrame, text_col: str = "query") -> DataFrame:
    """``queries`` plus ``search_type``; blank queries are dropped."""
    return queries.withColumn("search_type", search_type(F.col(text_col))).filter(F.col("search_type").isNotNull())
