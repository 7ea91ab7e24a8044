"""Anchors and links: extraction, URL resolution, filters, link-text map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Link filter of the page records: an article URL of the crawled site.  The
# host is a deployment parameter; this placeholder keeps the rule's shape
# (absolute http URL on the site, digits before ".shtml").
SITE_LINK_PATTERN = r"^http://news\.example\.cn/.+\d+\.shtml$"

_SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"


def extract_anchors(parsed: DataFrame) -> DataFrame:
    """``(page_id, url, pos, href, text)``: one row per anchor with an href,
    href and text paired per anchor."""
    return parsed.select("page_id", "url", F.posexplode("anchors").alias("pos", "a")).select(
        "page_id", "url", "pos", F.col("a.href").alias("href"), F.col("a.text").alias("text")
    )


def _remove_dots(path: Column) -> Column:
    """Dot-segment removal as Python's ``urljoin`` does it: empty inner
    segments dropped, ``.`` skipped, ``..`` pops, a trailing ``.``/``..``
    leaves a trailing slash."""
    segs = F.split(path, "/", -1)
    n = F.size(segs)
    inner = F.filter(F.slice(segs, 2, F.greatest(n - 2, F.lit(0))), lambda s: s != "")
    all_segs = F.when(n >= 2, F.concat(F.slice(segs, 1, 1), inner, F.slice(segs, -1, 1))).otherwise(segs)
    resolved = F.aggregate(
        all_segs,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc)
        .otherwise(F.array_append(acc, s)),
    )
    last = F.element_at(all_segs, -1)
    resolved = F.when(last.isin(".", ".."), F.array_append(resolved, F.lit(""))).otherwise(resolved)
    joined = F.array_join(resolved, "/")
    # an empty path becomes "/", and a path under a host always starts with "/"
    return F.when(joined == "", F.lit("/")).when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))


def resolve_url(base: Column, href: Column) -> Column:
    """``urllib.parse.urljoin(base, href)`` for http(s) bases as a column."""
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.\-]*):", 1)
    authority = F.regexp_extract(base, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)", 1)
    bpath = F.regexp_extract(base, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    bquery = F.regexp_extract(base, r"^[^?#]*(\?[^#]*)?", 1)
    origin = F.concat(scheme, F.lit("://"), authority)
    hpath = F.regexp_extract(href, r"^([^?#]*)", 1)
    hrest = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    base_dir = F.regexp_replace(bpath, r"[^/]*$", "")
    return (
        F.when(href == "", base)
        .when(href.rlike(_SCHEME), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("?"), F.concat(origin, bpath, href))
        .when(href.startswith("#"), F.concat(origin, bpath, bquery, href))
        .when(hpath.startswith("/"), F.concat(origin, _remove_dots(hpath), hrest))
        .otherwise(F.concat(origin, _remove_dots(F.concat(F.when(base_dir == "", F.lit("/")).otherwise(base_dir), hpath)), hrest))
    )


def resolve_links(anchors: DataFrame) -> DataFrame:
    """Anchors with ``target`` = href resolved against the page URL."""
    return anchors.withColumn("target", resolve_url(F.col("url"), F.col("href")))


def link_text_map(resolved: DataFrame) -> DataFrame:
    """``(target, text)``: unique targets, the text of the last anchor seen
    (by page, then position) wins."""
    return resolved.groupBy("target").agg(F.max_by("text", F.struct("page_id", "pos")).alias("text"))


def filter_http(df: DataFrame, col: str = "target") -> DataFrame:
    """Keep URLs starting with ``http`` (covers https)."""
    return df.filter(F.col(col).startswith("http"))


def filter_links(records: DataFrame, pattern: str, col: str = "links") -> DataFrame:
    """Keep array elements matching the link pattern, duplicates kept."""
    return records.withColumn(col, F.filter(col, lambda h: h.rlike(pattern)))
