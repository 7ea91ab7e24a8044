"""Highlighting and result rendering.

A shown field is cut into pieces, words and what stands between them (the same
words as its analyzer's).  Marks are spans of pieces: a word that is one of the
query's terms or matches one of its patterns is a span by itself, and a phrase
is a span from its first to its last word, only where its words stand one after
the other; spans that overlap are one.  The field is put back together with
``<strong>`` around the spans, all within its row.  Only fields with at least
one mark are returned, as ES does.  Hits are joined to the stored fields after
top-k, so only the shown documents are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators.common import fits, materialize
from quarry.operators.index import URL, Dictionary, SearchIndex
from quarry.operators.search import query_terms, wildcard_terms

# --- fixed values ----------------------------------------------------------
PRE_TAG = "<strong>"
POST_TAG = "</strong>"
DISPLAY_PRE = '<span style="color: red;">'
DISPLAY_POST = "</span>"
NO_TITLE = "无标题"
FRAGMENT_SIZE = 100
MAX_FRAGMENTS = 5
# ---------------------------------------------------------------------------

STD_PIECES = r"\p{IsHan}|[^\p{L}\p{N}]+|[\p{L}\p{N}&&[^\p{IsHan}]]+"
# Pieces of a marked text: a marked word, a word, what stands between words.
MARKED_PIECES = r"(?s)<strong>.+?</strong>|[\p{L}\p{N}]+|[^\p{L}\p{N}<]+|<"
SENTENCE_END = r"[.!?]\s|[。！？\n]"
WORD_CHARACTER = r"[\p{L}\p{N}]"
URL_PIECES = r"[\p{L}\p{N}_]+(?:\.[\p{L}\p{N}_]+)*|[^\p{L}\p{N}_]+|[\p{L}\p{N}_]"


def highlight(index: SearchIndex, hits: DataFrame, queries: DataFrame, fields: Sequence[str], text_col: str = "query",
              words: bool = True, phrases: DataFrame | None = None, patterns: DataFrame | None = None) -> DataFrame:
    """``(query_id, doc_id, field, fragment)`` — the whole field with marks,
    for each hit and each requested field that has one.

    ``words``: each term of the query's text is marked wherever it stands.
    ``phrases`` ``(query_id, phrase_no, <text_col>)``: each phrase's terms,
    where they stand one after the other.  ``patterns`` ``(query_id,
    <text_col>)``: words that match a wildcard pattern.  A query's marks are
    its own text, so they are bounded by it; patterns are tried on the shown
    words and never become lists of the dictionary's terms.

    In a run of a dictionary-analysed field every term that occurs is marked,
    overlapping ones as one (``highlight_runs``)."""
    plain = [f for f in fields if not isinstance(index.analyzers.get(f), Dictionary)]
    runs = [f for f in fields if f not in plain]
    h = materialize(hits.select("query_id", "doc_id").distinct(), "shown_hits")
    out = None
    if plain:
        spec = materialize(_marks(index, queries, plain, text_col, words, phrases, patterns), "marks")
        out = _marked_fields(index, h, spec, plain)
    if runs:
        terms = [] if not words else [query_terms(index, queries, runs, text_col)]
        if phrases is not None:
            terms.append(query_terms(index, phrases, runs, text_col))
        if patterns is not None:
            terms.append(wildcard_terms(index, patterns, runs, text_col))
        every = None
        for t in terms:
            t = t.select("query_id", "field", "term")
            every = t if every is None else every.unionByName(t)
        more = highlight_runs(index, h, every.distinct(), runs)
        out = more if out is None else out.unionByName(more)
    return out


def _marks(index: SearchIndex, queries: DataFrame, fields: Sequence[str], text_col: str, words: bool, phrases: DataFrame | None, patterns: DataFrame | None) -> DataFrame:
    """``(query_id, field, terms, phrases, patterns)``: single terms, longer
    phrases as arrays of terms, and regular expressions."""
    strings, lists = "array<string>", "array<array<string>>"
    parts = []

    def part(df: DataFrame, **columns: Column) -> None:
        every = {"terms": F.array().cast(strings), "phrases": F.array().cast(lists), "patterns": F.array().cast(strings)} | columns
        parts.append(df.select("query_id", "field", *(c.alias(n) for n, c in every.items())))

    if words:
        part(query_terms(index, queries, fields, text_col), terms=F.array("term"))
    if phrases is not None:
        asked = phrases.select(F.struct("query_id", "phrase_no").alias("query_id"), text_col)
        found = query_terms(index, asked, fields, text_col).groupBy("query_id", "field").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "term"))), lambda x: x["term"]).alias("run"))
        found = found.select("query_id.query_id", "field", "run")
        one = F.size("run") == 1
        part(found, terms=F.when(one, F.col("run")).otherwise(F.array().cast(strings)), phrases=F.when(one, F.array().cast(lists)).otherwise(F.array("run")))
    if patterns is not None:
        rx = patterns.select("query_id", T.wildcard_to_regex(F.col(text_col)).alias("rx"), F.explode(F.array(*map(F.lit, fields))).alias("field"))
        part(rx, patterns=F.array("rx"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    flat = {n: F.array_distinct(F.flatten(F.collect_list(n))).alias(n) for n in ("terms", "phrases", "patterns")}
    return out.groupBy("query_id", "field").agg(*flat.values())


def _marked_fields(index: SearchIndex, hits: DataFrame, spec: DataFrame, fields: Sequence[str]) -> DataFrame:
    stored = index.docs.select("doc_id", *[F.col(f).cast("string").alias(f) for f in fields])
    shown = stored.join(F.broadcast(hits) if fits(hits) else hits, "doc_id")
    rows = shown.select("query_id", "doc_id", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields])).alias("s")).select("query_id", "doc_id", "s.field", "s.text")
    url = F.col("field").isin([f for f in fields if index.analyzers.get(f) == URL])
    asked = rows.join(F.broadcast(spec) if fits(spec) else spec, ["query_id", "field"])
    cut = asked.withColumn("pieces", F.regexp_extract_all(F.coalesce("text", F.lit("")), F.when(url, F.lit(URL_PIECES)).otherwise(F.lit(STD_PIECES)), 0)).filter(F.size("pieces") > 0)
    cut = cut.withColumn("low", F.transform("pieces", F.lower))
    word = WORD_CHARACTER.replace("\\", "\\\\")
    # the places of words among the pieces, then the spans of each phrase: first and last piece
    cut = cut.withColumn("at", F.expr(f"filter(sequence(0, size(low) - 1), i -> low[i] rlike '{word}')"))
    spans = F.expr("""
        flatten(transform(phrases, p -> transform(
          filter(
            CASE WHEN size(at) < size(p) THEN cast(array() AS array<int>) ELSE sequence(0, size(at) - size(p)) END,
            s -> CASE WHEN low[at[s]] = p[0] THEN forall(sequence(1, size(p) - 1), j -> low[at[s + j]] = p[j]) ELSE false END),
          s -> named_struct('a', at[s], 'b', at[s + size(p) - 1]))))""")
    cut = cut.withColumn("spans", spans)
    alone = "(array_contains(terms, low[i]) OR exists(patterns, rx -> low[i] rlike rx)) AND low[i] rlike '" + word + "'"
    marked = F.expr(f"""
        array_join(transform(pieces, (x, i) -> CASE
          WHEN exists(spans, s -> s.a <= i AND i <= s.b) THEN concat(
            CASE WHEN exists(spans, s -> s.a <= i - 1 AND i - 1 <= s.b) THEN '' ELSE '{PRE_TAG}' END, x,
            CASE WHEN exists(spans, s -> s.a <= i + 1 AND i + 1 <= s.b) THEN '' ELSE '{POST_TAG}' END)
          WHEN {alone} THEN concat('{PRE_TAG}', x, '{POST_TAG}') ELSE x END), '')""")
    some = F.expr(f"size(spans) > 0 OR exists(at, i -> {alone})")
    # written before the filter: pushed below the projections, it would work out all arrays again for every piece
    found = materialize(cut.select("query_id", "doc_id", "field", F.when(some, marked).alias("fragment")), "marked_fields")
    return found.filter("fragment is not null")


def highlight_runs(index: SearchIndex, hits: DataFrame, qt: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The same for dictionary-analysed fields, by their terms ``qt (query_id,
    field, term)``: the shown fields are cut into runs and words, and these
    and their substrings meet the terms in a join."""
    stored = index.docs.select("doc_id", *[F.col(f).cast("string").alias(f) for f in fields])
    shown = stored.join(F.broadcast(hits) if fits(hits) else hits, "doc_id")
    is_run, pattern = F.lit(False), None
    for f in fields:
        run = "(?:" + index.analyzers[f].run_pattern + ")"
        own = F.col("field") == f
        pattern = F.when(own, F.lit(run + "|" + STD_PIECES)) if pattern is None else pattern.when(own, F.lit(run + "|" + STD_PIECES))
        is_run = is_run | (own & F.col("piece").rlike("^" + run + "$"))
    stacked = shown.select(
        "query_id",
        "doc_id",
        F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields])).alias("s"),
    ).select("query_id", "doc_id", "s.field", "s.text")
    pieces = stacked.select("query_id", "doc_id", "field", F.posexplode(F.regexp_extract_all(F.coalesce("text", F.lit("")), pattern, 0)).alias("i", "piece")).withColumn("term", F.lower("piece"))
    pieces = _with_spans(pieces, qt, is_run)
    # only words and runs meet the terms; what stands between them is the same in every text
    word = F.when(F.col("piece").rlike(WORD_CHARACTER), F.col("term"))
    hit = qt.withColumn("hit", F.lit(True)).withColumnRenamed("term", "word")
    marked_pieces = pieces.withColumn("word", word).join(hit, ["query_id", "field", "word"], "left").select(
        "query_id",
        "doc_id",
        "field",
        "i",
        F.when(F.col("hit"), F.concat(F.lit(PRE_TAG), "piece", F.lit(POST_TAG))).when(F.col("spans").isNotNull(), _marked_run()).otherwise(F.col("piece")).alias("p"),
        (F.coalesce("hit", F.lit(False)) | F.col("spans").isNotNull()).alias("hit"),
    )
    # one field of one document per group: bounded by the document's size
    per_field = marked_pieces.groupBy("query_id", "doc_id", "field").agg(
        F.max("hit").alias("any_hit"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "p"))), lambda x: x["p"]), "").alias("fragment"),
    )
    return per_field.filter("any_hit").select("query_id", "doc_id", "field", "fragment")


SPANS = "array<struct<at: int, n: int>>"


def _with_spans(pieces: DataFrame, terms: DataFrame, is_run: Column) -> DataFrame:
    """``pieces`` with ``spans``: where terms occur in each run (null: nowhere).
    Every substring of a run no longer than the longest term meets the terms
    in an equi-join."""
    keys = ["query_id", "doc_id", "field", "i"]
    longest = terms.agg(F.max(F.length("term")).alias("longest"))
    starts = pieces.filter(is_run).crossJoin(F.broadcast(longest)).select(*keys, "term", "longest", F.explode(F.sequence(F.lit(1), F.length("term"))).alias("at"))
    subs = starts.select(*keys, "term", "at", F.explode(F.expr("sequence(1, least(longest, length(term) - at + 1))")).alias("n")).select(*keys, "at", "n", F.expr("substring(term, at, n)").alias("term"))
    found = subs.join(terms, ["query_id", "field", "term"], "left_semi").groupBy(*keys).agg(F.collect_set(F.struct("at", "n")).alias("spans"))
    return pieces.join(found, keys, "left")


def _marked_run() -> Column:
    """A run with the union of its spans wrapped."""

    def inside(k: Column) -> Column:
        return F.exists("spans", lambda s: (s["at"] <= k) & (k < s["at"] + s["n"]))

    def char(k: Column) -> Column:
        on = inside(k)
        return F.concat(F.when(on & ~inside(k - 1), PRE_TAG).otherwise(""), F.substring(F.col("piece"), k, F.lit(1)), F.when(on & ~inside(k + 1), POST_TAG).otherwise(""))

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length("piece")), char), "")


def highlight_fragments(marked: DataFrame) -> DataFrame:
    """``(query_id, doc_id, field, fragments)``: the marked field cut after
    sentence ends and, within a sentence, at word limits into fragments of at
    most ``FRAGMENT_SIZE`` characters (tags not counted; one longer word is a
    fragment by itself).  Fragments with a mark stay, ``MAX_FRAGMENTS`` at
    most, in text order; every tag pair is whole."""
    tags = len(PRE_TAG) + len(POST_TAG)

    def step(acc: Column, p: Column) -> Column:
        mark = p.startswith(PRE_TAG)
        size = F.length(p) - F.when(mark, tags).otherwise(0)
        cut = acc["ended"] | ((acc["n"] + size > FRAGMENT_SIZE) & (acc["n"] > 0))
        return F.struct(
            F.when(cut & acc["hit"], F.array_append(acc["done"], acc["cur"])).otherwise(acc["done"]).alias("done"),
            F.when(cut, p).otherwise(F.concat(acc["cur"], p)).alias("cur"),
            F.when(cut, size).otherwise(acc["n"] + size).alias("n"),
            (mark | (~cut & acc["hit"])).alias("hit"),
            p.rlike(SENTENCE_END).alias("ended"),
        )

    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("cur"), F.lit(0).alias("n"), F.lit(False).alias("hit"), F.lit(False).alias("ended"))
    pieces = F.regexp_extract_all(F.col("fragment"), F.lit(MARKED_PIECES), 0)
    found = F.aggregate(pieces, start, step, lambda acc: F.when(acc["hit"], F.array_append(acc["done"], acc["cur"])).otherwise(acc["done"]))
    return marked.select("query_id", "doc_id", "field", F.transform(F.slice(found, 1, MAX_FRAGMENTS), lambda x: F.trim(x)).alias("fragments"))


def _shown(marks: Column, source: Column, default: str) -> Column:
    joined = F.replace(F.replace(marks, F.lit(PRE_TAG), F.lit(DISPLAY_PRE)), F.lit(POST_TAG), F.lit(DISPLAY_POST))
    fallback = F.when(F.coalesce(source, F.lit("")) == "", F.lit(default)).otherwise(source)
    return F.when(marks.isNotNull(), joined).otherwise(fallback)


def render_hits(hits: DataFrame, docs: DataFrame, marked: DataFrame) -> DataFrame:
    """Result rows as the page shows them: the field's fragments joined by a
    space (marks in red), else the stored field, else the default (``无标题``
    for a title).  ``marked`` is what ``highlight`` returns."""
    joined = highlight_fragments(marked).select("query_id", "doc_id", "field", F.array_join("fragments", " ").alias("fragment"))
    per_hit = joined.groupBy("query_id", "doc_id").pivot("field", ["title", "content", "editor", "url"]).agg(F.first("fragment"))
    d = docs.select("doc_id", F.col("title").alias("s_title"), F.col("content").alias("s_content"),
                    F.col("editor").alias("s_editor"), F.col("url").alias("s_url"))
    j = hits.select("query_id", "doc_id", "rank").join(per_hit, ["query_id", "doc_id"], "left").join(d, "doc_id")
    return j.select(
        "query_id",
        "rank",
        "doc_id",
        _shown(F.col("title"), F.col("s_title"), NO_TITLE).alias("title_html"),
        _shown(F.col("content"), F.col("s_content"), "").alias("content_html"),
        _shown(F.col("editor"), F.col("s_editor"), "").alias("editor_html"),
        _shown(F.col("url"), F.col("s_url"), "").alias("url_html"),
    )
