"""Batch search: a table of queries against the index tables.

Every operator takes a queries DataFrame ``(query_id, query, ...)`` and
returns ranked rows.  The analysed query terms are written once, measured once
and, within the bound, broadcast into the postings scan.  Postings are dealt to
shards by document, so a shard adds up its documents' scores (``blocks``: pairs
of query and document never become rows), intersects their phrase positions and
picks its best ``k`` per query without an exchange; only those leave it.

With many shards, impact bounds tell before the scan which score ``k``
documents of other shards are known to reach; no hit below it leaves a shard.

Scoring is Lucene BM25 (k1 = 1.2, b = 0.75) over exact field lengths:
``idf = ln(1 + (N - df + 0.5) / (df + 0.5))`` and
``score = idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))``
where N and avgdl count documents whose field has at least one term.  A
phrase uses the summed idf of its terms and the phrase frequency as tf.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import blocks as BL
from quarry.operators.common import SCORE_DECIMALS, bounded_broadcast, fits, materialize, rank_within, round_score
from quarry.operators.index import K1, B, SearchIndex, analyze

# Shards are asked about by their bounds when there are so many times k of them.
PRUNE_SHARDS = 4
# They have a row for each term of a query and shard that has it: so many at most.
LEAST_ROWS = 20_000_000
# Trigrams by which a wildcard pattern is tried first.
SIEVE_GRAMS = 4


def _queries(queries: DataFrame, text_col: str) -> DataFrame:
    """Drop blank queries (the search box ignores them): no character other
    than white space."""
    return queries.filter(F.coalesce(F.col(text_col), F.lit("")).rlike(r"[^\s\p{Z}]"))


def query_terms(index: SearchIndex, queries: DataFrame, fields: Sequence[str], text_col: str = "query") -> DataFrame:
    """``(query_id, field, pos, term)``: the query analysed with each field's
    analyzer (index and query always share the analyzer)."""
    q = _queries(queries, text_col).select("query_id", F.col(text_col).alias("_q"))
    parts = []
    for f in fields:
        a = index.analyzer(f)
        toks = analyze(q.withColumnRenamed("_q", f), "query_id", {f: a}, out_id="query_id")
        parts.append(toks.select("query_id", "field", "pos", "term"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _sent(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def _terms(index: SearchIndex, qt: DataFrame) -> tuple[DataFrame, bool]:
    """The query terms with df, N, avgdl and idf, written once (terms that the
    field doesn't have are left out), and whether they may be broadcast."""
    wanted = materialize(qt, "query_terms")
    small = fits(wanted)
    ts = index.term_stats.join(_sent(wanted.select("field", "term").distinct(), small), ["field", "term"], "left_semi")
    found = wanted.join(ts, ["field", "term"]).join(F.broadcast(index.field_stats), "field")  # one row per field
    idf = F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    return materialize(found.withColumn("idf", idf), "weighted_terms"), small


def _hits(index: SearchIndex, side: DataFrame, fields: Sequence[str], small: bool) -> DataFrame:
    """Postings of the terms of ``side``, a written table.  A persisted index
    is read in the fields' and terms' partitions only; their numbers, no more
    than the index has term buckets, are a constant of the plan."""
    side, post = index.keyed(side), index.postings.filter(F.col("field").isin(list(fields)))
    if "tb" in index.term_keys:
        post = post.filter(F.col("tb").isin([r.tb for r in side.select("tb").distinct().collect()]))
    return post.join(_sent(side, small), index.term_keys)


def _least(index: SearchIndex, side: DataFrame, best: bool, k: int) -> tuple[DataFrame, DataFrame]:
    """``(query_id, shard, most, sure)``, what a shard's documents score at most
    and one of them at least, and ``(query_id, least)``, reached by ``k``."""
    parts = index.bounds.join(side.select("query_id", "field", "term", "w"), ["field", "term"]).withColumn("part", F.col("w") * F.col("top"))
    fields = parts.groupBy("query_id", "shard", "field").agg(F.sum("part").alias("most"), F.max("part").alias("sure"))
    each = fields.groupBy("query_id", "shard").agg((F.max if best else F.sum)("most").alias("most"), F.max("sure").alias("sure"))
    return each, rank_within(each, "query_id", k, score="sure", tie="shard").filter(F.col("rank") == k).select("query_id", F.col("sure").alias("least"))


def _alive(index: SearchIndex, side: DataFrame, best: bool, k: int) -> DataFrame:
    """``(query_id, shard)`` of the shards that may hold one of a query's best
    ``k`` documents.

    No document of a shard scores more than the sum of its terms' largest
    shares (``best``: the best field's sum).  The single largest is reached by
    a document of the shard, so the k-th largest over the shards is reached by
    k documents.  A shard below that, by more than rounding moves, has no hit."""
    each, least = _least(index, side, best, k)
    return each.join(least, "query_id", "left").filter(F.col("most") >= F.coalesce("least", F.lit(0.0)) - 10.0**-SCORE_DECIMALS).select("query_id", "shard")


def _numbered(side: DataFrame) -> DataFrame:
    """``(field, term, avg_len, tno)``: the terms of ``side``, numbered once."""
    return materialize(side.select("field", "term", "avg_len").distinct().withColumn("tno", F.monotonically_increasing_id()), "term_numbers")


def bm25_scores(index: SearchIndex, queries: DataFrame, fields: Sequence[str], best: bool = False, k: int | None = None, text_col: str = "query") -> DataFrame:
    """``(query_id, doc_id, score)``: BM25 of the ``match`` query (OR of the
    query terms; a repeated term counts again) over the fields: their sum, or
    the ``best`` one's.  With ``k``, documents that can't be among a query's
    best ``k`` may be missing."""
    qt = query_terms(index, queries, fields, text_col)
    terms, small = _terms(index, qt.groupBy("query_id", "field", "term").agg(F.count(F.lit(1)).alias("qtf")))
    side = terms.select("query_id", "field", "term", "avg_len", (F.col("qtf") * F.col("idf") * (K1 + 1)).alias("w"))
    numbers = _numbered(side)
    per_query = side.join(numbers, ["field", "term", "avg_len"]).groupBy("query_id").agg(
        BL.asked("tno", F.array_position(F.array(*[F.lit(f) for f in fields]), F.col("field")), F.col("w"))
    )
    floor = F.lit(0.0)
    if k is not None and small and index.shards >= PRUNE_SHARDS * k and side.count() * index.shards <= LEAST_ROWS:
        least = _least(index, side, best, k)[1]
        per_query, floor = per_query.join(least, "query_id", "left"), F.coalesce("least", F.lit(0.0))
    share = F.col("tf") / (F.col("tf") + K1 * (1 - B) + K1 * B / F.col("avg_len") * F.col("dl"))
    postings = BL.shares(_hits(index, numbers, fields, fits(numbers)), share)
    return BL.best_scores(postings, per_query.withColumn("floor", floor), best and len(fields) > 1, k)


def _finish(scored: DataFrame, k: int | None) -> DataFrame:
    return rank_within(scored.withColumn("score", round_score(F.col("score"))), "query_id", k).select(
        "query_id", "doc_id", "score", "rank"
    )


def match_query(index: SearchIndex, queries: DataFrame, field: str = "content", k: int | None = 10, text_col: str = "query") -> DataFrame:
    """``match`` on one field: ``(query_id, doc_id, score, rank)``."""
    return _finish(bm25_scores(index, queries, [field], k=k, text_col=text_col), k)


def multi_match(index: SearchIndex, queries: DataFrame, fields: Sequence[str], k: int | None = 10, text_col: str = "query") -> DataFrame:
    """``multi_match`` (best_fields): the best single field score."""
    return _finish(bm25_scores(index, queries, fields, best=True, k=k, text_col=text_col), k)


def should_match(index: SearchIndex, queries: DataFrame, fields: Sequence[str], k: int | None = 10, text_col: str = "query") -> DataFrame:
    """``bool.should`` of one ``match`` per field: the sum of field scores."""
    return _finish(bm25_scores(index, queries, fields, k=k, text_col=text_col), k)


SIMPLE_FIELDS = ("title", "content", "url", "editor")


def simple_search(index: SearchIndex, queries: DataFrame, k: int | None = 10, text_col: str = "query") -> DataFrame:
    """Ordinary search: should over title, content, url and editor."""
    return should_match(index, queries, SIMPLE_FIELDS, k, text_col)


# --- phrases ---------------------------------------------------------------

def phrase_scores(index: SearchIndex, phrases: DataFrame, fields: Sequence[str], text_col: str = "query", k: int | None = None) -> DataFrame:
    """``(query_id, doc_id, field, freq, score)`` where all phrases of a query
    stand in the field (slop 0): how often, and the sum of their scores.

    ``phrases`` has a row per query, or with a column ``phrase_no`` a row per
    phrase of it.  A start counts when every phrase term sits at start + its
    offset; the number of starts is the phrase frequency.

    Documents with all terms of a query are found in blocks (``blocks``).  Only
    their postings come together per document and field, with positions; each
    phrase's starts are its position lists, shifted by the offsets and
    intersected, rarest term first.

    With ``k`` and one field, documents that can't be among a query's best ``k``
    may be missing, and ``freq`` of a query of single words is null: its
    documents are scored in their blocks, as the phrase frequency is ``tf``.
    """
    if "phrase_no" not in phrases.columns:
        phrases = phrases.withColumn("phrase_no", F.lit(0))
    some = _queries(phrases, text_col)
    asked = some.select(F.struct("query_id", "phrase_no").alias("query_id"), text_col)
    qt = query_terms(index, asked, fields, text_col).select("query_id.query_id", "query_id.phrase_no", "field", "pos", "term")
    terms, small = _terms(index, qt)
    # (the number of terms and of phrases tells whether any is missing from the field)
    wanted = qt.groupBy("query_id", "field").agg(F.count(F.lit(1)).alias("n_terms"))
    n_phrases = some.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_phrases"))
    per_phrase = terms.groupBy("query_id", "field", "phrase_no").agg(
        F.sum("idf").alias("idf"), F.first("avg_len").alias("avg_len"), F.count(F.lit(1)).alias("n"),
        F.array_sort(F.collect_list(F.struct("df", "pos", "term"))).alias("terms"),
    )
    spec = per_phrase.groupBy("query_id", "field").agg(
        F.sum("n").alias("n_found"), F.first("avg_len").alias("avg_len"),
        F.array_sort(F.collect_list(F.struct("phrase_no", "idf", F.transform("terms", lambda t: F.struct(t["term"].alias("term"), t["pos"].alias("pos"))).alias("terms")))).alias("phrases"),
    )
    spec = spec.join(wanted, ["query_id", "field"]).join(n_phrases, "query_id").filter((F.col("n_found") == F.col("n_terms")) & (F.size("phrases") == F.col("n_phrases")))
    words = F.forall("phrases", lambda p: F.size(p["terms"]) == 1) if k is not None and len(fields) == 1 else F.lit(False)
    spec = materialize(spec.select("query_id", "field", "avg_len", "phrases", words.alias("words")), "phrase_specs")
    every = spec.select(F.struct("query_id", "field").alias("query_id"), "field", "avg_len", "words", F.explode("phrases").alias("p")).select("*", F.explode("p.terms.term").alias("term"))
    numbers = _numbered(every)
    small = fits(numbers)
    weighted = every.join(numbers, ["field", "term", "avg_len"]).groupBy("query_id", "words").agg(BL.asked("tno", F.lit(0), F.col("p.idf") * (K1 + 1))).withColumn("floor", F.lit(0.0))
    share = F.col("tf") / (F.col("tf") + K1 * (1 - B) + K1 * B / F.col("avg_len") * F.col("dl"))
    vectors = BL.shares(_hits(index, numbers, fields, small), share)

    def met(single: bool, k: int | None) -> DataFrame:
        found = BL.scores_of_all(vectors, weighted.filter(F.col("words") == single).drop("words"), k)
        return found.select("query_id.query_id", "doc_id", "query_id.field", F.lit(None).cast("int").alias("freq"), "score")

    single = met(True, k) if k is not None and not spec.filter("words").isEmpty() else None
    spec = spec.filter(~F.col("words")).drop("words")
    if single is not None and spec.isEmpty():
        return single
    pairs = materialize(met(False, None).select("query_id", "doc_id", "field"), "phrase_documents")
    shown = pairs.select("doc_id", "field").distinct()
    hits = _hits(index, numbers.drop("avg_len"), fields, small).join(_sent(shown, fits(pairs)), ["doc_id", "field"], "left_semi")
    per_doc = hits.groupBy("doc_id", "field").agg(F.map_from_entries(F.collect_list(F.struct("term", "positions"))).alias("at"), F.max("dl").alias("dl"))
    found = per_doc.join(_sent(pairs, fits(pairs)), ["doc_id", "field"]).join(_sent(spec, fits(spec)), ["query_id", "field"])

    def starts(p):
        def shifted(t):
            return F.transform(F.element_at("at", t["term"]), lambda x: x - t["pos"])

        rest = F.slice(p["terms"], 2, F.greatest(F.size(p["terms"]) - 1, F.lit(0)))
        return F.aggregate(rest, shifted(p["terms"][0]), lambda acc, t: F.array_intersect(acc, shifted(t)))

    freq = F.transform("phrases", lambda p: F.struct(p["idf"].alias("idf"), F.size(starts(p)).alias("n")))
    scored = found.select("query_id", "doc_id", "field", "dl", "avg_len", freq.alias("freq")).filter(F.forall("freq", lambda x: x["n"] > 0))
    part = F.transform("freq", lambda x: x["idf"] * (K1 + 1) * x["n"] / (x["n"] + K1 * (1 - B) + K1 * B * F.col("dl") / F.col("avg_len")))
    total = F.aggregate("freq", F.lit(0), lambda a, x: a + x["n"])
    out = scored.select("query_id", "doc_id", "field", total.alias("freq"), F.aggregate(part, F.lit(0.0), lambda a, x: a + x).alias("score"))
    return out if single is None else out.unionByName(single)


def match_phrase(index: SearchIndex, queries: DataFrame, field: str = "content", k: int | None = 10, text_col: str = "query") -> DataFrame:
    """``match_phrase`` on one field: ``(query_id, doc_id, score, rank)``."""
    s = phrase_scores(index, queries, [field], text_col, k)
    return _finish(s.select("query_id", "doc_id", "score"), k)


PHRASE_FIELDS = ("title", "content", "editor")


def one_phrase_search(index: SearchIndex, queries: DataFrame, k: int | None = 1000, text_col: str = "query") -> DataFrame:
    """should[ multi_match(title, content, editor), should[phrase x 3] ].

    A document with the phrase has its terms too, so phrase scores are added
    to match scores by a join on the document, which stays in its shard."""
    mm = bm25_scores(index, queries, PHRASE_FIELDS, best=True, text_col=text_col)
    ph = phrase_scores(index, queries, PHRASE_FIELDS, text_col).groupBy("doc_id", "query_id").agg(F.sum("score").alias("s"))
    extra = ph.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("query_id", "s"))).alias("extra"))
    total = mm.join(extra, "doc_id", "left").select("query_id", "doc_id", (F.col("score") + F.coalesce(F.element_at("extra", F.col("query_id")), F.lit(0.0))).alias("score"))
    return _finish(total, k)


def split_phrases(queries: DataFrame, text_col: str = "query") -> DataFrame:
    """``(query_id, phrase_no, phrase)``: Python ``str.split()`` of the query."""
    return _queries(queries, text_col).select(
        "query_id", F.posexplode(F.split(T.py_strip(F.col(text_col)), r"[\s\p{Z}\u0085]+")).alias("phrase_no", "phrase")
    )


def multi_phrase_search(index: SearchIndex, queries: DataFrame, field: str = "content", k: int | None = 10, text_col: str = "query") -> DataFrame:
    """Every whitespace-separated phrase must match ``field``; the same
    phrases are also should clauses and the whole query has boost 2, so the
    score is ``4 * sum(phrase scores)``.  A phrase without terms matches
    nothing, so its query returns nothing."""
    s = phrase_scores(index, split_phrases(queries, text_col), [field], "phrase", k)
    return _finish(s.select("query_id", "doc_id", (F.col("score") * 4).alias("score")), k)


# --- wildcard / site / keyword -----------------------------------------------

def wildcard_terms(index: SearchIndex, patterns: DataFrame, fields: Sequence[str], text_col: str = "query", case_insensitive: bool = False) -> DataFrame:
    """``(query_id, field, term)``: dictionary terms matching the wildcard
    pattern; documents are reached afterwards by an equi-join on the terms.

    A pattern meets the dictionary by the rarest trigram of its literal runs,
    an equi-join, and is tried on the terms that have it.  Only patterns
    without a run of three characters (the term's ends count) go through the
    whole dictionary."""
    own = F.lower(F.col(text_col)) if case_insensitive else F.col(text_col)
    rx = T.wildcard_to_regex(own)
    asked = _queries(patterns, text_col).select(
        "query_id", (F.concat(F.lit("(?iu)"), rx) if case_insensitive else rx).alias("rx"), T.wildcard_trigrams(F.col(text_col), case_insensitive).alias("grams")
    )
    # (numbered as written, so that patterns of a query stay apart)
    asked = materialize(asked.withColumn("pattern", F.monotonically_increasing_id()), "patterns")
    grams, stats = index.trigrams()
    few = fits(stats)
    some = asked.filter(F.size("grams") > 0).select("pattern", "grams")
    # a pattern with a trigram that no term has matches none: most patterns go by
    # the first few of their trigrams, without rows for all of them
    sieve = F.slice(F.transform(F.sort_array(F.transform("grams", lambda g: F.struct(F.xxhash64(g).alias("h"), g.alias("g")))), lambda x: x["g"]), 1, SIEVE_GRAMS)
    unknown = some.select("pattern", F.explode(sieve).alias("gram")).join(_sent(stats.select("gram"), few), "gram", "left_anti").select("pattern").distinct()
    left = materialize(some.join(unknown, "pattern", "left_anti"), "sieved_patterns")
    wanted = left.select("pattern", F.size("grams").alias("n_grams"), F.explode("grams").alias("gram"))
    known = wanted.join(_sent(stats, few), "gram").groupBy("pattern").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"), F.count(F.lit(1)).alias("n_found"), F.first("n_grams").alias("n_grams"))
    best = materialize(known.filter(F.col("n_found") == F.col("n_grams")).join(asked.select("pattern", "query_id", "rx"), "pattern").select("query_id", "rx", "gram"), "pattern_trigrams")
    small = fits(best)
    of_fields = F.col("field").isin(list(fields))
    out = grams.filter(of_fields).join(_sent(best, small), "gram").filter(F.expr("term rlike rx")).select("query_id", "field", "term")
    short = asked.filter(F.size("grams") == 0).select("query_id", "rx")
    if not short.isEmpty():
        terms = index.term_stats.filter(of_fields).select("field", "term")
        out = out.unionByName(terms.join(_sent(short, fits(short)), F.expr("term rlike rx")).select("query_id", "field", "term"))
    return out


def wildcard_field_hits(index: SearchIndex, patterns: DataFrame, fields: Sequence[str], text_col: str = "query", case_insensitive: bool = False) -> DataFrame:
    """``(query_id, doc_id, field)`` where some term of the field matches."""
    # matched terms are written once: a pattern such as "*" can match the
    # whole dictionary, so their size is only known after the match
    mt = materialize(wildcard_terms(index, patterns, fields, text_col, case_insensitive), "wildcard_terms")
    side = bounded_broadcast(index.keyed(mt))
    return index.postings.filter(F.col("field").isin(list(fields))).join(side, index.term_keys).select("query_id", "doc_id", "field").distinct()


WILDCARD_FIELDS = ("title", "content", "editor", "url")


def wildcard_search(index: SearchIndex, queries: DataFrame, k: int | None = 10, text_col: str = "query", case_insensitive: bool = False) -> DataFrame:
    """should of one wildcard clause per field; each matching clause scores 1."""
    h = wildcard_field_hits(index, queries, WILDCARD_FIELDS, text_col, case_insensitive)
    return _finish(h.groupBy("query_id", "doc_id").agg(F.count(F.lit(1)).cast("double").alias("score")), k)


def site_search(index: SearchIndex, queries: DataFrame, k: int | None = 1000, text_col: str = "query", whole_url: bool = False) -> DataFrame:
    """``*query*`` against url terms (score 1).  ``whole_url=True`` tests the
    raw url string instead of its terms."""
    q = _queries(queries, text_col)
    if whole_url:
        side = bounded_broadcast(q.select("query_id", F.col(text_col).alias("_q")))
        h = index.docs.select("doc_id", "url").join(side, F.expr("contains(url, _q)")).select("query_id", "doc_id")
    else:
        pats = q.select("query_id", F.concat(F.lit("*"), F.col(text_col), F.lit("*")).alias("_pat"))
        h = wildcard_field_hits(index, pats, ["url"], "_pat").select("query_id", "doc_id")
    return _finish(h.withColumn("score", F.lit(1.0)), k)


def keyword_match(docs: DataFrame, queries: DataFrame, column: str, text_col: str = "query", array: bool = False) -> DataFrame:
    """Exact match on an un-analysed column (``array=True``: array element)."""
    q = _queries(queries, text_col).select("query_id", F.col(text_col).alias("_q"))
    if array:
        exploded = docs.select("doc_id", F.explode(F.array_distinct(column)).alias("_v"))
        return exploded.join(bounded_broadcast(q), F.col("_v") == F.col("_q")).select("query_id", "doc_id").distinct()
    return docs.select("doc_id", F.col(column).alias("_v")).join(bounded_broadcast(q), F.col("_v") == F.col("_q")).select("query_id", "doc_id")


def document_search(index: SearchIndex, queries: DataFrame, k: int | None = 10, text_col: str = "query") -> DataFrame:
    """multi_match(title, content); rows carry title, url and the first 150
    characters of content followed by ``...``.  Docs are joined after top-k."""
    top = multi_match(index, queries, ["title", "content"], k, text_col)
    docs = index.docs.select("doc_id", "title", "url", F.concat(F.substring("content", 1, 150), F.lit("...")).alias("snippet"))
    return top.join(docs, "doc_id").select(
        "query_id",
        "doc_id",
        "score",
        "rank",
        "title",
        "url",
        "snippet",
    )
