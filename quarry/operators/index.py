"""Inverted index as ordinary tables.

``build_index`` turns a docs DataFrame into

* ``postings``    (field, term, doc_id, tf, dl, positions) one row per (term, doc)
* ``doc_len``     (field, doc_id, len)
* ``field_stats`` (field, n_docs, avg_len)   docs with a non-empty field only
* ``term_stats``  (field, term, df)
* ``bounds``      (shard, field, term, df, top)  largest impact of a term in a shard

Documents are dealt to shards by a hash of ``doc_id`` before they are
analysed; postings are cut per document from its token array where it lies
and written bucketed by ``doc_id``, so a shard is one task of every later scan
and scores its documents alone.  The doc length rides on every posting, so
scoring never joins back to a per-document table.  ``analyze`` gives one row per token where a token table
is wanted (query analysis, the ``tokenize`` operator).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field as dfield

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from quarry.functions import text as T

STANDARD = "standard"
URL = "url"
KEYWORD = "keyword"

# Text bytes of a shard, and the most shards (the bucket limit of a table).
SHARD_BYTES = 64 << 20
MOST_SHARDS = 100_000
# BM25 (k1, b), as the search scores.
K1 = 1.2
B = 0.75

# Default word-run pattern for dictionary segmentation: runs of Han characters.
HAN_RUN = r"\p{IsHan}+"


@dataclass(frozen=True)
class Dictionary:
    """Dictionary analyzer: every dictionary word inside a run of text.

    ``words`` is a one-column DataFrame ``word``.  Runs are found with
    ``run_pattern``; text outside runs is analysed with the standard analyzer.
    Characters of a run covered by no dictionary word are single-character
    tokens.  Token position = ordinal of the piece of text it comes from.
    """

    words: DataFrame
    run_pattern: str = HAN_RUN
    lowercase: bool = True


def column_tokens(c: Column, analyzer) -> Column:
    if analyzer == STANDARD:
        return T.standard_tokens(c)
    if analyzer == URL:
        return T.url_tokens(c)
    if analyzer == KEYWORD:
        return T.keyword_tokens(c)
    if isinstance(analyzer, Dictionary):
        return plain_tokens(c, analyzer)
    raise ValueError(f"not a column analyzer: {analyzer!r}")


def analyze(df: DataFrame, id_col: str, fields: dict[str, object], out_id: str = "doc_id") -> DataFrame:
    """Tokens ``(field, <out_id>, pos, term, dl)`` for the given text columns.

    ``fields`` maps a column name of ``df`` to its analyzer.
    """
    parts: list[DataFrame] = []
    col_fields = {f: a for f, a in fields.items() if not isinstance(a, Dictionary)}
    if col_fields:
        stacked = df.select(
            F.col(id_col).alias(out_id),
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit(f).alias("field"), column_tokens(F.coalesce(F.col(f), F.lit("")), a).alias("toks"))
                        for f, a in col_fields.items()
                    ]
                )
            ).alias("s"),
        ).select(out_id, "s.field", "s.toks")
        parts.append(
            stacked.select(
                "field", out_id, F.posexplode("toks").alias("pos", "term"), F.size("toks").alias("dl")
            )
        )
    for f, a in fields.items():
        if isinstance(a, Dictionary):
            seg = dictionary_segment(df.select(F.col(id_col).alias(out_id), F.col(f).alias("text")), out_id, "text", a)
            w_dl = seg.groupBy(out_id).agg(F.count(F.lit(1)).alias("dl"))
            parts.append(
                seg.join(w_dl, out_id).select(F.lit(f).alias("field"), out_id, "pos", "term", "dl")
            )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def build_postings(tokens: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(field, term, doc_id, tf, dl, positions)``; positions ascending."""
    return tokens.groupBy("field", "term", id_col, "dl").agg(
        F.count(F.lit(1)).alias("tf"), F.sort_array(F.collect_list("pos")).alias("positions")
    ).select("field", "term", id_col, "tf", "dl", "positions")


def term_stats(postings: DataFrame) -> DataFrame:
    """``(field, term, df)``: documents containing the term."""
    return postings.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))


def field_stats(doc_len: DataFrame) -> DataFrame:
    """``(field, n_docs, avg_len)`` over documents whose field has a term."""
    return (
        doc_len.filter(F.col("len") > 0)
        .groupBy("field")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.avg("len").alias("avg_len"))
    )


@dataclass
class SearchIndex:
    """The index tables plus the analyzer of every field."""

    docs: DataFrame
    analyzers: dict[str, object]
    tokens: DataFrame | None
    postings: DataFrame
    doc_len: DataFrame
    field_stats: DataFrame
    term_stats: DataFrame
    extra: dict = dfield(default_factory=dict)
    shards: int = 0  # postings are bucketed by doc_id into so many; 0: they aren't
    bounds: DataFrame | None = None

    def analyzer(self, f: str):
        return self.analyzers[f]

    @property
    def term_keys(self) -> list[str]:
        """Join keys from terms to postings: a persisted index adds the term
        bucket, so dynamic partition pruning reads only the buckets that
        hold a query term."""
        return ["field", "tb", "term"] if "term_buckets" in self.extra else ["field", "term"]

    def trigrams(self) -> tuple[DataFrame, DataFrame]:
        """``(gram, field, term)`` of the term dictionary and ``(gram, n)``, the
        terms of each; made when a wildcard search asks first."""
        if "trigrams" not in self.extra:
            from quarry.operators.common import materialize

            grams = materialize(self.term_stats.select(F.explode(T.term_trigrams("term")).alias("gram"), "field", "term"), "trigrams")
            self.extra["trigrams"] = grams, materialize(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "trigram_stats")
        return self.extra["trigrams"]

    def keyed(self, terms: DataFrame) -> DataFrame:
        """``terms`` with the bucket column when the index is bucketed."""
        b = self.extra.get("term_buckets")
        return terms if b is None else terms.withColumn("tb", term_bucket(F.col("term"), b))


# Tokens that are sorted at a time (a longer document alone).
CUT_TOKENS = 100_000


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings of whole documents: tokens are numbered, sorted by (document,
    term, position), and runs of equal ones cut out."""
    from quarry.operators.common import give_back

    for b in batches:
        ends = np.cumsum(b.column("toks").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < b.num_rows:
            before = ends[at - 1] if at else 0
            to = max(int(np.searchsorted(ends, before + CUT_TOKENS, "right")), at + 1)
            yield _cut_rows(b.slice(at, to - at))
            at = to
        del b
        give_back()


def _cut_rows(b: pa.RecordBatch) -> pa.RecordBatch:
    lens = b.column("toks").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    terms = b.column("toks").flatten().dictionary_encode()
    code, row = terms.indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(lens)), lens)
    if "at" in b.schema.names:
        pos = b.column("at").flatten().to_numpy()
        order = np.lexsort((pos, code, row))
    else:
        pos = np.arange(len(code)) - (np.cumsum(lens) - lens)[row]
        order = np.argsort(row * (len(terms.dictionary) + 1) + code, kind="stable")
    code, row, pos = code[order], row[order], pos[order].astype(np.int32)
    first = np.flatnonzero((np.diff(code, prepend=-1) != 0) | (np.diff(row, prepend=-1) != 0))
    offsets = np.append(first, len(code)).astype(np.int32)
    rows = pa.array(row[first])
    return pa.RecordBatch.from_arrays(
        [b.column("field").take(rows), terms.dictionary.take(pa.array(code[first])), b.column("doc_id").take(rows), pa.array(np.diff(offsets)), pa.array(lens[row[first]].astype(np.int32)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(pos))],
        names=["field", "term", "doc_id", "tf", "dl", "positions"],
    )


def doc_postings(stacked: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Postings straight from per-document token arrays, with no shuffle.

    ``stacked`` is ``(field, doc_id, toks[, at])``; a token's position is its
    place, or ``at``.  Documents are cut in Arrow batches: Spark's array
    functions call the interpreter for every token.
    """
    from quarry.operators.common import small_batches

    small_batches(stacked.sparkSession)
    places = ["at"] if "at" in stacked.columns else []
    kind = ST.StructType.fromDDL("field string, term string, doc_id long, tf int, dl int, positions array<int>")
    kind["doc_id"].dataType = stacked.schema[id_col].dataType
    cut = stacked.filter(F.size("toks") > 0).select("field", F.col(id_col).alias("doc_id"), "toks", *places).mapInArrow(_cut, kind)
    return cut if id_col == "doc_id" else cut.withColumnRenamed("doc_id", id_col)


def pair_postings(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Postings from ``(field, doc_id, pairs array<struct<t, i>>)`` (term,
    position) pairs of one document; see ``doc_postings``."""
    return doc_postings(df.select("field", id_col, F.col("pairs.t").alias("toks"), F.col("pairs.i").alias("at")), id_col)


def stacked_tokens(df: DataFrame, id_col: str, fields: dict[str, object]) -> DataFrame:
    """``(field, doc_id, toks)``: one row per document and field; a dictionary
    field's texts with a run have no tokens here."""
    return df.select(
        F.col(id_col).alias("doc_id"),
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(f).alias("field"), column_tokens(F.coalesce(F.col(f), F.lit("")), a).alias("toks"))
                    for f, a in fields.items()
                ]
            )
        ).alias("s"),
    ).select("s.field", "doc_id", "s.toks")


def shard_count(docs: DataFrame, fields: list[str]) -> int:
    """Shards for the text of ``docs``: by its size, one per task slot at least."""
    size = docs.select(sum((F.coalesce(F.octet_length(F.col(f).cast("string")), F.lit(0)) for f in fields), F.lit(0)).cast("long").alias("n")).agg(F.sum("n")).first()[0] or 0
    return min(max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // SHARD_BYTES)), MOST_SHARDS)


def impact_bounds(postings: DataFrame, stats: DataFrame, shards: int) -> DataFrame:
    """``(shard, field, term, df, top)``: the shard's documents with the term,
    and the largest share of the term's weight that one of them gets,
    ``tf / (tf + k1 * (1 - b + b * dl / avg))``."""
    from quarry.operators.common import shard_of

    share = F.col("tf") / (F.col("tf") + K1 * (1 - B) + K1 * B * F.col("dl") / F.col("avg_len"))
    scored = postings.join(F.broadcast(stats.select("field", "avg_len")), "field")  # a row per field
    return scored.groupBy(shard_of("doc_id", shards).alias("shard"), "field", "term").agg(F.count(F.lit(1)).alias("df"), F.max(share).alias("top"))


def build_index(docs: DataFrame, fields: dict[str, object], id_col: str = "doc_id", materialized: bool = True, shards: int | None = None) -> SearchIndex:
    """Index ``fields`` of ``docs``; ``docs`` keeps the stored columns.

    Column-analysed fields, and dictionary fields' texts without a run, get their
    postings per document (``doc_postings``); texts with a run go through token
    rows and one aggregation per document.
    ``materialized`` deals the documents to ``shards`` (see ``shard_count``)
    and writes the postings once, bucketed by document (see
    ``common.materialize_bucketed``), so every scan of a search plan reads
    them instead of re-analysing the text.
    """
    from quarry.operators.common import materialize, materialize_bucketed

    if id_col != "doc_id":
        docs = docs.withColumnRenamed(id_col, "doc_id")
    stored = docs
    if materialized:
        shards = shards or shard_count(docs, list(fields))
        docs = docs.select("doc_id", *fields).repartition(shards, "doc_id")
    dict_fields = {f: a for f, a in fields.items() if isinstance(a, Dictionary)}
    # (a text without a run of its dictionary's has no such tokens: its words
    # stand where they stand, and no row is made of them)
    parts = [doc_postings(stacked_tokens(docs, "doc_id", fields))]
    for f, a in dict_fields.items():
        # dictionary tokens come out as rows; gather them per document (few
        # keys) and cut postings from the pairs like any other field
        runs = docs.select("doc_id", F.col(f).alias("text")).filter(has_run(F.col("text"), a))
        seg = dictionary_segment(runs, "doc_id", "text", a)
        pairs = seg.groupBy("doc_id").agg(F.collect_list(F.struct(F.col("term").alias("t"), F.col("pos").alias("i"))).alias("pairs"))
        cut = pair_postings(pairs.select(F.lit(f).alias("field"), "doc_id", "pairs"))
        parts.append(cut.repartition(shards, "doc_id") if materialized else cut)
    postings = parts[0]
    for p in parts[1:]:
        postings = postings.unionByName(p)
    if materialized:
        postings = materialize_bucketed(postings, "postings", "doc_id", shards, ["field"])
    # one row per (field, doc) with a term; empty fields are not counted by
    # the field statistics anyway
    dl = postings.groupBy("field", "doc_id").agg(F.max("dl").alias("len"))
    stats, bounds = field_stats(dl), None
    terms = term_stats(postings)
    if materialized:
        # corpus statistics are part of the index: a search reads a few rows
        # of them instead of aggregating all postings again
        dl = materialize(dl, "doc_len")
        stats = materialize(field_stats(dl), "field_stats")
        bounds = materialize(impact_bounds(postings, stats, shards), "bounds")
        terms = materialize(bounds.groupBy("field", "term").agg(F.sum("df").alias("df")), "term_stats")
    return SearchIndex(
        docs=stored,
        analyzers=dict(fields),
        tokens=None,
        postings=postings,
        doc_len=dl,
        field_stats=stats,
        term_stats=terms,
        shards=shards if materialized else 0,
        bounds=bounds,
    )


def term_bucket(term, buckets: int):
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def write_index(index: SearchIndex, path: str, term_buckets: int = 16) -> None:
    """Persist the index.  Postings are partitioned by field and a hash bucket
    of the term, so a lookup of a few terms reads their partitions only, and
    inside those bucketed by document, so a shard still scores
    alone.

    Every build goes to a version folder of its own; the small pointer table
    ``current`` is switched last, so readers see the old index or the new one,
    and a smaller rebuild leaves no posting of a larger one behind."""
    spark = index.docs.sparkSession
    base, version = path, f"v-{uuid.uuid4().hex}"
    path = f"{base}/{version}"
    postings = index.postings.withColumn("tb", term_bucket(F.col("term"), term_buckets))
    table = f"postings_{uuid.uuid4().hex}"
    postings.repartition(index.shards, "doc_id").write.format("parquet").partitionBy("field", "tb").bucketBy(index.shards, "doc_id").option("path", f"{path}/postings").saveAsTable(table)
    spark.sql(f"DROP TABLE {table}")  # of an external table only the catalog entry goes
    index.term_stats.write.mode("overwrite").parquet(f"{path}/term_stats")
    index.doc_len.write.mode("overwrite").partitionBy("field").parquet(f"{path}/doc_len")
    index.field_stats.write.mode("overwrite").parquet(f"{path}/field_stats")
    index.bounds.write.mode("overwrite").parquet(f"{path}/bounds")
    index.docs.write.mode("overwrite").parquet(f"{path}/docs")
    meta = spark.createDataFrame([(version, term_buckets, index.shards)], "version string, term_buckets int, shards int").coalesce(1)
    meta.write.mode("overwrite").json(f"{base}/current")


def read_index(spark, path: str, analyzers: dict[str, object]) -> SearchIndex:
    """The current version of the index written by ``write_index``; postings
    keep their ``field`` / ``tb`` partition columns, which the search joins use
    for pruning, and their buckets."""
    meta = spark.read.schema("version string, term_buckets int, shards int").json(f"{path}/current").first()
    path, table = f"{path}/{meta['version']}", f"postings_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{c}` {t}" for c, t in spark.read.parquet(f"{path}/postings").dtypes)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (field, tb) CLUSTERED BY (doc_id) INTO {meta['shards']} BUCKETS LOCATION '{path}/postings'")
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return SearchIndex(
        docs=spark.read.parquet(f"{path}/docs"),
        analyzers=dict(analyzers),
        tokens=None,  # not persisted; phrase search uses postings positions
        postings=spark.table(table),
        doc_len=spark.read.parquet(f"{path}/doc_len"),
        field_stats=spark.read.parquet(f"{path}/field_stats"),
        term_stats=spark.read.parquet(f"{path}/term_stats"),
        extra={"term_buckets": int(meta["term_buckets"])},
        shards=int(meta["shards"]),
        bounds=spark.read.parquet(f"{path}/bounds"),
    )


# --- dictionary segmentation ---------------------------------------------

def has_run(c: Column, analyzer: Dictionary) -> Column:
    """Whether a text has a run that the dictionary cuts."""
    text = F.coalesce(F.lower(c) if analyzer.lowercase else c, F.lit(""))
    return text.rlike("(?:" + analyzer.run_pattern + ")")


def plain_tokens(c: Column, analyzer: Dictionary) -> Column:
    """The tokens of a text without a run, whose pieces are its words (none of
    one with a run)."""
    text = F.lower(c) if analyzer.lowercase else c
    return F.when(~has_run(c, analyzer), F.regexp_extract_all(text, F.lit(T.WORD_PATTERN), 0)).otherwise(F.array().cast("array<string>"))


def dictionary_segment(df: DataFrame, id_col: str, text_col: str, analyzer: Dictionary) -> DataFrame:
    """``(id, pos, term, kind)`` for a dictionary analyzer.

    The text is cut into pieces: runs (``run_pattern``) and, between them,
    standard words.  Inside a run every substring no longer than the longest
    dictionary word is a candidate, semi-joined with the word table; the
    longest word length comes from the table itself (a one-row aggregate),
    so no word is missed.  Run characters covered by no word become
    single-character tokens (kind ``char``).  ``pos`` is the ordinal of the
    piece a token comes from, so tokens of one run share a position.
    """
    text = F.lower(F.col(text_col)) if analyzer.lowercase else F.col(text_col)
    words = analyzer.words.select(
        (F.lower("word") if analyzer.lowercase else F.col("word")).alias("term")
    ).filter(F.length("term") > 0).distinct()
    max_len = words.agg(F.max(F.length("term")).alias("max_len"))
    run = "(?:" + analyzer.run_pattern + ")"
    spaced = F.regexp_replace(text, "(" + run + ")", " $1 ")
    pieces = df.select(
        F.col(id_col).alias("_id"),
        F.posexplode(F.regexp_extract_all(spaced, F.lit(run + "|" + T.WORD_PATTERN), 0)).alias("pos", "piece"),
    ).withColumn("is_run", F.col("piece").rlike("^" + run + "$"))

    runs = pieces.filter("is_run")
    cands = (
        runs.crossJoin(F.broadcast(max_len))  # one row
        .select("_id", "pos", "piece", "max_len", F.explode(F.sequence(F.lit(1), F.length("piece"))).alias("i"))
        .select(
            "_id",
            "pos",
            "piece",
            "i",
            F.explode(F.sequence(F.lit(1), F.least(F.col("max_len"), F.length("piece") - F.col("i") + 1))).alias("n"),
        )
        .withColumn("term", F.substring("piece", F.col("i"), F.col("n")))
    )
    from quarry.operators.common import bounded_broadcast

    matched = cands.join(bounded_broadcast(words), "term", "left_semi")
    covered = matched.select("_id", "pos", F.explode(F.sequence(F.col("i"), F.col("i") + F.col("n") - 1)).alias("i")).distinct()
    chars = (
        runs.select("_id", "pos", "piece", F.explode(F.sequence(F.lit(1), F.length("piece"))).alias("i"))
        .join(covered, ["_id", "pos", "i"], "left_anti")
        .select("_id", "pos", F.substring("piece", F.col("i"), 1).alias("term"), F.lit("char").alias("kind"))
    )
    out = (
        matched.select("_id", "pos", "term", F.lit("word").alias("kind"))
        .unionByName(chars)
        .unionByName(pieces.filter(~F.col("is_run")).select("_id", "pos", F.col("piece").alias("term"), F.lit("word").alias("kind")))
    )
    return out.select(F.col("_id").alias(id_col), "pos", "term", "kind")
