"""Registered queries of the operators, with production parameters, over whole
tables.  Each derives the columns of its contract from its operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontaminate, interpolated_lm, license_scan, merkle, minhash, packing, partenum, quality_gbt, store, substring_dedup, token_file, toxicity, warc, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of 50-word windows that start in an earlier document, removed."""
    return substring_dedup.summary(_table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and tree verdict for every document."""
    return quality_gbt.assess(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_interpolated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document by a deleted-interpolation bigram model."""
    scored, n, _, _ = interpolated_lm.score(_table(spark, sf_dir, "documents"))
    return scored.select("doc_id", (F.col("fold") == 0).alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by 5-word shingles, similarity 0.75."""
    return partenum.groups(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-id files of all documents, written and read back."""
    manifest = token_file.write(_table(spark, sf_dir, "documents"), store.folder(spark, "token-files"))
    return token_file.read(manifest, token_file.checksums, token_file.CHECKSUMS)


def op6_warc_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as monolithic archives, normalised and read back."""
    raw = warc.write(_table(spark, sf_dir, "pages"), store.folder(spark, "warc"))
    return warc.read(warc.normalise(raw, store.folder(spark, "warc-members"))).drop("url", "html")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices in every document."""
    return license_scan.scan(_table(spark, sf_dir, "documents")).drop("matches")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = decontaminate.scan(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (hit > 0).alias("contaminated")
    )


def op9_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1,024 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels are learnt from the documents that
    aren't held out."""
    out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    documents = _table(spark, sf_dir, "documents")
    model = toxicity.train(documents, _table(spark, sf_dir, "labels").filter(~out))
    return toxicity.score(documents, model).select("doc_id", F.coalesce(out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight whitened components of every usable embedding."""
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by 5-word shingles, similarity 0.85."""
    return minhash.groups(_table(spark, sf_dir, "documents")).drop("sid")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's Merkle proof; where 7 divides the checksum of its
    doc_id, the proof is tried on a document with another n_chars."""
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.try_add(F.col("n_chars"), F.lit(1))).otherwise(F.col("n_chars"))
    return merkle.proofs(_table(spark, sf_dir, "documents"), {"n_chars": changed})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_interpolated_lm": op3_interpolated_lm,
    "op4_ngram_join": op4_ngram_join,
    "op5_token_files": op5_token_files,
    "op6_warc_members": op6_warc_members,
    "op7_license_scan": op7_license_scan,
    "op8_decontaminate": op8_decontaminate,
    "op9_pack_sequences": op9_pack_sequences,
    "op10_toxicity": op10_toxicity,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_minhash_dedup": op12_minhash_dedup,
    "op13_merkle_manifest": op13_merkle_manifest,
}
