"""The llm queries: each applies its operator, with production parameters, to
its whole table, and derives the digest columns where a contract names some."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.llm import bpe, decontaminate, lang_id, license_scan, line_dedup, merkle, near_dup, pu_quality, quality, resample, substring_dedup, token_shards, toxicity
from barlab.llm.scratch import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """Place of the public byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def sha256(col: str):
    return F.sha2(F.coalesce(F.col(col).cast("binary"), F.lit(b"")), 256)


def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token sequence's place in training order; the shards are written to a
    folder under ``spark.checkpoint.dir``."""
    import public_tokenizers

    docs, ranks = table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    return token_shards.write_shards(docs, scratch_dir(spark, "token-shards"), ranks, public_tokenizers.PATTERN, end_token=50256)


def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics of every text and the verdict of the line field."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = quality.label_lines(docs, quality.fit_field(docs, table(spark, sf_dir, "labels")))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every text, learned on the training rows' labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(lang_id.is_training_row())
    rows = toxicity.score(docs, toxicity.train(docs, labels))
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    return rows.select("doc_id", (~lang_id.is_training_row()).alias("held_out"), "score", predicted.alias("predicted"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that at least three documents hold, kept in the last of them only."""
    rows = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", sha256("text").alias("kept_sha256"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 200-byte strings that occur more than once."""
    rows = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate(F.zip_with("span_end", "span_start", lambda e, s: e - s), F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("span_start").cast("long").alias("n_spans"), sha256("kept").alias("kept_sha256"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact BPE ids of every text, and the text that they decode to."""
    rows = bpe.encode_and_decode(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())
    return rows.select("doc_id", "n_tokens", sha256("ids").alias("ids_sha256"), sha256("decoded").alias("decoded_sha256"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text by rank-order profiles learned on the training rows."""
    docs = table(spark, sf_dir, "documents")
    profiles = lang_id.train_profiles(docs.where(lang_id.is_training_row()))
    rows = lang_id.identify(docs.select("doc_id", "text"), profiles)
    return rows.select("doc_id", (~lang_id.is_training_row()).alias("held_out"), "lang_pred", "score")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, re-parameterised ones included."""
    return decontaminate.find_all_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document; ``kept`` is true for the one that stands for it."""
    rows = near_dup.near_dup_classes(table(spark, sf_dir, "documents"))
    kept = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("digest") == F.col("class_digest"))
    return rows.select("doc_id", "class_id", "similar", kept.alias("kept"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that each whole text names."""
    rows = license_scan.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_known", F.array_join("licenses", ",").alias("licenses"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the manifest, and whether a tampered copy shows."""
    docs = table(spark, sf_dir, "documents")
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, merkle.leaf_hash(text=lower))
    rows = merkle.build(docs, keep={"tampered": tampered}).proofs()
    rows = rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_hash().alias("proof_sha256"), merkle.fold(F.coalesce("tampered", "leaf")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text, learned from the training rows' good documents."""
    learned = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    good = table(spark, sf_dir, "labels").where(learned & (F.col("quality") == 1))
    rows = pu_quality.classify(table(spark, sf_dir, "documents").select("doc_id", "text"), good)
    predicted = (F.col("score") >= pu_quality.THRESHOLD).cast("int")
    return rows.select("doc_id", F.coalesce(~learned, F.lit(False)).alias("held_out"), "score", predicted.alias("predicted"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents drawn towards the benchmark's word distribution."""
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_token_shards, op2_line_quality, op3_toxicity, op4_line_dedup, op5_substring_dedup, op6_bpe, op7_language_id, op8_decontaminate, op9_near_dup, op10_license_scan, op11_merkle_manifest, op12_quality_classifier, op13_importance_resampling)}
ORACLE_SQL = {"op4_line_dedup": line_dedup.ORACLE_SQL, "op10_license_scan": license_scan.ORACLE_SQL, "op11_merkle_manifest": merkle.ORACLE_SQL, "op13_importance_resampling": resample.ORACLE_SQL}
