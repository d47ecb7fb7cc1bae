"""A corpus pipeline over ``documents``: five stages, each one operator of
``barlab.llm`` on everything that the stage before it kept.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; :func:`run`
writes it as Parquet to the shared folder and gives it, read again, to the next.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.llm import bpe, decontaminate, lang_id, line_dedup, near_dup
from barlab.llm.queries import table, tokenizer_path
from barlab.llm.scratch import stored

# Hash-based statistics, model fits and BPE have no SQL form; tests/llm compares
# the rows with brute force.
ORACLE_SQL = None


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a recognisable language; ``und`` goes, and so does a text
    that shares no n-gram with any profile (score 0)."""
    profiles = lang_id.train_profiles(docs.where(lang_id.is_training_row()))
    found = lang_id.identify(docs, profiles)
    return found.where((F.col("lang_pred") != lang_id.UND) & (F.col("score") > 0)).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that at least three documents hold, but for the
    last of them; ``n_chars`` follows."""
    rows = line_dedup.dedup_lines(docs).select(*docs.columns)
    return rows.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else rows


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return near_dup.drop_near_dups(docs)


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text (little-endian uint32), and whether they decode to it."""
    rows = bpe.encode_and_decode(docs.select("doc_id", "text"), tokenizer_path())
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return rows.select("doc_id", "n_tokens", "ids", same.alias("round_trip"))


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("near_dup", near_dup_stage),
    ("decontaminate", leak_stage),
    ("bpe", token_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
