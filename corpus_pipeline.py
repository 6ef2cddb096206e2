"""From raw documents to token pieces: quality, near-duplicates, benchmark leaks, secrets, encoding.

Each stage works on all rows that the one before it kept, and returns the
columns of ``documents``; the last one returns the encoded rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from modelspend.llm import op01_benchmark_wand as leaks
from modelspend.llm import op03_simhash_bktree as copies
from modelspend.llm import op04_piece_sampling as pieces
from modelspend.llm import op08_quality_outliers as quality
from modelspend.llm import op10_linked_credentials as secrets
from modelspend.llm.shared import read_table, stage

def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed rules and the outlier estimate keep."""
    return quality.keep_good(docs)


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that of the smallest doc_id."""
    return copies.first_rows(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return leaks.without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every found secret replaced."""
    return secrets.redacted(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled pieces of every text; the text itself is what they decode to."""
    return pieces.encode_documents(docs, tuple(c for c in docs.columns if c != "text"))


STAGES = [
    ("quality rules", keep_good),
    ("near-duplicates", keep_first_copies),
    ("benchmark leaks", drop_leaks),
    ("secrets", redact_secrets),
    ("pieces", encode),
]

#: Outlier iterations, components and sampled lattices have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
