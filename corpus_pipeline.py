"""The corpus pipeline: five stages over ``documents``, each one of the text operators.

Every stage is written as Parquet to the shared folder and read again as the next one's
input, so a stage starts from a stored table whatever happens to executors.

Edge cases: null, empty and very short texts go in the first stage, which asks for 50 words.
Very long texts pass every stage whole and are cut into pieces by the last one.  Of equal rows
one stays; in exact dedup a null doc_id loses to any other.  Further columns of the table, also
those named like a result, stay until the last stage, which returns the columns of a piece.  An
empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import best_fit, chosen_path, quality_lines, secret_scan, stream_dedup
from tidemark.llm.shared import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that break a rule go, then documents that fail or lose too much."""
    return quality_lines.cleaned_documents(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return stream_dedup.distinct_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of similar documents the one with the smallest doc_id stays."""
    return chosen_path.one_of_each_class(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; all documents stay."""
    return secret_scan.redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in a token sequence."""
    return best_fit.packed_pieces(docs)


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("secret scans", secrets),
    ("best-fit packing", packing),
]

#: Shingle joins and token packing have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
