"""Corpus pipeline: quality rules, toxicity, near-duplicates, personal data, packing.

Each stage takes the documents that its predecessor kept, written as Parquet and reread; all but the
last return the columns of ``documents``. The last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgermill.llm.common import discard, materialise, scratch, table
from ledgermill.llm.near_copies import keep_one
from ledgermill.llm.packing import pack
from ledgermill.llm.pii import redact
from ledgermill.llm.quality import keep_good
from ledgermill.llm.toxicity import keep_clean


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under 0.5."""
    return keep_clean(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id: SimHash components and MinHash
    keys of 5-word shingles find candidates, exact similarity of 0.8 decides."""
    return keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 2048 tokens."""
    return pack(docs)


STAGES = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: Trained scores and tokenised packing have no SQL; tests hold each stage against a brute-force version of its operator.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed pieces. A stage's own tables go when its output is written, and that when the next stage has read it; those of
    the last stage and its input stay until the result has been read (see scratch())."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before = docs
        with scratch():
            docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
