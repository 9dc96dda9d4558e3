"""Collecting: which indexed documents are new, and what is written for them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import bronze_key, bronze_versioned_key

#: Documents that one run fetches at most; the rest stays for the next.
RUN_CAP = 300


def split_known(entries: DataFrame, known: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(new, skipped) index entries. A new id that the index lists twice stays twice: the last write wins."""
    ids = known.select(key).distinct()
    return entries.join(ids, key, "left_anti"), entries.join(ids, key, "left_semi")


def capped(entries: DataFrame, cap: int = RUN_CAP) -> DataFrame:
    """The first entries in index order."""
    return entries.orderBy("index_row").limit(cap)


def bronze_plan(fetched: DataFrame, recorded: DataFrame, chamber: str, ext: str) -> DataFrame:
    """fetched (doc_id, year, content) with sha256, action and key: write where no hash is recorded (doc_id, sha256),
    noop at the same hash, versioned at another."""
    prior = recorded.groupBy("doc_id").agg(F.max("sha256").alias("prior"))
    hashed = fetched.withColumn("sha256", F.sha2("content", 256)).join(prior, "doc_id", "left")
    action = F.when(F.col("prior").isNull(), "write").when(F.col("prior") == F.col("sha256"), "noop").otherwise("versioned")
    parts = F.lit(chamber), F.col("year"), F.col("doc_id")
    key = F.when(action == "versioned", bronze_versioned_key(*parts, F.col("sha256"), F.lit(ext))).otherwise(bronze_key(*parts, F.lit(ext)))
    return hashed.withColumns({"action": action, "bronze_key": key}).drop("prior")


def run_counters(outcomes: DataFrame) -> DataFrame:
    """Number of rows for each action."""
    return outcomes.groupBy("action").agg(F.count("*").alias("n"))
