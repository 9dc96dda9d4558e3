"""Ids that earlier runs have collected, in a table of buckets: a run joins it where it lies and appends its own.

The join deals the run's entries to the buckets and does not move the known side, whatever it has grown to."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

KNOWN = "doc_id string, year int, sha256 string"
BUCKETS = 64


def known_table(spark: SparkSession, path: str, buckets: int = BUCKETS) -> str:
    """The name, in this session's catalog, of the table in a folder, which may be empty or hold earlier runs."""
    name = f"known_{hashlib.sha256(path.encode()).hexdigest()[:16]}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({KNOWN}) USING parquet CLUSTERED BY (doc_id) SORTED BY (doc_id) INTO {buckets} BUCKETS LOCATION '{path}'")
    return name


def remember(rows: DataFrame, name: str, buckets: int = BUCKETS) -> None:
    """Appends (doc_id, year, sha256): one file a bucket."""
    rows.select(*(x.split()[0] for x in KNOWN.split(", "))).repartition(buckets, "doc_id").write.insertInto(name)
    rows.sparkSession.catalog.refreshTable(name)


def new_entries(entries: DataFrame, name: str) -> DataFrame:
    """Entries whose doc_id the table does not hold."""
    return entries.join(entries.sparkSession.table(name).select("doc_id").hint("merge"), "doc_id", "left_anti")
