"""Silver tables (documents replaced whole), bronze contents with their manifest, dead letters."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .functions.keys import parsed_bronze_key
from .schemas import FILINGS, MANIFEST, TRANSACTIONS
from .shared import counted
from .sources.messages import queue_message

#: Named apart from the data columns chamber and year: the path's year can differ from the filing's.
PARTITIONS = ("bronze_chamber", "bronze_year", "version")
#: Actions that leave a content behind.
NEW = ("write", "versioned")
#: Attempts at a message before it is dead.
DEAD_AFTER = 3
DONE = "doc_id string, arrived long, bronze_chamber string, bronze_year int, version long"


def _columns(ddl: str) -> list[str]:
    return [x.split()[0] for x in ddl.replace(",", ", ").split(", ") if x.strip()]


def _placed(rows: DataFrame, names: list[str], version: Column) -> DataFrame:
    key = parsed_bronze_key(F.col("bronze_key"))
    return rows.select(*names, key["chamber"].alias("bronze_chamber"), key["year"].alias("bronze_year"), version.alias("version"))


def write_silver(filings: DataFrame, transactions: DataFrame, documents: DataFrame, path: str, version: int | None = None) -> dict[str, int]:
    """Replaces ``documents`` (doc_id, bronze_key), also those that have no rows left; how many of each table were written,
    counted by the writes themselves.

    Rows are written under a new version, and last the list of the documents that it holds. Readers take of a document
    the listed version that arrived last, so a run that is lost half way leaves them what was there before. A document
    arrives when documents' ``arrived`` (nanoseconds) says so, else when it is written: one that is written late, after
    a newer one, does not replace it."""
    # Nanoseconds of the clock: a batch that is run again gets a later version.
    mark = F.lit(time.time_ns() if version is None else version).cast("long")
    counts = {name: Observation(f"{name}-{uuid.uuid4().hex}") for name in ("transactions", "filings", "documents")}
    for name, rows, ddl in (("transactions", transactions, TRANSACTIONS), ("filings", filings, FILINGS)):
        placed = _placed(rows, _columns(ddl), mark).observe(counts[name], F.count(F.lit(1)).alias("n"))
        placed.repartition(*PARTITIONS, F.pmod(F.xxhash64("doc_id"), F.lit(8))).write.mode("append").partitionBy(*PARTITIONS).parquet(f"{path}/{name}")
    arrived = F.coalesce("arrived", mark) if "arrived" in documents.columns else mark
    listed = _placed(documents.withColumn("arrived", arrived), ["doc_id", "arrived"], mark).dropDuplicates()
    listed.observe(counts["documents"], F.count(F.lit(1)).alias("n")).write.mode("append").parquet(f"{path}/done")
    return {name: counted(found, "n")["n"] for name, found in counts.items()}


def _newest(spark: SparkSession, path: str) -> DataFrame:
    """The version of each document that readers take."""
    last = F.max_by("version", F.struct(F.coalesce("arrived", "version"), "version"))
    return spark.read.schema(DONE).parquet(f"{path}/done").groupBy("doc_id", "bronze_chamber", "bronze_year").agg(last.alias("version"))


def read_silver(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A silver table with its partition columns, each document in its newest finished version; the ids stay strings."""
    ddl = FILINGS if name == "filings" else TRANSACTIONS
    rows = spark.read.schema(f"{ddl}, bronze_chamber string, bronze_year int, version long").parquet(f"{path}/{name}")
    return rows.join(_newest(spark, path), ["doc_id", "bronze_chamber", "bronze_year", "version"], "left_semi").select(*_columns(ddl), "bronze_chamber", "bronze_year", "version")


def expire(spark: SparkSession, path: str) -> int:
    """Removes the folders of versions that readers take no document from, and gives their number. A version that a run is
    still writing has no listed document yet and stays; readers that began before may lose what they read."""
    keys = list(PARTITIONS)
    finished = spark.read.schema(DONE).parquet(f"{path}/done").select(*keys).distinct()
    # One row a folder: as many as the table has partitions.
    gone = finished.join(_newest(spark, path).select(*keys).distinct(), keys, "left_anti").collect()
    removed = 0
    for name in ("transactions", "filings"):
        for row in gone:
            place = spark._jvm.org.apache.hadoop.fs.Path("/".join([path, name, *(f"{k}={row[k]}" for k in keys)]))
            removed += bool(place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True))
    return removed


def compact(spark: SparkSession, path: str, name: str, out: str, files_a_year: int = 1) -> None:
    """A copy of the newest versions with few files a chamber and year."""
    keys = ["bronze_chamber", "bronze_year"]
    rows = read_silver(spark, path, name).drop("version")
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(files_a_year)))
    salted.repartition(*keys, "_salt").drop("_salt").sortWithinPartitions("doc_id").write.partitionBy(*keys).parquet(out)


def write_bronze(planned: DataFrame, path: str, run: str) -> DataFrame:
    """Writes a run's plan (bronze_plan's columns with chamber, ext, source_url, fetched_at, index_row, kind) and gives the outcomes back.

    Contents go first, in one pass, so that nothing is fetched twice; the manifest rows of what is new follow as the mark
    that their contents are there. What is known under the same hash keeps no second content."""
    spark = planned.sparkSession
    new = F.col("action").isin(*NEW)
    planned.withColumn("content", F.when(new, F.col("content"))).write.parquet(f"{path}/contents/run={run}")
    kept = spark.read.parquet(f"{path}/contents/run={run}")
    listed = kept.where(new).select(*(F.col(x).cast("string") if x == "fetched_at" else F.col(x) for x in _columns(MANIFEST)))
    listed.write.mode("append").parquet(f"{path}/manifest")
    return kept.drop("content")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """All manifest rows of a bronze folder, none if there is no run yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest")
    there = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest") if there else spark.createDataFrame([], MANIFEST)


def enqueue(outcomes: DataFrame, queue: str) -> None:
    """One message for each document that was written, none for others, as lines of files in the queue's folder."""
    outcomes.where(F.col("action").isin(*NEW)).select(queue_message(F.col("bronze_key"))).write.mode("append").text(queue)


def dead_letters(failures: DataFrame, prior: DataFrame, most: int = DEAD_AFTER) -> DataFrame:
    """doc_id, attempts, reason, dead of failures (doc_id, reason) added to prior (doc_id, attempts)."""
    seen = failures.groupBy("doc_id").agg(F.count("*").alias("now"), F.max("reason").alias("reason"))
    total = F.coalesce("attempts", F.lit(0)) + F.col("now")
    return seen.join(prior.select("doc_id", "attempts"), "doc_id", "left").select("doc_id", total.alias("attempts"), "reason", (total >= most).alias("dead"))
