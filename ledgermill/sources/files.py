"""Documents as files, and sets of known documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import parsed_bronze_key
from ..schemas import GOLD


def bronze_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, content and the parts of the key under ``bronze/`` of each file; content is read only where it is selected."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    key = F.regexp_extract("path", r"(bronze/.*)$", 1)
    return files.select("path", "content", key.alias("bronze_key"), parsed_bronze_key(key).alias("parts")).select("path", "content", "bronze_key", "parts.*")


def known_doc_ids(manifest: DataFrame, chamber: str, year: int | None = None) -> DataFrame:
    """Distinct ids of a chamber, of one year if it is given; keys of another form are passed over."""
    parts = manifest.select(parsed_bronze_key(F.col("bronze_key")).alias("p")).where(F.col("p.chamber") == chamber)
    kept = parts if year is None else parts.where(F.col("p.year") == year)
    return kept.select("p.doc_id").distinct()


def gold_records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(filings, transactions) of the gold files of a folder; a filing without transactions stays a filing."""
    gold = spark.read.schema(GOLD).option("multiLine", True).json(path)
    lines = gold.select("doc_id", F.posexplode("transactions").alias("position", "t")).select("doc_id", "position", "t.*")
    dated = lines.withColumns({x: F.to_date(x, "yyyy-MM-dd") for x in ("transaction_date", "notification_date")})
    return gold.select("doc_id", "kind", "year"), dated
