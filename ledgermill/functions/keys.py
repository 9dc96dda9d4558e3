"""Storage keys and source addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BRONZE = r"^bronze/([^/]+)/year=(\d+)/([^./]+)\."


def bronze_key(chamber: Column, year: Column, doc_id: Column, ext: Column) -> Column:
    return F.concat(F.lit("bronze/"), chamber, F.lit("/year="), year.cast("string"), F.lit("/"), doc_id, F.lit("."), ext)


def bronze_versioned_key(chamber: Column, year: Column, doc_id: Column, sha256: Column, ext: Column) -> Column:
    return bronze_key(chamber, year, F.concat(doc_id, F.lit("."), F.substring(sha256, 1, 8)), ext)


def bronze_meta_key(key: Column) -> Column:
    return F.concat(key, F.lit(".meta.json"))


def silver_key(table: Column, chamber: Column, year: Column, doc_id: Column) -> Column:
    return F.concat(F.lit("silver/"), table, F.lit("/chamber="), chamber, F.lit("/year="), year.cast("string"), F.lit("/part-"), doc_id, F.lit(".parquet"))


def parsed_bronze_key(key: Column) -> Column:
    """struct<chamber, year, doc_id>, null if the key has another form."""
    part = lambda i: F.regexp_extract(key, BRONZE, i)
    return F.when(key.rlike(BRONZE), F.struct(part(1).alias("chamber"), part(2).try_cast("int").alias("year"), part(3).alias("doc_id")))


# Public addresses of the sources.
HOUSE_INDEX = "https://disclosures-clerk.house.gov/public_disc/financial-pdfs/%dFD.zip"
HOUSE_FILING = "https://disclosures-clerk.house.gov/public_disc/ptr-pdfs/%d/%s.pdf"
SENATE_FILING = "https://efdsearch.senate.gov/search/view/ptr/%s/"


def house_index_url(year: Column) -> Column:
    return F.format_string(HOUSE_INDEX, year)


def house_filing_url(year: Column, doc_id: Column) -> Column:
    return F.format_string(HOUSE_FILING, year, doc_id)


def senate_filing_url(filing_id: Column) -> Column:
    return F.format_string(SENATE_FILING, filing_id)
