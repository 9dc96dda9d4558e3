"""Captured responses of the Senate's search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import grabbed
from ..operators.routing import senate_kind

# The shape of the site's responses, and the form of its addresses of filings (kind, id).
RESPONSE = "draw int, recordsTotal int, recordsFiltered int, data array<array<string>>"
LINK = r'href="/search/view/([a-z0-9_-]+(?:/[a-z0-9_-]+)?)/([0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12})/"'


def senate_entries(responses: DataFrame) -> DataFrame:
    """filing_id, year, kind, index_row of electronic periodic reports, from responses (data)."""
    rows = responses.select(F.posexplode("data").alias("index_row", "cells")).where(F.size("cells") >= 5)
    link, filed = F.get("cells", F.lit(3)), F.trim(F.get("cells", F.lit(4)))
    found = rows.select(
        grabbed(link, LINK, 2).alias("filing_id"),
        F.element_at(F.split(filed, "/"), -1).try_cast("int").alias("year"),
        senate_kind(grabbed(link, LINK)).alias("kind"),
        "index_row",
    )
    return found.where((F.col("kind") == "ptr") & F.col("filing_id").isNotNull() & F.col("year").isNotNull())


def read_senate_responses(spark, path: str) -> DataFrame:
    return spark.read.schema(RESPONSE).option("multiLine", True).json(path)
