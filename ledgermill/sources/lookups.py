"""Ticker lookups: ranked search responses and the company listing, as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEARCH = "data array<struct<figi:string,ticker:string,name:string,exchCode:string>>, error string"
COMPANIES = "map<string,struct<cik_str:long,ticker:string,title:string>>"


def search_candidates(responses: DataFrame) -> DataFrame:
    """query, rank, ticker, name from (query, body); entries without a ticker or a name are passed over, rank order stays."""
    entries = responses.select("query", F.posexplode(F.from_json("body", SEARCH)["data"]).alias("rank", "c"))
    return entries.select("query", "rank", "c.ticker", "c.name").where((F.col("ticker") != "") & (F.col("name") != ""))


def company_listing(listing: DataFrame) -> DataFrame:
    """position, ticker, title from (body), in the listing's order."""
    entries = listing.select(F.posexplode(F.map_values(F.from_json("body", COMPANIES))).alias("position", "c"))
    return entries.select("position", "c.ticker", "c.title").where((F.col("ticker") != "") & (F.col("title") != ""))
