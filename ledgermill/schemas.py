"""Table schemas, domains and row rules of the silver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Schemas are DDL strings: they need no session.
# The domains.
CHAMBERS = ("house", "senate")
OWNERS = ("self", "spouse", "joint", "dependent_child")
TRANSACTION_TYPES = ("purchase", "sale_full", "sale_partial", "exchange")
ASSET_TYPES = ("stock", "etf", "mutual_fund", "bond", "option", "cryptocurrency", "real_estate", "other")

MANIFEST = (
    "bronze_key string, source_url string, fetched_at string, sha256 string, chamber string, doc_id string, year int, ext string, index_row int, kind string"
)
FILINGS = (
    "doc_id string, chamber string, filer_name string, filing_date date, year int, confidence double, bronze_key string, extractor string"
)
TRANSACTIONS = (
    "doc_id string, line_no int, owner string, owner_raw string, transaction_type string, transaction_type_raw string, asset_type string,"
    " asset_description string, transaction_date date, value_min double, value_max double, confidence double, bronze_key string, extractor string,"
    " ticker string, notification_date date, filing_status string, sub_owner string, description string, disclosure_lag int"
)
GOLD = (
    "doc_id string, kind string, year int, transactions array<struct<line_no:int,owner:string,transaction_type:string,asset_type:string,"
    "asset_description:string,transaction_date:string,value_min:double,value_max:double,notification_date:string,filing_status:string,"
    "sub_owner:string,description:string>>"
)
#: Transaction columns that no row may lack, by the data model.
REQUIRED = ("doc_id", "line_no", "owner", "owner_raw", "transaction_type_raw", "asset_type", "asset_description", "transaction_date", "confidence", "bronze_key", "extractor")


def _broken(rules: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items())))


def _filled(name: str) -> Column:
    return F.length(name) > 0


def filing_violations() -> Column:
    confidence = F.col("confidence")
    return _broken({"doc_id": _filled("doc_id"), "chamber": F.col("chamber").isin(*CHAMBERS), "filer_name": _filled("filer_name"), "filing_date": F.col("filing_date").isNotNull(), "confidence": (confidence >= 0) & (confidence <= 1), "bronze_key": _filled("bronze_key"), "extractor": _filled("extractor")})


def transaction_violations() -> Column:
    confidence, low, high = F.col("confidence"), F.col("value_min"), F.col("value_max")
    kind = F.col("transaction_type")
    return _broken({
        "doc_id": _filled("doc_id"),
        "line_no": F.col("line_no") >= 1,
        "owner": F.col("owner").isin(*OWNERS),
        "transaction_type": kind.isNull() | kind.isin(*TRANSACTION_TYPES),
        "asset_type": F.col("asset_type").isin(*ASSET_TYPES),
        "asset_description": _filled("asset_description"),
        "transaction_date": F.col("transaction_date").isNotNull(),
        "value_range": (low.isNull() & high.isNull()) | ((low >= 0) & (high.isNull() | (high >= low))),
        "confidence": (confidence >= 0) & (confidence <= 1),
        "bronze_key": _filled("bronze_key"),
        "extractor": _filled("extractor"),
    })


def split_valid(filings: DataFrame, transactions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(filings, transactions, quarantine): one bad row keeps its whole document out."""
    bad = reduce(DataFrame.unionByName, [
        filings.select("doc_id", F.explode(filing_violations()).alias("reason")),
        transactions.select("doc_id", F.explode(transaction_violations()).alias("reason")),
    ])
    quarantine = bad.groupBy("doc_id").agg(F.array_sort(F.collect_set("reason")).alias("reasons"))
    ids = quarantine.select("doc_id")
    return filings.join(ids, "doc_id", "left_anti"), transactions.join(ids, "doc_id", "left_anti"), quarantine


def lookup(values: dict[str, str], key: Column, default: Column | None = None) -> Column:
    """values[key] as an expression, null or ``default`` where there is none."""
    found = F.try_element_at(F.create_map(*(F.lit(x) for pair in values.items() for x in pair)), key)
    return found if default is None else F.coalesce(found, default)
