from datetime import date
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from ledgermill.functions.dates import loose_date, stamp_date, us_date
from ledgermill.functions.house_form import asset_cell, looks_like_asset
from ledgermill.functions.keys import parsed_bronze_key
from ledgermill.functions.money import value_range
from ledgermill.functions.names import clean_asset_name, comparable_name, scanned_filer, senate_filer
from ledgermill.functions.similarity import near_exact, similarity
from ledgermill.functions.text import snake, unicode_findings


def one(spark, function, *texts):
    columns = [F.lit(x) for x in texts]
    return spark.range(1).select(function(*columns).alias("x")).first()["x"]


@pytest.mark.parametrize("text,low,high", [
    ("$1,001 - $15,000", 1001.0, 15000.0), ("$1,001  -\n$15,000", 1001.0, 15000.0), ("Over $50,000,000", 50000001.0, None), ("Spouse/DC Over $1,000,000", 1000001.0, None), ("$9.00", 9.0, 9.0), ("$250", 250.0, 250.0),
])
def test_value_range(spark, text, low, high):
    assert tuple(one(spark, value_range, text)) == (low, high)


@pytest.mark.parametrize("text", ["", "None (or less than $201)", "$1,001 -", "1,001 - 15,000"])
def test_value_range_unreadable(spark, text):
    assert one(spark, value_range, text) is None


def test_dates(spark):
    assert one(spark, us_date, "8/4/2026") == date(2026, 8, 4)
    assert one(spark, us_date, "13/4/2026") is None
    assert one(spark, us_date, "08/04/26") is None
    assert one(spark, loose_date, "8/4/26") == date(2026, 8, 4)
    assert one(spark, loose_date, "2/30/2026") is None
    assert one(spark, stamp_date, "x 4021 HAR 28 PH 5:39") == date(2021, 3, 28)
    assert one(spark, stamp_date, "2021 JUL 45 PM") is None


def test_asset_cell(spark):
    cell = one(spark, asset_cell, "SP Amgen Inc. - Common Stock (AMGN) [ST]")
    assert (cell.owner, cell.owner_raw, cell.asset_type, cell.ticker, cell.type_confidence) == ("spouse", "SP", "stock", "AMGN", 1.0)
    assert cell.description == "Amgen Inc. - Common Stock (AMGN) [ST]"
    bond = one(spark, asset_cell, "sp US Bill (912797KV9) [gs]")
    assert (bond.owner, bond.asset_type, bond.ticker) == ("self", "bond", None)
    plain = one(spark, asset_cell, "Some Fund")
    assert (plain.asset_type, plain.type_confidence) == ("other", 0.0)


def test_asset_text(spark):
    assert one(spark, looks_like_asset, "Apple Computer Inc")
    for bad in ("Apple", "12 34 56 7a", "Provide full name of it", "I was here today", "Example: Mega Corp"):
        assert not one(spark, looks_like_asset, bad)


def test_keys(spark):
    assert tuple(one(spark, parsed_bronze_key, "bronze/senate/year=2025/ab-c.12345678.html.meta.json")) == ("senate", 2025, "ab-c")
    assert one(spark, parsed_bronze_key, "silver/x/year=2025/a.b") is None


def test_names(spark):
    assert one(spark, senate_filer, "Mr. John Q Public (Public, John)") == "John Q Public"
    assert one(spark, senate_filer, "(x)") is None
    assert one(spark, scanned_filer, "NAME: Hon. Jane Doe OFFICE TELEPHONE 1") == "Hon. Jane Doe"
    assert one(spark, scanned_filer, "nothing") is None
    assert one(spark, clean_asset_name, "Amgen Inc. - Common Stock (AMGN) [ST]") == "Amgen Inc. - Common Stock"
    assert one(spark, comparable_name, "The Amgen Inc. - Common Stock") == "amgen"
    assert one(spark, snake, " Sale (Full) ") == "sale_full"


def test_similarity_is_difflib(spark):
    pairs = [("tide", "diet"), ("diet", "tide"), ("", "x"), ("a" * 300 + "b", "a" * 299 + "cb"), ("same", "same")]
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", similarity("a", "b").alias("r")).collect()
    assert all(x.r == SequenceMatcher(None, x.a, x.b).ratio() for x in rows) and len(rows) == 5
    assert one(spark, near_exact, "Alphabet Inc", "The Alphabet Corp")
    assert not one(spark, near_exact, "Inc", "Corp")


def test_unicode(spark):
    assert one(spark, unicode_findings, "﻿a​b‮�") == ["bom", "replacement", "zero_width_space", "bidi_control"]
    assert one(spark, unicode_findings, "clean é") == []
