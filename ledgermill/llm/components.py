"""Connected components of a link table by alternating large and small stars.

Links stay distributed; each round writes a table in the shared folder, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Large: each node ties its larger neighbours to its smallest; small: its smaller ones and itself."""
    if large:
        near = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
    else:
        near = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    tied = near.join(least, "u")
    if large:
        out = tied.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = tied.where(F.col("v") != F.col("m")).select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of the links (a, b): root is the smallest node of its component."""
    links = materialise(links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        sums = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sums[0] == 0 or sums == seen:
            break
        seen = sums
        larger = materialise(_stars(links, True), "stars")
        discard(links)
        links = materialise(_stars(larger, False), "stars")
        discard(larger)
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(links.select("b", "b").distinct())
