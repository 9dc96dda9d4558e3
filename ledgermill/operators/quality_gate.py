"""Run summaries and the gate before silver is overwritten."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import REQUIRED

DROP = 0.5
_FAILURE = "struct<reason:string,detail:string>"


def run_summary(rows: DataFrame, required: tuple[str, ...] = REQUIRED, announced: Column | None = None) -> DataFrame:
    """One row: row_count, null_counts (map), announced_count."""
    nulls = F.create_map(*(x for name in required for x in (F.lit(name), F.count_if(F.col(name).isNull()))))
    return rows.agg(F.count("*").alias("row_count"), nulls.alias("null_counts")).withColumn("announced_count", F.lit(None).cast("long") if announced is None else announced)


def volume_failure(prior: Column, current: Column, threshold: float = DROP) -> Column:
    """A drop of more than the threshold against a prior run that had rows."""
    drop = (prior - current) / prior
    return F.when((prior > 0) & (drop > threshold), F.struct(F.lit("volume_regression").alias("reason"), F.format_string("%d rows after %d", current, prior).alias("detail")))


def completeness_failure(null_counts: Column) -> Column:
    """Required columns that hold nulls, all of them named."""
    bad = F.map_filter(null_counts, lambda _, n: n > 0)
    return F.when(F.size(bad) > 0, F.struct(F.lit("incomplete").alias("reason"), F.array_join(F.array_sort(F.map_keys(bad)), ",").alias("detail")))


def divergence_failure(announced: Column, current: Column) -> Column:
    return F.when(announced != current, F.struct(F.lit("row_count_divergence").alias("reason"), F.format_string("%d rows, %d announced", current, announced).alias("detail")))


def gate(summaries: DataFrame, prior: str = "prior_count", threshold: float = DROP) -> DataFrame:
    """Adds ``failures`` (volume, completeness, divergence, in this order) and ``passed``."""
    checks = [volume_failure(F.col(prior), F.col("row_count"), threshold), completeness_failure(F.col("null_counts")), divergence_failure(F.col("announced_count"), F.col("row_count"))]
    failures = F.array_compact(F.array(*(x.cast(_FAILURE) for x in checks)))
    return summaries.withColumn("failures", failures).withColumn("passed", F.size("failures") == 0)


