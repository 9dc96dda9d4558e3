"""One collecting run: index entries to bronze contents, manifest and messages."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.collect import RUN_CAP, bronze_plan, split_known
from ..operators.routing import filing_outcome
from ..sinks import enqueue, manifest, write_bronze
from ..sources.fetch import fetched

Fetch = Callable[[str], tuple[int, bytes]]


def collect_run(entries: DataFrame, fetch: Fetch, path: str, queue: str | None, chamber: str, ext: str, mark: bytes = b"", cap: int = RUN_CAP, pace=None) -> DataFrame:
    """The run's outcomes (doc_id, year, action, bronze_key, outcome ...) for entries (doc_id, year, kind, index_row, source_url).

    Ids in the manifest are not asked for again. The last outcome may be an answer that was not cleared: it has action
    ``blocked``, nothing of it is kept and the run ends with it. Without a queue no message is written."""
    spark = entries.sparkSession
    known = manifest(spark, path).where(F.col("chamber") == chamber)
    new, _ = split_known(entries, known)
    answers = fetched(new, fetch, mark, cap, pace).withColumn("outcome", _outcome(mark))
    planned = bronze_plan(answers, known.select("doc_id", "sha256"), chamber, ext).withColumns({"chamber": F.lit(chamber), "ext": F.lit(ext)})
    judged = planned.withColumn("action", F.when(F.col("outcome") == "cleared", F.col("action")).otherwise("blocked"))
    # What is not cleared has neither content nor manifest row.
    outcomes = write_bronze(judged.withColumn("content", F.when(F.col("action") != "blocked", F.col("content"))), path, uuid.uuid4().hex)
    if queue is not None:
        enqueue(outcomes, queue)
    return outcomes


def _outcome(mark: bytes) -> Column:
    """cleared, error, or what kind of refusal it is."""
    text = F.coalesce(F.make_valid_utf8(F.col("content").cast("string")), F.lit(""))
    held = F.contains(F.col("content"), F.lit(mark)) if mark else F.lit(True)
    refused = filing_outcome(F.col("status"), text)
    return F.when(F.col("error").isNotNull(), "error").when((F.col("status") == 200) & held, "cleared").when(F.col("status") == 200, "ambiguous").otherwise(refused)


def distinct_years(entries: DataFrame) -> DataFrame:
    """years, sorted: the years that a run's index names (a few)."""
    return entries.select("year").distinct().agg(F.array_sort(F.collect_list("year")).alias("years"))


def run_result(outcomes: DataFrame) -> DataFrame:
    """written, unchanged and the outcome that ended the run (null if none did) in one row."""
    stop = F.max(F.when(F.col("action") == "blocked", F.col("outcome")))
    return outcomes.agg(F.count_if(F.col("action").isin("write", "versioned")).alias("written"), F.count_if(F.col("action") == "noop").alias("unchanged"), stop.alias("stopped_by"))
