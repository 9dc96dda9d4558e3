"""Incremental extraction: documents named by messages, in micro-batches.

Delivery is at least once and the sink replaces whole documents, so a batch may be run again. A document
that fails, or whose batch the gate holds back, goes to the quarantine table with its reason, its message and
its attempts and does not stop its batch; a message that names no document is kept whole under the hash of its
body. ``redelivered`` gives what is not dead yet back as messages. A batch that raises leaves a line in the run log.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.keys import parsed_bronze_key
from ..shared import counted, held, holding
from ..sinks import dead_letters, write_silver
from ..sources.messages import decoded_messages
from .run_log import logged

Extract = Callable[[DataFrame], tuple[DataFrame, DataFrame, DataFrame]]


def message_stream(spark: SparkSession, folder: str, files_a_batch: int = 100) -> DataFrame:
    """Message files (one JSON a line) of a folder, as they come, with the time at which each came."""
    lines = spark.readStream.schema("value string").option("maxFilesPerTrigger", files_a_batch).text(folder)
    return lines.select(F.col("value").alias("body"), F.col("_metadata.file_modification_time").alias("arrived"))


def _unnamed(body: Column) -> Column:
    """The id of a message that names no document."""
    return F.concat(F.lit("message-"), F.sha2(F.coalesce(body, F.lit("")), 256))


def _told(batch: DataFrame) -> DataFrame:
    """bronze_key, error, body, arrival of every record of a batch: the order of arrival is that of time, then place in the batch."""
    at = F.unix_micros("arrived") * 1000 if "arrived" in batch.columns else F.lit(None).cast("long")
    return decoded_messages(batch.select("body", F.struct(at.alias("arrived"), F.monotonically_increasing_id().alias("place")).alias("arrival")), with_body=True)


def batch_writer(load: Callable[[DataFrame], DataFrame], extract: Extract, silver: str, quarantine: str, gate: Callable[[DataFrame], bool] | None = None, tell: Callable[[str], None] = print, outcomes: str | None = None):
    """foreachBatch function: load(keys) gives documents (doc_id, bronze_key, content); the gate, if any, must pass before silver is replaced.

    Of the keys that name one document (its versions) the one that arrived last is extracted, the others are done with it.
    A key without an object and a message that cannot be read are quarantined. ``outcomes`` is a folder for what became of
    each document, for ``streaming.attempts``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        with logged("extract", tell, batch=batch_id) as event, holding():
            event.update(taken(batch, batch_id))

    def taken(batch: DataFrame, batch_id: int) -> dict:
        spark = batch.sparkSession
        keys = held(_told(batch))
        named = keys.where(F.col("error").isNull()).groupBy("bronze_key").agg(F.max_by("body", "arrival").alias("body"), F.max("arrival").alias("arrival"))
        loaded = held(load(named.select("bronze_key")))
        there = loaded.select("doc_id", "bronze_key").join(named, "bronze_key")
        newest = there.groupBy("doc_id").agg(F.max_by(F.struct("bronze_key", "body", "arrival"), F.struct("arrival", "bronze_key")).alias("m")).select("doc_id", "m.*")
        documents = loaded.join(newest.select("doc_id", "bronze_key"), ["doc_id", "bronze_key"], "left_semi")
        filings, transactions, failed = extract(documents)
        transactions, failed = held(transactions), held(failed)
        passed = gate is None or gate(transactions)
        lost = failed.select("doc_id", F.array_join("reasons", ",").alias("reason"))
        good = newest.join(failed.select("doc_id"), "doc_id", "left_anti")
        event = {"outcome": "success" if passed else "gate"}
        if passed:
            event |= write_silver(filings, transactions, good.select("doc_id", "bronze_key", "arrival.arrived"), silver)
        else:
            lost = lost.unionByName(good.select("doc_id", F.lit("quality_gate").alias("reason")))
        lost = lost.join(newest, "doc_id").select("doc_id", "reason", "body")
        absent = named.join(loaded.select("bronze_key"), "bronze_key", "left_anti")
        absent = absent.select(F.coalesce(parsed_bronze_key(F.col("bronze_key"))["doc_id"], _unnamed(F.col("body"))).alias("doc_id"), F.lit("no_object").alias("reason"), "body")
        unread = keys.where(F.col("error").isNotNull()).select(_unnamed(F.col("body")).alias("doc_id"), F.col("error").alias("reason"), "body")
        lost = held(lost.unionByName(absent).unionByName(unread))
        if outcomes is not None:
            # The files of a batch that is run again come beside the old ones; who reads them takes a batch once.
            done = good.select("doc_id", F.lit(True).alias("ok"), F.lit(None).cast("string").alias("reason"), "body") if passed else lost.limit(0).withColumn("ok", F.lit(True)).select("doc_id", "ok", "reason", "body")
            every = done.unionByName(lost.select("doc_id", F.lit(False).alias("ok"), "reason", "body"))
            every.select("doc_id", F.lit(batch_id).cast("long").alias("batch_id"), F.current_timestamp().alias("at"), "ok", "reason", "body").write.mode("append").parquet(outcomes)
        return event | record_failures(spark, lost, quarantine, batch_id)

    return write


QUARANTINE = "doc_id string, attempts long, reason string, dead boolean, body string, batch_id long"


def _quarantined(spark: SparkSession, quarantine: str) -> DataFrame:
    place = spark._jvm.org.apache.hadoop.fs.Path(quarantine)
    there = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
    return spark.read.schema(QUARANTINE).parquet(quarantine) if there else spark.createDataFrame([], QUARANTINE)


def record_failures(spark: SparkSession, failures: DataFrame, quarantine: str, batch_id: int) -> dict[str, int]:
    """Writes this batch's failures over what the same batch wrote before, with attempts counted over all other batches;
    gives their numbers as the write counts them."""
    earlier = _quarantined(spark, quarantine).where(F.col("batch_id") != batch_id)
    prior = earlier.groupBy("doc_id").agg(F.max("attempts").alias("attempts"))
    bodies = failures.groupBy("doc_id").agg(F.max("body").alias("body"))
    found = Observation(f"failures-{uuid.uuid4().hex}")
    counts = {"failed": F.count(F.lit(1)), "dead": F.count_if("dead")} | {x: F.count_if(F.col("reason") == x) for x in ("no_object", "quality_gate")}
    out = dead_letters(failures, prior).join(bodies, "doc_id").withColumn("batch_id", F.lit(batch_id).cast("long"))
    observed = out.observe(found, *(c.alias(k) for k, c in counts.items()))
    observed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(quarantine)
    return counted(found, *counts)


def redelivered(spark: SparkSession, quarantine: str, batch_id: int) -> DataFrame:
    """(body) of the messages that the batch quarantined and that are not dead, to be put into the queue again."""
    return _quarantined(spark, quarantine).where((F.col("batch_id") == batch_id) & ~F.col("dead")).select("body")


def run_available(messages: DataFrame, writer, checkpoint: str) -> StreamingQuery:
    """Takes all that is there and ends; the checkpoint keeps what was taken."""
    query = messages.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def stale(run_log: DataFrame, now, periods: int = 2, hours: int = 24) -> DataFrame:
    """Stages without a success in the last periods: (stage, last_success)."""
    last = run_log.where(F.col("outcome") == "success").groupBy("stage").agg(F.max("at").alias("last_success"))
    every = run_log.select("stage").distinct().join(last, "stage", "left")
    return every.where(F.col("last_success").isNull() | (F.col("last_success") < F.lit(now) - F.make_interval(hours=F.lit(periods * hours))))
