"""Queue and storage events that name documents to extract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EVENT = "bronze_key string, Records array<struct<eventSource:string,messageId:string,body:string,s3:struct<object:struct<key:string>>>>"


def queue_message(key: Column) -> Column:
    return F.to_json(F.struct(key.alias("bronze_key")))


def decoded_messages(events: DataFrame, with_body: bool = False) -> DataFrame:
    """bronze_key, message_id, error (and, if asked for, the body) of every record of (body), in order; unknown shapes give an error row.
    Other columns of the events stay beside each of their records."""
    rest = [x for x in events.columns if x != "body"]
    none = F.lit(None).cast("string")
    parsed = events.select(F.from_json("body", EVENT).alias("e"), "body", *rest)
    direct = parsed.where(F.col("e.bronze_key").isNotNull()).select(F.col("e.bronze_key").alias("bronze_key"), none.alias("message_id"), none.alias("error"), "body", *rest)
    other = parsed.where(F.col("e.bronze_key").isNull())
    unknown = other.where(F.col("e.Records").isNull()).select(none.alias("bronze_key"), none.alias("message_id"), F.lit("unrecognized_event").alias("error"), "body", *rest)
    records = other.select(F.explode("e.Records").alias("r"), "body", *rest)
    queued = F.from_json("r.body", "bronze_key string")["bronze_key"]
    stored = F.try_url_decode("r.s3.object.key")
    key = F.when(F.col("r.eventSource") == "aws:sqs", queued).when(F.col("r.eventSource") == "aws:s3", stored)
    named = records.select(key.alias("bronze_key"), F.when(F.col("r.eventSource") == "aws:sqs", F.col("r.messageId")).alias("message_id"), "body", *rest)
    checked = named.select("bronze_key", "message_id", F.when(F.col("bronze_key").isNull(), F.lit("unrecognized_record")).alias("error"), "body", *rest)
    found = direct.unionByName(unknown).unionByName(checked)
    return found if with_body else found.drop("body")
