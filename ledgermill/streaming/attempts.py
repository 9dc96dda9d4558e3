"""Attempts at a document in state: redelivery when a timer fires, dead after the last attempt.

The stream of outcomes (one row an attempt) is grouped by document. A failure counts an attempt and sets a timer; when
event time passes it, the message goes out again, and the count stays until a success clears it. The last attempt makes
the message dead at once, and the count begins anew. Outcomes of a document are taken in order of time within a batch,
and a timer that is due before an outcome fires before it, so the result does not depend on how rows fall into batches.
The state holds the last outcome's id: one that is given again, by a batch that was run twice, counts once."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..sinks import DEAD_AFTER

OUTCOMES = "doc_id string, batch_id long, at timestamp, ok boolean, reason string, body string"
#: kind: redelivered or dead; at: when.
FATES = "doc_id string, at timestamp, kind string, attempts long, reason string, body string"
#: Seconds until a failed message is delivered again.
BACKOFF = 60
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Attempts(StatefulProcessor):
    def __init__(self, backoff: int, most: int) -> None:
        self.backoff, self.most = 1000 * backoff, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # due: when the timer fires, 0 without one.
        self.held = handle.getValueState("attempts", "last long, attempts long, due long, reason string, body string")

    def _fired(self, doc: str, state: tuple) -> tuple:
        return doc, state[2], "redelivered", state[1], state[3], state[4]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        doc, out = key[0], []
        state = tuple(self.held.get()) if self.held.exists() else (-1, 0, 0, None, None)
        before = state[2]
        told = pd.concat(list(rows)).sort_values(["now", "batch_id"], kind="stable")
        for batch_id, now, ok, reason, body in zip(*(told[x].tolist() for x in ("batch_id", "now", "ok", "reason", "body"))):
            last, attempts, due, *_ = state
            if batch_id <= last:
                continue
            if due and due <= now:
                out.append(self._fired(doc, state))
                due = 0
            if ok:
                state = (batch_id, 0, 0, None, None)
            elif attempts + 1 >= self.most:
                out.append((doc, now, "dead", attempts + 1, reason, body))
                state = (batch_id, 0, 0, None, None)
            else:
                state = (batch_id, attempts + 1, now + self.backoff, reason, body)
        if before and before != state[2]:
            self.handle.deleteTimer(before)
        if state[2] and before != state[2]:
            self.handle.registerTimer(state[2])
        self.held.update(state)
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state = tuple(self.held.get()) if self.held.exists() else None
        due = state is not None and state[2] == expiredTimerInfo.getExpiryTimeInMs()
        if due:
            self.held.update((state[0], state[1], 0, state[3], state[4]))
        yield self._frame([self._fired(key[0], state)] if due else [])

    @staticmethod
    def _frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=[x.split()[0] for x in FATES.split(", ")])

    def close(self) -> None:
        pass


def fates(outcomes: DataFrame, backoff: int = BACKOFF, most: int = DEAD_AFTER, late: str = "0 seconds") -> DataFrame:
    """FATES of a stream of OUTCOMES. Rows later than ``late`` behind the newest may be dropped by the watermark."""
    known = outcomes.where(F.col("doc_id").isNotNull() & F.col("at").isNotNull()).withWatermark("at", late)
    found = known.withColumn("now", F.unix_millis("at")).groupBy("doc_id").transformWithStateInPandas(_Attempts(backoff, most), FATES.replace("timestamp", "long"), "Append", "EventTime")
    return found.withColumn("at", F.timestamp_millis("at"))


def outcome_stream(spark: SparkSession, folder: str, files_a_batch: int = 100) -> DataFrame:
    """The outcomes that ``batch_writer`` leaves in a folder, as they come."""
    return spark.readStream.schema(OUTCOMES).option("maxFilesPerTrigger", files_a_batch).parquet(folder)


def write_fates(found: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends to a table all that is due by now, each row once, and ends; the checkpoint keeps state and timers."""
    spark = found.sparkSession
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, ROCKS)  # the only store that holds timers
    try:
        query = found.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(STORE, before)
    query.awaitTermination()
    return query
