"""Messages as a sink that takes each batch once.

Tasks write lines into a staging folder; the commit of a batch moves that folder to ``batch=<id>`` in one step, unless
the batch is there already. A task or driver that is lost leaves staging files that no reader looks at, and a batch that
is run again after its commit adds nothing. The folder must be one that pyarrow reaches and can rename in one step (a
file system or hdfs)."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery


@dataclass
class _Part(WriterCommitMessage):
    """A file that a task wrote (none if it had no rows), and its run: commits get a writer of their own."""

    run: str
    name: str | None


class _Writer(DataSourceStreamWriter):
    def __init__(self, path: str) -> None:
        self.path, self.run = path.rstrip("/"), uuid.uuid4().hex

    def _place(self, *names: str) -> tuple[pafs.FileSystem, str]:
        filesystem, top = pafs.FileSystem.from_uri(self.path)
        return filesystem, "/".join([top, *names])

    def write(self, iterator: Iterator[Row]) -> _Part:
        name, out = f"part-{uuid.uuid4().hex}.json", None
        filesystem, folder = self._place("_staging", self.run)
        for row in iterator:
            if out is None:
                filesystem.create_dir(folder)
                out = filesystem.open_output_stream(f"{folder}/{name}")
            out.write(row[0].encode() + b"\n")
        if out is None:
            return _Part(self.run, None)
        out.close()
        return _Part(self.run, name)

    def commit(self, messages: list[_Part | None], batchId: int) -> None:
        kept = {(x.run, x.name) for x in messages if x is not None and x.name}
        filesystem, final = self._place(f"batch={batchId}")
        known = filesystem.get_file_info(final).type != pafs.FileType.NotFound
        for run in {run for run, _ in kept}:
            _, staged = self._place("_staging", run)
            if known:
                filesystem.delete_dir(staged)
                continue
            for part in filesystem.get_file_info(pafs.FileSelector(staged)):
                if (run, part.base_name) not in kept:  # of attempts that did not count
                    filesystem.delete_file(part.path)
            filesystem.move(staged, final)

    def abort(self, messages: list[_Part | None], batchId: int) -> None:
        for run in {x.run for x in messages if x is not None}:
            filesystem, staged = self._place("_staging", run)
            if filesystem.get_file_info(staged).type != pafs.FileType.NotFound:
                filesystem.delete_dir(staged)


class MessageSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "ledgermill_messages"

    def schema(self) -> str:
        return "value string"

    def streamWriter(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"])


def send_messages(messages: DataFrame, queue: str, checkpoint: str) -> StreamingQuery:
    """Appends a stream of messages (value) to a queue's folder, all that is there by now, and ends."""
    messages.sparkSession.dataSource.register(MessageSink)
    query = messages.writeStream.format(MessageSink.name()).option("path", queue).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def sent_messages(spark: SparkSession, queue: str) -> DataFrame:
    """value of every message of a queue's folder."""
    return spark.read.option("recursiveFileLookup", True).text(queue)
