"""Pages of documents as a batch source: read by document and range of pages, so that a long document is many tasks.

Documents are rows (doc_id, content) of a Parquet table that pyarrow reaches. A task's documents are neighbours in one file:
it opens that file and its part of the plan alone, and of a file that is sorted by doc_id the row groups of its documents only
(so write small ones). A reader opens a document: ``count(content)`` is its number of pages and ``page(content, k)`` the text
and the image of page k, counted from 1. Counting is one pass over the documents; the plan (which task reads which pages) is a
table too, of which the driver knows no more than the number of tasks of each file.

A document that cannot be counted has one page without text or image, and its ``error`` says why; a page that cannot be
read likewise. A document of no pages gives no rows."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..shared import fresh_path, written
from .scans import PAGES

PAGES_A_TASK = 200
#: Pages that go to Spark together.
BYTES_AT_ONCE = 1 << 20
_SHAPE = pa.schema([("doc_id", pa.string()), ("page_no", pa.int32()), ("text", pa.string()), ("image", pa.binary()), ("error", pa.string())])


class PageReader(Protocol):
    def count(self, content: bytes) -> int: ...

    def page(self, content: bytes, page_no: int) -> tuple[str | None, bytes | None]: ...


def _fault(error: Exception) -> str:
    return f"{type(error).__name__}: {error}"


def _counts(documents: DataFrame, reader: PageReader) -> DataFrame:
    def count(batches):
        for pdf in batches:
            out = []
            for doc_id, content, file in zip(pdf.doc_id, pdf.content, pdf.file):
                try:
                    out.append((doc_id, file, reader.count(content), None))
                except Exception as error:  # any reader, any fault: only this document
                    out.append((doc_id, file, 1, _fault(error)))
            yield pd.DataFrame(out, columns=["doc_id", "file", "pages", "error"])

    return documents.select("doc_id", "content", F.col("_metadata.file_path").alias("file")).mapInPandas(count, "doc_id string, file string, pages int, error string")


def _rows(path: str, columns: list[str], wanted: pc.Expression) -> Iterator[pa.RecordBatch]:
    filesystem, place = pafs.FileSystem.from_uri(path)
    yield from ds.dataset(place, filesystem=filesystem, format="parquet", partitioning=None).to_batches(columns=columns, filter=wanted, batch_size=16)


class _Task(InputPartition):
    def __init__(self, file: str, plan: str, number: int) -> None:
        self.file, self.plan, self.number = file, plan, number


class _Reader(DataSourceReader):
    def __init__(self, tasks: list[_Task], reader: PageReader) -> None:
        self.tasks, self.reader = tasks, reader

    def partitions(self) -> list[InputPartition]:
        return self.tasks

    def read(self, partition: _Task) -> Iterator[pa.RecordBatch]:
        ranges: dict[str, list[tuple[int, int]]] = {}
        mine = (pc.field("task") == partition.number) & (pc.field("file") == partition.file)
        for batch in _rows(partition.plan, ["doc_id", "low", "high"], mine):
            for row in batch.to_pylist():
                ranges.setdefault(row["doc_id"], []).append((row["low"], row["high"]))
        found, held = [], 0
        for batch in _rows(partition.file, ["doc_id", "content"], pc.field("doc_id").isin(list(ranges))) if ranges else ():
            for row in batch.to_pylist():
                for low, high in ranges[row["doc_id"]]:
                    for k in range(low, high):
                        text = image = error = None
                        try:
                            text, image = self.reader.page(row["content"], k)
                        except Exception as wrong:
                            error = _fault(wrong)
                        found.append({"doc_id": row["doc_id"], "page_no": k, "text": text, "image": image, "error": error})
                        held += len(text or "") + len(image or b"")
                        if held >= BYTES_AT_ONCE:
                            yield pa.RecordBatch.from_pylist(found, schema=_SHAPE)
                            found, held = [], 0
        if found:
            yield pa.RecordBatch.from_pylist(found, schema=_SHAPE)


def read_pages(spark: SparkSession, documents: str, reader: PageReader, pages_a_task: int = PAGES_A_TASK) -> DataFrame:
    """PAGES and ``error`` of the documents in the table at a path, in tasks of about ``pages_a_task`` pages."""
    counts = written(_counts(spark.read.parquet(documents), reader), "page-counts")
    low = F.explode(F.sequence(F.lit(1), F.col("pages"), F.lit(pages_a_task)))
    ranges = counts.where("pages > 0 and error is null").select("file", "doc_id", "pages", low.alias("low")).withColumn("high", F.least(F.col("low") + pages_a_task, F.col("pages") + 1))
    before = Window.partitionBy("file").orderBy("doc_id", "low").rowsBetween(Window.unboundedPreceding, -1)
    task = F.floor(F.coalesce(F.sum(F.col("high") - F.col("low")).over(before), F.lit(0)) / pages_a_task).cast("int")
    plan = fresh_path(spark, "page-plan")
    ranges.select("file", F.hex(F.xxhash64("file")).alias("part"), task.alias("task"), "doc_id", "low", "high").write.partitionBy("part").parquet(plan)
    # One row a task; the plan of a file is a folder of its own.
    numbers = spark.read.schema("file string, part string, task int").parquet(plan).distinct().collect()
    tasks = [_Task(x.file, f"{plan}/part={x.part}", x.task) for x in numbers]

    class PageSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return "ledgermill_pages"

        def schema(self) -> str:
            return f"{PAGES}, error string"

        def reader(self, schema) -> _Reader:
            return _Reader(tasks, reader)

    spark.dataSource.register(PageSource)
    uncounted = counts.where("error is not null").select("doc_id", F.lit(1).alias("page_no"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("binary").alias("image"), "error")
    return spark.read.format("ledgermill_pages").load().unionByName(uncounted)
