"""A parsed index as a streaming source: a bounded number of entries a batch, offsets by index row.

The index is a Parquet table of ENTRIES in a folder that pyarrow reaches (file, hdfs, s3, gs). A batch reads the rows of
its range only; what is beyond the limit waits in the offset, and rows that come later continue it. With the trigger
``availableNow`` a run takes one batch, as a scheduled collection does."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from ..operators.collect import RUN_CAP

ENTRIES = "doc_id string, year int, kind string, index_row int, source_url string"
NAMES = [x.split()[0] for x in ENTRIES.split(", ")]


class _Reader(SimpleDataSourceStreamReader):
    def __init__(self, path: str, limit: int) -> None:
        self.path, self.limit = path, limit

    def _rows(self, low: int, high: int | None = None) -> Iterator[tuple]:
        """Entries from row ``low`` on, to ``high`` or the limit, in order; equal rows stay together."""
        filesystem, place = pafs.FileSystem.from_uri(self.path)
        index = ds.dataset(place, filesystem=filesystem, format="parquet")
        wanted = pc.field("index_row") >= low
        if high is None:
            # Only the column of places is read to find where the batch ends; rows before the offset are skipped by statistics.
            places = index.to_table(["index_row"], filter=wanted).column(0)
            if len(places) > self.limit:
                high = pc.max(places.take(pc.bottom_k_unstable(places, self.limit))).as_py() + 1
        if high is not None:
            wanted = wanted & (pc.field("index_row") < high)
        table = index.to_table(NAMES, filter=wanted).sort_by([("index_row", "ascending"), ("doc_id", "ascending")])
        return zip(*(table.column(x).to_pylist() for x in NAMES))

    def initialOffset(self) -> dict:
        return {"row": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows = list(self._rows(start["row"]))
        return iter(rows), {"row": rows[-1][NAMES.index("index_row")] + 1 if rows else start["row"]}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter(list(self._rows(start["row"], end["row"])))


class IndexSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "ledgermill_index"

    def schema(self) -> str:
        return ENTRIES

    def simpleStreamReader(self, schema) -> _Reader:
        return _Reader(self.options["path"], int(self.options.get("limit", RUN_CAP)))


def index_stream(spark: SparkSession, path: str, limit: int = RUN_CAP) -> DataFrame:
    """ENTRIES of the index at path as a stream, at most ``limit`` a batch (more only where entries share the last row)."""
    spark.dataSource.register(IndexSource)
    return spark.readStream.format(IndexSource.name()).option("path", path).option("limit", limit).load()
