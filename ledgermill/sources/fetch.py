"""Documents from the web through an injected fetcher, a bounded number a run, one after another.

The sources allow about one request a second, so a run's fetches belong in one task; ``capped`` bounds them and
what is left over waits for the next run."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.collect import RUN_CAP, capped

FETCHED = "doc_id string, year int, kind string, index_row int, source_url string, status int, content binary, error string, fetched_at timestamp"
_ARROW = pa.schema([
    ("doc_id", pa.string()), ("year", pa.int32()), ("kind", pa.string()), ("index_row", pa.int32()), ("source_url", pa.string()),
    ("status", pa.int32()), ("content", pa.binary()), ("error", pa.string()), ("fetched_at", pa.timestamp("us", "UTC")),
])


def fetched(entries: DataFrame, fetch: Callable[[str], tuple[int, bytes]], mark: bytes = b"", cap: int = RUN_CAP, pace=None) -> DataFrame:
    """FETCHED rows of entries (doc_id, year, kind, index_row, source_url) in index order, at most ``cap``.

    The first answer that is not cleared (a status other than 200, a content without ``mark``, an exception) is the last
    row: nothing after it is asked for, what came before stays. ``pace.wait()``, if given, goes before each request."""

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                if pace is not None:
                    pace.wait()
                status = content = error = None
                try:
                    status, content = fetch(row["source_url"])
                except Exception as wrong:  # the run ends here with what it has
                    error = f"{type(wrong).__name__}: {wrong}"
                out = {**row, "status": status, "content": content, "error": error, "fetched_at": datetime.now(timezone.utc)}
                yield pa.RecordBatch.from_pylist([out], schema=_ARROW)
                if error is not None or status != 200 or mark not in content:
                    return

    asked = capped(entries, cap).select("doc_id", F.col("year").cast("int"), "kind", F.col("index_row").cast("int"), "source_url")
    return asked.coalesce(1).mapInArrow(read, FETCHED)
