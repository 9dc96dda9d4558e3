"""Lines of the run log: one at the end of each run, whatever came of it, and one for each step on the way."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql.streaming import StreamingQueryListener

Tell = Callable[[str], None]


def line(stage: str, env: Iterable[str] = (), **fields) -> str:
    """A line of the log; ``env`` names variables of the environment to put on it, those that are not set are left out."""
    known = {x: os.environ[x] for x in env if x in os.environ}
    fields = fields | ({"environment": known} if known else {})
    return json.dumps({"stage": stage, "at": datetime.now(timezone.utc).isoformat(), **fields}, sort_keys=True, default=str)


def progress(stage: str, tell: Tell = print, **fields) -> None:
    """A line at once, for a step of a long run."""
    tell(line(stage, type="progress", **fields))


@contextmanager
def logged(stage: str, tell: Tell = print, **fields) -> Iterator[dict]:
    """One line when the block ends: what the block put into the dict, the outcome (``success`` unless it says otherwise),
    the milliseconds, and the error if there was one, which goes on."""
    found, began = dict(fields), time.monotonic()
    try:
        yield found
        found.setdefault("outcome", "success")
    except BaseException as error:
        found |= {"outcome": "error", "error": {"type": type(error).__name__, "message": str(error)[:500]}}
        raise
    finally:
        tell(line(stage, duration_ms=round(1000 * (time.monotonic() - began)), **found))


class ProgressLines(StreamingQueryListener):
    """Progress lines of streaming queries, for ``spark.streams.addListener``."""

    def __init__(self, stage: str, tell: Tell = print) -> None:
        self.stage, self.tell = stage, tell

    def onQueryStarted(self, event) -> None:
        progress(self.stage, self.tell, query=event.id, state="started")

    def onQueryProgress(self, event) -> None:
        progress(self.stage, self.tell, query=event.progress.id, batch=event.progress.batchId, rows=event.progress.numInputRows)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        progress(self.stage, self.tell, query=event.id, state="ended", error=event.exception)
