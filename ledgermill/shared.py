"""The folder that the driver and all executors share, and tables that several outputs read."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession

_own: list[str] = []
_held: ContextVar[list[DataFrame] | None] = ContextVar("held", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Only a local session without that setting gets a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="ledgermill-"))
        atexit.register(shutil.rmtree, _own[0], True)
    return f"file://{_own[0]}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder, made once whoever reads them."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(found: Observation, *names: str) -> dict[str, int]:
    """The observed counts of a write. A plan that turns out to be empty is cut off with the counters in it: all zero."""
    try:
        counts = found.get
    except Py4JJavaError:  # an observed row without columns
        counts = {}
    return {x: counts.get(x) or 0 for x in names}


def held(df: DataFrame) -> DataFrame:
    """Inside holding(), df kept by the executors, so that several outputs read it and make it once; lost parts are made
    again. Elsewhere df as it is: one output gains nothing."""
    kept = _held.get()
    if kept is None:
        return df
    kept.append(df.persist())
    return kept[-1]


@contextmanager
def holding():
    """Lets go, at its end, of what was held inside: write what reads it before."""
    outer = _held.set([])
    try:
        yield
    finally:
        for df in _held.get():
            df.unpersist()
        _held.reset(outer)
