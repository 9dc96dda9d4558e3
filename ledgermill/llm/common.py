"""Shared plumbing: table access, tables in the shared folder and their removal, documents as one column, hot keys."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import fresh_path

#: A key is hot from this part of all rows on, so there are at most HOT_KEYS of them, whatever the table holds.
HOT_KEYS = 1024

_scratch: list[list[DataFrame]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends here, and lost executors take nothing with them.
    ``keep`` spares it from the scratch() around."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._ledgermill_path = path
    if _scratch and not keep:
        _scratch[-1].append(back)
    return back


def materialise_buckets(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """materialise() into ``buckets`` buckets by a key, so that joins by the key need not move these rows."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    known = path.rsplit("/", 1)[-1].replace("-", "_")
    df.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(known)
    back = spark.table(known)
    back._ledgermill_path, back._ledgermill_table = path, known
    if _scratch:
        _scratch[-1].append(back)
    return back


def materialise_parts(df: DataFrame, name: str, key: str) -> DataFrame:
    """materialise() into one folder for each value of a key, so that a task can read the rows of one value alone."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.partitionBy(key).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._ledgermill_path = path
    if _scratch:
        _scratch[-1].append(back)
    return back


def discard(df: DataFrame) -> None:
    """Removes a table that materialise() wrote and that nothing reads any more."""
    if known := getattr(df, "_ledgermill_table", None):
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {known}")
    path = getattr(df, "_ledgermill_path", None)
    if path:
        spark = df.sparkSession
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        df._ledgermill_path = None


@contextmanager
def scratch():
    """Removes, at its end, every table that was materialised inside: write or collect what reads them before."""
    _scratch.append([])
    try:
        yield
    finally:
        for df in _scratch.pop():
            discard(df)


def packed(docs: DataFrame) -> DataFrame:
    """Each row as one struct ``doc``: names added beside it cannot clash with the documents' own; undone by select("doc.*")."""
    return docs.select(F.struct("*").alias("doc"))


def join_hot(rows: DataFrame, keyed: DataFrame, key: str, counts: DataFrame) -> DataFrame:
    """Inner join of rows with ``keyed``, one small row a key. Keys that hold over 1 / HOT_KEYS of the rows, by ``counts``
    (key, n), are met by broadcast where they lie, at most HOT_KEYS of them; all others are shuffled."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = keyed.join(F.broadcast(counts.where(F.col("n") * HOT_KEYS > total).select(key)), key, "left_semi")
    hot = materialise(hot, "hot-keys")
    there = rows.join(F.broadcast(hot), key)
    others = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(keyed, key)
    return there.unionByName(others)
