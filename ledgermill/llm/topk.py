"""Exact top-k inner products by no-random-access aggregation of sorted lists.

Vectors are integers, floor(256 * x). Rows are dealt into shards of bounded size; a shard keeps, for
each dimension, its rows sorted by value: one sorted list a dimension, whose entries carry row, value
and the row's whole squared norm. A query reads all lists in step and only in order, from the top where
its own component is positive and from the bottom where it is negative; many queries read together, and
each step adds only the entries that it newly reads. What was read, plus the least and the most that the
unread components can still add, bounds each row's score. Those are bounded twice, and the tighter bound
counts: by the lists (what is unread lies between the place reached and the list's far end), and by
Cauchy-Schwarz (the norm that the row has left times the norm that the query has left in the unread
components). A query stops once few rows have an upper bound that reaches the k-th best score known; no
other row, seen or unseen, can qualify. The few have their scores resolved.

The score known at the start comes from the query's home shard, which is asked first, without one; all
other shards start with it. Queries travel in blocks of BLOCK, so a shard reads a block once.

Defined cases: vectors that are null or hold null, NaN or infinite components take no part, nor do those
whose integer vector has a squared norm of 2 ** 62 or more (a single component beyond some 8 million), since
every product of the others fits a long; vectors meet only those of their own length; fewer than k
candidates give as many rows; ties go to the smaller vec_id; rows that repeat a vec_id are candidates
each, but never of a query with that vec_id; queries that repeat a vec_id and its vector are one, and of
different query vectors under one vec_id each candidate counts with its best score; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

K = 5
EVERY = 50
SHARD_ROWS, BLOCK = 16_384, 128
#: Reading stops, and the rest is resolved, once so small a part of a shard can still qualify.
FEW = 1 / 64
#: The depths, in parts of a list, at which bounds are compared.
DEPTHS = (1 / 8, 1 / 4, 1 / 2, 5 / 8, 3 / 4, 7 / 8, 1)
LARGEST = float(1 << 62)


class SortedLists:
    """The rows of one shard: numbers, ids, integer vectors, and for each dimension the place of each row by value."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.rows, self.ids, self.vectors = rows[order], ids[order], vectors[order]
        n = len(ids)
        by_value = np.argsort(self.vectors, axis=0, kind="stable").astype(np.int32)
        self.place = np.empty_like(by_value)
        np.put_along_axis(self.place, by_value, np.broadcast_to(np.arange(n, dtype=np.int32)[:, None], by_value.shape), axis=0)
        self.sorted = np.take_along_axis(self.vectors, by_value, axis=0)
        self.norms = (self.vectors.astype(np.float64) ** 2).sum(axis=1)
        self.read = 0.0  # the part of all lists read, summed over queries

    def top(self, query_ids: np.ndarray, queries: np.ndarray, k: int, known: np.ndarray | None = None) -> list[tuple[int, int, int, int]]:
        """(place of the query, row, vec_id, score) of rows that may be among the k best of each query, its own left out:
        the k best rows of this shard, but for those below the query's ``known`` score."""
        n, dims = self.vectors.shape
        size = float(np.sqrt(self.norms.max(initial=0) * (queries.astype(np.float64) ** 2).sum(axis=1).max(initial=0)))
        # Bounds are rounded, and widened by more than the rounding; scores are whole numbers throughout.
        kind, slack = (np.float32, size * 1e-4) if size < 1 << 23 else (np.float64, size * 1e-9)
        open_, out, depth = np.arange(len(queries)), [], 0
        known = np.full(len(queries), -np.inf) if known is None else known
        up, down = (f(queries.T, 0).astype(kind) for f in (np.maximum, np.minimum))
        done = np.zeros((n, len(queries)), kind)  # what was read of each row's score, and of its squared norm
        used = np.zeros((n, len(queries)), kind)
        values, squares = self.vectors.astype(kind), self.vectors.astype(kind) ** 2
        spent = np.zeros((n, len(queries)), kind)  # the query's squared norm in the components read
        whole = (queries.astype(np.float64) ** 2).sum(axis=1).astype(kind)
        for part in DEPTHS:
            before, depth = depth, max(1, int(np.ceil(n * part)))
            new_high = (self.place >= n - depth) & (self.place < n - before)
            new_low = (self.place < depth) & (self.place >= before)
            done += np.where(new_high, values, 0) @ up + np.where(new_low, values, 0) @ down
            if depth == n:
                lower = upper = done
            else:
                is_up, is_down = (up != 0).astype(kind), (down != 0).astype(kind)
                used += np.where(new_high, squares, 0) @ is_up + np.where(new_low, squares, 0) @ is_down
                spent += new_high.astype(kind) @ up**2 + new_low.astype(kind) @ down**2
                high, low = (self.place < n - depth).astype(kind), (self.place >= depth).astype(kind)
                ends = lambda at_up, at_down: high @ (at_up.astype(kind)[:, None] * up) + low @ (at_down.astype(kind)[:, None] * down)
                left = np.sqrt(np.maximum(self.norms[:, None].astype(kind) - used, 0) * np.maximum(whole - spent, 0))
                lower = done + np.maximum(ends(self.sorted[0], self.sorted[-1]), -left) - kind(slack)
                upper = done + np.minimum(ends(self.sorted[n - depth], self.sorted[depth - 1]), left) + kind(slack)
            begin, end = (np.searchsorted(self.ids, query_ids[open_], x) for x in ("left", "right"))
            lower, upper = lower.copy(), upper.copy()
            for j in range(len(open_)):
                lower[begin[j] : end[j], j] = -np.inf
                upper[begin[j] : end[j], j] = -np.inf
            # The k-th best score known: every row whose upper bound is below it is out, seen or unseen.
            bar = np.partition(lower, n - k, axis=0)[n - k] if n > k else np.full(len(open_), -np.inf)
            bar = np.maximum(bar - slack, known[open_] - slack)
            maybe = (upper >= bar) & (upper > -np.inf)
            some = maybe.sum(axis=0)
            ended = (some <= max(k, n * FEW)) | (depth == n)
            for j in np.flatnonzero(ended):
                rest = np.flatnonzero(maybe[:, j])
                scores = self.vectors[rest] @ queries[open_[j]]
                best = np.lexsort((self.ids[rest], -scores))[:k]
                out += [(int(open_[j]), int(self.rows[rest[i]]), int(self.ids[rest[i]]), int(scores[i])) for i in best]
            self.read += depth / n * int(ended.sum())
            if ended.all():
                return out
            stay = ~ended
            open_, up, down, done, used, spent, whole = open_[stay], up[:, stay], down[:, stay], done[:, stay], used[:, stay], spent[:, stay], whole[stay]
        return out


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """row (a number of its own), vec_id, v (floor(256 * x), long) of the rows that take part."""
    finite = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    usable = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite).select("vec_id", F.transform("embedding", lambda x: x.cast("double") * 256).alias("x"))
    norm = F.aggregate("x", F.lit(0.0), lambda a, x: a + x * x)
    return usable.where(norm < LARGEST).select(F.monotonically_increasing_id().alias("row"), "vec_id", F.transform("x", lambda x: F.floor(x)).alias("v"), F.size("x").alias("dims"))


def _blocks(queries: DataFrame) -> DataFrame:
    """(dims, home, asked): queries (dims, home, blocks, query, vec_id, v, known) in blocks that share a home."""
    block = F.pmod(F.xxhash64("query", F.lit("block")), F.col("blocks"))
    listed = F.sort_array(F.collect_list(F.struct("query", "vec_id", "known", "v")))  # about BLOCK of them
    return queries.groupBy("dims", "home", block.alias("block")).agg(listed.alias("asked")).select("dims", "home", "asked")


def _answers(dealt: DataFrame, k: int) -> DataFrame:
    """(query, query_id, row, vec_id, score) of (dims, shard, asks, row, vec_id, v, asked), the rows of a shard first."""

    def answer(batches):
        key, held, lists = None, [], None
        for batch in batches:
            out: list[tuple[int, int, int, int, int]] = []
            dims, shard, asks = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            edge = np.flatnonzero((dims[1:] != dims[:-1]) | (shard[1:] != shard[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *edge], [*edge, len(dims)]):
                if a == b:
                    continue
                if key != (dims[a], shard[a]):
                    key, held, lists = (dims[a], shard[a]), [], None
                part = batch.slice(a, b - a)
                if not asks[a]:
                    flat = part.column(5).flatten().to_numpy(zero_copy_only=False)
                    held.append((part.column(3).to_numpy(), part.column(4).to_numpy(), flat.reshape(b - a, dims[a])))
                    continue
                if lists is None and held:
                    lists, held = SortedLists(*map(np.concatenate, zip(*held))), []
                for block in part.column(6) if lists else ():
                    asked = block.values
                    query, ids, known = (asked.field(i).to_numpy(zero_copy_only=False) for i in range(3))
                    vectors = asked.field(3).flatten().to_numpy(zero_copy_only=False).reshape(len(ids), dims[a])
                    out += [(int(query[j]), int(ids[j]), *x) for j, *x in lists.top(ids, vectors, k, known.astype(np.float64))]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in range(5)], names=["query", "query_id", "row", "vec_id", "score"])

    dealt = dealt.repartition("dims", "shard").sortWithinPartitions("dims", "shard", "asks")
    return dealt.mapInArrow(answer, "query long, query_id long, row long, vec_id long, score long")


def top_k(candidates: DataFrame, queries: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of each query; both inputs are (row, vec_id, v, dims)."""
    sizes = candidates.groupBy("dims").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards"))
    sizes = materialise(sizes, "topk-shards")  # one row a vector length
    dealt_to = F.pmod(F.xxhash64("row", F.lit("shard")), F.col("shards")).cast("int")
    rows = candidates.join(sizes, "dims").withColumn("shard", dealt_to)
    none = F.lit(None).cast("array<struct<query:bigint,vec_id:bigint,known:double,v:array<bigint>>>")
    rows = materialise(rows.select("dims", "shard", F.lit(0).alias("asks"), "row", "vec_id", "v", none.alias("asked")), "topk-rows")
    alone = materialise(queries.groupBy("vec_id", "v", "dims").agg(F.min("row").alias("query")), "topk-alone")
    asking = alone.groupBy("dims").agg(F.count("*").alias("n")).join(sizes, "dims").select("dims", "shards", F.ceil(F.col("n") / F.col("shards") / BLOCK).cast("int").alias("blocks"))
    home = F.pmod(F.xxhash64("query", F.lit("home")), F.col("shards")).cast("int")
    alone = materialise(alone.join(asking, "dims").select("dims", "shards", "blocks", home.alias("home"), "query", "vec_id", "v"), "topk-queries")

    def ask(blocks: DataFrame) -> DataFrame:
        asked = blocks.select("dims", "shard", F.lit(1).alias("asks"), F.lit(0).cast("long").alias("row"), F.lit(0).cast("long").alias("vec_id"), F.lit(None).cast("array<bigint>").alias("v"), "asked")
        return _answers(rows.union(asked), k)

    first = _blocks(alone.withColumn("known", F.lit(float("-inf")))).withColumnRenamed("home", "shard")
    first = materialise(ask(first), "topk-first")
    # k rows of the home shard whose score is this or more: no row below it is among the k best.
    known = first.groupBy("query").agg(F.min("score").cast("double").alias("least"), F.count("*").alias("n"))
    again = alone.where("shards > 1").join(known, "query", "left").withColumn("known", F.when(F.col("n") >= k, F.col("least")).otherwise(float("-inf")))
    others = _blocks(again).join(sizes, "dims").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).where("shard <> home")
    found = first.unionByName(ask(others)).groupBy("query_id", "row", "vec_id").agg(F.max("score").alias("score"))
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", "row"))
    return found.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_topk(spark, sf_dir: str) -> DataFrame:
    """The 5 best neighbours of every vector whose id is divisible by 50, among all vectors."""
    vectors = materialise(integer_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")), "vectors")
    return top_k(vectors, vectors.where(F.col("vec_id") % EVERY == 0))


OP10_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND coalesce(list_sum(list_transform(embedding, lambda x: (256 * CAST(x AS DOUBLE)) ** 2)), 0) < 4611686018427387904
), scored AS (
  SELECT q.vec_id AS query_id, c.row, c.vec_id,
         max(CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT)) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
  WHERE q.vec_id % 50 = 0
  GROUP BY ALL
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id, row) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
