"""Filter interaction audit: what five document filters remove, alone and in every order.

Texts are scanned as Arrow buffers: a table of byte classes, prefix sums and word edges give words, capitals, symbols
and code points of all documents of a piece at once (every byte that counts is ASCII, so UTF-8 needs no decoding).
Distinct words come from word hashes sorted within each document; neighbours with equal hashes are compared byte by
byte, and a document in which two differ is counted by its words themselves. Each document becomes a mask of the
filters that it fails; masks are counted, and all orders are read off the 32 counts of a part.

Filters: A under 50 words; B 100 * distinct words < 65 * words; C 100 * capitals > 5 * code points; D holds one of
``#$%&*|``; E the same text stands under a smaller doc_id, in the whole table, whether that document is removed or not.

Defined cases: a null text is empty, and equal to an empty one; a null source is the part ``""``, as an empty one; a null
doc_id is neither smaller nor greater than another, so it never fails E and makes none fail; equal texts under one
doc_id do not make each other fail; repeated rows count each; a document is good or toxic if any of its labels says so;
a text of any length is scanned in one piece with what fits beside it; an empty table gives no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_hot, materialise, table

FILTERS = "ABCDE"
SYMBOLS = b"#$%&*|"
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 50, 65, 5
#: Bytes of text that are scanned at once; a longer text is a piece of its own.
PIECE = 1_000_000

SPACE, CAPITAL, SYMBOL, LEAD = 1, 2, 4, 8
_CLASSES = np.zeros(256, np.uint8)
_CLASSES[[0x20, *range(0x09, 0x0E)]] |= SPACE
_CLASSES[ord("A") : ord("Z") + 1] |= CAPITAL
_CLASSES[list(SYMBOLS)] |= SYMBOL
_CLASSES[[x for x in range(256) if x & 0xC0 != 0x80]] |= LEAD  # first bytes of code points
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _sums(flags: np.ndarray) -> np.ndarray:
    """Prefix sums with a zero before."""
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def _slices(sizes: np.ndarray):
    """Ranges of words of about PIECE bytes together."""
    ends, low = np.cumsum(sizes), 0
    while low < len(sizes):
        done = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + PIECE, side="right")))
        yield slice(low, high)
        low = high


def _inside(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of the sizes."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def word_hashes(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: bytes times powers of an odd base by their place in the word, summed."""
    powers = np.full(int(sizes.max(initial=1)), _BASE, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    out = np.zeros(len(sizes), np.uint64)
    for k in _slices(sizes):
        own, place = sizes[k], _inside(sizes[k])
        terms = (data[np.repeat(begins[k], own) + place].astype(np.uint64) + np.uint64(1)) * powers[place]
        out[k] = np.add.reduceat(terms, np.cumsum(own) - own)
    return (out ^ (out >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)


def distinct_words(data: np.ndarray, docs: np.ndarray, begins: np.ndarray, sizes: np.ndarray, n: int, hashes: np.ndarray | None = None) -> np.ndarray:
    """How many different words each of n documents has; docs tells the document of each word."""
    hashes = word_hashes(data, begins, sizes) if hashes is None else hashes
    order = np.lexsort((sizes, hashes, docs))
    docs, begins, sizes, hashes = docs[order], begins[order], sizes[order], hashes[order]
    same = (docs[1:] == docs[:-1]) & (hashes[1:] == hashes[:-1])
    found = np.bincount(docs, minlength=n) - np.bincount(docs[1:][same], minlength=n)
    pairs = np.flatnonzero(same)
    alike = sizes[pairs] == sizes[pairs + 1]
    wrong, pairs = [pairs[~alike]], pairs[alike]
    for k in _slices(sizes[pairs]):
        at, own = pairs[k], sizes[pairs[k]]
        place = _inside(own)
        differ = data[np.repeat(begins[at], own) + place] != data[np.repeat(begins[at + 1], own) + place]
        if differ.any():
            wrong.append(at[np.logical_or.reduceat(differ, np.cumsum(own) - own)])
    for doc in set(docs[np.concatenate(wrong)].tolist()):
        own = docs == doc
        found[doc] = len({data[b : b + s].tobytes() for b, s in zip(begins[own], sizes[own])})
    return found


def scanned(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Masks (1 A, 2 B, 4 C, 8 D) of texts that lie end to end in data; ends: n + 1 offsets from 0."""
    n = len(ends) - 1
    kinds = _CLASSES[data]
    capitals, symbols, points = (np.diff(_sums((kinds & x) != 0)[ends]) for x in (CAPITAL, SYMBOL, LEAD))
    solid = (kinds & SPACE) == 0
    first = np.zeros(len(data) + 1, bool)
    first[ends[:-1]] = True  # a word never goes on over the edge of a text
    before = np.concatenate([[False], solid[:-1]]) & ~first[:-1]
    begins = np.flatnonzero(solid & ~before)
    after = np.concatenate([solid[1:], [False]]) & ~np.concatenate([first[1:-1], [True]])
    sizes = np.flatnonzero(solid & ~after) - begins + 1 if len(data) else begins
    docs = np.searchsorted(ends, begins, side="right") - 1
    words = np.bincount(docs, minlength=n)
    distinct = distinct_words(data, docs, begins, sizes, n)
    fails = (words < MIN_WORDS, 100 * distinct < DISTINCT_PERCENT * words, 100 * capitals > CAPITAL_PERCENT * points, symbols > 0)
    return sum((x.astype(np.int32) << i for i, x in enumerate(fails)), np.zeros(n, np.int32))


def masks_of(texts: pa.Array) -> np.ndarray:
    """Masks of a binary array without nulls, a piece of about PIECE bytes at a time."""
    if not len(texts):
        return np.zeros(0, np.int32)
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    out, low = [], 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + PIECE, side="right")) - 1)
        out.append(scanned(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]))
        low = high
    return np.concatenate(out)


def _scan(batches):
    for batch in batches:
        texts = batch.column("text")
        yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in ("doc_id", "part", "digest")), pa.array(masks_of(texts), pa.int32())], names=["doc_id", "part", "digest", "mask"])


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask (bits of A to E) of every row of (doc_id, text, source)."""
    text = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    given = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))
    ids = given.schema["doc_id"].dataType.simpleString()
    rows = materialise(given.mapInArrow(_scan, f"doc_id {ids}, part string, digest binary, mask int"), "audit-rows")
    firsts = materialise(rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "audit-texts")
    met = join_hot(rows, firsts.select("digest", "first"), "digest", firsts.select("digest", "n"))
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return met.select("doc_id", "part", F.when(later, F.col("mask") + 16).otherwise(F.col("mask")).alias("mask"))


def mask_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: how many rows of (doc_id, part, mask), and of how many the labels say that they are so."""
    said = labels.where((F.col("quality") == 1) | (F.col("toxic") == 1)).groupBy("doc_id")
    said = said.agg(F.coalesce(F.max((F.col("quality") == 1).cast("long")), F.lit(0)).alias("good"), F.coalesce(F.max((F.col("toxic") == 1).cast("long")), F.lit(0)).alias("toxic"))
    alike = materialise(rows.groupBy("doc_id", "part", "mask").agg(F.count("*").alias("times")), "audit-masks")
    labelled = join_hot(alike, said, "doc_id", alike.groupBy("doc_id").agg(F.count("*").alias("n")))
    zero = F.lit(0).cast("long")
    every = alike.select("part", "mask", F.col("times").alias("n"), zero.alias("good"), zero.alias("toxic"))
    counted = labelled.select("part", "mask", zero.alias("n"), (F.col("times") * F.col("good")).alias("good"), (F.col("times") * F.col("toxic")).alias("toxic"))
    return every.unionByName(counted).groupBy("part", "mask").agg(*(F.sum(x).alias(x) for x in ("n", "good", "toxic")))


def _orders() -> Column:
    """All orders as an array of (filter_order, step, filter's bit, bits of the filters before)."""
    steps = []
    for order in permutations(FILTERS):
        bits = [1 << FILTERS.index(x) for x in order]
        steps += [F.struct(F.lit("".join(order)).alias("filter_order"), F.lit(k + 1).alias("step"), F.lit(bits[k]).alias("own"), F.lit(sum(bits[:k])).alias("before")) for k in range(len(bits))]
    return F.array(*steps)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row a part, order and step, from the counts of the part's masks."""
    cells = F.array_agg(F.struct("mask", "n", "good", "toxic"))  # 32 at most
    parts = mask_counts(failures(docs), labels).groupBy("part").agg(cells.alias("cells"))
    at = parts.select("part", "cells", F.explode(_orders()).alias("at")).select("part", "cells", "at.*")
    own, before = F.col("own"), F.col("before")
    zero = F.lit(0).cast("long")

    def total(of, where) -> Column:
        return F.aggregate("cells", zero, lambda x, c: x + F.when(where(c["mask"]), of(c)).otherwise(zero))

    n = lambda c: c["n"]
    fails = lambda m: m.bitwiseAND(own) != 0
    open_ = lambda m: m.bitwiseAND(before) == 0
    removed = lambda m: fails(m) & open_(m)
    # Of the orders, a document's first failing filter is each of those that it fails equally often.
    share = lambda c: c["n"] * F.lit(120).cast("long") / F.bit_count(c["mask"])
    return at.select(
        "part", "filter_order", "step",
        total(n, lambda m: open_(m) & ~fails(m)).alias("kept"), total(n, removed).alias("removed"),
        total(n, lambda m: fails(m) & ~open_(m)).alias("redundant"), total(n, lambda m: m == own).alias("unique_fails"),
        total(lambda c: c["good"], removed).alias("good_lost"), total(lambda c: c["toxic"], removed).alias("toxic_lost"),
        total(lambda c: share(c).cast("long"), fails).alias("shapley"),
    )


def op11_filter_audit(spark, sf_dir: str) -> DataFrame:
    """The audit of all documents by source."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP11_SQL = """
WITH firsts AS (
  SELECT coalesce(text, '') AS text, min(doc_id) AS first FROM documents GROUP BY 1
), words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), failing AS (
  SELECT w.doc_id, part, CAST(len(w) < 50 AS INTEGER) + 2 * CAST(100 * len(list_distinct(w)) < 65 * len(w) AS INTEGER)
    + 4 * CAST(100 * length(regexp_replace(w.text, '[^A-Z]', '', 'g')) > 5 * length(w.text) AS INTEGER)
    + 8 * CAST(regexp_matches(w.text, '[#$%&*|]') AS INTEGER) + 16 * CAST(coalesce(doc_id > first, false) AS INTEGER) AS mask
  FROM words w JOIN firsts f ON f.text = w.text
), said AS (
  SELECT doc_id, coalesce(max(CAST(quality = 1 AS INTEGER)), 0) AS good, coalesce(max(CAST(toxic = 1 AS INTEGER)), 0) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY 1
), cells AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM failing LEFT JOIN said USING (doc_id) GROUP BY 1, 2
), letters AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) t(l, b)
), orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.b | b.b | c.b | d.b | e.b = 31
), steps AS (
  SELECT filter_order, step, bits[step] AS own, coalesce(CAST(list_sum(bits[1:step - 1]) AS INTEGER), 0) AS before FROM orders, range(1, 6) t(step)
), told AS (
  SELECT part, filter_order, step, own,
    sum(n) FILTER (mask & (own | before) = 0) AS kept, sum(n) FILTER (mask & own <> 0 AND mask & before = 0) AS removed,
    sum(n) FILTER (mask & own <> 0 AND mask & before <> 0) AS redundant, sum(n) FILTER (mask = own) AS unique_fails,
    sum(good) FILTER (mask & own <> 0 AND mask & before = 0) AS good_lost, sum(toxic) FILTER (mask & own <> 0 AND mask & before = 0) AS toxic_lost
  FROM cells, steps GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
  CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost, CAST(coalesce(sum(removed) OVER (PARTITION BY part, own), 0) AS BIGINT) AS shapley
FROM told
"""
