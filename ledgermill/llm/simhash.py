"""SimHash near-duplicates: 64-bit fingerprints of 3-word shingles, linked within 3 bits by BK-trees.

Distinct fingerprints are dealt into shards by some of their bits: with the 64 bits in k bands, two
fingerprints within 3 bits agree on at least k - 3 bands, so each fingerprint enters the shard of
every choice of k - 3 bands, and each link is met in one shard at least. k grows with the number of
fingerprints so that shards stay small. A shard above LARGEST is dealt again by bands of its other
bits in the same way, until it is small or its bits are used up. Each shard's BK-tree answers for all
of the shard's members; it hands on only links that join something new, so groups of copies cost
linear space. Trees are routed to their queries by the shard key and not broadcast: a broadcast of
all trees would grow with the corpus.

Defined cases: null and empty texts have fingerprint zero, which links like any other; fewer than
three words give one shingle, the whole sequence; rows that repeat a doc_id are linked row by row; a
null doc_id never becomes a component id unless its component has no other; a very long text is hashed in
blocks; other columns are ignored, whatever their names; empty table: no rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bk_tree import forest_links
from .common import join_hot, materialise
from .components import components

RADIUS = 3
SHINGLE = 3
SEED = 42
#: Members from which a shard is dealt again, and the mean shard size up to which fewer bands do.
LARGEST, MEAN = 4096, 256


def fingerprint(text: str | None) -> int:
    """Unsigned fingerprint; a bit is set if set in over half of the shingles' hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    grams = list(map(b" ".join, zip(words, words[1:], words[2:]))) if len(words) >= SHINGLE else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    return majority(np.fromiter((digest(x, SEED) for x in grams), np.uint64, len(grams)))


def majority(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the unsigned 64-bit hashes."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        block = hashes[at : at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(hashes), bitorder="little").tobytes(), "little")


def with_fingerprints(docs: DataFrame, columns: list[str], text: str = "text", name: str = "fp") -> DataFrame:
    """``columns`` of docs and the signed 64-bit fingerprint of ``text``."""
    kept = docs.select(*columns) if text in columns else docs.select(*columns, text)
    place = kept.columns.index(text)
    out = kept.select(*columns, F.lit(0).cast("long").alias(name)).schema

    def add(batches):
        for batch in batches:
            marks = np.fromiter((fingerprint(x.as_py()) for x in batch.column(place)), np.uint64, batch.num_rows).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(columns))), pa.array(marks)], names=[*columns, name])

    return kept.mapInArrow(add, out)


def band_masks(bits: list[int], bands: int) -> list[int]:
    """Masks of every choice of bands - RADIUS of the bands that ``bits`` are cut into."""
    cuts = [bits[len(bits) * i // bands : len(bits) * (i + 1) // bands] for i in range(bands)]
    masks = [sum(1 << x for x in cut) for cut in cuts]
    return [reduce(int.__or__, chosen) for chosen in combinations(masks, bands - RADIUS)]


def bands_for(n: int, mean: int = MEAN) -> int:
    """The fewest bands at which n evenly spread fingerprints make shards of ``mean`` members at most."""
    bands = RADIUS + 1
    while n >> (64 * (bands - RADIUS) // bands) > mean and comb(bands + 1, RADIUS) <= 56:
        bands += 1
    return bands


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _dealt(members: DataFrame, masks: list[int]) -> DataFrame:
    """members (fp) into (mask, key, fp), one row for each mask."""
    choices = F.explode(F.array(*(F.lit(_signed(x)).cast("long") for x in masks)))
    return members.select(choices.alias("mask"), "fp").select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")


def shards(members: DataFrame, n: int, largest: int = LARGEST, bands: int | None = None) -> DataFrame:
    """(mask, key, fp): every pair within RADIUS bits shares a (mask, key); large shards are dealt finer."""
    masks = band_masks(list(range(64)), bands or bands_for(n))
    open_, done = materialise(_dealt(members, masks), "shards"), []
    while True:
        large = open_.groupBy("mask", "key").count().where(F.col("count") > largest).select("mask", "key")
        hot = [int(x["mask"]) for x in large.select("mask").distinct().collect()]  # masks, a fixed few
        finer = [_signed(full) for x in hot for full in (x & (1 << 64) - 1,) if 64 - full.bit_count() > 2 * (RADIUS + 1)]
        if not finer:
            return reduce(DataFrame.unionByName, [*done, open_])
        large = large.where(F.col("mask").isin(finer))
        done.append(open_.join(large, ["mask", "key"], "left_anti"))
        again = open_.join(large, ["mask", "key"], "left_semi")
        parts = []
        for mask in finer:
            full = mask & (1 << 64) - 1
            free = [x for x in range(64) if not full >> x & 1]
            parts.append(_dealt(again.where(F.col("mask") == mask).select("fp"), [full | x for x in band_masks(free, RADIUS + 1)]))
        open_ = materialise(reduce(DataFrame.unionByName, parts).distinct(), "shards")


def tree_links(dealt: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that keep all members of each shard connected that are within the radius."""

    def walk(batches):
        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def links(mask, key, fp):
            edge = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
            starts, ends = np.concatenate([[0], edge]), np.concatenate([edge, [len(fp)]])
            out = []
            for a, b in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
                out += forest_links(fp[a:b].view(np.uint64).tolist(), radius)
            found = np.array(out, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            now = tuple(x.to_numpy(zero_copy_only=False) for x in batch.columns)
            if kept and (kept[0][0][0], kept[0][1][0]) == (now[0][-1], now[1][-1]):
                kept.append(now)  # one shard so far
                continue
            whole = tuple(map(np.concatenate, zip(*kept, now)))
            last = (whole[0] == whole[0][-1]) & (whole[1] == whole[1][-1])
            first = int(np.argmax(last))
            yield links(*(x[:first] for x in whole))
            kept = [tuple(x[first:] for x in whole)]
        if kept:
            yield links(*map(np.concatenate, zip(*kept)))

    return dealt.repartition("mask", "key").sortWithinPartitions("mask", "key").select("mask", "key", "fp").mapInArrow(walk, "a long, b long")


def rooted(distinct: DataFrame, largest: int = LARGEST, bands: int | None = None) -> DataFrame:
    """distinct (fp, ...) with root, one fingerprint for each component."""
    links = tree_links(shards(distinct.select("fp"), distinct.count(), largest, bands))
    roots = components(links).withColumnRenamed("node", "fp")
    return materialise(distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")


def linked(marked: DataFrame, largest: int = LARGEST, bands: int | None = None) -> DataFrame:
    """marked (doc_id, fp, ...) with component_id, the smallest doc_id of the row's component."""
    distinct = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "fingerprints")
    placed = rooted(distinct.select("fp", "least"), largest, bands)
    smallest = materialise(placed.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n")), "roots")
    # One group of near copies, or of copies of one text, may hold a third of all rows.
    named = join_hot(placed.select("fp", "root"), smallest.select("root", "component_id"), "root", smallest.select("root", "n"))
    named = materialise(named.select("fp", "component_id"), "named")
    return join_hot(marked, named, "fp", distinct.select("fp", "n"))


def simhash_components(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row of (doc_id, text)."""
    marked = materialise(with_fingerprints(docs.select("doc_id", "text"), ["doc_id"]), "marked")
    return linked(marked).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
