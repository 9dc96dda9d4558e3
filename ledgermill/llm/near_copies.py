"""Near-duplicates of the pipeline: 5-word shingle sets with a Jaccard similarity of 0.8 or more.

Each document's set of shingles gives one SimHash fingerprint, whose component under op5's BK-trees is a key,
and BANDS keys of ROWS MinHash values each: at 0.8 fingerprints differ by ten bits on average, so 3 bits alone
would miss most pairs. Documents that share a key are candidates, and candidates are linked only if the exact
Jaccard similarity of their whole sets is at least 0.8. Two sets of similarity s share no MinHash key with
probability (1 - s ** ROWS) ** BANDS: 6 in 100,000 at 0.8, less than one in ten million at 0.9.

Equal sets are one node from the start, so groups of copies cost nothing. The nodes of a candidate group of up to
LARGEST are compared in one task, and only nodes that are not connected yet. In a larger group each node is first
compared with the smallest node of each of its keys, pair by pair in many tasks; that connects groups of near
copies. What is then outside the group's largest component is compared with the whole group, in blocks of LARGEST.

Documents are not shuffled at the end: the numbers of the rows that stay are written by the partition that numbered
them, and each task looks up those of the rows it reads. The shared folder must be one that pyarrow can open on
every executor (file://, hdfs://, s3://, gs://).

Defined cases: null and empty texts have the empty set, which is similar to itself only; fewer than five
words give one shingle, the whole sequence; doc_ids may be null or repeat: components are of texts; columns of
any name stay as they were; whole texts are read, however long; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_hot, materialise, materialise_parts, packed
from .components import components
from .simhash import majority, rooted
from .token_files import open_place

SHINGLE = 5
SEED = 42
BANDS, ROWS = 32, 6
#: Nodes of a candidate group that one task compares.
LARGEST = 1024
#: monotonically_increasing_id() numbers the rows of a partition in the bits below this one.
PART_BIT = 33
#: Similarity NUMERATOR / DENOMINATOR, in whole numbers so that the bound itself is met.
NUMERATOR, DENOMINATOR = 4, 5

_DRAW = np.random.default_rng(SEED)
_TIMES = _DRAW.integers(0, 1 << 31, (BANDS * ROWS, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_MIXED = _DRAW.integers(0, 1 << 32, (BANDS * ROWS, 1), dtype=np.uint32)


def shingles(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct shingles of the lowered words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    grams = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)))) if len(words) >= SHINGLE else [b" ".join(words)]
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(x, SEED) for x in grams), np.uint64))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One signed key for each band; none of the empty set."""
    if not len(hashes):
        return np.empty(0, np.int64)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 1024):
        np.minimum(least, ((short[at : at + 1024] ^ _MIXED) * _TIMES).min(axis=1), out=least)
    return np.array([xxhash.xxh64_intdigest(x.tobytes(), i) for i, x in enumerate(least.reshape(BANDS, ROWS))], np.uint64).view(np.int64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two sorted sets reaches the bound."""
    if len(a) > len(b):
        a, b = b, a
    if DENOMINATOR * len(a) < NUMERATOR * len(b):
        return False
    both = int((b.take(np.searchsorted(b, a), mode="clip") == a).sum()) if len(a) else 0
    return DENOMINATOR * both >= NUMERATOR * (len(a) + len(b) - both)


def group_roots(sets: list[np.ndarray], keys: list[np.ndarray]) -> list[int]:
    """For each set the place of the first one of its component; sets that share a key are compared unless connected."""
    parent, mates = list(range(len(sets))), {}

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, row in enumerate(keys):
        for key in row.tolist():
            mates.setdefault(key, []).append(i)
    for members in mates.values():
        if len(members) < 2:
            continue
        parts: dict[int, list[int]] = {}
        for i in members:
            parts.setdefault(top(i), []).append(i)
        apart: list[list[int]] = []
        for part in parts.values():
            rest = []
            for other in apart:
                if any(similar(sets[x], sets[y]) for x in part for y in other):
                    a, b = sorted((top(part[0]), top(other[0])))
                    parent[b] = a
                    part = other + part
                else:
                    rest.append(other)
            apart = [*rest, part]
    return [top(i) for i in range(len(sets))]


def with_sketches(docs: DataFrame) -> DataFrame:
    """(doc, row, set, fp, bands): each row as one struct, one number for its set of shingles, the set's fingerprint and keys."""
    kept, place = packed(docs).withColumn("row", F.monotonically_increasing_id()), docs.columns.index("text")
    mark = F.lit(0).cast("long")
    out = kept.select("*", mark.alias("set"), mark.alias("fp"), F.array(mark).alias("bands")).schema

    def add(batches):
        for batch in (x.slice(at, 512) for x in batches for at in range(0, x.num_rows, 512)):
            marks, keys = np.empty((2, batch.num_rows), np.uint64), []
            for i, x in enumerate(pc.struct_field(batch.column(0), [place])):
                hashes = shingles(x.as_py())
                marks[:, i] = xxhash.xxh64_intdigest(hashes.tobytes(), SEED), majority(hashes)
                keys.append(band_keys(hashes))
            ends = np.concatenate([[0], np.cumsum([len(x) for x in keys], dtype=np.int64)]).astype(np.int32)
            bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *keys])))
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, marks.view(np.int64)), bands], names=["doc", "row", "set", "fp", "bands"])

    return kept.mapInArrow(add, out)


def _compared(batches):
    """(a, b) links that join each group of (root, set, bands, text), rows of a root together."""
    root, nodes, sets, keys = None, [], [], []

    def done():
        tops = [nodes[i] for i in group_roots(sets, keys)]
        apart = [(a, b) for a, b in zip(nodes, tops) if a != b]
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in apart], pa.int64()) for i in (0, 1)], names=["a", "b"])

    for batch in batches:
        for i in range(batch.num_rows):
            now = batch.column(0)[i].as_py()
            if now != root:
                if nodes:
                    yield done()
                root, nodes, sets, keys = now, [], [], []
            nodes.append(batch.column(1)[i].as_py())
            keys.append(batch.column(2)[i].values.to_numpy(zero_copy_only=False))
            sets.append(shingles(batch.column(3)[i].as_py()))
    if nodes:
        yield done()


def _held_against(batches):
    """(a, b) links between the held rows and the others of each (block, part, other, set, top, text), held rows first:
    similar ones that neither their ``top`` nor an earlier link connects."""
    key, held, parent = None, [], {}

    def top(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for batch in batches:
        found = []
        for block, part, other, node, own, text in zip(*(x.to_pylist() for x in batch.columns)):
            if key != (block, part):
                key, held, parent = (block, part), [], {}
            mine = shingles(text)
            if not other:
                held.append((node, own, mine))
                continue
            for there, group, theirs in held:
                if top(own) != top(group) and similar(mine, theirs):
                    parent[top(own)] = top(group)
                    found.append((node, there))
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])


def _against(held: DataFrame, others: DataFrame) -> DataFrame:
    """Links of (block, part, set, top, text) rows of both sides that share block and part."""
    rows = held.withColumn("other", F.lit(0)).unionByName(others.withColumn("other", F.lit(1))).select("block", "part", "other", "set", "top", "text")
    return rows.repartition("block", "part").sortWithinPartitions("block", "part", "other").mapInArrow(_held_against, "a long, b long")


def _part(node: str, parts) -> F.Column:
    return F.pmod(F.xxhash64(node, F.lit("part")), parts)


def _large_links(large: DataFrame, dealt: DataFrame, texts: DataFrame, largest: int) -> DataFrame:
    """Links in the candidate groups large (set, root, n): against each key's smallest node, then of what is left against all."""
    members = dealt.join(large.select(F.col("set").alias("a")), "a", "left_semi")
    keys = materialise(members.groupBy("key").agg(F.min("a").alias("b"), F.count("*").alias("n")), "large-keys")
    pairs = join_hot(members, keys.select("key", "b"), "key", keys.select("key", "n")).where("a != b").select("a", "b").distinct()
    pairs = materialise(pairs, "large-pairs")
    leaders = pairs.groupBy("b").agg(F.ceil(F.count("*") / largest).cast("int").alias("parts"), F.count("*").alias("n"))
    leaders = materialise(leaders, "leaders")
    placed = join_hot(pairs, leaders.select("b", "parts"), "b", leaders.select("b", "n")).select(F.col("b").alias("block"), _part("a", F.col("parts")).alias("part"), F.col("a").alias("set"))
    lead = leaders.select(F.col("b").alias("block"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("b").alias("set"))
    with_text = lambda x: x.join(texts, "set").withColumn("top", F.col("set"))
    links = materialise(_against(with_text(lead), with_text(placed)), "leader-links")

    tops = components(links).select(F.col("node").alias("set"), F.col("root").alias("top"))
    placed = materialise(large.join(tops, "set", "left").withColumn("top", F.coalesce("top", "set")), "large-tops")
    sizes = placed.groupBy("root", "top").count()
    main = materialise(sizes.groupBy("root").agg(F.max(F.struct("count", "top")).alias("main"), F.sum("count").alias("n")), "largest-parts")
    main = main.select("root", F.col("main.top").alias("main"), F.ceil((F.col("n") - F.col("main.count")) / largest).cast("int").alias("blocks"), F.ceil(F.col("n") / largest).cast("int").alias("parts"), "n")
    placed = join_hot(placed.select("root", "set", "top"), main.select("root", "main", "blocks", "parts"), "root", main.select("root", "n")).where("blocks > 0").join(texts, "set")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    block = lambda i: F.xxhash64("root", i.cast("int"))
    left = placed.where("top != main").withColumn("i", F.pmod(F.xxhash64("set", F.lit("block")), F.col("blocks"))).withColumn("part", every("parts"))
    whole = placed.withColumn("part", _part("set", F.col("parts"))).withColumn("i", every("blocks"))
    pick = lambda x: x.select(block(F.col("i")).alias("block"), F.col("part").cast("int"), "set", "top", "text")
    return links.unionByName(_against(pick(left), pick(whole)))


def _stays(folder: str):
    """A condition on row numbers: whether ``folder``, which has one folder for each partition that numbered rows, lists them."""

    def listed(part: int) -> np.ndarray:
        system, path = open_place(f"{folder}/part={part}")
        if system.get_file_info(path).type == pafs.FileType.NotFound:
            return np.empty(0, np.int64)
        return np.sort(pq.read_table(path, columns=["row"], filesystem=system, partitioning=None, use_threads=False)["row"].to_numpy())

    def look(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        last, known = None, np.empty(0, np.int64)
        for batch in batches:
            rows = batch.to_numpy(zero_copy_only=False)
            parts, found = rows >> PART_BIT, np.zeros(len(rows), bool)
            for part in np.unique(parts).tolist():
                if part != last:
                    last, known = part, listed(part)
                mine = np.flatnonzero(parts == part)
                if len(known):
                    found[mine] = known.take(np.searchsorted(known, rows[mine]), mode="clip") == rows[mine]
            yield pa.array(found)

    return F.arrow_udf(look, "boolean")


def keep_one(docs: DataFrame, largest: int = LARGEST) -> DataFrame:
    """One document of each component of similar texts, the one with the smallest doc_id; columns as they were."""
    marked = materialise(with_sketches(docs), "sketched-docs")
    least = F.min(F.struct(F.col("doc.doc_id").isNull(), "doc.doc_id", "row"))
    alone = materialise(marked.groupBy("set", "fp").agg(least.alias("first")), "sets")
    rows = alone.select(F.col("first")["row"].alias("row"))
    prints = materialise(alone.groupBy("fp").agg(F.count("*").alias("n")), "fingerprints")
    roots = rooted(prints.select("fp"))
    by_print = join_hot(alone.select("set", "fp"), roots.select("fp", F.xxhash64("root", F.lit("simhash")).alias("key")), "fp", prints).select("key", F.col("set").alias("a"))
    by_band = marked.select("row", "set", "bands").join(rows, "row", "left_semi").select(F.explode("bands").alias("key"), F.col("set").alias("a"))
    dealt = materialise(by_band.unionByName(by_print), "dealt-keys")
    keys = materialise(dealt.groupBy("key").agg(F.min("a").alias("b"), F.count("*").alias("n")).where(F.col("n") > 1), "keys")
    candidates = join_hot(dealt, keys.select("key", "b"), "key", keys.select("key", "n")).select("a", "b")
    groups = materialise(components(candidates).select(F.col("node").alias("set"), "root"), "candidates")
    sizes = materialise(groups.groupBy("root").agg(F.count("*").alias("n")), "group-sizes")
    sized = materialise(join_hot(groups, sizes.withColumn("size", F.col("n")).select("root", "size"), "root", sizes), "sized-groups")

    texts = marked.select("row", "set", "bands", "fp", "doc.text").join(rows, "row", "left_semi")
    key = F.xxhash64(F.col("root_fp"), F.lit("simhash"))
    small = texts.join(sized.where(F.col("size") <= largest).select("set", "root"), "set").join(roots.select("fp", F.col("root").alias("root_fp")), "fp")
    small = small.select("root", "set", F.concat("bands", F.array(key)).alias("bands"), "text")
    links = small.repartition("root").sortWithinPartitions("root").mapInArrow(_compared, "a long, b long")
    large = sized.where(F.col("size") > largest).select("set", "root")
    if not large.isEmpty():
        links = links.unionByName(_large_links(large, dealt, texts.select("set", "text"), largest))
    tops = components(links).select(F.col("node").alias("set"), F.col("root").alias("top"))
    kept = alone.join(tops, "set", "left").groupBy(F.coalesce("top", "set")).agg(F.min("first")["row"].alias("row")).select("row")
    kept = kept.repartitionByRange("row").withColumn("part", F.shiftright("row", PART_BIT))
    stays = _stays(materialise_parts(kept, "kept-rows", "part")._ledgermill_path)
    return marked.where(stays("row")).select("doc.*")
