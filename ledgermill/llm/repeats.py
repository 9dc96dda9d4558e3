"""Removal of passages that occur elsewhere: every byte under a SPAN-byte string that also starts somewhere else.

Suffixes are only sorted against each other where they can be equal. Each SPAN-byte window has an anchor, its leftmost
GRAM-byte string of least hash: equal windows have equal anchors at equal places, and neighbouring windows mostly share
theirs, so a text has an anchor about every 77 bytes. Anchors are dealt by ranges of their hash; one whose hash occurs
once is dropped. Those that are left are bundled into chunks of about CHUNK, and each takes along its context, the bytes
of all windows that it is the anchor of. Within a chunk equal contexts are counted as one, and the windows of different
contexts of one anchor are ordered as suffixes by deep-shallow sorting: a multikey quicksort, which takes eight bytes at
a time as one character and parts all groups at once, to SHALLOW bytes; what still agrees goes into a blind trie, whose
leaves with more than one window are repeats. An anchor with more occurrences than a chunk takes, or that lies at the
edge of a task, stands in several chunks: the digests of its windows are matched between chunks, so no chunk, task or
driver ever holds all of a hot passage. Texts are stored once each, deflated, in buckets by digest; copies are counted.

Defined cases: a null text is empty; texts under SPAN bytes lose nothing; a text of SPAN bytes or more that stands in
several rows loses everything in each, one span; null and repeated doc_ids are rows like any other; one long text is
taken SEGMENT bytes at a time, also where it repeats itself; an empty table gives no rows; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_hot, materialise, materialise_buckets, table

SPAN = 200
GRAM = 48
#: Anchors whose windows are sorted together.
CHUNK = 8192
#: Depth in bytes at which the multikey quicksort hands over to blind tries; a multiple of 8.
SHALLOW = 64
#: Bytes of a text that are hashed at once.
SEGMENT = 1 << 20
BUCKET_BYTES, MOST_BUCKETS = 16_000_000, 50_000
#: Low bits of a window's key that hold a place in a segment.
_PLACE = np.uint64((1 << 24) - 1)
_BASE = 0x9E3779B97F4A7C15
EMPTY = hashlib.sha256(b"").hexdigest()


@cache
def _powers(base: int) -> np.ndarray:
    out = np.full(SEGMENT + SPAN, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def anchors(text: bytes, segment: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """hash, place, and first and last window (starts) of each anchor of a text; the windows of all are all windows."""
    found = []
    for low in range(0, len(text) - SPAN + 1, segment):
        data = np.frombuffer(text, np.uint8)[low : low + segment + SPAN - 1]
        n, width = len(data), SPAN - GRAM + 1
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE)[:n], out=sums[1:])
        hashes = (sums[GRAM:] - sums[:-GRAM]) * _powers(pow(_BASE, -1, 1 << 64))[: n - GRAM + 1]
        hashes = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        hashes ^= hashes >> np.uint64(32)
        # Least key of each window by running minima from both sides of blocks as wide as a window holds grams.
        keys = np.full(-(-len(hashes) // width) * width, ~np.uint64(0), np.uint64)
        keys[: len(hashes)] = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        blocks = keys.reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, 1).ravel()[width - 1 : len(hashes)]
        least = np.minimum(ahead, np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()[: len(ahead)])
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        last = np.concatenate([first[1:] - 1, [len(least) - 1]])
        place = (least[first] & _PLACE).astype(np.int64)
        found.append((hashes[place].view(np.int64), place + low, first + low, last + low))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 4


class BlindTrie:
    """Patricia trie over strings of SPAN bytes in data, given by their starts. A string goes down by the bytes at which
    known ones part, without looking at those between, and is compared once with the leaf that it meets."""

    def __init__(self, data: bytes, start: int, shared: int = 0) -> None:
        self.data, self.shared = data, shared
        self.root: list = [SPAN, [start]]  # a leaf: [SPAN, starts]; a fork: [depth, {byte: node}]

    def add(self, start: int) -> None:
        data, node = self.data, self.root
        while node[0] < SPAN:
            node = node[1].get(data[start + node[0]]) or next(iter(node[1].values()))
        other = node[1][0]
        if data[start + self.shared : start + SPAN] == data[other + self.shared : other + SPAN]:
            node[1].append(start)
            return
        low, high = self.shared, SPAN - 1  # the first byte that differs lies between
        while low < high:
            middle = (low + high) // 2
            if data[start + low : start + middle + 1] == data[other + low : other + middle + 1]:
                low = middle + 1
            else:
                high = middle
        over, node = None, self.root
        while node[0] < low:
            over, node = node, node[1][data[start + node[0]]]
        if node[0] == low:
            node[1][data[start + low]] = [SPAN, [start]]
            return
        fork = [low, {data[other + low]: node, data[start + low]: [SPAN, [start]]}]
        if over is None:
            self.root = fork
        else:
            over[1][data[start + over[0]]] = fork

    def leaves(self) -> Iterator[list[int]]:
        """Starts of equal strings, in the order of the strings."""
        stack = [self.root]
        while stack:
            depth, below = stack.pop()
            if depth == SPAN:
                yield below
            else:
                stack += [below[x] for x in sorted(below, reverse=True)]


def shallow_groups(data: np.ndarray, starts: np.ndarray, groups: np.ndarray, depth: int = SHALLOW) -> Iterator[np.ndarray]:
    """Multikey quicksort of the strings at starts within each group, all groups at once: the sets of two or more that
    agree in the first ``depth`` bytes. Each round parts every open group into less than, equal to and greater than the
    eight bytes of its middle member; the equal go on eight bytes deeper."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    words = np.zeros(len(data), np.uint64)
    for k in range(8):
        words |= padded[k : k + len(data)] << np.uint64(56 - 8 * k)
    order = np.argsort(groups, kind="stable")
    starts, groups, deep = starts[order], groups[order], np.zeros(len(starts), np.int64)
    while len(starts):
        first = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
        sizes = np.diff(np.append(first, len(groups)))
        done = (deep[first] >= depth) & (sizes > 1)
        for k in np.flatnonzero(done):
            yield starts[first[k] : first[k] + sizes[k]]
        keep = np.repeat((sizes > 1) & ~done, sizes)
        if not keep.any():
            return
        starts, deep, sizes = starts[keep], deep[keep], sizes[(sizes > 1) & ~done]
        first = np.cumsum(sizes) - sizes
        own = words[starts + deep]
        pivot = np.repeat(own[first + sizes // 2], sizes)
        side = 1 + (own > pivot).astype(np.int64) - (own < pivot)
        keys = 3 * np.repeat(np.arange(len(sizes)), sizes) + side
        order = np.argsort(keys, kind="stable")
        starts, groups, deep = starts[order], keys[order], (deep + 8 * (side == 1))[order]


def repeated_windows(contexts: Sequence[bytes], groups: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """For different contexts, with their anchor's group and its place in each: which of a context's windows equal one of
    another context, by deep-shallow sorting of the windows of each group and place."""
    whole = b"".join(contexts)
    sizes = np.array([len(x) - SPAN + 1 for x in contexts])
    bases = np.cumsum(sizes + SPAN - 1) - (sizes + SPAN - 1)
    inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    starts = np.repeat(bases, sizes) + inside
    keys = np.repeat(groups * SPAN + offsets, sizes) - inside
    marks = np.zeros(len(whole), bool)
    for group in shallow_groups(np.frombuffer(whole, np.uint8), starts, keys):
        trie = BlindTrie(whole, int(group[0]), SHALLOW)
        for start in group[1:].tolist():
            trie.add(start)
        for leaf in trie.leaves():
            if len(leaf) > 1:
                marks[leaf] = True
    return [marks[b : b + n] for b, n in zip(bases, sizes)]


def _first_seen(batches):
    """Each text of a task once, deflated."""
    seen: set[bytes] = set()
    for batch in batches:
        digests = batch.column("d").to_pylist()
        fresh = []
        for k, d in enumerate(digests):
            if d not in seen:
                seen.add(d)
                fresh.append(k)
        texts = batch.column("text")
        packed = pa.array([zlib.compress(texts[k].as_py(), 1) for k in fresh], pa.binary())
        kept = batch.take(pa.array(fresh, pa.int32()))
        yield pa.RecordBatch.from_arrays([*(kept.column(x) for x in ("t", "u", "d")), packed], names=["t", "u", "d", "z"])


def _anchored(batches):
    for batch in batches:
        for low in range(0, batch.num_rows, 500):
            part, out = batch.slice(low, 500), []
            for t, z in zip(part.column("t").to_pylist(), part.column("z")):
                h, at, _, _ = anchors(zlib.decompress(z.as_py()))
                out.append((h, np.full(len(h), t, np.int64), at))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["h", "t", "a"])


def _recurring(size: int):
    """Of rows in order of h, those whose h recurs, with a chunk of about ``size``; ``whole``: all rows of this h are in it."""

    def run(batches):
        task = TaskContext.get().partitionId() << 32
        held = np.zeros((3, 0), np.int64)
        given, edge, long = 0, True, None  # rows so far; whether no run has ended yet; the h of a run that was cut

        def rows(x: np.ndarray, first: np.ndarray, whole: np.ndarray):
            """first: for each row, how many rows of x stand before those that must share its chunk."""
            nonlocal given
            chunk = task + (given + first) // size
            given += x.shape[1]
            return pa.RecordBatch.from_arrays([*map(pa.array, x), pa.array(chunk), pa.array(whole)], names=["h", "t", "a", "chunk", "whole"])

        for batch in batches:
            fresh = np.stack([batch.column(x).to_numpy(zero_copy_only=False) for x in ("h", "t", "a")])
            held = np.concatenate([held, fresh], axis=1)
            if not held.shape[1]:
                continue
            begin = np.flatnonzero(np.concatenate([[True], held[0, 1:] != held[0, :-1]]))
            ended, held = held[:, : begin[-1]], held[:, begin[-1] :]
            if ended.shape[1]:
                sizes = np.diff(begin)
                whole = np.ones(len(sizes), bool)
                whole[0] = not edge and ended[0, 0] != long
                keep = (sizes > 1) | ~whole
                edge, sizes, whole = False, sizes[keep], whole[keep]
                x = ended[:, np.repeat(keep, np.diff(begin))]
                if x.shape[1]:
                    first = np.where(np.repeat(whole, sizes), np.repeat(np.cumsum(sizes) - sizes, sizes), np.arange(x.shape[1]))
                    yield rows(x, first, np.repeat(whole, sizes))
            if held.shape[1] > size:
                long = held[0, 0]
                yield rows(held, np.arange(held.shape[1]), np.zeros(held.shape[1], bool))
                held = held[:, :0]
        if held.shape[1]:
            yield rows(held, np.arange(held.shape[1]), np.zeros(held.shape[1], bool))

    return run


_CONTEXT = ("chunk", "whole", "h", "t", "u", "low", "place", "context")


def _contexts(batches):
    for batch in batches:
        for low in range(0, batch.num_rows, 100):
            part, out = batch.slice(low, 100), []
            for t, u, z, marks in zip(*(part.column(x).to_pylist() for x in ("t", "u", "z", "marks"))):
                text = zlib.decompress(z)
                wanted = {(x["a"], x["h"]): (x["chunk"], x["whole"]) for x in marks}
                for h, at, first, last in zip(*(x.tolist() for x in anchors(text))):
                    found = wanted.get((at, h))
                    if found is not None:
                        out.append((*found, h, t, u, first, at - first, text[first : last + SPAN]))
            kinds = [pa.int64(), pa.bool_(), *[pa.int64()] * 5, pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(list(zip(*out)) or [()] * len(kinds), kinds)], names=list(_CONTEXT))


def _runs(marks: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marks.view(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


_FOUND = "t long, u long, start long, stop long, digest binary, chunk long"


def _sorted(table: pa.Table) -> pa.Table:
    """Repeats within one chunk as (t, u, start, stop); of anchors that stand in other chunks too, digests of all windows,
    with their place where this chunk has them once."""
    rows = list(zip(*(table.column(x).to_pylist() for x in _CONTEXT)))
    same: dict[bytes, list[int]] = {}
    for k, row in enumerate(rows):
        same.setdefault(row[-1], []).append(k)
    kinds: dict[int, list[bytes]] = {}
    for context, at in same.items():
        kinds.setdefault(rows[at[0]][2], []).append(context)
    marks = {c: np.full(len(c) - SPAN + 1, len(at) > 1) for c, at in same.items()}
    mixed = [(n, c) for n, own in enumerate(x for x in kinds.values() if len(x) > 1) for c in own]
    if mixed:
        places = np.array([rows[same[c][0]][6] for _, c in mixed])
        for (_, c), found in zip(mixed, repeated_windows([c for _, c in mixed], np.array([n for n, _ in mixed]), places)):
            marks[c] |= found
    out, told = [], set()
    for context, at in same.items():
        chunk, whole, *_ = rows[at[0]]
        spans = _runs(marks[context])
        for k in at:
            _, _, _, t, u, low, _, _ = rows[k]
            out += [(t, u, low + i, low + j - 1 + SPAN, None, None) for i, j in spans]
        if not whole:
            _, _, _, t, u, low, _, _ = rows[at[0]]
            for i, seen in enumerate(marks[context].tolist()):
                digest = hashlib.sha256(context[i : i + SPAN]).digest()
                if not seen:
                    out.append((t, u, low + i, low + i + SPAN, digest, chunk))
                elif digest not in told:
                    told.add(digest)
                    out.append((None, None, None, None, digest, chunk))
    columns = list(zip(*out)) or [()] * 6
    kinds_out = [*[pa.int64()] * 4, pa.binary(), pa.int64()]
    return pa.table({x.split()[0]: pa.array(c, k) for x, c, k in zip(_FOUND.split(", "), columns, kinds_out)})


def cut_out(text: bytes, spans: Sequence[tuple[int, int]]) -> tuple[int, int, str]:
    """Bytes removed, maximal removed runs, digest of what is left."""
    left, runs, at, kept = hashlib.sha256(), 0, 0, 0
    stop = None
    for low, high in sorted(spans):
        if stop is None or low > stop:
            left.update(text[at:low])
            kept, runs = kept + low - at, runs + 1
            stop = high
        stop = max(stop, high)
        at = stop
    left.update(text[at:])
    return at - kept, runs, left.hexdigest()


def _cut(batches):
    for batch in batches:
        out = []
        for u, d, z, spans in zip(*(batch.column(x).to_pylist() for x in ("u", "d", "z", "spans"))):
            own = [(x["start"], x["stop"]) for x in spans if x["u"] == u]
            if own:
                out.append((d, *cut_out(zlib.decompress(z), own)))
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(list(zip(*out)) or [()] * 4, kinds)], names=["d", "removed", "spans", "kept"])


def repeats(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of (doc_id, text)."""
    text = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    given = docs.select("doc_id", text.alias("text")).select("doc_id", "text", F.unhex(F.sha2("text", 256)).alias("d"), F.octet_length("text").cast("long").alias("n_bytes"))
    rows = materialise(given.select("doc_id", "d", "n_bytes"), "repeat-rows")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = min(MOST_BUCKETS, max(1, -(-total // BUCKET_BYTES)))

    long = given.where(F.col("n_bytes") >= SPAN).select(F.xxhash64("d").alias("t"), F.xxhash64("d", F.lit("u")).alias("u"), "d", "text")
    packed = long.mapInArrow(_first_seen, "t long, u long, d binary, z binary").repartition(buckets, "t").dropDuplicates(["t", "d"])
    texts = materialise_buckets(packed, "repeat-texts", "t", buckets)

    found = materialise(texts.select("t", "z").mapInArrow(_anchored, "h long, t long, a long"), "repeat-anchors")
    order = ["h", "t", "a"]
    recurring = found.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_recurring(chunk), "h long, t long, a long, chunk long, whole boolean")
    recurring = materialise(recurring, "repeat-recurring")
    marks = recurring.groupBy("t").agg(F.collect_list(F.struct("a", "h", "chunk", "whole")).alias("marks"))  # of one text
    contexts = texts.select("t", "u", "z").join(marks, "t").mapInArrow(_contexts, "chunk long, whole boolean, h long, t long, u long, low long, place long, context binary")
    ordered = materialise(contexts.groupBy("chunk").applyInArrow(_sorted, _FOUND), "repeat-found")

    between = ordered.where("digest is not null")
    again = between.groupBy("digest").agg(F.min("chunk").alias("least"), F.max("chunk").alias("most")).where("least < most").select("digest")
    crossing = between.where("t is not null").join(again, "digest")
    spans = ordered.where("digest is null").unionByName(crossing.select(ordered.columns)).groupBy("t").agg(F.collect_list(F.struct("u", "start", "stop")).alias("spans"))
    cut = texts.join(spans, "t").select("u", "d", "z", "spans").mapInArrow(_cut, "d binary, removed long, spans long, kept string")

    groups = materialise(rows.groupBy("d").agg(F.count("*").alias("n"), F.max("n_bytes").alias("size")), "repeat-copies")
    gone = (F.col("n") > 1) & (F.col("size") >= SPAN)
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    answers = groups.join(cut, "d", "left").select(
        "d",
        F.when(gone, F.col("size")).otherwise(F.coalesce("removed", zero)).alias("n_removed"),
        F.when(gone, one).otherwise(F.coalesce("spans", zero)).alias("n_spans"),
        F.when(gone, F.lit(EMPTY)).otherwise(F.coalesce("kept", F.lower(F.hex("d")))).alias("kept_sha256"),
    )
    answers = materialise(answers, "repeat-answers")
    return join_hot(rows, answers, "d", groups.select("d", "n")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op12_repeats(spark, sf_dir: str) -> DataFrame:
    """What 200-byte strings that occur elsewhere take from each document."""
    return repeats(table(spark, sf_dir, "documents"))
