"""Packing documents into sequences of at most 2048 tokens by non-negative least squares.

A document is cut into full windows and one remainder shorter than a window. Only the histogram of
remainder lengths (at most 2047 counts) reaches the driver. There, shallow combinations of two to four
lengths that fill a window (to SLACK tokens) are enumerated, their repeat counts are solved against
the histogram by non-negative least squares and rounded down to what is there, and what is left over
is packed greedily, largest first. A left-over length for which no filling is found is cut into powers
of two, which fill windows without a gap. The plan gives, for each length, ranges of ranks; a row's
rank among equal lengths (numbered in bounded runs) picks its sequence and offset, so no group of equal
lengths meets in one task. Checksums of every possible piece are taken while tokenising, so ids are
never shuffled.

Defined cases: a null or empty text is the end id alone; null and repeated doc_ids are rows like any other;
repeated rows are packed each; ties in length go by row number; a very long text has as many full windows as
it fills; other columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise
from .tokenise import columns_of, default_vocabulary, encoder

WINDOW = 2048
END_ID = 1
#: Tokens of padding that a filling combination may leave.
SLACK = 8
#: Combinations of more than two lengths are taken among so many of the commonest lengths.
COMMON = 64
#: Rows of one length are numbered in runs of about so many rows of all lengths.
ROWS_PER_RUN = 8192


def combinations_of(lengths: dict[int, int], window: int = WINDOW, slack: int = SLACK, common: int = COMMON) -> list[tuple[int, ...]]:
    """Combinations of up to four lengths (not increasing) that fill the window to ``slack``."""
    present = sorted(lengths)
    held = set(present)
    found: set[tuple[int, ...]] = set()

    def filled(chosen: tuple[int, ...]) -> None:
        left = window - sum(chosen)
        for gap in range(slack + 1):
            if left - gap in held:
                found.add(tuple(sorted((*chosen, left - gap), reverse=True)))
                return

    for a in present:
        if window - slack <= a:
            found.add((a,))
        filled((a,))
        if 0 <= window % a <= slack and window // a <= 4:
            found.add((a,) * (window // a))
    top = sorted(present, key=lambda x: (-lengths[x], -x))[:common]
    for i, a in enumerate(top):
        for b in top[i:]:
            if a + b < window:
                filled((a, b))
                for c in top[: common // 4]:
                    if a + b + c < window:
                        filled((a, b, c))
    return sorted(found, reverse=True)


def nnls(combos: list[tuple[int, ...]], counts: dict[int, int], sweeps: int = 40) -> np.ndarray:
    """min |A x - h| over x >= 0 by coordinate descent; column j of A counts each length in combination j."""
    rest = {k: float(v) for k, v in counts.items()}
    columns = [[(x, c.count(x)) for x in dict.fromkeys(c)] for c in combos]
    norms = [sum(n * n for _, n in column) for column in columns]
    x = [0.0] * len(combos)
    for _ in range(sweeps):
        moved = 0.0
        for j, column in enumerate(columns):
            step = max(-x[j], sum(n * rest[a] for a, n in column) / norms[j])
            if step:
                x[j] += step
                moved = max(moved, abs(step))
                for a, n in column:
                    rest[a] -= n * step
        if moved < 0.01:
            break
    return np.array(x)


class Plan:
    """Ranges (length, low, high, sequence, repeat, offset): rank r in [low, high) of that length goes to sequence + (r - low) // repeat, at offset + (r - low) % repeat * length. cut: (length, low, high, [(power, first place)])."""

    def __init__(self, counts: dict[int, int], window: int = WINDOW, slack: int = SLACK) -> None:
        self.window, self.next = window, defaultdict(int)
        self.ranges: list[tuple[int, int, int, int, int, int]] = []
        self.sequences = 0
        left = dict(counts)
        combos = combinations_of(counts, window, slack)
        wanted = nnls(combos, counts)
        for j in sorted(range(len(combos)), key=lambda j: -wanted[j]):
            combo = combos[j]
            times = min(int(wanted[j]), *(left[a] // combo.count(a) for a in combo))
            self._use(combo, times, left)
        cut = self._greedy(left, slack)
        self.cut: list[tuple[int, int, int]] = []
        for length in sorted(cut, reverse=True):
            self.cut.append((length, self.next[length], self.next[length] + cut[length]))
            self.next[length] += cut[length]
        # Pieces of powers of two, largest first, end to end: none crosses a window's edge.
        self.pieces: list[tuple[int, int, int]] = []  # length, power, first place in the stream
        place = 0
        for bit in reversed(range(window.bit_length() - 1)):
            for length, low, high in self.cut:
                if length >> bit & 1:
                    self.pieces.append((length, 1 << bit, place))
                    place += (high - low) << bit
        self.stream, self.sequences = self.sequences, self.sequences + -(-place // window)

    def _use(self, combo: tuple[int, ...], times: int, left: dict[int, int]) -> None:
        if times <= 0:
            return
        offset = 0
        for length in dict.fromkeys(combo):
            repeat = combo.count(length)
            low = self.next[length]
            self.ranges.append((length, low, low + times * repeat, self.sequences, repeat, offset))
            self.next[length] += times * repeat
            left[length] -= times * repeat
            offset += repeat * length
        self.sequences += times

    def _greedy(self, left: dict[int, int], slack: int) -> dict[int, int]:
        cut: dict[int, int] = {}
        present = sorted(x for x, n in left.items() if n)
        while present:
            first = present[-1]
            used: dict[int, int] = {first: 1}
            room = self.window - first
            while room:
                i = bisect_right(present, room) - 1
                while i >= 0 and left[present[i]] <= used.get(present[i], 0):
                    i -= 1
                if i < 0:
                    break
                x = present[i]
                n = min(left[x] - used.get(x, 0), room // x)
                used[x] = used.get(x, 0) + n
                room -= n * x
            if room > slack:
                cut[first], left[first] = cut.get(first, 0) + left[first], 0
            else:
                self._use(tuple(x for x, n in used.items() for _ in range(n)), min(left[x] // n for x, n in used.items()), left)
            present = [x for x in present if left[x]]
        return cut


def tokenised(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID, window: int = WINDOW) -> DataFrame:
    """row, doc_id, doc_tokens, and checksums of its full windows, its remainder and the remainder's powers of two."""
    vocabulary = vocabulary or default_vocabulary()

    def count(batches):
        encode = encoder(vocabulary)
        end = np.array([end_id], "<u4")
        for ids, texts in columns_of(batches):
            doc_ids = pa.array(ids, pa.int64())
            tokens, full, rest, powers = [], [], [], []
            for packed in encode.encode(texts):
                raw = np.concatenate([encode.as_uint32(packed), end]).tobytes()
                n = len(raw) // 4
                tokens.append(n)
                edge = n // window * window
                full.append([zlib.crc32(raw[4 * i : 4 * (i + window)]) for i in range(0, edge, window)])
                rest.append(zlib.crc32(raw[4 * edge :]))
                at, parts = edge, []
                for bit in reversed(range(window.bit_length() - 1)):
                    if (n - edge) >> bit & 1:
                        parts.append(zlib.crc32(raw[4 * at : 4 * (at + (1 << bit))]))
                        at += 1 << bit
                powers.append(parts)
            many = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([doc_ids, pa.array(tokens, pa.int64()), pa.array(full, many), pa.array(rest, pa.int64()), pa.array(powers, many)], names=["doc_id", "doc_tokens", "full", "rest", "powers"])

    kept = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counted = kept.mapInArrow(count, "doc_id long, doc_tokens long, full array<long>, rest long, powers array<long>")
    return materialise(counted.withColumn("row", F.monotonically_increasing_id()), "pack-tokens")


def pack(docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW, rows_per_run: int = ROWS_PER_RUN) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    spark = docs.sparkSession
    rows = tokenised(docs, vocabulary, window=window)
    rows = rows.withColumn("length", (F.col("doc_tokens") % window).cast("int"))
    counts = {x["length"]: x["count"] for x in rows.groupBy("length").count().collect()}  # at most ``window`` of them
    total = sum(counts.values())
    counts.pop(0, None)
    plan = Plan(counts, window)
    runs = max(1, -(-total // rows_per_run))
    rows = rows.withColumn("run", F.pmod(F.xxhash64("row"), F.lit(runs)).cast("int"))

    # Rank among the rows of one length, and number of full windows before: within a run, plus earlier runs.
    by_length = rows.where(F.col("length") > 0)
    per_run = by_length.groupBy("length", "run").count()
    earlier = per_run.select("length", "run", (F.sum("count").over(Window.partitionBy("length").orderBy("run")) - F.col("count")).alias("before"))
    number = F.row_number().over(Window.partitionBy("length", "run").orderBy("row")) - 1
    ranked = by_length.withColumn("number", number).join(earlier, ["length", "run"]).withColumn("rank", F.col("before") + F.col("number"))

    base = (F.col("doc_tokens") - F.col("length")).alias("start")
    ranges = spark.createDataFrame(plan.ranges, "length int, low long, high long, first long, repeat long, at long")
    within = F.col("rank") - F.col("low")
    placed = ranked.join(F.broadcast(ranges), "length").where((F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    whole = placed.select("doc_id", base, F.col("length").cast("long").alias("length"), F.col("rest").alias("ids_crc32"), "doc_tokens", (F.col("first") + F.floor(within / F.col("repeat"))).alias("sequence_id"), (F.col("at") + within % F.col("repeat") * F.col("length")).alias("offset"))

    lows = {length: low for length, low, _ in plan.cut}
    bits = [(length, lows[length], power, (length >> power.bit_length()).bit_count(), (length >> power.bit_length()) << power.bit_length(), place) for length, power, place in plan.pieces]
    cuts = spark.createDataFrame(bits, "length int, low long, power long, nth int, skip long, place long")
    place = F.col("place") + (F.col("rank") - F.col("low")) * F.col("power")
    cut = ranked.join(F.broadcast(cuts), "length").where(F.col("rank") >= F.col("low"))
    cut = cut.select("doc_id", (base + F.col("skip")).alias("start"), F.col("power").alias("length"), F.get("powers", F.col("nth")).alias("ids_crc32"), "doc_tokens", (F.lit(plan.stream) + F.floor(place / window)).alias("sequence_id"), (place % window).alias("offset"))

    long = rows.where(F.col("doc_tokens") >= window)
    sizes = long.groupBy("run").agg(F.sum(F.size("full")).alias("n"))
    before = sizes.select("run", (F.sum("n").over(Window.orderBy("run")) - F.col("n")).alias("before"))  # one row a run
    order = Window.partitionBy("run").orderBy("row")
    counted = long.withColumn("mine", F.sum(F.size("full")).over(order) - F.size("full")).join(before, "run")
    full = counted.select("doc_id", "doc_tokens", (F.col("before") + F.col("mine")).alias("first"), F.posexplode("full").alias("k", "ids_crc32"))
    full = full.select("doc_id", (F.col("k").cast("long") * window).alias("start"), F.lit(window).cast("long").alias("length"), "ids_crc32", "doc_tokens", (F.lit(plan.sequences) + F.col("first") + F.col("k")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return whole.unionByName(cut).unionByName(full)


def op3_packing(spark, sf_dir: str) -> DataFrame:
    """All documents' pieces and places."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
