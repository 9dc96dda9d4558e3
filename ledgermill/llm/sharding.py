"""Sharding by best-fit-decreasing bin packing of indivisible groups (copies of one text).

Law: ``bytes`` - shard sizes come out near equal. A group never splits. Groups are packed as
themselves, largest first, each into the bin with the tightest remaining capacity that takes it,
found in a balanced search tree (an AVL tree here). Groups of one size are interchangeable, so the
driver gets sizes with their numbers of groups and packs all groups of a size in a few steps; a
group's rank among those of its size then tells its bin. Sizes are told apart to PRECISE significant
bits (exactly below 2 ** PRECISE bytes, to 0.02 % above, rounded up), which bounds the number of
sizes by 2 ** (PRECISE - 1) for each doubling. Groups above an even share get a shard each; the capacity of
the others is an even share of the rest, then the least that takes what is over, so that a hot group leaves no
shard empty.

Defined cases: a null text has size 1 and groups with the other nulls; an empty text is a
group of its own; null and repeated doc_ids are rows like any other; an empty table gives no rows;
repeated rows each get a slot of their own; a very long text, or any group above an even share, makes
its shard that large, and the rest stays balanced; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import join_hot, materialise

SHARDS = 8
#: Significant bits to which group sizes are told apart.
PRECISE = 13
ROWS_PER_RUN = 50_000


@dataclass
class _Node:
    key: tuple[int, int]
    left: _Node | None = None
    right: _Node | None = None
    height: int = 1


class CapacityTree:
    """AVL tree of (remaining capacity, bin); pops the tightest bin that still takes a size."""

    def __init__(self) -> None:
        self.root: _Node | None = None

    def add(self, remaining: int, bin_id: int) -> None:
        self.root = self._add(self.root, (remaining, bin_id))

    def take(self, size: int) -> tuple[int, int] | None:
        at, best = self.root, None
        while at:
            if at.key[0] >= size:
                best, at = at.key, at.left
            else:
                at = at.right
        if best is not None:
            self.root = self._drop(self.root, best)
        return best

    @staticmethod
    def _level(node: _Node | None) -> int:
        return node.height if node else 0

    def _fixed(self, node: _Node) -> _Node:
        lean = self._level(node.left) - self._level(node.right)
        if lean > 1:
            if self._level(node.left.left) < self._level(node.left.right):
                node.left = self._turn(node.left, "left")
            return self._turn(node, "right")
        if lean < -1:
            if self._level(node.right.right) < self._level(node.right.left):
                node.right = self._turn(node.right, "right")
            return self._turn(node, "left")
        node.height = 1 + max(self._level(node.left), self._level(node.right))
        return node

    def _turn(self, node: _Node, to: str) -> _Node:
        away = "right" if to == "left" else "left"
        top = getattr(node, away)
        setattr(node, away, getattr(top, to))
        node.height = 1 + max(self._level(node.left), self._level(node.right))
        setattr(top, to, node)
        top.height = 1 + max(self._level(top.left), self._level(top.right))
        return top

    def _add(self, node: _Node | None, key: tuple[int, int]) -> _Node:
        if node is None:
            return _Node(key)
        if key < node.key:
            node.left = self._add(node.left, key)
        else:
            node.right = self._add(node.right, key)
        return self._fixed(node)

    def _drop(self, node: _Node, key: tuple[int, int]) -> _Node | None:
        if key < node.key:
            node.left = self._drop(node.left, key)
        elif key > node.key:
            node.right = self._drop(node.right, key)
        elif node.left is None or node.right is None:
            return node.left or node.right
        else:
            low = node.right
            while low.left:
                low = low.left
            node.key = low.key
            node.right = self._drop(node.right, low.key)
        return self._fixed(node)


Sizes = list[tuple[int, int]]
Plan = list[tuple[int, int, int]]


def best_fit_decreasing(sizes: Sizes, room: list[int]) -> tuple[Plan, Sizes]:
    """(size, bin, number of groups) in the order of packing, and what no bin takes, for (size, number of groups), sizes
    falling, into bins with so much room. A bin that takes a group stays the tightest for the next of its size as long as
    it takes one."""
    tree, out, over = CapacityTree(), [], []
    for k, free in enumerate(room):
        tree.add(free, k)
    for size, n in sizes:
        while n:
            found = tree.take(size)
            if found is None:
                over.append((size, n))
                break
            here = min(n, found[0] // size)
            out.append((size, found[1], here))
            tree.add(found[0] - here * size, found[1])
            n -= here
    return out, over


def pack_into(sizes: Sizes, bins: int) -> Plan:
    """Near equal bins. Groups above an even share of what is left get a bin each, largest first. The others are packed by
    best fit into the bins that remain, all open, with an even share of the rest as capacity; what is over then goes by
    best fit into the least capacity (to 0.05 %) that takes it. No bin exceeds that share by more than one group."""
    sizes, out, first = [list(x) for x in sizes], [], 0
    total = sum(s * n for s, n in sizes)
    while sizes and first < bins - 1 and sizes[0][0] * (bins - first) > total:
        out.append((sizes[0][0], first, 1))
        total -= sizes[0][0]
        first += 1
        sizes[0][1] -= 1
        if not sizes[0][1]:
            del sizes[0]
    share = total // (bins - first)
    found, over = best_fit_decreasing([tuple(x) for x in sizes], [share] * (bins - first))
    room = [share] * (bins - first)
    for size, k, n in found:
        room[k] -= size * n
    low, high, best = -1, over[0][0] if over else 0, None
    step = max(1, share // 2000)
    while over and high - low > step:
        middle = (low + high) // 2
        trial, left = best_fit_decreasing(over, [x + middle for x in room])
        if left:
            low = middle
        else:
            high, best = middle, trial
    if over and best is None:
        best, left = best_fit_decreasing(over, [x + high for x in room])
        assert not left  # a bin with an even share or less always takes one more group
    return out + [(size, k + first, n) for size, k, n in found + (best or [])]


def rounded(size: Column) -> Column:
    """A size (column) rounded up to PRECISE significant bits."""
    spare = F.greatest(F.length(F.bin(size)) - PRECISE, F.lit(0)).cast("int")
    unit = F.call_function("shiftleft", F.lit(1).cast("long"), spare)
    return (size + unit - 1 - (size + unit - 1) % unit).cast("long")


def ranked(rows: DataFrame, within: str, by: str, total: int, rows_per_run: int = ROWS_PER_RUN) -> DataFrame:
    """rows with ``rank`` from 0 among equal ``within``: row numbers in bounded runs plus the sizes of earlier runs."""
    runs = max(1, -(-total // rows_per_run))
    kept = rows.withColumn("run", F.pmod(F.xxhash64(by, F.lit("run")), F.lit(runs)).cast("int"))
    counts = kept.groupBy(within, "run").count()
    before = F.sum("count").over(Window.partitionBy(within).orderBy("run")) - F.col("count")
    number = F.row_number().over(Window.partitionBy(within, "run").orderBy(by)) - 1
    numbered = kept.withColumn("number", number).join(counts.select(within, "run", before.alias("before")), [within, "run"])
    return numbered.withColumn("rank", F.col("before") + F.col("number")).drop("run", "number", "before")


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, rows_per_run: int = ROWS_PER_RUN) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row of (doc_id, text)."""
    rows = materialise(
        docs.select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))).alias("text_crc32"),
            F.coalesce(F.sha2(F.encode("text", "UTF-8"), 256), F.lit("null")).alias("grp"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "shard-rows",
    )
    groups = materialise(rows.groupBy("grp").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).withColumn("about", rounded(F.col("bytes"))), "shard-groups")
    sizes = sorted(((x["about"], x["count"]) for x in groups.groupBy("about").count().collect()), reverse=True)  # bounded by PRECISE
    plan, done = [], {}
    for size, shard, n in pack_into(sizes, shards):
        low = done.get(size, 0)
        plan.append((size, low, low + n, shard))
        done[size] = low + n
    plan = docs.sparkSession.createDataFrame(plan, "about long, low long, high long, shard int")  # ``shards`` rows a size at most
    placed = ranked(groups, "about", "grp", sum(n for _, n in sizes), rows_per_run).join(F.broadcast(plan), "about")
    placed = placed.where((F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))).select("grp", "shard")
    dealt = join_hot(rows, placed, "grp", groups.select("grp", "n")).select("doc_id", "size", "text_crc32", "shard", "row")
    return with_slots(dealt, rows_per_run)


def with_slots(dealt: DataFrame, rows_per_run: int = ROWS_PER_RUN) -> DataFrame:
    """Adds ``slot``, gapless from 0 in each shard, to rows that ``row`` tells apart."""
    kept = materialise(dealt, "shard-dealt")
    return ranked(kept, "shard", "row", kept.count(), rows_per_run).withColumn("slot", F.col("rank").cast("long")).drop("row", "rank")


def op6_sharding(spark, sf_dir: str) -> DataFrame:
    """Best-fit-decreasing shards of all documents, law ``bytes``."""
    dealt = shard_by_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"), "slot", F.lit(None).cast("int").alias("grown_shard")
    )
