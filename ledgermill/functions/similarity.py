"""Gestalt similarity of strings. It is not symmetric and no built-in function has it, so it runs in
Arrow batches; equal pairs are answered once a batch."""

from __future__ import annotations

from difflib import SequenceMatcher
from functools import reduce
from operator import add

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .names import comparable_name

NEAR = 0.9


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    pairs = pd.DataFrame({"a": a, "b": b})
    known = {(x, y): SequenceMatcher(None, x, y).ratio() for x, y in pairs.dropna().drop_duplicates().itertuples(index=False)}
    return pd.Series([known.get(x) for x in zip(a, b)], dtype="float64")


#: What comparable names are made of.
LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789 "


def ratio_bound(a: Column, b: Column) -> Column:
    """An upper bound of the ratio: twice the characters that both names hold, each as often as the one that holds it less
    often, by the characters of both. No matching of blocks can pair more."""
    times = lambda text, x: F.length(text) - F.length(F.replace(text, F.lit(x)))
    shared = reduce(add, (F.least(times(a, x), times(b, x)) for x in LETTERS))
    return 2.0 * shared / (F.length(a) + F.length(b))


def may_be_near(a: Column, b: Column, least: float = NEAR) -> Column:
    """Whether the ratio of two comparable names can reach ``least``: first by their lengths, then by their characters."""
    short, long = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    return (2.0 * short >= least * (short + long)) & (ratio_bound(a, b) >= least)


def near_exact(query: Column, candidate: Column) -> Column:
    """Both names hold something and are equal or similar; only pairs whose bounds leave it open reach similarity()."""
    a, b = comparable_name(query), comparable_name(candidate)
    needed = (a != "") & (b != "") & (a != b) & may_be_near(a, b)
    ratio = similarity(F.when(needed, a), F.when(needed, b))
    return (a != "") & (b != "") & ((a == b) | F.coalesce(ratio >= NEAR, F.lit(False)))


def _grams(name: Column, size: int) -> Column:
    """Runs of ``size`` neighbouring characters, each with how often it stood before, in an order that all names share."""
    every = F.transform(F.sequence(F.lit(1), F.length(name) - (size - 1)), lambda k: F.substring(name, k, F.lit(size)))
    counted = F.transform(every, lambda x, k: F.concat(x, F.size(F.filter(F.slice(every, F.lit(1), k + 1), lambda y: y == x)).cast("string")))
    return F.transform(F.array_sort(F.transform(counted, lambda x: F.struct(F.xxhash64(x).alias("h"), x.alias("x")))), lambda s: s["x"])


#: Left names of up to SEGMENTED characters meet others by segments, longer ones by threes of characters; no right name under
#: LONG is near to one of the latter.
SEGMENTED, LONG = 60, 49


def _edits(n: Column, m: Column, least: float) -> Column:
    """How many characters of two names, of n and m characters, no block may match for a ratio of ``least``."""
    most = F.floor((n + m) * (1 - least) + 1e-6).cast("int")
    return most - (most + n + m) % 2


def _segment_keys(name: Column, n: Column, m: Column, least: float, right: bool) -> Column:
    """Keys of a left name's segments, or of the places in a right name where one of them may stand: n and m are the lengths
    of the left and the right name."""
    edits = _edits(n, m, least)
    short = F.floor(n / (edits + 1)).cast("int")
    longer = edits + 1 - n % (edits + 1)  # from here on segments have a character more

    def keys(i: Column) -> Column:
        start, size = i * short + F.greatest(i - longer, F.lit(0)) + 1, short + (i >= longer).cast("int")
        key = lambda at: F.xxhash64(n, m, i, F.substring(name, at, size))
        if not right:
            return F.array(key(start))
        shifts = F.sequence(F.greatest(-i, m - n - edits + i), F.least(i, m - n + edits - i), F.lit(2))
        fits = F.filter(F.transform(shifts, lambda s: start + s), lambda at: (at >= 1) & (at + size - 1 <= m))
        return F.transform(fits, key)

    return F.flatten(F.transform(F.sequence(F.lit(0), edits), keys))


def _threes(name: Column, least: float) -> Column:
    """Keys of which two long names with a ratio of ``least`` or more share one."""
    n = F.length(name)
    both = (1 + least / (2 - least)) * n  # characters of this and the shortest name that is near to it
    kept = n - 1 - F.ceil((2.5 * least - 2) * both - 2 - 1e-9).cast("int")
    return F.transform(F.slice(_grams(name, 3), F.lit(1), F.greatest(kept, F.lit(1))), lambda x: F.xxhash64(x))


def near_candidates(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """Pairs of the different names in ``left`` and ``right`` (a column each) that share a key and are near enough in length
    and by Levenshtein's distance: all with a ratio of ``least`` or more, and few others."""
    near = 2.0 * F.least("left_n", "right_n") >= least * (F.col("left_n") + F.col("right_n"))
    measured = {own: rows.select(own, F.length(own).alias(f"{own}_n")) for own, rows in (("left", left), ("right", right))}
    lengths = lambda own: measured[own].select(f"{own}_n").distinct()
    sizes = lengths("left").where(F.col("left_n") <= SEGMENTED).join(lengths("right"), near)

    def keyed(own: str, longest: Column) -> DataFrame:
        placed = measured[own].join(F.broadcast(sizes), f"{own}_n")
        segments = placed.select(own, F.explode(_segment_keys(F.col(own), F.col("left_n"), F.col("right_n"), least, own == "right")).alias("key"))
        return segments.union(measured[own].where(longest).select(own, F.explode(F.array_distinct(_threes(F.col(own), least))).alias("key")))

    met = keyed("left", F.col("left_n") > SEGMENTED).join(keyed("right", F.col("right_n") >= LONG), "key")
    met = met.select("left", "right", F.length("left").alias("left_n"), F.length("right").alias("right_n")).where(near)
    distance = F.call_function("levenshtein", "left", "right", _edits(F.col("left_n"), F.col("right_n"), least))
    return met.where(distance >= 0).select("left", "right").distinct()


def near_names(left: DataFrame, right: DataFrame, least: float = NEAR) -> DataFrame:
    """left, right (ids), score: the pairs of (id, name) rows whose comparable names have a ratio of ``least`` (0.9 or more)
    or more, though no key narrows them.

    A ratio r over S characters leaves at most E = S (1 - r) of them outside the matching blocks, so E deletions and
    insertions make one name of the other. Of E + 1 segments of the left name let the i-th be the first before whose end
    there are fewer than i of them: it holds none, exactly i - 1 come before it and at most E - i + 1 behind it. So it
    stands in the right name, moved by one of few steps, and the names meet by it. Names that are long meet by threes of
    characters instead: with M = S r / 2 matched, 5M - 2S - 2 threes are common to both, and with each name's in one order
    one of the first few of both must agree. What met is checked by lengths and Levenshtein's distance (no more than E), and
    what is left by similarity(). Equal names are one row before they meet."""
    if not NEAR <= least <= 1:
        raise ValueError("the filter holds from 0.9 on")

    def prepared(rows: DataFrame, own: str) -> DataFrame:
        named = rows.select(F.col("id").alias(f"{own}_id"), comparable_name(F.col("name")).alias(own)).where(F.col(own) != "")
        return named.groupBy(own).agg(F.collect_set(f"{own}_id").alias(f"{own}_ids"))

    a, b = prepared(left, "left"), prepared(right, "right")
    pairs = near_candidates(a.select("left"), b.select("right"), least)
    open_ = F.col("left") != F.col("right")
    asked = similarity(F.when(open_, F.col("left")), F.when(open_, F.col("right")))
    scored = pairs.withColumn("score", F.coalesce(asked, F.lit(1.0))).where(F.col("score") >= least)
    found = scored.join(a, "left").join(b, "right")
    return found.select(F.explode("left_ids").alias("left"), "right_ids", "score").select("left", F.explode("right_ids").alias("right"), "score")
