"""Quality rules: base counts of every text, then a hashed n-gram log-likelihood ratio.

Built-in functions only. The n-grams are all words and all pairs of neighbouring words, whole, hashed by
XXH64 into BUCKETS cells. Two multinomials with add-one smoothing are counted over all documents: the trusted target (documents labelled quality 1)
and the raw corpus. A document's ratio is the mean over its n-grams of log p_target - log p_raw; it is
kept if it passes the base rules and the ratio is at least the threshold, which is one number for all
documents: SPREADS standard deviations below the mean ratio of the target's texts of MIN_WORDS words or
more. (Ratios shrink as the corpus grows, so no constant serves every size.) Every document gets a verdict.

Defined cases: null text has no words (and so fails the base rules); with no trusted document the
ratio is 0 for all; repeated rows are counted and judged each; a doc_id labelled twice is trusted
if any of its labels is 1, and each text under it is; a null doc_id is judged and never trusted; a very
long text is split once and takes memory in proportion to it; an empty table gives no rows; columns of
other names are ignored, and kept as they were by keep_good.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, packed

BUCKETS, SPREADS = 1 << 16, 6
MIN_WORDS, MAX_REPEATED_PERCENT, WINDOW = 20, 30, 8
SPACE = r"[\x20\x09-\x0D]"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def let(value: Column, body) -> Column:
    """body(value) with value computed once, also where body uses it inside another lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), "")


def buckets_of(words: Column, buckets: int = BUCKETS) -> Column:
    """Cells of all words, then of all pairs of neighbours."""

    def cells(w: Column) -> Column:
        pairs = F.greatest(F.size(w) - 1, F.lit(0))
        one = F.transform(w, lambda x: F.pmod(F.xxhash64(x), F.lit(buckets)).cast("int"))
        return F.concat(one, F.zip_with(F.slice(w, F.lit(1), pairs), F.slice(w, F.lit(2), pairs), lambda x, y: F.pmod(F.xxhash64(x, y), F.lit(buckets)).cast("int")))

    return let(words, cells)


def _covered(windows: Column) -> Column:
    """Word places inside windows whose hash occurs again: sorted by hash, equal neighbours stay, intervals are united."""

    def repeated(s: Column) -> Column:
        return F.filter(s, lambda x, i: F.coalesce(F.when(i > 0, F.get(s, i - 1)["h"] == x["h"]), F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))

    def united(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)

    pairs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    places = let(F.sort_array(pairs), lambda s: F.sort_array(F.transform(repeated(s), lambda x: x["i"])))
    return let(places, united)


def repeated_words(words: Column) -> Column:
    """Words in WINDOW-word windows found twice or more in the text, first occurrence included."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    windows = let(hashes, lambda h: F.transform(F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(h, i, WINDOW))))
    counted = let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(_covered(w)))
    return F.when(F.size(words) < WINDOW, F.lit(0)).otherwise(counted)


def with_base(docs: DataFrame, words: str, text: str) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.length(whole) - F.length(F.regexp_replace(whole, r"[#*$%&|<>]", "")),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_repeat_words": repeated_words(F.col(words)),
    }
    added = docs.withColumns({k: v.cast("long") for k, v in counts.items()})
    n, again = F.col("n_words"), F.col("n_repeat_words")
    return added.withColumn("base_failed", (n < MIN_WORDS) | (100 * again > MAX_REPEATED_PERCENT * n))


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.lit(1).alias("_trusted"))


def ratio_weights(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> list[float]:
    """log p_target - log p_raw of each bucket, counted over all documents; ``buckets`` numbers come to the driver."""
    trusted = trusted_ids(labels)
    # Texts are shuffled and not their n-grams, which are larger; the labels grow with the corpus and are never broadcast.
    counts = (
        docs.select("doc_id", "text").join(trusted.hint("merge"), "doc_id", "left")
        .select(F.explode(buckets_of(words_of(F.col("text")), buckets)).alias("b"), "_trusted")
        .groupBy("b").agg(F.count("*").alias("raw"), F.count("_trusted").alias("target"))
        .collect()
    )
    raw, target = [0] * buckets, [0] * buckets
    for x in counts:
        raw[x["b"]], target[x["b"]] = x["raw"], x["target"]
    n_raw, n_target = sum(raw), sum(target)
    if not n_target:
        return [0.0] * buckets
    return [math.log((t + 1) / (n_target + buckets)) - math.log((r + 1) / (n_raw + buckets)) for r, t in zip(raw, target)]


def mean_ratio(words: Column, weights: list[float]) -> Column:
    table = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    total = lambda grams: F.aggregate(grams, F.lit(0.0), lambda a, b: a + F.get(table, b.cast("int"))) / F.size(grams)
    return F.when(F.size(words) > 0, let(buckets_of(words, len(weights)), total)).otherwise(F.lit(0.0))


def target_threshold(judged: DataFrame, labels: DataFrame) -> float:
    """SPREADS standard deviations below the mean ratio of the target's texts of MIN_WORDS words or more, from
    (doc_id, n_words, ratio) of all documents."""
    ids = trusted_ids(labels).select("doc_id")
    worded = judged.where(F.col("n_words") >= MIN_WORDS).join(ids.hint("merge"), "doc_id", "left_semi")
    mean, spread = worded.agg(F.avg("ratio"), F.stddev_pop("ratio")).first()
    return 0.0 if mean is None else mean - SPREADS * spread - 1e-9  # less than a rounding error of the mean


def judge(texts: DataFrame, weights: list[float]) -> DataFrame:
    """(doc, text) with the base counts and ``ratio`` added."""
    worded = texts.withColumn("words", words_of(F.col("text")))
    return with_base(worded, "words", "text").withColumn("ratio", mean_ratio(F.col("words"), weights)).drop("words", "text")


def _judged(docs: DataFrame, labels: DataFrame, shown: DataFrame) -> DataFrame:
    """(doc, counts, base_failed, ratio, kept): ``doc`` holds the columns of ``shown``, a selection of docs with doc_id and text."""
    # Written once: the threshold comes from the ratios of all texts, and verdicts then need no text.
    judged = judge(packed(shown).select("doc", "doc.text"), ratio_weights(docs, labels))
    if shown is not docs:
        judged = judged.withColumn("doc", F.struct("doc.doc_id"))
    judged = materialise(judged, "judged")
    threshold = target_threshold(judged.select("doc.doc_id", "n_words", "ratio"), labels)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= threshold))


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id and every count, the ratio and the verdict of each document."""
    return _judged(docs, labels, docs.select("doc_id", "text")).select("doc.doc_id", *COUNTS, "base_failed", "ratio", "kept")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with their columns as they were."""
    return _judged(docs, labels, docs).where("kept").select("doc.*")


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{x}.parquet") for x in ("documents", "labels"))
    return quality_rules(docs, labels).select("doc_id", *COUNTS, "base_failed", "kept", "ratio")
