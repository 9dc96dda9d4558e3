"""Toxicity: gradient-boosted trees over dense features of the whole text, isotonically calibrated.

The features: density and strength of lexicon words, their closeness to second-person words, rates of
capitals, punctuation, digits, symbols and obfuscated words, and length. The lexicon itself is learnt:
words far more frequent (by documents) under label 1. Everything is fitted on at most PER_CLASS
labelled documents of each class, the ones with the smallest hash of their id, weighted back to the
classes' true sizes; rows whose crc32(doc_id as text) mod 5 is 0 are held out of all fitting. Two-fold
cross-fitting keeps the lexicon, the trees and the calibration from seeing their own rows. Words are
counted and features taken where the texts lie: the driver gets the lexicon and 2 * PER_CLASS rows of
N_FEATURES numbers, never a text.

Defined cases: null and empty texts get the score of their (zero) features; a null doc_id is scored and
never fitted on; a doc_id labelled twice counts as toxic if any label is 1; of several texts under one
labelled doc_id the one with the smallest hash is fitted on; with labels of one class only, or none,
every score is that class's rate (0 without labels); repeated rows are scored each; features take time
in proportion to the text, whatever it holds; other columns are ignored, and kept as they were by
keep_clean, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .boosting import BoostedTrees, Isotonic
from .common import discard, materialise, packed

#: At most so many labelled documents of each class are fitted on.
PER_CLASS = 4000
HELD_OUT = 5
#: A lexicon word: in so many toxic documents at least (number, part), and so much likelier (log) under label 1.
SUPPORT, SUPPORT_PART, LOG_ODDS = 3, 0.012, 2.0
NEAR = 5

# Second-person words of four languages.
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves du dich dir dein deine deiner ihr euch euer tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros".split()
)
# Characters written for letters.
LOOKALIKES = str.maketrans("@4310$5!7", "aaeiossit")

_WORD = re.compile(r"[^\W\d_]+")
#: From the start of a run of letters only, and without going back: one pass over any text.
_OBFUSCATED = re.compile(r"(?<![^\W\d_])[^\W\d_]++(?:[@$!*0134570.\-]++[^\W\d_]++)++")
_CHUNK = 1 << 20
N_FEATURES = 20


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    text = text or ""
    low = text.lower()
    words = _WORD.findall(low)
    n = len(words) or 1
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    raw = np.zeros(256, np.int64)
    for at in range(0, len(data), _CHUNK):
        raw += np.bincount(data[at : at + _CHUNK], minlength=256)
    size = int(raw.sum()) or 1
    odd = [x for x in _OBFUSCATED.findall(low) if not x.isalpha()]
    plain = [y for y in (re.sub(r"[^\w]", "", x.translate(LOOKALIKES)) for x in odd) if y in lexicon]
    hits = [] if lexicon.keys().isdisjoint(words) else [i for i, x in enumerate(words) if x in lexicon]
    near = 0
    seconds = sum(map(SECOND_PERSON.__contains__, words))
    if hits and seconds:
        near = sum(not SECOND_PERSON.isdisjoint(words[max(0, i - NEAR) : i + NEAR + 1]) for i in hits)
    kinds = {words[i] for i in hits} | set(plain)
    odds = sorted((lexicon[x] for x in kinds), reverse=True)
    found = len(hits) + len(plain)
    letters = int(raw[65:91].sum() + raw[97:123].sum()) or 1
    return [
        math.log1p(len(words)),
        1000 * found / n,
        math.log1p(found),
        len(kinds),
        sum(odds),
        odds[0] if odds else 0.0,
        odds[1] if len(odds) > 1 else 0.0,
        near / found if found else 0.0,
        near,
        seconds / n,
        int(raw[65:91].sum()) / letters,
        int(raw[33:48].sum() + raw[58:65].sum() + raw[91:97].sum() + raw[123:127].sum()) / size,
        int(raw[33]) / size,
        int(raw[63]) / size,
        int(raw[[35, 36, 37, 38, 42, 60, 62, 64, 124]].sum()) / size,
        int(raw[48:58].sum()) / size,
        len(odd) / n,
        len(plain),
        int(raw[128:].sum()) / size,
        sum(map(len, words)) / n,
    ]


class ToxicityModel:
    def __init__(self, constant: float = 0.0) -> None:
        self.constant, self.lexicon, self.trees, self.calibration = constant, {}, None, None

    @classmethod
    def fit(cls, crossed: np.ndarray, labels: np.ndarray, weight: np.ndarray, folds: np.ndarray, lexicon: dict[str, float]) -> ToxicityModel:
        """From features whose lexicon was learnt on the other fold, and the lexicon of both."""
        model = cls(float(np.average(labels, weights=weight)) if len(labels) else 0.0)
        if len(set(labels.tolist())) < 2 or min(np.bincount(folds, minlength=2)) == 0:
            return model
        # Each fold's margins come from trees of the other fold, whose features in turn come from the first one's words.
        margins = np.zeros(len(crossed))
        for fold in (0, 1):
            there, here = np.flatnonzero(folds != fold), np.flatnonzero(folds == fold)
            margins[here] = BoostedTrees().fit(crossed[there], labels[there], weight[there]).margin(crossed[here])
        model.calibration = Isotonic().fit(margins, labels, weight)
        model.trees = BoostedTrees().fit(crossed, labels, weight)
        model.lexicon = lexicon
        return model

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.trees is None or not texts:
            return np.full(len(texts), self.constant)
        return self.calibration(self.trees.margin(np.array([features(x, self.lexicon) for x in texts])))


def remainder(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")), F.lit(HELD_OUT))


def _sample(docs: DataFrame, labels: DataFrame, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, toxic, fold, text) of the rows to fit on, 2 * per_class at most, and the true size of each class."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id")) != 0)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.where(F.col("toxic").isin(0, 1))
    sizes = {x["toxic"]: x["count"] for x in known.groupBy("toxic").count().collect()}
    chosen = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    ids = chosen[0].union(chosen[1])  # 2 * per_class ids at most
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("first"))
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(2)).cast("int")
    return materialise(rows.select("doc_id", "toxic", fold.alias("fold"), F.col("first.text").alias("text")), "toxicity-sample"), sizes


def _word_counts(sample: DataFrame) -> DataFrame:
    """Documents that hold each word, by label and fold: word, t0, t1 (toxic), o0, o1 (other)."""

    def count(batches):
        for batch in batches:
            cells = [Counter() for _ in range(4)]
            for y, fold, text in zip(*(batch.column(i) for i in range(3))):
                cells[2 * (1 - y.as_py()) + fold.as_py()].update(set(_WORD.findall((text.as_py() or "").lower())))
            words = list(set().union(*cells))
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *(pa.array([c[x] for x in words], pa.int64()) for c in cells)], names=["word", "t0", "t1", "o0", "o1"])

    counted = sample.select("toxic", "fold", "text").mapInArrow(count, "word string, t0 long, t1 long, o0 long, o1 long")
    return counted.groupBy("word").agg(*(F.sum(x).alias(x) for x in ("t0", "t1", "o0", "o1")))


def learn_lexicons(sample: DataFrame) -> list[dict[str, float]]:
    """Words with their log-odds under label 1, by document frequency: learnt on fold 0, on fold 1, on both."""
    sizes = {(x["toxic"], x["fold"]): x["count"] for x in sample.groupBy("toxic", "fold").count().collect()}
    odds = []
    for folds in ((0,), (1,), (0, 1)):
        n_toxic, n_other = (sum(sizes.get((y, f), 0) for f in folds) for y in (1, 0))
        toxic, other = (reduce(Column.__add__, (F.col(f"{c}{f}") for f in folds)) for c in "to")
        value = F.log((toxic + 0.5) / (n_toxic + 1)) - F.log((other + 0.5) / (n_other + 1))
        odds.append(F.when((toxic >= max(SUPPORT, SUPPORT_PART * n_toxic)) & (value >= LOG_ODDS), value))
    found = _word_counts(sample).select("word", *(x.alias(f"l{i}") for i, x in enumerate(odds))).where(F.coalesce("l0", "l1", "l2").isNotNull()).collect()
    return [{x["word"]: x[f"l{i}"] for x in found if x[f"l{i}"] is not None} for i in range(3)]


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> ToxicityModel:
    """The model from labelled documents that are not held out."""
    sample, sizes = _sample(docs, labels, per_class)
    *single, both = learn_lexicons(sample)
    sent = docs.sparkSession.sparkContext.broadcast(single)

    def described(batches):
        for batch in batches:
            rows = [features(text.as_py(), sent.value[1 - fold.as_py()]) for fold, text in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "toxic", "fold", "x"])

    rows = sample.mapInArrow(described, sample.select("doc_id", "toxic", "fold", F.array(F.lit(0.0)).alias("x")).schema).collect()  # 2 * per_class rows of numbers
    rows.sort(key=lambda x: x["doc_id"])
    y = np.array([x["toxic"] for x in rows], dtype=np.float64)
    picked = np.bincount(y.astype(int), minlength=2)
    weight = np.array([sizes[int(x)] / picked[int(x)] for x in y])
    weight = weight / weight.mean() if len(weight) else weight
    discard(sample)
    return ToxicityModel.fit(np.array([x["x"] for x in rows]).reshape(-1, N_FEATURES), y, weight, np.array([x["fold"] for x in rows], dtype=np.int64), both)


def with_scores(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc, score) of every row."""
    kept, place = packed(docs), docs.columns.index("text")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def add(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                docs = batch.column(0).slice(at, 512)
                scores = sent.value.score(pc.struct_field(docs, [place]).to_pylist())
                yield pa.RecordBatch.from_arrays([docs, pa.array(scores, pa.float64())], names=["doc", "score"])

    return kept.mapInArrow(add, kept.withColumn("score", F.lit(0.0)).schema)


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    docs = docs.select("doc_id", "text")
    scored = with_scores(docs, fit(docs, labels, per_class)).select("doc.doc_id", "score")
    return scored.select("doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents scored under 0.5, with their columns as they were."""
    return with_scores(docs, fit(docs, labels)).where(F.col("score") < 0.5).select("doc.*")


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    """Score and prediction of every document."""
    return toxicity(*(spark.read.parquet(f"{sf_dir}/{x}.parquet") for x in ("documents", "labels")))
