"""The filters' audit against words counted one by one and against SQL on defined cases."""

import random
import re
from itertools import permutations

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgermill.llm import filter_audit
from ledgermill.llm.filter_audit import FILTERS, OP11_SQL, audit, distinct_words, failures, masks_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def mask(text):
    words = WORD.findall(text or "")
    text = text or ""
    capitals = sum("A" <= x <= "Z" for x in text)
    return (len(words) < 50) + 2 * (100 * len(set(words)) < 65 * len(words)) + 4 * (100 * capitals > 5 * len(text)) + 8 * bool(re.search(r"[#$%&*|]", text))


def drawn(n, seed=0):
    rng = random.Random(seed)
    pieces = ["word", "Word", "é", "ÀB", " ", " x", "a|b", "#", "x" * 40, "same", "same", "日本", "i", "\x1f", "Z"]
    return [rng.choice(["", " ", "\n"]) + "".join(rng.choice(pieces) + rng.choice([" ", "\t", "\x0b\x0c", "\r\n", " "]) for _ in range(rng.choice([0, 1, 49, 50, 51, 80, 200]))) for _ in range(n)]


def test_masks(monkeypatch):
    """Any cut into pieces, texts without a byte between others, words at the edges of texts."""
    texts = ["", "edge", "edge", "", *drawn(300), "word " * 60_000, "x" * 300_000, ""]
    wanted = [mask(x) for x in texts]
    for piece in (1, 5_000, 1_000_000):
        monkeypatch.setattr(filter_audit, "PIECE", piece)
        assert masks_of(pa.array([x.encode() for x in texts])).tolist() == wanted
    assert masks_of(pa.array([b"skip", *(x.encode() for x in texts)]).slice(1)).tolist() == wanted
    assert masks_of(pa.array([], pa.binary())).tolist() == []


def test_equal_hashes_are_verified():
    words = [b"ab", b"cd", b"ab", b"xyz", b"cd", b"q"]
    data = np.frombuffer(b"".join(words), np.uint8)
    sizes = np.array([len(x) for x in words])
    begins = np.cumsum(sizes) - sizes
    docs = np.array([0, 0, 0, 0, 2, 2])
    for hashes in (None, np.zeros(6, np.uint64), np.array([1, 1, 1, 2, 1, 1], np.uint64)):
        assert distinct_words(data, docs, begins, sizes, 3, hashes).tolist() == [3, 0, 2]


def frames(spark, docs):
    texts = drawn(40, 3) + ["Same text. " * 30] * 6 + [None, "", None]
    ids = [*range(40), 50, 50, 51, None, None, 49, 60, 61, None]
    sources = [f"s{k % 3}" for k in range(46)] + [None, "", "s0"]
    rows = list(zip(ids, texts, sources))
    frame = docs(*texts, ids=ids).drop("source").withColumn("n", F.lit(1))
    given = spark.createDataFrame(rows, "doc_id long, text string, source string").select("*", *(F.lit(7).alias(x) for x in frame.columns if x not in ("doc_id", "text", "source")))
    said = spark.createDataFrame([(k, k % 2, None if k % 5 else 1) for k in range(60)] + [(50, 1, 1), (50, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    return rows, given, said


def test_defined_cases(spark, docs):
    """Null ids, texts and sources, repeated ids and rows, clashing names: as counted row by row, and as in SQL."""
    rows, given, said = frames(spark, docs)
    masks = sorted(((x.doc_id, x.part, x.mask) for x in failures(given).collect()), key=str)
    least = {t or "": min((i for i, x, _ in rows if (x or "") == (t or "") and i is not None), default=None) for _, t, _ in rows}
    later = lambda i, t: i is not None and i > least[t or ""]
    assert masks == sorted(((i, s or "", mask(t) + 16 * later(i, t)) for i, t, s in rows), key=str)

    got = audit(given, said)
    labels = pa.Table.from_pylist([x.asDict() for x in said.collect()], schema=pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())]))  # noqa: F841
    documents = pa.Table.from_pylist([dict(zip(("doc_id", "text", "source"), x)) for x in rows])  # noqa: F841
    wanted = duckdb.sql(OP11_SQL)
    assert got.columns == wanted.columns
    found = sorted(map(tuple, got.collect()))
    assert found == sorted(wanted.fetchall()) and len(found) == 4 * 120 * 5
    assert audit(given.where("false"), said).collect() == [] and audit(given, said.where("false")).where("good_lost + toxic_lost > 0").count() == 0

    # The last part by hand: every order applied to its rows.
    own = [m for _, p, m in masks if p == "s1"]
    removed = {x: 0 for x in FILTERS}
    for order in permutations(FILTERS):
        left = own
        for f in order:
            bit = 1 << FILTERS.index(f)
            removed[f] += sum(bool(m & bit) for m in left)
            left = [m for m in left if not m & bit]
    at = got.columns.index("shapley")
    assert {x[1][x[2] - 1]: x[at] for x in found if x[0] == "s1"} == removed
