import random
import re
import time
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgermill.llm.boosting import BoostedTrees
from ledgermill.llm.toxicity import _OBFUSCATED, LOG_ODDS, _sample, features, fit, learn_lexicons, toxicity


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="abé@$.-_13 9!", max_size=24))
def test_obfuscated_is_the_plain_pattern(text):
    assert _OBFUSCATED.findall(text) == re.findall(r"[^\W\d_]+(?:[@$!*0134570.\-]+[^\W\d_]+)+", text)


def test_long_runs_take_time_in_proportion():
    for unit in ("a", "9", "1.", "a.", "you ", "A!b@"):
        began = time.perf_counter()
        features(unit * (3_000_000 // len(unit)), {"you": 3.0})
        assert time.perf_counter() - began < 20


def plain_trees(x, y, weight, rounds, depth, rate, ridge):
    """Boosting by trying every cut of every feature in every node."""
    p = np.average(y, weights=weight)
    margin = np.full(len(y), np.log(p / (1 - p)))
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-margin))
        g, h = (q - y) * weight, q * (1 - q) * weight
        nodes = [np.arange(len(y))]
        for _ in range(depth):
            following = []
            for rows in nodes:
                best, cut = 1e-9, None
                score = lambda r: g[r].sum() ** 2 / (h[r].sum() + ridge)
                for j in range(x.shape[1]):
                    for v in np.unique(x[:, j])[:-1]:
                        left, right = rows[x[rows, j] <= v], rows[x[rows, j] > v]
                        gain = score(left) + score(right) - score(rows)
                        if gain > best + 1e-9:
                            best, cut = gain, (left, right)
                following += cut or (rows, rows[:0])
            nodes = following
        for rows in nodes:
            margin[rows] -= rate * g[rows].sum() / (h[rows].sum() + ridge)
    return margin


def test_trees_are_those_of_every_cut():
    draw = np.random.default_rng(4)
    x = draw.integers(0, 6, (80, 3)).astype(float)
    y = ((x[:, 0] > 2) ^ (x[:, 1] > 3)).astype(float)
    y[:6] = 1 - y[:6]
    weight = draw.random(80) + 0.5
    found = BoostedTrees(rounds=6, depth=2, rate=0.3, bins=100, ridge=1.0).fit(x, y, weight).margin(x)
    assert np.allclose(found, plain_trees(x, y, weight, 6, 2, 0.3, 1.0))


def drawn(n=600):
    draw = random.Random(6)
    plain = ["".join(draw.choice("abcdefghij") for _ in range(5)) for _ in range(200)]
    texts = []
    for i in range(n):
        words = [draw.choice(plain) for _ in range(draw.randint(15, 40))]
        if i % 5 == 0:
            words[3:3] = ["scumbag", "vermin", "blockhead"][: 1 + i % 3] + ["you"]
        texts.append(" ".join(words))
    return texts


def test_lexicon_counts(spark, docs, labels):
    """Words' log-odds on each fold and on both, against a count by hand."""
    texts = drawn()
    sample, sizes = _sample(docs(*texts), labels([(i, 1, int(i % 5 == 0)) for i in range(600)]), 4000)
    rows = sample.collect()
    assert not any(zlib.crc32(str(x.doc_id).encode()) % 5 == 0 for x in rows) and sum(sizes.values()) == len(rows)
    for folds, lexicon in zip(((0,), (1,), (0, 1)), learn_lexicons(sample)):
        bags = {y: [set(x.text.split()) for x in rows if x.toxic == y and x.fold in folds] for y in (0, 1)}
        held = {y: lambda w, y=y: sum(w in b for b in bags[y]) for y in (0, 1)}
        wanted = {}
        for w in set().union(*bags[1]):
            odds = np.log((held[1](w) + 0.5) / (len(bags[1]) + 1)) - np.log((held[0](w) + 0.5) / (len(bags[0]) + 1))
            if held[1](w) >= max(3, 0.012 * len(bags[1])) and odds >= LOG_ODDS:
                wanted[w] = odds
        assert lexicon.keys() == wanted.keys() and all(np.isclose(lexicon[w], wanted[w]) for w in wanted)


def test_repeated_and_null_ids(spark, docs, labels):
    """Of several texts under one labelled doc_id the one with the smallest hash is fitted on, in any order of the rows."""
    texts, known = drawn(), labels([(i, 1, int(i % 5 == 0)) for i in range(600)] + [(None, 1, 1)])
    more = [f"quite another text {i}" for i in range(40)]
    ids = [*range(600), *[7] * 20, *[None] * 20]
    frame = docs(*texts, *more, ids=ids)
    one, two = (fit(x, known) for x in (frame, frame.orderBy(F.desc("text")).repartition(3)))
    assert one.lexicon == two.lexicon and np.array_equal(one.score(texts), two.score(texts))
    out = toxicity(frame, known)
    assert out.count() == 640 and out.where("doc_id is null and not held_out").count() + out.where("doc_id is null and held_out").count() == 20
