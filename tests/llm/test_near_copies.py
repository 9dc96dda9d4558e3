import random

import numpy as np

from ledgermill.llm.near_copies import band_keys, group_roots, keep_one, shingles, similar


def brute_set(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} - {()}


def changed(words, n, draw):
    out = list(words)
    for i in draw.sample(range(len(words)), n):
        out[i] = f"new{draw.random()}"
    return out


def test_near_copies_of_similarity_four_fifths(spark, docs):
    """Copies with a few words changed are over 3 bits of 64 apart, and yet similar."""
    draw, texts = random.Random(1), []
    for _ in range(40):
        words = [f"w{draw.randrange(5000)}" for _ in range(draw.randint(100, 400))]
        texts.append(" ".join(words))
        texts += [" ".join(changed(words, n, draw)) for n in (1, len(words) // 60, len(words) // 40, len(words) // 15)]
    sets, top = [brute_set(x) for x in texts], list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                top = [top[j] if x == top[i] else x for x in top]
    first = {}
    for i, x in enumerate(top):
        first.setdefault(x, i)
    assert len(first) < len(texts) - 60
    frame = docs(*texts)
    out = keep_one(frame)
    assert out.columns == frame.columns and {x.doc_id for x in out.collect()} == set(first.values())
    # Groups above two nodes go pair by pair and block by block.
    assert {x.doc_id for x in keep_one(frame, largest=2).collect()} == set(first.values())


def test_one_large_group(spark, docs):
    """Near copies of one text, with some that only few others are near to."""
    draw = random.Random(2)
    words = [f"w{i}" for i in range(120)]
    texts = [" ".join(changed(words, 1 + i % 3, draw)) for i in range(90)] + [" ".join(changed(words, 40, draw)) for _ in range(5)]
    sets, top = [brute_set(x) for x in texts], list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                top = [top[j] if x == top[i] else x for x in top]
    for largest in (8, 1024):
        assert {x.doc_id for x in keep_one(docs(*texts), largest).collect()} == {min(i for i, x in enumerate(top) if x == t) for t in top}
    assert keep_one(docs("x").where("false")).count() == 0


def test_similar_and_keys():
    a = np.arange(9, dtype=np.uint64)
    assert similar(a[:8], a[:8]) and similar(a[:8], np.arange(10, dtype=np.uint64)) and not similar(a[:7], a)
    assert similar(a[:4], a[:5]) and not similar(a[:3], a[:4]) and similar(a[:0], a[:0]) and not similar(a[:0], a)
    assert len(band_keys(shingles(""))) == 0 and len(set(band_keys(shingles("a b c d e f")).tolist())) == 32
    key = np.array([1])
    assert group_roots([a[:8], a[:0], np.arange(9, 18, dtype=np.uint64), a], [key, key, key, key]) == [0, 1, 2, 0]


def test_null_and_repeated_ids_are_no_component(spark, docs):
    """Unrelated texts without an id, or under one id, all stay; only real copies go."""
    texts = ["one text without id", "another text without an id", "one text without id", "first under three", "second under three", "first under three"]
    out = keep_one(docs(*texts, ids=[None, None, None, 3, 3, 3]))
    assert sorted(x.text for x in out.collect()) == sorted(set(texts))


def test_documents_are_not_shuffled_at_the_end(spark, docs):
    """Partitions without rows, without a row that stays, and without one that goes; whole documents move nowhere."""
    draw = random.Random(3)
    texts = [" ".join(f"w{draw.randrange(5000)}" for _ in range(60)) for _ in range(20)]
    parts = [docs(*texts, ids=range(20)), docs("x").where("false"), docs(*texts, ids=range(100, 120)), docs("one more", None, ids=[200, 201]), docs(*texts[:5], "the last", ids=range(300, 306))]
    frame = parts[0]
    for part in parts[1:]:
        frame = frame.unionByName(part)
    assert frame.rdd.getNumPartitions() > 4
    out = keep_one(frame)
    assert sorted(x.doc_id for x in out.collect()) == [*range(20), 200, 201, 305]
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
