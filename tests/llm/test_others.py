"""Sharding, quality, toxicity, pieces, top-k and the pipeline."""

import itertools
import random
import re
import zlib
from array import array
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from ledgermill.llm.boosting import BoostedTrees, Isotonic
from ledgermill.llm.pieces import PieceLattice, default_model, segment
from ledgermill.llm.quality import BUCKETS, SPREADS, keep_good, quality_rules, ratio_weights
from ledgermill.llm.sharding import best_fit_decreasing, pack_into, rounded, shard_by_bytes
from ledgermill.llm.topk import SortedLists, integer_vectors, top_k
from ledgermill.llm.toxicity import keep_clean, toxicity

from .test_quality_grams import cells


def plainly_packed(sizes, room):
    """Best fit item by item, by looking at every bin; None where none takes it."""
    left, wanted = list(room), []
    for x in sizes:
        b = min(((free, b) for b, free in enumerate(left) if free >= x), default=(0, None))[1]
        if b is not None:
            left[b] -= x
        wanted.append(b)
    return wanted


def counted(sizes):
    return sorted(Counter(sizes).items(), reverse=True)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60), st.lists(st.integers(0, 120), max_size=9))
def test_best_fit(sizes, room):
    found, over = best_fit_decreasing(counted(sizes), room)
    wanted = plainly_packed(sorted(sizes, reverse=True), room)
    assert [b for _, b, n in found for _ in range(n)] == [b for b in wanted if b is not None]
    assert over == counted(x for x, b in zip(sorted(sizes, reverse=True), wanted) if b is None)


def loads_of(sizes, bins):
    """Loads of the bins, after checks that every group is packed once and that what oversize groups leave is near equal."""
    loads, packed_sizes = [0] * bins, Counter()
    for size, b, n in pack_into(counted(sizes), bins):
        loads[b] += size * n
        packed_sizes[size] += n
    assert packed_sizes == Counter(sizes)
    rest, left, alone = sorted(sizes, reverse=True), bins, []
    while rest and left > 1 and rest[0] * left > sum(rest):
        alone.append(rest.pop(0))
        left -= 1
    others = sorted(loads, reverse=True)
    for x in alone:
        others.remove(x)
    assert max(others, default=0) <= sum(rest) / left + max(rest, default=0)
    assert all(loads) or len(sizes) < bins
    return sorted(loads, reverse=True)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(1, 50), st.integers(1, 5000)), max_size=80), st.integers(1, 9))
def test_pack_into(sizes, bins):
    loads_of(sizes, bins)


@pytest.mark.parametrize("hot", (0.0, 0.15, 0.2, 0.33, 0.5))
def test_hot_group_leaves_no_shard_empty(hot):
    draw = random.Random(1)
    small = [draw.randint(1, 1000) for _ in range(20_000)]
    big = int(sum(small) * hot / (1 - hot))
    loads = loads_of(small + [big] * (hot > 0), 8)
    if hot > 1 / 8:
        assert loads.pop(0) == big
    assert loads[0] - loads[-1] < 0.001 * sum(loads) / len(loads)


def test_few_groups():
    assert loads_of([10] * 17, 8) == [30, 20, 20, 20, 20, 20, 20, 20] and loads_of([100, 1, 1], 8) == [100, 1, 1, 0, 0, 0, 0, 0]
    assert pack_into([], 8) == [] and loads_of([7] * 8, 8) == [7] * 8 and loads_of([5, 5], 1) == [10]


def test_rounded(spark):
    sizes = [1, 2, 8191, 8192, 8193, 16383, 16384, 16385, 10**6 + 1, 2**40 + 1]
    out = [x.about for x in spark.createDataFrame([(x,) for x in sizes], "bytes long").select(rounded(F.col("bytes")).alias("about")).collect()]
    unit = [1 << max(0, x.bit_length() - 13) for x in sizes]
    assert out == [-(-x // u) * u for x, u in zip(sizes, unit)] and out[:4] == sizes[:4]


def test_shards(spark, docs):
    draw = random.Random(4)
    texts = [None, "", "é" * 10, *["copy " * 20] * 30, *("x" * draw.randint(1, 300) for _ in range(400)), None, "y" * 100_000]
    ids = [None, 5, 5, *range(len(texts) - 3)]
    frame = docs(*texts, ids=ids)
    out = shard_by_bytes(frame, rows_per_run=40).toPandas()
    assert len(out) == len(texts)
    wanted = Counter((x, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for x, t in zip(ids, texts))
    found = Counter((None if np.isnan(r.doc_id) else int(r.doc_id), r.size, r.text_crc32) for r in out.itertuples())
    assert found == wanted
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in out.groupby("shard"))
    # Shards are as full as the plan for the groups' sizes (100,001 bytes are 100,016 to 13 bits), a group in one of them.
    groups = Counter()
    for t in texts:
        groups[t] += len((t or "").encode()) + 1
    loads = loads_of([-(-x // 16) * 16 if x > 8191 else x for x in groups.values()], 8)
    assert sorted(out.groupby("shard")["size"].sum(), reverse=True) == [loads[0] - 15, *loads[1:]]
    assert out[out.text_crc32 == zlib.crc32(b"copy " * 20)].shard.nunique() == 1
    assert shard_by_bytes(docs("x").where("false")).count() == 0


WORD = r"[^\x20\x09-\x0D]+"


def base(text):
    words = re.findall(WORD, text or "")
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {j for i, x in enumerate(windows) if often[x] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality(spark, docs, labels):
    good = "the cat sat on the mat with another cat near a warm wall while rain fell over all of the old town again"
    run = " ".join(f"r{i}" for i in range(12))
    texts = [None, "", "few words", good, good + "\n" + good, f"{run} a {run} b {run[:20]}", "a#b$ " * 30, " ".join(f"{w}###" for w in good.split()), "x\n\nx\ny\n \n ", good + " extra", *[f"{good} number {i}" for i in range(20)], "w" * 200_000 + " b"]
    frame, known = docs(*texts), labels([(i, 1, 0) for i in range(9, 30)] + [(9, 0, 0), (None, 1, 0), (7, 0, 0)])
    rows = {x.doc_id: x for x in quality_rules(frame, known).collect()}
    weights = ratio_weights(frame.select("doc_id", "text"), known)
    raw, target = Counter(), Counter()
    for i, x in enumerate(texts):
        raw.update(cells(x))
        if 9 <= i < 30:
            target.update(cells(x))
    weight = lambda b: np.log((target[b] + 1) / (target.total() + BUCKETS)) - np.log((raw[b] + 1) / (raw.total() + BUCKETS))
    assert np.allclose(weights, [weight(b) for b in range(BUCKETS)])
    ratios = [np.mean([weight(b) for b in cells(x)]) if cells(x) else 0.0 for x in texts]
    trusted = [ratios[i] for i in range(9, 30) if base(texts[i])[0] >= 20]
    bar = np.mean(trusted) - SPREADS * np.std(trusted) - 1e-9
    for i, x in enumerate(texts):
        n, *rest = base(x)
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, *rest)
        failed = n < 20 or 100 * rest[-1] > 30 * n
        assert r.base_failed == failed and r.ratio == pytest.approx(ratios[i]) and r.kept == (not failed and ratios[i] >= bar)
    assert rows[10].kept and not rows[7].kept
    kept = keep_good(frame, known)
    assert kept.columns == frame.columns and {x.doc_id for x in kept.collect()} == {i for i, r in rows.items() if r.kept}
    assert set(ratio_weights(frame.select("doc_id", "text"), known.where("false"))) == {0.0}
    assert quality_rules(frame.where("false"), known).count() == 0


def test_boosting():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    margin = BoostedTrees(rounds=60).fit(x[:1500], y[:1500], np.ones(1500)).margin(x[1500:])
    assert ((margin > 0) == y[1500:]).mean() > 0.93
    fit = Isotonic().fit(np.array([1.0, 2, 3, 4]), np.array([0.0, 1, 0, 1]), np.ones(4))
    assert np.allclose(fit.y, [0, 0, 0.5, 0.5, 1, 1]) and (np.diff(fit(np.linspace(0, 5, 50))) >= 0).all()


def test_toxicity(spark, docs, labels):
    draw = random.Random(6)
    plain, bad = [f"word{i}" for i in range(200)], ["scumbag", "vermin", "blockhead"]
    plain = ["".join(draw.choice("abcdefghij") for _ in range(5)) for _ in range(200)]
    texts, known = [], []
    for i in range(900):
        words = [draw.choice(plain) for _ in range(draw.randint(15, 40))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                words.insert(draw.randrange(len(words)), draw.choice(bad))
        texts.append(" ".join(words))
        known.append((i, 1, int(toxic)))
    texts += [None, "", "you are a v3rmin"]
    out = {x.doc_id: x for x in toxicity(docs(*texts), labels(known)).collect()}
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(out[i].held_out for i in held) and sum(x.held_out for x in out.values()) >= len(held)
    assert np.mean([out[i].predicted == (i % 5 == 0) for i in held]) > 0.97
    assert all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.5) for x in out.values()) and len(out) == 903
    kept = keep_clean(docs(*texts), labels(known))
    assert {x.doc_id for x in kept.collect()} == {i for i, x in out.items() if x.score < 0.5} and kept.columns == docs("x").columns
    one = toxicity(docs("a", None), labels([(0, 1, 0), (1, 1, 0), (2, 1, 0)])).collect()
    assert {x.score for x in one} == {0.0}
    assert {x.score for x in toxicity(docs("a"), labels([])).collect()} == {0.0}


@pytest.fixture(scope="module")
def lattice():
    return PieceLattice(default_model(), young=5, old=5)


def test_pieces(lattice):
    draw = random.Random(0)
    for _ in range(150):
        text = "".join(draw.choice("the ing.aé\n##ß日 o") for _ in range(draw.randint(0, 10)))
        whole = lattice.normalised(text)
        edges, ways = lattice.edges(whole)[0], {0: [(0, ())]}
        for b in range(1, len(whole) + 1):
            ways[b] = [(s + t, i + j) for a, t, j in edges[b] for s, i in ways[a]]
        wanted = sorted(ways[len(whole)], key=lambda x: (-x[0], x[1]))
        found = [(s, tuple(np.frombuffer(i, "<u4").tolist())) for s, i in lattice.n_best([text])[0]]
        assert [s for s, _ in found] == [s for s, _ in wanted[:4]] and len(set(found)) == len(found) and set(found) <= set(wanted)
        assert all(lattice.decode(array("I", i).tobytes()) == text for _, i in found)


def test_segment(spark, docs):
    rows = {x.doc_id: x for x in segment(docs(None, "", "hello there", "hello there", "x" * 5000, "a b " * 3000)).collect()}
    assert (rows[0].n_pieces, rows[0].score, rows[0].n_best) == (0, 0, 1) and rows[2].scores == rows[3].scores
    assert all(x.round_trip and x.scores == sorted(x.scores, reverse=True) for x in rows.values())
    assert segment(docs("x").where("false")).count() == 0


@settings(max_examples=120, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 60), st.sampled_from([3, 300, 40_000_000]), st.booleans())
def test_sorted_lists(seed, n, size, seeded):
    draw = np.random.default_rng(seed)
    ids, v = draw.integers(0, 30, n), draw.integers(-size, size, (n, 4))
    queries = draw.integers(-size, size, (3, 4))
    best = [sorted(((-int(s), int(i), r) for r, (s, i) in enumerate(zip(v @ query, ids)) if i != q))[:5] for q, query in zip((1, 2, 99), queries)]
    # A score that five rows reach may be known beforehand: they and all as good must still be found.
    known = np.array([-x[-1][0] if seeded and len(x) == 5 else -np.inf for x in best], float)
    found = SortedLists(np.arange(n), ids, v).top(np.array([1, 2, 99]), queries, 5, known)
    for j in range(3):
        assert sorted((-s, i, r) for a, r, i, s in found if a == j) == best[j]


def test_sorted_lists_stop_early():
    """On clustered vectors a small part of the lists is read, and the answers are those of all products."""
    draw = np.random.default_rng(3)
    v = np.repeat(draw.normal(size=(60, 32)), 20, 0) + 0.2 * draw.normal(size=(1200, 32))
    v = np.floor(256 * v / np.linalg.norm(v, axis=1)[:, None]).astype(np.int64)
    draw.shuffle(v)
    lists = SortedLists(np.arange(1200), np.arange(1200), v)
    found = lists.top(np.arange(0, 1200, 100), v[::100], 5)
    assert lists.read / 12 < 0.6
    for j, q in enumerate(range(0, 1200, 100)):
        assert sorted((-s, i) for a, _, i, s in found if a == j) == sorted((-int(s), i) for i, s in enumerate(v @ v[q]) if i != q)[:5]


def wanted_top(rows):
    fine = []
    for n, (i, v) in enumerate(rows):
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and sum(256 * float(x) * 256 * float(x) for x in v) < 2**62:
            fine.append((n, i, [int(np.floor(256 * float(x))) for x in v]))
    best = {}
    for _, q, a in fine:
        if q % 50 == 0:
            for n, i, b in fine:
                if i != q and len(a) == len(b):
                    s = sum(x * y for x, y in zip(a, b))
                    best[q, n, i] = max(s, best.get((q, n, i), s))
    out = []
    for q in {x[0] for x in best}:
        ranked = sorted((-s, i) for (p, _, i), s in best.items() if p == q)[:5]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(ranked, 1)]
    return sorted(out)


def test_top_k(spark):
    draw = np.random.default_rng(5)
    rows = [(int(i), [float(np.float32(x)) for x in draw.normal(size=4) / 3]) for i in range(120)]
    rows += [(200, None), (250, [1.0, float("nan"), 0.0, 0.0]), (251, [1.0, None, 0.0, 0.0]), (252, [float("inf")] * 4), (253, [1.0]), (300, [0.5]), (None, [0.0] * 4), (7, [0.125] * 4)]
    # Repeated queries, two vectors under one query, components that no long can hold, a large one that fits, empty vectors.
    rows += [rows[50], rows[50], (100, [0.5, -0.5, 0.25, 0.0]), (8, [1e300, 1.0, 0.0, 0.0]), (350, [1e300, 1.0, 0.0, 0.0]), (9, [4e6, 1.0, 0.0, 0.0]), (400, []), (401, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({x: F.lit(1) for x in ("score", "row", "v", "dims", "rank")})
    vectors = integer_vectors(frame)
    for shard_rows in (25, 10_000):
        out = top_k(vectors, vectors.where("vec_id % 50 = 0"), shard_rows=shard_rows).collect()
        assert sorted(map(tuple, out)) == wanted_top(rows)
    five = [x for x in sorted(map(tuple, out)) if x[0] == 50]
    assert [x[1] for x in five] == [1, 2, 3, 4, 5]
    assert top_k(vectors.where("false"), vectors.where("false")).count() == 0
    assert top_k(vectors.where("false"), vectors).count() == 0


def test_pipeline_stages_compose(spark, tmp_path):
    from .test_pii import brute

    draw = random.Random(8)
    syllables = ["the", "ing", "er", "on", "at", "re", "st"]
    word = lambda: "".join(draw.choice(syllables) for _ in range(draw.randint(1, 3)))
    texts = [" ".join(word() for _ in range(draw.randint(30, 60))) for _ in range(60)]
    texts += [texts[0], texts[1].upper().lower(), "too short", texts[2] + " mail ann.lee@example.com now", " ".join(f"{word()}%%%" for _ in range(40)), None]
    rows = [(i, x, "en", "s", None if x is None else len(x)) for i, x in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = {x.doc_id: x.text for x in docs.collect()}
    assert set(range(60)) <= set(seen["quality"]) and not {62, 64, 65} & set(seen["quality"])
    assert seen["toxicity"] == seen["quality"]
    assert set(seen["quality"]) - set(seen["near_duplicates"]) >= {60, 61}
    assert not any(brute(x) for x in seen["personal_data"].values())
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert {x.doc_id for x in last.collect()} == set(seen["personal_data"])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == last.count()
    assert list(itertools.islice((n for n, _ in corpus_pipeline.STAGES), 5)) == ["quality", "toxicity", "near_duplicates", "personal_data", "packing"]
