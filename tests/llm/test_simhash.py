import random

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgermill.llm.bk_tree import BKTree, forest_links
from ledgermill.llm.components import components
from ledgermill.llm.near_copies import keep_one
from ledgermill.llm.simhash import band_masks, bands_for, fingerprint, linked, simhash_components


def brute_print(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, radius=3):
    top = list(range(len(values)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= radius:
                top[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


def near_values(n, seed):
    draw = random.Random(seed)
    out = [draw.getrandbits(64) for _ in range(4)]
    while len(out) < n:
        x = draw.choice(out)
        for _ in range(draw.randint(0, 5)):
            x ^= 1 << draw.randrange(64)
        out.append(x)
    return out


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000))
def test_tree_and_forest(seed):
    values = near_values(60, seed)
    tree = BKTree()
    for x in values:
        tree.add(x)
    assert {tree.values[i] for i in tree.within(values[-1], 3)} == {x for x in values if (x ^ values[-1]).bit_count() <= 3}
    links = forest_links(values, 3)
    assert all((a ^ b).bit_count() <= 3 for a, b in links)
    joined = groups(list(dict.fromkeys(values)))
    assert len(links) == len(set(values)) - len(set(joined))


def test_masks_meet_every_link():
    draw = random.Random(2)
    for bands in (4, 5, 6):
        masks = band_masks(list(range(64)), bands)
        for _ in range(200):
            flips = sum(1 << x for x in draw.sample(range(64), 3))
            assert any(not flips & m for m in masks)
    assert bands_for(1000) == 4 and bands_for(1 << 30) > 4


def test_fingerprint():
    for text in (None, "", " \x0b\n", "One", "one TWO", "a b c d e é É  x\x1cy", "w " * 200_000):
        assert fingerprint(text) == brute_print(text)


def test_components_of_links(spark):
    draw = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 130)] + [(draw.randrange(200, 260), draw.randrange(200, 260)) for _ in range(40)]
    out = {x.node: x.root for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {}
    for a, b in links:
        parent.setdefault(a, {a}).add(b)
    sets = [{a, b} for a, b in links if a != b]
    merged = []
    for s in sets:
        hit = [m for m in merged if m & s]
        merged = [m for m in merged if not m & s] + [s.union(*hit)]
    assert out == {x: min(m) for m in merged for x in m}


def test_linked_small_shards(spark):
    values = near_values(150, 5)
    signed = [x - (1 << 64) if x >> 63 else x for x in values]
    frame = spark.createDataFrame([(i + 10, v) for i, v in enumerate(signed)], "doc_id long, fp long")
    joined = groups(values)
    wanted = {i + 10: min(j for j, g in enumerate(joined) if g == joined[i]) + 10 for i in range(len(values))}
    for largest, bands in ((4, 4), (4096, 5)):
        assert {x.doc_id: x.component_id for x in linked(frame, largest, bands).collect()} == wanted


def test_documents(spark, docs):
    base = " ".join(f"w{i}" for i in range(400))
    texts = [base, base + " end", base.upper(), None, "", " ", "other words here", base]
    rows = {x.doc_id: x for x in simhash_components(docs(*texts, ids=[4, 2, 9, 7, 8, 1, 3, 4])).collect()}
    assert rows[7].fingerprint == "0" * 16 and rows[7].component_id == rows[8].component_id == rows[1].component_id == 1
    assert rows[4].fingerprint == f"{brute_print(base):016x}"
    assert rows[4].component_id == rows[9].component_id and rows[3].component_id == 3
    assert simhash_components(docs("x").where("false")).count() == 0


def test_keep_one(spark, docs):
    frame = docs("a b c d", "a b c d", "A B c d", None, "", "z y x", ids=[3, 3, 5, 8, 7, 9])
    out = keep_one(frame)
    assert sorted(x.doc_id for x in out.collect()) == [3, 7, 9] and out.columns == frame.columns
