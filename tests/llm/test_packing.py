import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgermill.llm.packing import Plan, combinations_of, nnls, pack
from ledgermill.llm.tokenise import WordwiseEncoder, default_vocabulary


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 63), st.integers(1, 40), max_size=20))
def test_plan_places_each_once(counts):
    plan = Plan(counts, window=64, slack=2)
    used = {}
    for length, low, high, first, repeat, offset in plan.ranges:
        for r in range(low, high):
            used.setdefault(length, []).append(r)
    for length, low, high in plan.cut:
        used.setdefault(length, []).extend(range(low, high))
    assert {k: sorted(v) for k, v in used.items()} == {k: list(range(n)) for k, n in counts.items()}
    fill = {}
    for length, low, high, first, repeat, offset in plan.ranges:
        for r in range(low, high):
            fill.setdefault(first + (r - low) // repeat, []).append((offset + (r - low) % repeat * length, length))
    for places in fill.values():
        places.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:])) and places[0][0] == 0
        assert 62 <= places[-1][0] + places[-1][1] <= 64


def test_nnls():
    x = nnls([(3, 1), (2, 2)], {3: 5, 1: 5, 2: 8})
    assert np.allclose(x, [5, 4], atol=0.05) and (nnls([(3, 1)], {3: 0, 1: 0}) == 0).all()
    assert (3, 1) in combinations_of({3: 1, 1: 1}, window=4, slack=0) and (2, 2) in combinations_of({2: 5}, window=4, slack=0)


def test_pack(spark, docs):
    words = "The quick brown fox, jumps over 12 lazy dogs.\n"
    texts = [None, "", "a", words * 700, words * 700, *[words * n for n in range(1, 60)], "é 日本  x " * 50]
    out = pack(docs(*texts), rows_per_run=7).toPandas()
    encode = WordwiseEncoder(default_vocabulary())
    ids = {i: np.append(encode.as_uint32(x), np.uint32(1)).astype("<u4") for i, x in enumerate(encode.encode([x or "" for x in texts]))}
    assert set(out.doc_id) == set(ids)
    for doc, rows in out.groupby("doc_id"):
        rows = rows.sort_values("start")
        assert (rows.doc_tokens == len(ids[doc])).all() and rows.length.sum() == len(ids[doc])
        assert rows.start.tolist() == [0, *np.cumsum(rows.length)[:-1]]
        assert all(zlib.crc32(ids[doc][a : a + n].tobytes()) == c for a, n, c in zip(rows.start, rows.length, rows.ids_crc32))
    sizes = []
    for _, rows in out.groupby("sequence_id"):
        rows = rows.sort_values("offset")
        assert rows.offset.tolist() == [0, *np.cumsum(rows.length)[:-1]]
        sizes.append(rows.length.sum())
    assert max(sizes) <= 2048 and sum(x < 2040 for x in sizes) <= 1
    assert pack(docs("x").where("false")).count() == 0
