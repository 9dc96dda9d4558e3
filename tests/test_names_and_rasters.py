"""Near-exact names by bounds, normal forms by classes, known ids in buckets, rasters."""

import random
from difflib import SequenceMatcher
from unicodedata import is_normalized

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgermill.functions.similarity import NEAR, may_be_near, near_exact, near_names, ratio_bound
from ledgermill.functions.text import is_nfc, nfc_in_doubt
from ledgermill.sources.known import known_table, new_entries, remember
from ledgermill.sources.scans import upright_candidates, without_gridlines

from .conftest import values


def drawn_names(n, seed=1):
    """Names of few letters with edits, so that many ratios lie near 0.9; short and repeated ones."""
    rng = random.Random(seed)
    names = ["", "a", "ab", "abc", "abcd", "abce", "aaaa", "aaaaa", "abcdefghij", "abcdefghik"]
    while len(names) < n:
        x = list(rng.choice(names) if rng.random() < 0.7 else "".join(rng.choice("abcd e") for _ in range(rng.randint(3, 30))))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(x) + 1)
            x[k : k + rng.randint(0, 1)] = rng.choice(["", "x", "b"])
        names.append(" ".join("".join(x).split()))
    return names


def ratio(a, b):
    return 1.0 if a == b else SequenceMatcher(None, a, b).ratio()


@pytest.mark.parametrize("least", (NEAR, 0.95, 1.0))
def test_near_names_lose_no_pair(spark, least):
    left, right = drawn_names(150), drawn_names(150, 2)
    frame = lambda names: spark.createDataFrame(list(enumerate(names)), "id int, name string")
    wanted = {(i, j) for i, a in enumerate(left) for j, b in enumerate(right) if a and b and ratio(a, b) >= least}
    found = near_names(frame(left), frame(right), least).collect()
    assert {(x.left, x.right) for x in found} == wanted and len(found) == len(wanted) > 20
    assert all(abs(x.score - ratio(left[x.left], right[x.right])) < 1e-9 for x in found)
    with pytest.raises(ValueError):
        near_names(frame(left), frame(right), 0.8)


def test_bounds_and_gate(spark):
    names = drawn_names(120, 3)
    pairs = [(a, b) for a in names[::2] for b in names[1::2] if a and b]
    out = spark.createDataFrame(pairs, "a string, b string").select("a", "b", ratio_bound(F.col("a"), F.col("b")).alias("bound"), may_be_near(F.col("a"), F.col("b")).alias("may"), near_exact(F.col("a"), F.col("b")).alias("near")).collect()
    assert all(x.bound >= ratio(x.a, x.b) - 1e-9 and x.near == (ratio(x.a, x.b) >= NEAR) and (x.may or not x.near) for x in out)
    assert 0 < sum(x.near and x.a != x.b for x in out) and sum(x.may for x in out) < len(out) / 3


def test_normal_form(spark):
    rng = random.Random(4)
    texts = [None, "", "plain", "café", "café", "́", "ﬁ", "Å", "한글", "日本", "가", "“quoted”", "ӑ"]
    texts += ["".join(chr(rng.choice([rng.randint(1, 0x2FF), rng.randint(0x2000, 0x20FF), rng.randint(0x300, 0x36F), rng.randint(0x4E00, 0x9FFF)])) for _ in range(4)) for _ in range(3000)]
    out = spark.createDataFrame([(x,) for x in texts], "t string").select("t", is_nfc(F.col("t")).alias("n"), nfc_in_doubt(F.col("t")).alias("d")).collect()
    assert all(x.n == (None if x.t is None else is_normalized("NFC", x.t)) for x in out)
    assert not any(x.d for x in out if x.t in ("plain", "café", "日本", "“quoted”"))


def test_known_ids_are_not_moved(spark, tmp_path):
    name = known_table(spark, f"file://{tmp_path}/known", 4)
    entries = spark.createDataFrame([(str(k), 2026, "h") for k in range(50)], "doc_id string, year int, sha256 string")
    assert new_entries(entries, name).count() == 50
    remember(entries.where("doc_id < '3'"), name, 4)
    left = new_entries(entries, name)
    assert sorted(x.doc_id for x in left.collect()) == sorted(str(k) for k in range(50) if str(k) >= "3")
    plan = left._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan and "Exchange" not in plan[plan.rindex("Sort [") :]
    remember(left, name, 4)
    spark.sql(f"DROP TABLE {name}")
    assert new_entries(entries, known_table(spark, f"file://{tmp_path}/known", 4)).count() == 0


def test_rasters(spark):
    draw = np.random.default_rng(1)
    pages = [draw.integers(0, 256, (7, 9), np.uint8), np.zeros((1, 1), np.uint8), np.full((6, 12), 255, np.uint8)]
    pages[2][3], pages[2][:, 5] = 0, 0
    rows = [(str(k), 1, x.shape[1], x.tobytes()) for k, x in enumerate(pages)] + [("short", 1, 4, b"12345"), ("none", 1, 4, None), ("empty", 1, 0, b"")]
    out = upright_candidates(spark.createDataFrame(rows, "doc_id string, page_no int, width int, pixels binary"))
    wanted = [(str(k), a, np.rot90(x, a // 90).shape[1], without_gridlines(np.rot90(x, a // 90)).tobytes()) for k, x in enumerate(pages) for a in (0, 90, 180, 270)]
    assert sorted((x.doc_id, x.angle, x.width, bytes(x.pixels)) for x in out.collect()) == sorted(wanted)
    assert values(upright_candidates(spark.createDataFrame(rows[:3], "doc_id string, page_no int, width int, pixels binary"), (0,), blank=False), "pixels") == sorted(((x.tobytes(),) for x in pages), key=lambda r: str(bytearray(r[0])))
