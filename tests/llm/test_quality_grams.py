import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from ledgermill.llm.quality import MIN_WORDS, SPREADS, BUCKETS, keep_good, quality_rules


def cells(text):
    """XXH64 as Spark chains it: the hash of a word seeds that of the next."""
    words = [x.encode() for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    one = [xxhash.xxh64_intdigest(w, 42) for w in words]
    two = [xxhash.xxh64_intdigest(b, xxhash.xxh64_intdigest(a, 42)) for a, b in zip(words, words[1:])]
    return [(x - (1 << 64) if x >> 63 else x) % BUCKETS for x in one + two]


def test_whole_words_and_pairs(spark, docs, labels):
    """Words in a wrong order, or repeated each, end alike and pass the base rules; whole n-grams tell them."""
    draw = random.Random(2)
    phrases = [" ".join("".join(draw.choice("aeioustr") for _ in range(4)) + "ing" for _ in range(6)) for _ in range(12)]
    texts = [" ".join(draw.sample(phrases, 8)) for _ in range(60)]
    runs = [" ".join(w for w in x.split()[:30] for _ in range(3)) for x in texts[:6]]
    texts += [*runs, None, "", "one", texts[0]]
    frame, known = docs(*texts), labels([(i, 1, 0) for i in range(50)] + [(i, 0, 0) for i in range(60, 66)])
    rows = {x.doc_id: x for x in quality_rules(frame, known).collect()}
    raw, target = Counter(), Counter()
    for i, x in enumerate(texts):
        raw.update(cells(x))
        if i < 50:
            target.update(cells(x))
    weight = lambda b: np.log((target[b] + 1) / (target.total() + BUCKETS)) - np.log((raw[b] + 1) / (raw.total() + BUCKETS))
    ratios = [np.mean([weight(b) for b in cells(x)]) if cells(x) else 0.0 for x in texts]
    assert all(rows[i].ratio == pytest.approx(x) for i, x in enumerate(ratios))
    trusted = [ratios[i] for i in range(50) if len(texts[i].split()) >= MIN_WORDS]
    bar = np.mean(trusted) - SPREADS * np.std(trusted)
    assert all(rows[i].kept == (not rows[i].base_failed and x >= bar - 1e-9) for i, x in enumerate(ratios))
    assert all(rows[i].kept for i in range(60)) and not any(rows[i].base_failed or rows[i].kept for i in range(60, 66))
    assert {x.doc_id for x in keep_good(frame, known).collect()} == {i for i, x in rows.items() if x.kept}
    assert all(x.ratio == 0 and x.kept != x.base_failed for x in quality_rules(frame, known.where("false")).collect())
