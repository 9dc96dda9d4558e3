"""Repeated passages against sets of all 200-byte strings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from ledgermill.llm.repeats import SHALLOW, SPAN, BlindTrie, anchors, cut_out, repeated_windows, repeats


def plain(texts):
    """n_bytes, removed, spans, digest of each text, by counting every 200-byte string of every text."""
    texts = [(x or "").encode() for x in texts]
    counts = Counter(x[k : k + SPAN] for x in texts for k in range(len(x) - SPAN + 1))
    out = []
    for x in texts:
        gone = bytearray(len(x))
        for k in range(len(x) - SPAN + 1):
            if counts[x[k : k + SPAN]] > 1:
                gone[k : k + SPAN] = b"\1" * SPAN
        left = bytes(b for b, g in zip(x, gone) if not g)
        out.append((len(x), sum(gone), len(bytes(gone).replace(b"\0", b" ").split()), hashlib.sha256(left).hexdigest()))
    return out


def drawn(seed, n):
    """Texts of few letters with shared passages at, above and under the limit, edited copies, runs of one letter."""
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("abé \n日") for _ in range(k))
    passages = [word(k) for k in (150, 190, 199, 200, 201, 260, 700)]
    texts = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.2 and texts:
            x = list(rng.choice(texts))
            for _ in range(rng.randint(0, 3)):
                x.insert(rng.randrange(len(x) + 1), "#")
            texts.append("".join(x))
        else:
            texts.append("".join(rng.choice([word(rng.randint(1, 300)), rng.choice(passages)]) for _ in range(rng.randint(1, 6))))
    return texts


@pytest.mark.parametrize("segment", (37, 1000, 1 << 20))
def test_every_window_has_its_anchor(segment):
    """Windows are covered once each, by a gram inside them; equal windows have equal anchors at equal places."""
    known = {}
    for text in drawn(1, 20) + ["a" * 500, "ab" * 300, "x" * 199, ""]:
        data = text.encode()
        h, at, first, last = anchors(data, segment)
        assert [k for f, l in zip(first, last) for k in range(f, l + 1)] == list(range(max(0, len(data) - SPAN + 1)))
        for a, f, l, value in zip(at.tolist(), first.tolist(), last.tolist(), h.tolist()):
            for k in range(f, l + 1):
                assert k <= a and known.setdefault(data[k : k + SPAN], (a - k, value)) == (a - k, value)


def test_blind_trie_orders_strings():
    rng = random.Random(2)
    data = bytes(rng.choice(b"ab") for _ in range(300)) + b"a" * 600 + bytes(rng.choice(b"ab\0\xff") for _ in range(400))
    starts = [rng.randrange(len(data) - SPAN) for _ in range(500)]
    trie = BlindTrie(data, starts[0])
    for k in starts[1:]:
        trie.add(k)
    leaves = list(trie.leaves())
    strings = [data[x[0] : x[0] + SPAN] for x in leaves]
    assert strings == sorted({data[k : k + SPAN] for k in starts}) and sorted(k for x in leaves for k in x) == sorted(starts)
    assert all(len({data[k : k + SPAN] for k in x}) == 1 for x in leaves)


def test_deep_shallow_finds_equal_windows():
    """Windows that differ before, at and behind the depth at which tries take over, in groups of their own."""
    rng = random.Random(3)
    base = bytes(rng.choice(b"abc") for _ in range(SPAN + 60))
    contexts, groups = [], []
    for k in range(60):
        x = bytearray(base)
        for _ in range(rng.randint(0, 2)):
            x[rng.choice([3, SHALLOW - 1, SHALLOW, SHALLOW + 1, 150, SPAN + 30])] = rng.choice(b"xy")
        if (bytes(x), k % 3) not in zip(contexts, groups):
            contexts.append(bytes(x))
            groups.append(k % 3)
    found = repeated_windows(contexts, np.array(groups), np.full(len(contexts), 100))
    counts = Counter((g, i, x[i : i + SPAN]) for g, x in zip(groups, contexts) for i in range(61))
    assert [x.tolist() for x in found] == [[counts[g, i, x[i : i + SPAN]] > 1 for i in range(61)] for g, x in zip(groups, contexts)]


def test_cut_out():
    assert cut_out(b"abcdefgh", [(4, 6), (1, 3), (3, 4)]) == (5, 1, hashlib.sha256(b"agh").hexdigest())
    assert cut_out(b"abcd", [(0, 1), (2, 4)]) == (3, 2, hashlib.sha256(b"b").hexdigest()) and cut_out(b"ab", []) == (0, 0, hashlib.sha256(b"ab").hexdigest())


@pytest.mark.parametrize("chunk", (5, 8192))
def test_repeats(spark, docs, chunk):
    """Shared passages, copies, nulls, long texts that repeat themselves, repeated ids, clashing names; with chunks so small
    that every anchor stands in several."""
    texts = drawn(7, 60) + [None, "", "x" * 3000, "y" * 199, "z" * 200, "z" * 200, "ab" * 101, "q" * 201, None]
    ids = [*range(len(texts) - 3), 4, 4, None]
    frame = docs(*texts, ids=ids)
    got = sorted((tuple(x) for x in repeats(frame, chunk).collect()), key=str)
    assert got == sorted(((i, *x) for i, x in zip(ids, plain(texts))), key=str)
    assert repeats(frame.where("false"), chunk).collect() == [] and len(repeats(frame.where("text is null"), chunk).collect()) == 2
