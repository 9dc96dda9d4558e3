import base64
import hashlib
import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgermill.llm.lstm_crf import BiLstmCrf, CarriedViterbi
from ledgermill.llm.lstm_crf import settled
from ledgermill.llm.pii import DRAWN, KINDS, N_TAGS, Detector, allowed_steps, base_spans, default_model, drawn_examples, extents, find_pii, listed, luhn, redact, train, valid


def brute(text):
    digits = lambda x: re.sub("[^0-9]", "", x)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "@", ".", "1", "25", "4111111111111111", " ", "-", "+", "(", "é", "b.c", "@x.y", "10.0.0.1", "\n"]), max_size=14).map("".join))
def test_base_is_the_patterns(text):
    assert base_spans(text) == brute(text)


def test_luhn():
    assert luhn("4111111111111111") and not luhn("4111111111111112")


def test_slopes_are_derivatives():
    net = BiLstmCrf(3, width=4, hidden=3, seed=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    draw = np.random.default_rng(0)
    codes, gold = draw.integers(1, 40, (2, 5)), draw.integers(0, 3, (2, 5))
    _, slopes = net.slopes(codes, gold)
    for name in ("trans", "out", "fh", "bx", "bb"):
        at = (0,) * net.p[name].ndim
        kept, step = net.p[name][at], 1e-2
        found = []
        for move in (step, -step):
            net.p[name][at] = kept + move
            found.append(net.slopes(codes, gold)[0])
        net.p[name][at] = kept
        assert slopes[name][at] == pytest.approx((found[0] - found[1]) / (2 * step), abs=5e-3)


def test_held_out_accuracy():
    examples = drawn_examples(600, seed=99)
    right = found = wanted = 0
    for (_, gold), spans in zip(examples, Detector(default_model()).raw_spans([x for x, _ in examples])):
        inner = lambda xs: {x for x in xs if x[1] > 0 and x[2] < 64}
        right, found, wanted = right + len(inner(gold) & inner(spans)), found + len(inner(spans)), wanted + len(inner(gold))
    assert right / found > 0.9 and right / wanted > 0.88


def test_network_adds_and_base_stays():
    text = "call (415) 555-2671 today or write to ann.lee@example.com now, token 24be64439e3e49cf46b2d7c90f3602a3"
    base, every = Detector(default_model()).spans([text])[0]
    assert base == brute(text) and set(base) <= set(every)
    assert ("phone", 5, 19) in every and len(every) == 2


def test_find(spark, docs):
    texts = [None, "", "x a@b.co 10.0.0.1 y", "x a@b.co 10.0.0.1 y", "w " * 50_000 + "a@b.co", "plain words only"]
    rows = {x.doc_id: x for x in find_pii(docs(*texts)).collect()}
    assert len(rows) == 6
    assert (rows[2].n_email, rows[2].n_ip, rows[2].spans) == (1, 1, "email:2:8,ip:9:17")
    assert rows[4].spans == "email:100000:100006"
    for i in (0, 1, 5):
        assert rows[i].spans == "" and rows[i].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert rows[3].base_sha256 == hashlib.sha256(listed(brute(texts[3])).encode()).hexdigest()
    assert find_pii(docs("x").where("false")).count() == 0


def test_redact(spark, docs):
    frame = docs("x a@b.co y", None, "clean")
    out = {x.doc_id: x for x in redact(frame).collect()}
    assert out[0].text == "x [EMAIL] y" and out[0].n_chars == 11 and out[1].text is None and out[2].text == "clean"
    assert redact(frame).columns == frame.columns and KINDS == ("email", "ip", "card", "phone")


@pytest.mark.parametrize("at", ["(at)", "[at]", "(AT)", "[At]"])
def test_address_without_digit_or_at_sign(at):
    """Found wherever it stands to the windows, with no digit or @ in the whole text."""
    detector, address = Detector(default_model()), f"jane {at} example.org"
    texts = [f"{'plain words and more of them ' * 5}{'x' * k} write to {address} for the rest of the story" for k in range(0, 64, 3)]
    found = [every for _, every in detector.spans(texts)]
    assert all(spans == [("email", x.index(address), x.index(address) + len(address))] for x, spans in zip(texts, found))
    assert detector.stretches(0, "no address (here) or [there] " * 9, False) == []


PARTS = ["jane", "x.y", " ", "  ", "@", "(at)", "[AT]", "(dot)", "[dot]", ".", "example", "org", "1", "42", "255", "4111 1111 1111 1111", "4111.1111-1111/1111", "9" * 25, "+49", "(030)", "/", "-", "_", "(", "+", "é", "\n", "10 . 0 . 0 . 1"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), min_size=1, max_size=9).map("".join))
def test_every_span_that_can_be_valid_lies_in_an_extent(text):
    held = extents(text)
    for a in range(len(text)):
        for b in range(a + 1, len(text) + 1):
            if any(valid(kind, text[a:b]) for kind in KINDS) and not (text[a - 1 : a].isalnum() or text[b : b + 1].isalnum()):
                assert any(x <= a and b <= y for x, y in held), text[a:b]


def test_all_windows_find_no_more():
    """Running every window of a text gives the same spans as running those that an extent touches."""
    examples = [x for x, _ in drawn_examples(900, seed=41)]
    texts = [" ".join(examples[i : i + 12]) for i in range(0, 900, 12)]
    assert Detector(default_model()).spans(texts) == Detector(default_model(), every=True).spans(texts)


def test_prose_around_changes_nothing():
    """Long prose around each drawn sentence, where most windows are not run; long extents, carried from block to block."""
    draw = random.Random(8)
    words = "the of and to in is that it was for on are with as his they at be this from have or by one had not but what".split()
    prose = lambda: " ".join(draw.choices(words, k=draw.randint(15, 60)))
    texts = [f"{prose()} {x} {prose()}" for x, _ in drawn_examples(500, seed=43)]
    texts += [f"{prose()} {'1.2 ' * n} +1 (415) 555-2671 {prose()}" for n in (2060, 2200)]
    some, every = Detector(default_model()), Detector(default_model(), every=True)
    assert some.spans(texts) == every.spans(texts)


def test_settled_places_hold_in_longer_sequences():
    draw, model = np.random.default_rng(1), default_model()
    steps = allowed_steps()
    for _ in range(20):
        e = draw.normal(0, 3, (120, N_TAGS)).astype(np.float32)
        found = settled(e[None, 30:90], model._transitions(steps))[0]
        for _ in range(5):
            e[:30], e[90:] = draw.normal(0, 3, (2, 30, N_TAGS))
            path = model.viterbi(e, steps)[30:90]
            assert (found < 0).mean() < 0.8 and (path == found)[found >= 0].all()


def test_long_runs():
    """A million characters of one kind take seconds, and base spans stay those of the patterns."""
    n, detector = 1_000_000, Detector(default_model())
    for text in ("a" * n, "9" * n, base64.b64encode(random.Random(1).randbytes(n * 3 // 4)).decode(), "a@" * (n // 2), "+1" * (n // 2)):
        began = time.perf_counter()
        base, every = detector.spans([text])[0]
        assert time.perf_counter() - began < 20 and base == every == []
    text = "1." * 60_000 + " or call (415) 555-2671 today"
    base, every = detector.spans([text])[0]
    assert base == brute(text) and ("phone", 120_009, 120_023) in every


def test_carried_viterbi_is_viterbi():
    draw, model = np.random.default_rng(2), default_model()
    for n in (1, 2, 40, 700):
        e = (draw.normal(size=(n, N_TAGS)) * 3).astype(np.float32)
        carried = CarriedViterbi(model, allowed_steps())
        for at in range(0, n, 37):
            carried.feed(e[at : at + 37])
        assert carried.finish().tolist() == model.viterbi(e, allowed_steps()).tolist()
    several = [(draw.normal(size=(n, N_TAGS)) * 3).astype(np.float32) for n in (5, 1, 90, 33)]
    assert [x.tolist() for x in model.viterbi_batch(several, allowed_steps())] == [model.viterbi(e, allowed_steps()).tolist() for e in several]
    # By brute force on a short one.
    e, steps = several[0][:4], np.where(allowed_steps(), model.p["trans"], -1e4)
    paths = np.stack(np.meshgrid(*[np.arange(N_TAGS)] * 4, indexing="ij"), -1).reshape(-1, 4)
    scores = sum(e[t, paths[:, t]] for t in range(4)) + sum(steps[paths[:, t - 1], paths[:, t]] for t in range(1, 4))
    assert paths[scores.argmax()].tolist() == model.viterbi(e, allowed_steps()).tolist()


def test_training_gives_the_kept_weights():
    """The weights beside the code are those that training gives (rounding may differ between machines)."""
    again, texts = train(drawn_examples(DRAWN)), [x for x, _ in drawn_examples(300, seed=17)]
    found, kept = (Detector(x).raw_spans(texts) for x in (again, default_model()))
    assert sum(x == y for x, y in zip(found, kept)) >= 285
