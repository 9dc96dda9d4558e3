"""Personal data: base patterns with checks, and a character BiLSTM-CRF that adds what they miss.

The network is trained in numpy from labelled spans (a fixed, seeded set of drawn sentences with e-mail
addresses, ip addresses, card and phone numbers in many written forms, and look-alikes that are none) by
``train_pii.py``, which writes ``pii_weights.npz``. A text is cut into overlapping windows; emissions of
all windows are averaged place by place, weighted towards each window's middle, and one Viterbi pass over
the text gives spans that no window edge cuts. Added spans must pass the checks of their kind (``valid``)
and overlap no base span; base spans stay as they are. What lies far from any such span need not be run:
``extents`` are all runs of characters that hold a span which ``valid`` accepts; each is run with MARGIN places
at both sides, with every window that covers one of them, so all have the emissions of a full run. The text's best
path is taken from places in the margins at which it has the same tag whatever stands further out (``settled``);
where a margin has no such place, the whole text is run. So the spans are those of running everything.

Defined cases: a null text is empty and has no span; repeated rows are read each; null and repeated doc_ids
are rows like any other; a very long text is read in blocks of windows, its Viterbi pass carried from block
to block, in time and memory in proportion to the text; columns of other names are ignored, and kept as they
were by ``redact``; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from itertools import islice
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed
from .lstm_crf import PAD, BiLstmCrf, CarriedViterbi, char_codes, settled

KINDS = ("email", "ip", "card", "phone")
LENGTH, STRIDE = 64, 32
Span = tuple[str, int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: From the start of a run of digits only, and without going back: one pass over any text, the same matches.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")
_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


def digits_of(text: str) -> str:
    return "".join(x for x in text if "0" <= x <= "9")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(x), 10)) for x in digits[-2::-2])) % 10 == 0


def small_parts(text: str) -> bool:
    return all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in text.split("."))


def base_spans(text: str) -> list[Span]:
    """Base matches, by kind as listed, then start."""
    out: list[Span] = []
    if not _TRIGGER.search(text):
        return out
    # A match of the e-mail pattern has one @: walk the @ signs, not every possible start.
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append(("email", start, domain.end()))
            done = domain.end()
        at = text.find("@", max(at + 1, done))
    out += [("ip", *x.span()) for x in _IP.finditer(text) if small_parts(x[0])]
    for x in _CARD.finditer(text):
        digits = digits_of(x[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *x.span()))
    out += [("phone", *x.span()) for x in _PHONE.finditer(text) if 9 <= len(digits_of(x[0])) <= 15]
    return out


_ADDED_EMAIL = re.compile(r"[^\W_][\w.%+-]*\s?(?:@|\(at\)|\[at\])\s?[\w-]+(?:\s?(?:\.|\(dot\)|\[dot\])\s?[\w-]+)+", re.IGNORECASE)
#: The network knows (at) only; [at] is as long, so it is shown as (at) and all places stay.
_SQUARE_AT = re.compile(r"\[at\]", re.IGNORECASE)


def valid(kind: str, text: str) -> bool:
    """Checks of spans that the network adds."""
    digits = digits_of(text)
    if kind == "email":
        return _ADDED_EMAIL.fullmatch(text) is not None
    if kind == "ip":
        return re.fullmatch(r"[0-9]{1,3}(?:\s?\.\s?[0-9]{1,3}){3}", text) is not None and small_parts(re.sub(r"\s", "", text))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits) and re.fullmatch(r"[0-9][0-9\s._/-]*[0-9]", text) is not None
    return 9 <= len(digits) <= 15 and re.fullmatch(r"[+(]{0,2}[0-9][0-9\s().\-/]*[0-9]", text) is not None and len(re.findall(r"[0-9]+", text)) > 1


def tag_of(kind: str, first: bool) -> int:
    return 1 + 2 * KINDS.index(kind) + (not first)


N_TAGS = 1 + 2 * len(KINDS)


def allowed_steps() -> np.ndarray:
    """An inside tag follows its kind's first or inside tag only."""
    out = np.ones((N_TAGS, N_TAGS), bool)
    for inside in range(2, N_TAGS, 2):
        out[:, inside] = False
        out[[inside - 1, inside], inside] = True
    return out


def drawn_examples(n: int, seed: int = 3) -> list[tuple[str, list[Span]]]:
    """Sentences of made-up words with labelled spans and look-alikes, the same for the same seed."""
    draw = np.random.default_rng(seed)
    pick = lambda x: x[int(draw.integers(len(x)))]
    number = lambda k: "".join(map(str, draw.integers(0, 10, k)))
    letters, more = "etaoinshrdlucmfwypvbgk", "éèêçñáíóäöüß"

    def word(low=2, high=11):
        k = int(draw.integers(low, high))
        w = "".join(pick(letters) if draw.random() > 0.06 else pick(more) for _ in range(k))
        return w.upper() if draw.random() < 0.06 else w.capitalize() if draw.random() < 0.12 else w

    plain = lambda low=2, high=9: "".join(pick(letters) for _ in range(int(draw.integers(low, high))))

    def card():
        d = pick("3456") + number(int(pick((12, 13, 14, 14, 14, 14, 17))))
        d += next(x for x in "0123456789" if luhn(d + x))
        gap = pick(("", "", "", " ", "-", ".", "_", "/"))
        return gap.join(d[i : i + 4] for i in range(0, len(d), 4)) if gap else d

    def phone():
        a, b, c = number(3), number(3), number(4)
        return pick((f"+{pick('123456789')} ({a}) {b}-{c}", f"+{number(2)} {a} {b} {c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+{pick('1234')}{a}{b}{c}", f"0{number(3)}/{number(7)}", f"({a}){b} {c}"))

    def email():
        host = f"{plain()}{pick(('', '', number(1)))}.{pick(('example.com', 'com', 'org', 'de', 'fr', 'co.uk', 'net'))}"
        name = plain() + pick(("", "." + plain(), "." + number(2), "_" + plain(), number(2)))
        return pick((f"{name}@{host}", f"{name}@{host}", f"{name} @ {host}", f"{name}@ {host}", f"{name} (at) {host}{pick(('', number(1)))}", f"{name}@{host.replace('.', ' . ')}"))

    def ip():
        parts = [str(int(x)) for x in draw.integers(0, 256, 4)]
        return pick((".", ".", ".", " . ")).join(parts)

    def neither():
        return pick((f"{number(4)}-{number(2)}-{number(2)}", f"{number(1)}.{number(1)}", f"${number(3)}.{number(2)}", "".join(pick("0123456789abcdef") for _ in range(int(draw.integers(8, 41)))), number(int(draw.integers(1, 9))), f"{number(2)}:{number(2)}", f"{number(2)}/{number(2)}/{number(4)}", f"v{number(1)}.{number(2)}.{number(1)}", f"#{number(5)}", f"{number(1)},{number(3)},{number(3)}", f"{plain()}{number(2)}", f"@{plain()}", f"{number(3)}%", f"{number(4)}-{number(4)}", f"{plain()}=\"{number(6)}{plain()}\""))

    makers = {"email": email, "ip": ip, "card": card, "phone": phone}
    out = []
    for _ in range(n):
        text, spans = "", []
        while len(text) < LENGTH:
            r = draw.random()
            if r < 0.16:
                kind = pick(KINDS)
                piece = makers[kind]()
                spans.append((kind, len(text), len(text) + len(piece)))
            else:
                piece = neither() if r < 0.24 else word()
            text += piece + pick((" ", " ", " ", " ", " ", ", ", ". ", "\n", "### ", "!! ", " | ", ".\n"))
        start = int(draw.integers(0, max(1, len(text) - LENGTH + 1)))
        out.append((text[start : start + LENGTH], [(k, max(0, a - start), min(LENGTH, b - start)) for k, a, b in spans if b > start and a < start + LENGTH]))
    return out


def train(examples: list[tuple[str, list[Span]]], epochs: int = 6, hidden: int = 20) -> BiLstmCrf:
    """A network from (text, spans), each text cut or padded to LENGTH."""
    codes, gold = np.full((len(examples), LENGTH), PAD), np.zeros((len(examples), LENGTH), np.int64)
    for i, (text, spans) in enumerate(examples):
        row = char_codes(text[:LENGTH])
        codes[i, : len(row)] = row
        for kind, a, b in spans:
            if a < LENGTH:
                gold[i, a : min(b, LENGTH)] = tag_of(kind, False)
                gold[i, a] = tag_of(kind, True)
    return BiLstmCrf(N_TAGS, hidden=hidden).fit(codes, gold, epochs)


#: Written by train_pii.py from drawn_examples(DRAWN).
WEIGHTS, DRAWN = Path(__file__).with_name("pii_weights.npz"), 6000


@lru_cache(1)
def default_model() -> BiLstmCrf:
    model = BiLstmCrf(N_TAGS)
    with np.load(WEIGHTS) as held:
        model.p = {k: held[k] for k in held.files}
    return model


#: Where an added e-mail address has its sign, what follows it, and what can stand before it.
_AT = re.compile(r"@|\(at\)|\[at\]", re.IGNORECASE)
_HOST = re.compile(r"\s?[\w-]++(?:\s?(?:\.|\(dot\)|\[dot\])\s?[\w-]++)++", re.IGNORECASE)
_NAME = re.compile(r"[\w.%+-]")
#: Digits and the marks that added numbers hold. No added number has more than 19 digits.
_NUMBERS = re.compile(r"[+(]{0,2}[0-9][0-9\s().\-/_]*+")
_TOO_LONG = re.compile(r"[0-9]{20,}+")


def extents(text: str) -> list[tuple[int, int]]:
    """Runs of characters, one of which holds each span that ``valid`` can accept, in no order."""
    out = []
    for x in _AT.finditer(text):
        host = _HOST.match(text, x.end())
        start = x.start() - 1 if text[x.start() - 1 : x.start()].isspace() else x.start()
        low = start
        while low > 0 and _NAME.match(text[low - 1]):
            low -= 1
        if host and low < start:
            out.append((low, host.end()))
    for x in _NUMBERS.finditer(text):
        low, end = x.span()
        if end - low < 7:  # 1.1.1.1
            continue
        cuts = [low, *(e for y in _TOO_LONG.finditer(text, low, end) for e in y.span()), end]
        for a, b in zip(cuts[::2], cuts[1::2]):
            run = text[a:b]
            n = sum(map(run.count, "0123456789"))
            if n >= 9 or (n >= 4 and run.count(".") >= 3):
                out.append((a, b))
    return out


#: Places run at each side of an extent, in which the tags of the text's best path must settle.
MARGIN = 48
#: Places of a stretch that are decoded at once; longer stretches carry their Viterbi state from block to block.
BLOCK = 8192


class _Stretch:
    """Touching extents with a margin at each side: averages emissions as the windows over them come in, and decodes long
    ones block by block. ``core`` runs from the first extent to the end of the last."""

    def __init__(self, text: int, start: int, end: int, core: tuple[int, int], windows: range) -> None:
        self.text, self.start, self.end, self.core, self.windows = text, start, end, core, windows
        self.total = np.zeros((0, N_TAGS), np.float32)
        self.weight = np.zeros(0, np.float32)
        self.at, self.carry = start, None

    def add(self, start: int, e: np.ndarray, weight: np.ndarray, detector: Detector) -> None:
        if start - self.at >= BLOCK + MARGIN:  # so that the last block holds the margin behind
            self._decode(start - self.at - MARGIN, detector)
        low, high = max(start, self.start), min(start + LENGTH, self.end)
        grow = high - self.at - len(self.weight)
        if grow > 0:
            self.total = np.concatenate([self.total, np.zeros((max(grow, min(len(self.weight), 2 * BLOCK)), N_TAGS), np.float32)])
            self.weight = np.concatenate([self.weight, np.zeros(len(self.total) - len(self.weight), np.float32)])
        a, here = low - self.at, slice(low - start, high - start)
        self.total[a : a + high - low] += e[here] * weight[here, None]
        self.weight[a : a + high - low] += weight[here]

    def _decode(self, n: int, detector: Detector) -> None:
        e = self.total[:n] / self.weight[:n, None]
        if self.carry is None:
            self.carry = CarriedViterbi(detector.model, detector.steps)
            e = self.begun(e, detector)
        if e is not None and self.at + n == self.end:
            e = self.stopped(e, detector)
        self.lost = self.lost or e is None
        if not self.lost:
            self.carry.feed(e)
        self.total, self.weight, self.at = self.total[n:].copy(), self.weight[n:].copy(), self.at + n

    lost = False

    def begun(self, e: np.ndarray, detector: Detector, tags: np.ndarray | None = None) -> np.ndarray | None:
        """Emissions from the last settled place of the margin before, which allow its tag only; None if there is none."""
        if self.start:
            n = self.core[0] - self.start + 1
            tags = detector.settled([e[:n]])[0] if tags is None else tags
            sure = np.flatnonzero(tags >= 0)
            if not len(sure):
                return None
            e, self.start = e[sure[-1] :].copy(), self.start + int(sure[-1])
            e[0, np.arange(N_TAGS) != tags[sure[-1]]] -= 1e4
        return e

    def stopped(self, e: np.ndarray, detector: Detector, tags: np.ndarray | None = None) -> np.ndarray | None:
        """Emissions to the first settled place of the margin behind, likewise; the text's end needs none."""
        if self.margin:
            tags = detector.settled([e[-self.margin :]])[0] if tags is None else tags
            sure = np.flatnonzero(tags >= 0)
            if not len(sure):
                return None
            e = e[: len(e) - self.margin + int(sure[0]) + 1].copy()
            e[-1, np.arange(N_TAGS) != tags[sure[0]]] -= 1e4
        return e

    margin = 0

    def tags(self, detector: Detector) -> np.ndarray | None:
        """The tags of a long stretch, from ``start``; short ones are decoded with others, from ``emissions``."""
        if self.carry is None:
            return None
        if not self.lost:
            self._decode(self.end - self.at, detector)
        return None if self.lost else self.carry.finish()

    def emissions(self) -> np.ndarray:
        n = self.end - self.at
        return self.total[:n] / self.weight[:n, None]


class Detector:
    """``every`` runs all windows of a text, also those in which no span can lie."""

    def __init__(self, model: BiLstmCrf, batch: int = 256, every: bool = False) -> None:
        self.model, self.batch, self.every, self.steps = model, batch, every, allowed_steps()
        away = np.abs(np.arange(LENGTH) - (LENGTH - 1) / 2)
        self.weight = (LENGTH / 2 + 0.5 - away).astype(np.float32)

    def settled(self, margins: list[np.ndarray]) -> list[np.ndarray]:
        """settled() of margins of any lengths."""
        out: list[np.ndarray] = [np.empty(0)] * len(margins)
        for n in {len(x) for x in margins}:
            same = [k for k, x in enumerate(margins) if len(x) == n]
            for at in range(0, len(same), 64):
                part = same[at : at + 64]
                for k, tags in zip(part, settled(np.stack([margins[k] for k in part]), self.model._transitions(self.steps))):
                    out[k] = tags
        return out

    def stretches(self, k: int, text: str, every: bool) -> list[_Stretch]:
        n = len(text)
        last = max(0, -(-(n - LENGTH) // STRIDE))
        runs: list[list[int]] = []
        for low, end in [(0, n)] * bool(text) if every else sorted(extents(text)):
            if runs and low - MARGIN <= runs[-1][1] + MARGIN:
                runs[-1][1] = max(runs[-1][1], end)
            else:
                runs.append([low, end])
        out = []
        for low, end in runs:
            start, stop = max(0, low - MARGIN), min(n, end + MARGIN)
            windows = range(max(0, (start - LENGTH) // STRIDE + 1), min(last, (stop - 1) // STRIDE) + 1)
            out.append(_Stretch(k, start, stop, (low, end), windows))
            out[-1].margin = stop - end if stop < n else 0
        return out

    def raw_spans(self, texts: list[str]) -> list[list[Span]]:
        """Spans of the network alone, before any check: those of one Viterbi pass over the whole text that extents hold.
        Where a margin leaves a tag open, the whole text is run."""
        texts = [_SQUARE_AT.sub("(at)", x) for x in texts]
        out, open_ = self._run(texts, self.every)
        again = sorted(open_)
        for k, spans in zip(again, self._run([texts[k] for k in again], True)[0] if again else []):
            out[k] = spans
        return out

    def _run(self, texts: list[str], every: bool) -> tuple[list[list[Span]], set[int]]:
        out: list[list[Span]] = [[] for _ in texts]
        lost: set[int] = set()
        ended: list[_Stretch] = []
        asked = ((held, x) for k, text in enumerate(texts) for held in self.stretches(k, text, every) for x in held.windows)
        while block := list(islice(asked, self.batch)):
            codes = np.full((len(block), LENGTH), PAD)
            for r, (held, x) in enumerate(block):
                row = char_codes(texts[held.text][x * STRIDE : x * STRIDE + LENGTH])
                codes[r, : len(row)] = row
            e = self.model.emissions(codes)
            for r, (held, x) in enumerate(block):
                held.add(x * STRIDE, e[:, r], self.weight, self)
                if x == held.windows[-1]:
                    if held.carry is None:
                        ended.append(held)
                    else:
                        self._told(held, held.tags(self), out, lost)
            if len(ended) >= self.batch:
                self._decoded(ended, out, lost)
                ended = []
        self._decoded(ended, out, lost)
        return out, lost

    @staticmethod
    def _told(held: _Stretch, tags: np.ndarray | None, out: list[list[Span]], lost: set[int]) -> None:
        if tags is None:
            lost.add(held.text)
        else:
            # A span that goes on to the last place may go on behind it: it leaves its extent, where no valid one ends.
            found = [(kind, held.start + x, held.start + y) for kind, x, y in spans_of(tags)]
            out[held.text] += [x for x in found if not held.margin or x[2] < held.start + len(tags)]

    def _decoded(self, ended: list[_Stretch], out: list[list[Span]], lost: set[int]) -> None:
        given = [x.emissions() for x in ended]
        before = [k for k, x in enumerate(ended) if x.start]
        heads = dict(zip(before, self.settled([given[k][: ended[k].core[0] - ended[k].start + 1] for k in before])))
        behind = [k for k, x in enumerate(ended) if x.margin]
        tails = dict(zip(behind, self.settled([given[k][-ended[k].margin :] for k in behind])))
        ready = []
        for k, held in enumerate(ended):
            e = held.begun(given[k], self, heads.get(k))
            e = None if e is None else held.stopped(e, self, tails.get(k))
            if e is None:
                self._told(held, None, out, lost)
            else:
                ready.append((held, e))
        ready.sort(key=lambda x: len(x[1]))
        for at in range(0, len(ready), 64):
            part = ready[at : at + 64]
            for (held, _), tags in zip(part, self.model.viterbi_batch([e for _, e in part], self.steps)):
                self._told(held, tags, out, lost)

    def spans(self, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
        """(base, all) of each text, by kind as listed, then start."""
        out = []
        for text, raw in zip(texts, self.raw_spans(texts)):
            base = base_spans(text)
            taken = sorted((a, b) for _, a, b in base)
            added = []
            for kind, a, b in sorted(raw, key=lambda x: x[1]):
                alone = not (text[a - 1 : a].isalnum() or text[b : b + 1].isalnum())
                if alone and valid(kind, text[a:b]) and not any(x < b and a < y for x, y in taken):
                    added.append((kind, a, b))
            out.append((base, sorted(base + added, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))))
        return out


def spans_of(tags: np.ndarray) -> list[Span]:
    """Each first tag with the inside tags that follow it."""
    out, start, before = [], -1, -1
    places = np.flatnonzero(tags)
    for t, tag in zip([*places.tolist(), len(tags)], [*tags[places].tolist(), 0]):
        if start >= 0 and (tag % 2 == 1 or tag == 0 or t > before + 1):
            out.append((KINDS[(int(tags[start]) - 1) // 2], start, before + 1))
            start = -1
        if tag % 2 == 1:
            start = t
        before = t
    return out


def listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; of overlapping spans the first, longest names the whole."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda x: (x[1], -x[2])):
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def _batched(docs: DataFrame, place: int, schema, make):
    """mapInArrow of make(batch slice, spans of its texts) over (doc), with the network sent once."""
    sent = docs.sparkSession.sparkContext.broadcast(default_model())

    def run(batches):
        detector = Detector(sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = pc.struct_field(part.column(0), [place]).to_pylist()
                yield make(part.column(0), texts, detector.spans([x or "" for x in texts]))

    return packed(docs).mapInArrow(run, schema)


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, base counts by kind, base_sha256 and all spans of every text."""

    def make(docs, texts, spans):
        counts = [[sum(x[0] == kind for x in base) for base, _ in spans] for kind in KINDS]
        sums = [hashlib.sha256(listed(base).encode()).hexdigest() for base, _ in spans]
        columns = [pc.struct_field(docs, [0]), *(pa.array(x, pa.int64()) for x in counts), pa.array(sums, pa.string()), pa.array([listed(x) for _, x in spans], pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", *(f"n_{x}" for x in KINDS), "base_sha256", "spans"])

    return _batched(docs.select("doc_id", "text"), 1, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string", make)


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind; n_chars follows the text; other columns stay."""

    def make(docs, texts, spans):
        clean = [None if old is None else redacted(old, found) for old, (_, found) in zip(texts, spans)]
        return pa.RecordBatch.from_arrays([docs, pa.array(clean, pa.string())], names=["doc", "clean"])

    out = _batched(docs, docs.columns.index("text"), packed(docs).withColumn("clean", F.lit(None).cast("string")).schema, make)
    changed = {"text": F.col("clean"), "n_chars": F.length("clean").cast("long")}
    return out.select(*(changed.get(x, F.col("doc")[x]).alias(x) for x in docs.columns))


def op1_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))
