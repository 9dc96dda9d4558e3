"""Whole-text byte-level BPE through the tokenizers library, word by word.

Byte-level pre-tokenisation always cuts before a space that stands before a non-space, so a text
may be cut there and its parts (words here) encoded apart. Arrow cuts a few texts at a time and numbers
their different words, so that each is looked up once however often it stands there. Words recur, so each
worker keeps those it has met: new ones in a young store that is emptied when full, those met again in an
old store. Both are bounded, and what they hold changes nothing but time. New words of Latin script are cut
further into pre-tokens, kept likewise, and new ones of these go to the model of the tokenizer itself; all
other words go through the whole tokenizer.
Added tokens are looked for in the whole text before it is cut, so a text that holds the literal of one
goes through the unchanged tokenizer in one piece.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

VOCABULARY = "byte_bpe_50k.json"
#: Not before white space or the end.
_CUT = re.compile(r" (?=\S)")
_LONGEST_KEPT = 64
#: After letters these are a pre-token of their own.
_MARKS = frozenset(".,;:!?")
#: Below this character, letters, numbers and white space are the same in all Unicode versions.
_LATIN_END = "\u0250"


def _latin(kind: str) -> str:
    """The characters of a kind below _LATIN_END, for a set in a pattern."""
    return "".join(re.escape(x) for x in map(chr, range(ord(_LATIN_END))) if regex.match(kind, x))


_L, _N, _S = _latin(r"\p{L}"), _latin(r"\p{N}"), _latin(r"\s")
# Fixed value: the public byte-level pre-tokenisation pattern, for Latin script only: plain sets are faster than properties.
_PRETOKEN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")


def _byte_letters() -> list[str]:
    """The printable character that byte-level BPE writes for each byte: itself if printable, else the next from U+0100."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(x if x in printable else next(spare)) for x in range(256)]


_BYTE_LETTERS = _byte_letters()
_SPACE_LETTER = _BYTE_LETTERS[32]


def _plain_byte_level(tokenizer) -> bool:
    """Whether the tokenizer is byte-level BPE with the public pattern and nothing before or after it."""
    kind = json.loads(tokenizer.to_str())
    before = kind["pre_tokenizer"] or {}
    steady = not kind["model"].get("dropout") and not kind["normalizer"] and before.get("type") == "ByteLevel"
    return steady and kind["model"]["type"] == "BPE" and not before.get("add_prefix_space") and before.get("use_regex", True)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


class WordStore(dict):
    """What ``find`` says of words met at least twice; asks it for others. A word met once waits in ``young``."""

    def __init__(self, find, young: int, old: int) -> None:
        super().__init__()
        self.find, self.young, self.limits = find, {}, (young, old)

    def __missing__(self, word: str):
        found = self.young.pop(word, None)
        if found is None:
            found = self.find(word)
            if len(word) <= _LONGEST_KEPT:
                self.young[word] = found
        else:
            self[word] = found
        return found

    def trim(self) -> None:
        if len(self.young) > self.limits[0]:
            self.young.clear()
        if len(self) > self.limits[1]:
            self.clear()


class WordwiseEncoder:
    """encode(texts): the little-endian ids of each text as bytes, ``width`` bytes an id.

    Literals of added tokens become their ids, as in the library, if ``added``; else they are text.
    """

    def __init__(self, path: str, young: int = 150_000, old: int = 250_000, pieces: int = 300_000, added: bool = False) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        literals = [x.content for x in self.tokenizer.get_added_tokens_decoder().values() if x.content] if added else []
        self.literal = re.compile("|".join(map(re.escape, literals))) if literals else None
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.code = "H" if self.width == 2 else "I"
        self.model = self.tokenizer.model if _plain_byte_level(self.tokenizer) else None
        self.pieces = WordStore(self._piece, pieces, pieces)
        self.words = WordStore(self._word if self.model is not None else self._whole, young, old)

    def _whole(self, word: str) -> bytes:
        return self._ids([" " + word])[0]

    def _piece(self, piece: str) -> bytes:
        plain = piece.isascii() and piece.isprintable()
        mapped = piece.replace(" ", _SPACE_LETTER) if plain else piece.encode().decode("latin1").translate(_BYTE_LETTERS)
        return array(self.code, [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def _word(self, word: str) -> bytes:
        if not word.isascii() and max(word) >= _LATIN_END:
            return self._whole(word)
        if word.isalpha():  # one pre-token
            return self.pieces[" " + word]
        if word[-1] in _MARKS and word[:-1].isalpha():
            return self.pieces[" " + word[:-1]] + self.pieces[word[-1]]
        return b"".join(map(self.pieces.__getitem__, _PRETOKEN.findall(" " + word)))

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array(self.code, x.ids).tobytes() for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.literal is not None:
            held = [i for i, x in enumerate(texts) if self.literal.search(x)]
            return self._apart(texts, held, self._ids, self._by_words)
        return self._by_words(texts)

    @staticmethod
    def _apart(texts: list[str], held: list[int], one, other) -> list[bytes]:
        """The texts at ``held`` by one way, all others by another."""
        if not held:
            return other(texts)
        found = dict(zip(held, one([texts[i] for i in held])))
        rest = iter(other([x for i, x in enumerate(texts) if i not in found]))
        return [found[i] if i in found else next(rest) for i in range(len(texts))]

    def _by_words(self, texts: list[str], inner: bool = False) -> list[bytes]:
        """``inner``: the texts may hold spaces that are no place to cut."""
        if not texts:
            return []
        if inner:
            parts = pa.array([_CUT.split(x) for x in texts], pa.large_list(pa.large_string()))
        else:
            parts = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        firsts, numbered = parts.offsets.to_numpy(), parts.values.dictionary_encode()
        words, places = numbered.dictionary.to_numpy(zero_copy_only=False).tolist(), numbered.indices.to_numpy().astype(np.int64)
        heads = self._ids([words[i] for i in places[firsts[:-1]]])  # no space stands before these
        places[firsts[:-1]] = np.arange(len(words), len(words) + len(texts))
        used = np.zeros(len(words) + len(texts), bool)
        used[places] = True
        used = used.tolist()
        if not inner and (odd := [i for i, x in enumerate(words) if used[i] and (not x or x[0].isspace())]):
            there = np.zeros(len(used), bool)
            there[odd] = True
            held = np.flatnonzero(np.logical_or.reduceat(there[places], firsts[:-1])).tolist()
            return self._apart(texts, held, lambda x: self._by_words(x, True), self._by_words)
        get = self.words.__getitem__
        found = [get(x) if known else b"" for x, known in zip(words, used)] + heads
        self.words.trim()
        self.pieces.trim()
        return self._placed(found, places, firsts)

    def _placed(self, found: list[bytes], places: np.ndarray, firsts: np.ndarray, step: int = 1 << 15) -> list[bytes]:
        """The ids of each text, whose words' ids are found[i] for i in places, a few words at a time."""
        pool = np.frombuffer(b"".join(found), f"<u{self.width}")
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // self.width
        starts = np.cumsum(lengths) - lengths
        runs = []
        for at in range(0, len(places), step):
            part = places[at : at + step]
            n = lengths[part]
            ends = np.cumsum(n)
            runs.append(pool[np.repeat(starts[part] - ends + n, n) + np.arange(ends[-1])])
        ids = memoryview(np.concatenate(runs)).cast("B")
        edges = (np.add.reduceat(lengths[places], firsts[:-1]).cumsum() * self.width).tolist()
        return [bytes(ids[a:b]) for a, b in zip([0, *edges], edges)]

    def as_uint32(self, ids: bytes) -> np.ndarray:
        return np.frombuffer(ids, dtype=f"<u{self.width}").astype("<u4")


_encoders: dict[str, WordwiseEncoder] = {}


def encoder(path: str) -> WordwiseEncoder:
    """One encoder for each worker process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = WordwiseEncoder(path, added=True)
    return _encoders[path]


def columns_of(batches, limit: int = 4_000_000):
    """The first two columns as lists, a few rows at a time: texts of at most ``limit`` bytes together, or one longer text."""
    for batch in batches:
        ends, at = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False), dtype=np.int64), 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, limit + (ends[at - 1] if at else 0), "right")))
            part = batch.slice(at, to - at)
            yield part.column(0).to_pylist(), part.column(1).to_pylist()
            at = to
