"""N-best segmentation over the piece lattice of a SentencePiece model, and decoding.

The lattice of a text has an edge for each piece at each place; a segmentation's score is the sum of
its pieces' scores in the model. Forward Viterbi gives the best score up to every place, which is the
exact heuristic of a backward A-star search: partial segmentations are popped from the end in the order
of what they can still reach, so the k-th complete one popped is the k-th best. No piece spans two
neighbouring characters that no piece holds side by side, so the lattice falls apart there; the N best
of the parts are merged into the N best of the text, exactly. The N best of a text can differ from its
best only in the N - 1 parts with the least loss of their second best; that loss comes from forward
and backward scores, and only those parts are searched. Words recur, so workers keep their results in
bounded stores. A character without a piece becomes its UTF-8 byte pieces, at a score below every piece's.

Defined cases: a null or empty text has no pieces, score 0 and one (empty) segmentation; equal scores
come in an order that the text fixes; repeated rows are segmented each, and null and repeated doc_ids are rows
like any other; long texts are cut into words first; a literal U+2581 decodes as a space, as in the library;
other columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .tokenise import WordStore

MODEL = "piece_bpe_32k.model"
BEST = 4
SPACE = "▁"
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
Alternative = tuple[int, tuple[int, ...]]  # score, ids
#: The loss of a second segmentation where there is none.
NEVER = 1 << 60


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


class PieceLattice:
    def __init__(self, path: str, best: int = BEST, young: int = 200_000, old: int = 400_000) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        normal = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.best = best
        self.pieces = {pieces[i]: (i, int(model.get_score(i))) for i in normal}
        self.tree: dict = {}  # by character; at "" the piece that ends here: (score, ids)
        for x, (i, score) in self.pieces.items():
            node = self.tree
            for c in x:
                node = node.setdefault(c, {})
            node[""] = score, (i,)
        self.byte_ids = {int(pieces[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.below = min(s for _, s in self.pieces.values()) - 10
        self.joined = {x[i : i + 2] for x in self.pieces for i in range(len(x) - 1)}
        values = {v: bytes([b]) for b, v in self.byte_ids.items()}
        self.bytes = [values.get(i, b"") for i in range(n)]
        for x, (i, _) in self.pieces.items():
            self.bytes[i] = x.encode()
        self.words = WordStore(self.word, young, old)
        self.parts = WordStore(self._part, old, old)

    @staticmethod
    def normalised(text: str) -> str:
        return SPACE + text.replace(" ", SPACE) if text else ""

    def edges(self, text: str) -> tuple[list[list[tuple[int, int, tuple[int, ...]]]], list[int]]:
        """For each place, the (start, score, ids) of the edges that end there; and the forward Viterbi scores."""
        tree, n = self.tree, len(text)
        out: list[list] = [[] for _ in range(n + 1)]
        forward = [-(1 << 60)] * (n + 1)
        forward[0] = 0
        for a in range(n):
            node, reached, alone = tree, forward[a], True
            for b in range(a, n):
                node = node.get(text[b])
                if node is None:
                    break
                found = node.get("")
                if found:
                    if b == a:
                        alone = False
                    out[b + 1].append((a, *found))
                    if reached + found[0] > forward[b + 1]:
                        forward[b + 1] = reached + found[0]
            if alone:
                out[a + 1].append((a, self.below, tuple(self.byte_ids[x] for x in text[a].encode("utf-8", "surrogatepass"))))
                forward[a + 1] = max(forward[a + 1], reached + self.below)
        return out, forward

    def search(self, text: str) -> list[Alternative]:
        """(score, ids) of the N best segmentations, best first: backward A-star under forward Viterbi scores."""
        edges, forward = self.edges(text)
        # (reach, place, count, ids as a chain, score so far): of equal reach the one nearest the start, so ties cost no breadth.
        heap, out, count = [(-forward[-1], len(text), 0, None, 0)], [], 0
        while heap and len(out) < self.best:
            reach, at, _, chain, done = heapq.heappop(heap)
            if at == 0:
                ids: list[int] = []
                while chain:
                    ids.extend(chain[0])
                    chain = chain[1]
                out.append((-reach, tuple(ids)))
            for a, s, own in edges[at]:
                count += 1
                heapq.heappush(heap, (-(forward[a] + s + done), a, count, (own, chain), s + done))
        return out

    def first(self, text: str) -> tuple[tuple[int, ...], int, int | None]:
        """Ids and score of the best segmentation, and the loss of the second best (None without one)."""
        edges, forward = self.edges(text)
        n, best = len(text), forward[-1]
        if n == 1:
            return edges[1][0][2], best, None
        backward = [-(1 << 60)] * n + [0]
        # Where one path alone has the best score, the second best has an edge off it; else the search tells.
        second, tied = -(1 << 60), 0
        for b in range(n, 0, -1):
            rest = backward[b]
            for a, s, _ in edges[b]:
                onward = rest + s
                if onward > backward[a]:
                    backward[a] = onward
                through = forward[a] + onward
                if through == best:
                    tied += b - a
                elif through > second:
                    second = through
        if tied != n:
            found = self.search(text)
            return found[0][1], best, best - found[1][0]
        ids: list[tuple[int, ...]] = []
        at = n
        while at:
            at, _, own = next(x for x in edges[at] if forward[x[0]] + x[1] == forward[at])
            ids.append(own)
        return tuple(i for own in reversed(ids) for i in own), best, best - second if second > -(1 << 59) else None

    def cut(self, text: str) -> list[str]:
        """Parts of a word that no piece joins."""
        joined, out, start = self.joined, [], 0
        for i in range(1, len(text)):
            if text[i - 1 : i + 1] not in joined:
                out.append(text[start:i])
                start = i
        out.append(text[start:])
        return out

    def _part(self, text: str) -> tuple[bytes, int, int]:
        ids, score, loss = self.first(text)
        return array("I", ids).tobytes(), score, NEVER if loss is None else loss

    def word(self, text: str) -> tuple[bytes, int, int]:
        """Packed best ids, score, and least loss of another segmentation."""
        ids, score, least = [], 0, NEVER
        for x in self.cut(text):
            found = self.parts[x]
            ids.append(found[0])
            score += found[1]
            least = min(least, found[2])
        return b"".join(ids), score, least

    def alternatives(self, words: list[str]) -> list[tuple[int, dict[int, bytes]]]:
        """(loss, {place in words: packed ids}) of the N best over these words, least loss first."""
        combos: list[tuple[int, tuple[tuple[int, int], ...]]] = [(0, ())]
        cut = [(i, x) for i, word in enumerate(words) for x in self.cut(word)]
        found = [self.search(x) for _, x in cut]
        # Part by part, the N best choices so far; ties go to the earlier choice.
        for place, options in enumerate(found):
            combos = heapq.nsmallest(self.best, [(loss + options[0][0] - s, picks + ((place, k),) if k else picks) for loss, picks in combos for k, (s, _) in enumerate(options)])
        out = []
        for loss, picks in combos:
            taken = dict(picks)
            changed = {cut[place][0] for place in taken}
            out.append((loss, {i: b"".join(array("I", found[p][taken.get(p, 0)][1]).tobytes() for p, (j, _) in enumerate(cut) if j == i) for i in changed}))
        return out

    def n_best(self, texts: list[str]) -> list[list[tuple[int, bytes]]]:
        """(score, little-endian unsigned 32-bit ids) of each text's N best segmentations."""
        get, out = self.words.__getitem__, []
        for text in texts:
            words = _WORD.findall(self.normalised(text))
            self.words.trim()
            self.parts.trim()
            if not words:
                out.append([(0, b"")])
                continue
            ids, scores, losses = zip(*map(get, words))
            score, loss = sum(scores), np.array(losses)
            few = min(self.best - 1, len(words))
            # The few words of the least loss, the earlier ones of equal loss.
            bar = np.partition(loss, few - 1)[few - 1]
            below = np.flatnonzero(loss < bar)
            places = np.sort(np.concatenate([below, np.flatnonzero(loss == bar)[: few - len(below)]])).tolist()
            found = []
            for lost, changed in self.alternatives([words[i] for i in places]):
                own = list(ids) if changed else ids
                for i, packed in changed.items():
                    own[places[i]] = packed
                found.append((score - lost, b"".join(own)))
            out.append(found)
        return out

    def decode(self, ids: bytes) -> str:
        text = b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "surrogatepass").replace(SPACE, " ")
        return text[1:] if text[:1] == " " else text


_lattices: dict[tuple[str, int], PieceLattice] = {}


def lattice(path: str, best: int = BEST) -> PieceLattice:
    if (path, best) not in _lattices:
        _lattices[path, best] = PieceLattice(path, best)
    return _lattices[path, best]


SCHEMA = "doc_id long, n_pieces long, score long, n_best int, scores array<long>, ids_crc32 array<long>, round_trip boolean"


def segment(docs: DataFrame, model: str | None = None, best: int = BEST) -> DataFrame:
    """doc_id, size and score of the best segmentation, scores and checksums of the N best, and whether decoding gives the text back."""
    model = model or default_model()

    def run(batches):
        held = lattice(model, best)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [x or "" for x in part.column(1).to_pylist()]
                found = held.n_best(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(x[0][1]) // 4 for x in found], pa.int64()),
                        pa.array([x[0][0] for x in found], pa.int64()),
                        pa.array([len(x) for x in found], pa.int32()),
                        pa.array([[s for s, _ in x] for x in found], pa.list_(pa.int64())),
                        pa.array([[zlib.crc32(ids) for _, ids in x] for x in found], pa.list_(pa.int64())),
                        pa.array([held.decode(x[0][1]) == text.replace(SPACE, " ") for x, text in zip(found, texts)]),
                    ],
                    names=["doc_id", "n_pieces", "score", "n_best", "scores", "ids_crc32", "round_trip"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def op8_pieces(spark, sf_dir: str) -> DataFrame:
    """The N best segmentations of every document."""
    return segment(spark.read.parquet(f"{sf_dir}/documents.parquet"))
