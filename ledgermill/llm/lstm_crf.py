"""Character-level bidirectional LSTM with CRF transitions, forward, backward and Viterbi in numpy."""

from __future__ import annotations

import numpy as np

PAD = 0


def char_codes(text: str) -> np.ndarray:
    """0 is padding, 1..127 ASCII, 128 other letters, 129 other digits or marks, 130 other spaces."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    codes = np.minimum(points, 128).astype(np.int64)
    for i in np.flatnonzero(points >= 128):
        x = text[i]
        codes[i] = 128 if x.isalpha() else 130 if x.isspace() else 129
    codes[codes == 0] = 129
    return codes


N_CODES = 131


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class BiLstmCrf:
    def __init__(self, tags: int, width: int = 12, hidden: int = 20, seed: int = 7) -> None:
        draw = np.random.default_rng(seed)
        self.tags, self.hidden = tags, hidden
        init = lambda *shape: (draw.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {"emb": init(N_CODES, width) * 3, "out": init(2 * hidden, tags), "bias": np.zeros(tags, np.float32), "trans": np.zeros((tags, tags), np.float32)}
        for d in "fb":
            self.p |= {f"{d}x": init(width, 4 * hidden), f"{d}h": init(hidden, 4 * hidden), f"{d}b": np.zeros(4 * hidden, np.float32)}
            self.p[f"{d}b"][hidden : 2 * hidden] = 1.0

    def _run(self, x: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """x (time, batch, width) through one direction; gates are input, forget, output, candidate."""
        p, n, h = self.p, self.hidden, np.zeros((x.shape[1], self.hidden), np.float32)
        c, out = h, np.empty((*x.shape[:2], n), np.float32)
        given = x @ p[f"{d}x"] + p[f"{d}b"]
        for t in range(len(x)) if d == "f" else reversed(range(len(x))):
            g = given[t] + h @ p[f"{d}h"]
            s = _sigmoid(g[:, : 3 * n])
            i, f, o, z = s[:, :n], s[:, n : 2 * n], s[:, 2 * n :], np.tanh(g[:, 3 * n :])
            before = (h, c)
            c = f * c + i * z
            tc = np.tanh(c)
            h = o * tc
            out[t] = h
            if keep is not None:
                keep.append((t, i, f, o, z, tc, *before))
        return out

    def emissions(self, codes: np.ndarray) -> np.ndarray:
        """(time, batch, tags) for codes (batch, time)."""
        x = self.p["emb"][codes.T]
        return np.concatenate([self._run(x, "f"), self._run(x, "b")], axis=2) @ self.p["out"] + self.p["bias"]

    def _crf(self, e: np.ndarray, gold: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Mean negative log-likelihood and its slopes in emissions and transitions; gold (time, batch)."""
        steps, batch, k = e.shape
        tr = self.p["trans"].astype(np.float64)
        e = e.astype(np.float64)
        a, b = np.empty_like(e), np.zeros_like(e)
        a[0] = e[0]
        fold = lambda m, axis: (top := m.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(np.exp(m - top).sum(axis=axis))
        for t in range(1, steps):
            a[t] = e[t] + fold(a[t - 1][:, :, None] + tr, 1)
        for t in range(steps - 2, -1, -1):
            b[t] = fold(tr + (e[t + 1] + b[t + 1])[:, None, :], 2)
        z = fold(a[-1], 1)
        slope = np.exp(a + b - z[None, :, None])
        rows = np.arange(batch)
        d_tr = np.zeros((k, k))
        score = np.zeros(batch)
        for t in range(steps):
            score += e[t, rows, gold[t]]
            slope[t, rows, gold[t]] -= 1
            if t:
                score += tr[gold[t - 1], gold[t]]
                d_tr += np.exp(a[t - 1][:, :, None] + tr + (e[t] + b[t])[:, None, :] - z[:, None, None]).sum(0)
                np.add.at(d_tr, (gold[t - 1], gold[t]), -1)
        return float((z - score).mean()), (slope / batch).astype(np.float32), (d_tr / batch).astype(np.float32)

    def slopes(self, codes: np.ndarray, gold: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        p, n = self.p, self.hidden
        x = p["emb"][codes.T]
        kept = {"f": [], "b": []}
        hidden = np.concatenate([self._run(x, d, kept[d]) for d in "fb"], axis=2)
        loss, d_e, d_tr = self._crf(hidden @ p["out"] + p["bias"], gold.T)
        flat = lambda m: m.reshape(-1, m.shape[-1])
        g = {"trans": d_tr, "out": flat(hidden).T @ flat(d_e), "bias": flat(d_e).sum(0)}
        d_hidden = d_e @ p["out"].T
        d_x = np.zeros_like(x)
        for k, d in enumerate("fb"):
            d_h = np.zeros((x.shape[1], n), np.float32)
            d_c = d_h
            gates = np.empty((*x.shape[:2], 4 * n), np.float32)
            g[f"{d}h"] = np.zeros_like(p[f"{d}h"])
            for t, i, f, o, z, tc, h0, c0 in reversed(kept[d]):
                d_h = d_h + d_hidden[t, :, k * n : (k + 1) * n]
                d_c = d_c + d_h * o * (1 - tc * tc)
                gates[t] = np.concatenate([d_c * z * i * (1 - i), d_c * c0 * f * (1 - f), d_h * tc * o * (1 - o), d_c * i * (1 - z * z)], axis=1)
                g[f"{d}h"] += h0.T @ gates[t]
                d_h, d_c = gates[t] @ p[f"{d}h"].T, d_c * f
            g[f"{d}x"], g[f"{d}b"] = flat(x).T @ flat(gates), flat(gates).sum(0)
            d_x += gates @ p[f"{d}x"].T
        g["emb"] = np.zeros_like(p["emb"])
        np.add.at(g["emb"], codes.T, d_x)
        return loss, g

    def fit(self, codes: np.ndarray, gold: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 11) -> BiLstmCrf:
        """Adam over shuffled batches; same data and seed, same weights."""
        draw, step = np.random.default_rng(seed), 0
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        total = epochs * -(-len(codes) // batch)
        for _ in range(epochs):
            order = draw.permutation(len(codes))
            for at in range(0, len(order), batch):
                rows = order[at : at + batch]
                _, g = self.slopes(codes[rows], gold[rows])
                norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
                step += 1
                now = rate * (1 - 0.9 * step / total)
                for k, x in g.items():
                    x = x * min(1.0, 5.0 / (norm + 1e-9))
                    m[k] = 0.9 * m[k] + 0.1 * x
                    v[k] = 0.999 * v[k] + 0.001 * x * x
                    self.p[k] -= now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def _transitions(self, allowed: np.ndarray | None) -> np.ndarray:
        return self.p["trans"] if allowed is None else np.where(allowed, self.p["trans"], np.float32(-1e4))

    def viterbi(self, e: np.ndarray, allowed: np.ndarray | None = None) -> np.ndarray:
        """Best tags of one sequence of emissions (time, tags); allowed (tags, tags) forbids transitions."""
        return self.viterbi_batch([e], allowed)[0]

    def viterbi_batch(self, sequences: list[np.ndarray], allowed: np.ndarray | None = None) -> list[np.ndarray]:
        """Best tags of each sequence of emissions (time, tags), all sequences in step."""
        if not sequences:
            return []
        tr, sizes = self._transitions(allowed).T[None], np.array([len(x) for x in sequences])
        steps, rows = int(sizes.max()), np.arange(len(sequences))
        e = np.zeros((steps, len(sequences), self.tags), np.float32)
        for i, x in enumerate(sequences):
            e[: len(x), i] = x
        best, back = e[0].copy(), np.empty((steps, len(sequences), self.tags), np.uint8)
        for t in range(1, steps):
            all_ = best[:, None, :] + tr  # (sequence, next, before)
            back[t] = all_.argmax(2)
            live = (t < sizes)[:, None]
            best = np.where(live, all_.max(2) + e[t], best)
        out, tag = np.zeros((steps, len(sequences)), np.uint8), best.argmax(1)
        for t in range(steps - 1, -1, -1):
            out[t] = tag
            if t:
                tag = np.where(t < sizes, back[t, rows, tag], tag)
        return [out[:n, i] for i, n in enumerate(sizes)]


def settled(e: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """For stretches of emissions (stretch, time, tags) that stand inside longer ones: each place's tag if every best path
    through the stretch has it there, whatever tags the stretch begins and ends with, else -1."""
    n, tags = e.shape[1], e.shape[2]
    ahead = np.full((len(e), n, tags, tags), -1e9, np.float64)  # (stretch, place, first tag, tag)
    ahead[:, 0, range(tags), range(tags)] = e[:, 0]
    for t in range(1, n):
        ahead[:, t] = (ahead[:, t - 1, :, :, None] + transitions).max(2) + e[:, t, None, :]
    out, after = np.full((len(e), n), -1, np.int64), np.where(np.eye(tags, dtype=bool), 0.0, -1e9)[None].repeat(len(e), 0)  # (stretch, tag, last tag)
    for t in range(n - 1, -1, -1):
        both = ahead[:, t, :, :, None] + after[:, None]  # (stretch, first, tag, last)
        two = np.partition(both, -2, 2)[:, :, -2:]
        best = both.argmax(2).reshape(len(e), -1)
        sure = (best == best[:, :1]).all(1) & ((two[:, :, 1] - two[:, :, 0]) > 1e-3).all((1, 2))
        out[sure, t] = best[sure, 0]
        if t:
            after = (transitions[None, :, :, None] + (e[:, t, :, None] + after)[:, None]).max(2)
    return out


class CarriedViterbi:
    """Viterbi over a sequence that comes in blocks. What all best paths share is settled, the rest is carried on."""

    def __init__(self, model: BiLstmCrf, allowed: np.ndarray | None = None) -> None:
        self.tr = np.ascontiguousarray(model._transitions(allowed).T)
        self.best: np.ndarray | None = None
        self.back = np.empty((0, model.tags), np.uint8)  # of the places after the settled ones
        self.settled: list[np.ndarray] = []

    def feed(self, e: np.ndarray) -> None:
        back = np.empty((len(e), e.shape[1]), np.uint8)
        best, start, places = self.best, 0, np.arange(e.shape[1])
        if best is None:
            best, start, back[0] = e[0], 1, places
        for t in range(start, len(e)):
            all_ = self.tr + best
            back[t] = all_.argmax(1)
            best = all_.max(1) + e[t]
        self.best, self.back = best - best.max(), np.concatenate([self.back, back])
        tags = places
        for t in range(len(self.back) - 1, 0, -1):
            tags = self.back[t][tags]
            if (tags == tags[0]).all():  # the tag at t - 1, whatever follows
                self._settle(t, int(tags[0]))
                break

    def _settle(self, n: int, tag: int) -> None:
        """The first n places end with this tag."""
        out = np.empty(n, np.uint8)
        for t in range(n - 1, -1, -1):
            out[t] = tag
            tag = int(self.back[t, tag])
        self.settled.append(out)
        self.back = self.back[n:]

    def finish(self) -> np.ndarray:
        if self.best is not None and len(self.back):
            self._settle(len(self.back), int(self.best.argmax()))
        return np.concatenate(self.settled) if self.settled else np.empty(0, np.uint8)
