"""Elias-Fano encoding of a non-decreasing sequence of non-negative integers.

Each value keeps its low bits in a packed array; its high part is one set bit in a bit vector, at
place high + index. Every SAMPLE-th set bit's place is stored, so ``select`` scans a few words.
Near 2 + log2(universe / n) bits a value; no table of 64-bit offsets.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
_HEAD = struct.Struct("<QQBQQQ")


class EliasFano:
    def __init__(self, n: int, last: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray) -> None:
        self.n, self.last, self.low_bits = n, last, low_bits
        self.low, self.high, self.samples = low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        if n == 0:
            return cls(0, 0, 0, np.zeros(0, np.uint8), np.zeros(0, np.uint8), np.zeros(0, np.uint32))
        if np.any(values[1:] < values[:-1]):
            raise ValueError("values must not decrease")
        last = int(values[-1])
        bits = max(0, (last // n).bit_length() - 1)
        places = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n, dtype=np.int64)
        vector = np.zeros(int(places[-1]) + 1, dtype=np.uint8)
        vector[places] = 1
        shifts = np.arange(bits, dtype=np.uint64)
        low = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel()
        kind = np.uint32 if len(vector) < 1 << 32 else np.uint64
        return cls(n, last, bits, np.packbits(low, bitorder="little"), np.packbits(vector, bitorder="little"), places[::SAMPLE].astype(kind))

    def _low(self, i: int) -> int:
        if not self.low_bits:
            return 0
        at = i * self.low_bits
        word = int.from_bytes(self.low[at >> 3 : (at + self.low_bits + 7 >> 3)].tobytes(), "little")
        return word >> (at & 7) & (1 << self.low_bits) - 1

    def select(self, i: int) -> int:
        """Value i, from the nearest sample before it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte, bits = place >> 3, int(self.high[place >> 3]) >> (place & 7) << (place & 7)
        while (ones := bits.bit_count()) <= left:
            left -= ones
            byte += 1
            bits = int(self.high[byte])
        for _ in range(left):
            bits &= bits - 1
        place = (byte << 3) + (bits & -bits).bit_length() - 1
        return (place - i) << self.low_bits | self._low(i)

    def values(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """Values first to last - 1: from the nearest sample on, only the bytes that hold them are unpacked."""
        last = self.n if last is None else min(last, self.n)
        if first >= last:
            return np.zeros(0, np.uint64)
        start = first // SAMPLE
        end = -(-last // SAMPLE)
        byte = int(self.samples[start]) >> 3
        stop = (int(self.samples[end]) >> 3) + 1 if end < len(self.samples) else len(self.high)
        bits = np.unpackbits(self.high[byte:stop], bitorder="little")
        bits[: int(self.samples[start]) - 8 * byte] = 0
        places = np.flatnonzero(bits)[first - start * SAMPLE : last - start * SAMPLE] + 8 * byte
        out = (places - np.arange(first, last)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            at = first * self.low_bits
            low = np.unpackbits(self.low[at >> 3 : (last * self.low_bits + 7) >> 3], bitorder="little")[at & 7 :][: (last - first) * self.low_bits].reshape(last - first, self.low_bits)
            out |= low.astype(np.uint64) @ (np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64))
        return out

    def to_bytes(self) -> bytes:
        head = _HEAD.pack(self.n, self.last, self.low_bits, len(self.low), len(self.high), len(self.samples) << 1 | (self.samples.itemsize == 8))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, last, bits, n_low, n_high, packed = _HEAD.unpack_from(data)
        n_samples, wide = packed >> 1, packed & 1
        at = _HEAD.size
        low = np.frombuffer(data, np.uint8, n_low, at)
        high = np.frombuffer(data, np.uint8, n_high, at + n_low)
        return cls(n, last, bits, low, high, np.frombuffer(data, np.uint64 if wide else np.uint32, n_samples, at + n_low + n_high))
