"""Elias-Fano coding of a non-decreasing sequence: n values below u take about 2 + log2(u / n) bits each.

The low l = floor(log2(u / n)) bits of each value are packed as they are; the high parts are unary gaps in a
bit vector (one set bit a value). ``select`` finds the i-th set bit from a sample of every ``SAMPLE``-th
one's place plus a byte-wise count, so any value is read without decoding the rest."""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
HEAD = struct.Struct("<QQBxxxxxxxQQQ")
COUNT = np.array([bin(i).count("1") for i in range(256)], np.int64)
WINDOW = 1 << 16


class EliasFano:
    def __init__(self, n: int, universe: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray) -> None:
        self.n, self.universe, self.low_bits, self.low, self.high, self.samples = n, universe, low_bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n = len(v)
        universe = int(v[-1]) + 1 if n else 1
        low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        if low_bits:
            bits = ((v[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
            low = np.packbits(bits.reshape(-1), bitorder="little")
        else:
            low = np.zeros(0, np.uint8)
        places = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros((int(places[-1]) // 8 + 1) if n else 0, np.uint8)
        np.bitwise_or.at(high, places >> 3, (1 << (places & 7)).astype(np.uint8))
        return cls(n, universe, low_bits, low, high, places[::SAMPLE].astype(np.uint32) if len(high) < 1 << 28 else places[::SAMPLE].astype(np.uint64))

    def to_bytes(self) -> bytes:
        s = self.samples.tobytes()
        return (HEAD.pack(self.n, self.universe, self.low_bits, len(self.low), len(self.high), len(s)) + self.low.tobytes() + self.high.tobytes() + s)

    @classmethod
    def from_bytes(cls, data: bytes, at: int = 0) -> tuple[EliasFano, int]:
        """The sequence stored at an offset, and the offset after it."""
        n, universe, low_bits, a, b, c = HEAD.unpack_from(data, at)
        at += HEAD.size
        part = lambda i, j: np.frombuffer(data, np.uint8, j - i, i)
        low, high, s = part(at, at + a), part(at + a, at + a + b), part(at + a + b, at + a + b + c)
        return cls(n, universe, low_bits, low, high, s.view(np.uint32 if b < 1 << 28 else np.uint64)), at + a + b + c

    def select(self, i: int) -> int:
        """The place of the i-th set bit (from 0) in the high bits."""
        start = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        byte = start >> 3
        seen = -int(COUNT[int(self.high[byte]) & ((1 << (start & 7)) - 1)])
        while True:
            run = np.cumsum(COUNT[self.high[byte:byte + WINDOW]]) + seen
            k = int(np.searchsorted(run, left + 1))
            if k < len(run):
                before = int(run[k - 1]) if k else seen
                bits = np.flatnonzero((int(self.high[byte + k]) >> np.arange(8)) & 1)
                return (byte + k) * 8 + int(bits[left - before])
            seen, byte = int(run[-1]), byte + WINDOW

    def __getitem__(self, i: int) -> int:
        return int(self.slice(i, i + 1)[0])

    def __len__(self) -> int:
        return self.n

    def slice(self, a: int, b: int) -> np.ndarray:
        """Values a to b - 1, decoding only the bits between their select positions."""
        b = min(b, self.n)
        if a >= b:
            return np.zeros(0, np.int64)
        first, last = self.select(a), self.select(b - 1)
        bits = np.unpackbits(self.high[first >> 3:(last >> 3) + 1], bitorder="little")
        places = np.flatnonzero(bits) + (first >> 3) * 8
        places = places[(places >= first) & (places <= last)]
        value = (places - np.arange(a, b)) << self.low_bits
        if self.low_bits:
            p, q = a * self.low_bits, b * self.low_bits
            raw = np.unpackbits(self.low[p >> 3:(q + 7) >> 3], bitorder="little")[p - (p >> 3) * 8:][:q - p]
            value = value + (raw.reshape(-1, self.low_bits).astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)
        return value
