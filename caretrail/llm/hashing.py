"""Vectorised 64-bit hashes of words and word shingles, over whole texts in Arrow buffers.

A word is a run of bytes other than space and 0x09-0x0D; A-Z are lower-cased. The hash of a word is a
polynomial of its bytes (mod 2^64, odd base), read off a running sum, then mixed with its length.
Shingle hashes combine the word hashes. Everything is deterministic across machines and processes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from caretrail.llm.common import SLICE_BYTES, slices

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
KEEP = np.arange(256, dtype=np.uint8)
COEF = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
                 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9C6E6877736C46E3], U)
_POW: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply), so that every bit depends on every other."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i mod 2^64 for i up to n."""
    if len(_POW.get("up", ())) <= n:
        size = max(n + 1, SLICE_BYTES + 2)
        with np.errstate(over="ignore"):
            for name, b in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
                step = np.full(size, b, U)
                step[0] = 1
                _POW[name] = np.multiply.accumulate(step)
    return _POW["up"], _POW["down"]


def word_spans(raw: np.ndarray, doc_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end positions of the words of a run of documents; no word crosses a document's start."""
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = np.empty(n + 1, bool)
    np.logical_not(SPACE[raw], out=word[:n])
    word[n] = False
    first = word[:n].copy()
    first[1:] &= ~word[:n - 1]
    last = word[:n] & ~word[1:]
    cut = doc_starts[(doc_starts > 0) & (doc_starts < n)]
    first[cut] |= word[cut]
    last[cut - 1] |= word[cut - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def running(raw: np.ndarray, fold: np.ndarray = LOWER) -> np.ndarray:
    """Running sums of byte * BASE^position, with a leading 0: any span's polynomial is a difference."""
    up, _ = powers(len(raw) + 1)
    out = np.zeros(len(raw) + 1, U)
    np.cumsum(fold[raw].astype(U) * up[1:len(raw) + 1], out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U) * U(0xA24BAED4963EE407) + U(seed))


def pieces(raw: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[np.ndarray]:
    """One text in pieces of about `limit` bytes that end at white space (a longer word stays whole)."""
    a, n = 0, len(raw)
    while a < n:
        b = min(a + limit, n)
        while b < n:
            gap = np.flatnonzero(SPACE[raw[b:b + 65536]])
            if len(gap):
                b += int(gap[0])
                break
            b = min(b + 65536, n)
        yield raw[a:b]
        a = b


def word_hashes(raw: np.ndarray, offsets: np.ndarray, fold: np.ndarray = LOWER) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(a, b, hashes, bounds) for runs [a, b) of documents: the words of document a + i are
    hashes[bounds[i]:bounds[i + 1]]. Whole texts, however long."""
    with np.errstate(over="ignore"):
        for a, b in slices(offsets):
            part = raw[offsets[a]:offsets[b]]
            if b == a + 1 and len(part) > SLICE_BYTES:
                found = []
                for p in pieces(part):
                    s, e = word_spans(p, np.zeros(0, np.int64))
                    found.append(span_hash(running(p, fold), s, e))
                h = np.concatenate(found)
                yield a, b, h, np.array([0, len(h)])
                continue
            doc_starts = offsets[a:b + 1] - offsets[a]
            s, e = word_spans(part, doc_starts[:-1])
            yield a, b, span_hash(running(part, fold), s, e), np.searchsorted(s, doc_starts)


def shingles(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Hashes of all k-word windows in order; fewer words make one shingle of the whole sequence."""
    n = len(words)
    if n == 0:
        return words
    size = min(k, n)
    with np.errstate(over="ignore"):
        out = words[:n - size + 1] * COEF[0]
        for j in range(1, size):
            out = mix(out) if j % 4 == 0 else out
            out = out + words[j:n - size + 1 + j] * COEF[j % len(COEF)]
        return mix(out + U(size))


def distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) > 1 else x
