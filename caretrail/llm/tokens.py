"""Tokenization of whole texts with a public tokenizer file, fast enough for a corpus.

The tokenizers library defines the ids. For the word-BPE kind of file (NFC, white space, lower case, a
split into words, digits and symbol runs, then BPE within each) a text's ids are the ids of its pieces in
order. So pieces are found and hashed with numpy for a whole Arrow batch, each distinct piece goes through
the library's BPE model once a worker, and ids are gathered. Texts with characters beyond U+00FF, control
characters that Unicode calls spaces, or special-token strings go through the library whole, as does
everything for other kinds of file."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
from tokenizers import Tokenizer

from caretrail.llm.common import slices
from caretrail.llm.hashing import LOWER, SPACE, U, running, span_hash

CACHE_PIECES = 2_000_000
#: the split pattern of the file kind that the fast path reproduces
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ENDINGS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")
LETTER, NUMBER, SYMBOL = 1, 2, 3


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Class of each ASCII byte, and of U+0080-U+00FF by low byte (0: not handled here)."""
    ascii_ = np.full(256, SYMBOL, np.uint8)
    ascii_[SPACE] = 0
    for a, b, c in ((65, 91, LETTER), (97, 123, LETTER), (48, 58, NUMBER)):
        ascii_[a:b] = c
    latin = np.full(256, SYMBOL, np.uint8)
    latin[0xC0:] = LETTER
    latin[[0xAA, 0xB5, 0xBA]] = LETTER
    latin[[0xD7, 0xF7]] = SYMBOL
    latin[[0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE]] = NUMBER
    return ascii_, latin


ASCII, LATIN = _classes()
ODD = np.zeros(256, bool)
ODD[[0x1C, 0x1D, 0x1E, 0x1F]] = True
ODD[0xC4:] = True


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes each byte as a printable character: itself where printable, else from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class CorpusTokenizer:
    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.specials = [t["content"].encode() for t in spec.get("added_tokens") or []]
        steps = lambda part, key: [s["type"] for s in (spec.get(part) or {}).get(key, [])]
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        self.fast = (steps("normalizer", "normalizers") == ["NFC", "Replace", "Lowercase"] and steps("pre_tokenizer", "pretokenizers") == ["Split", "ByteLevel"]
                     and (split.get("pattern") or {}).get("Regex") == PATTERN and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout"))
        self.letters = _byte_letters()
        self._forget()

    def _forget(self) -> None:
        self.keys, self.at, self.size = np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(a, b, ids, bounds) for runs [a, b) of texts: text a + i has ids[bounds[i]:bounds[i + 1]]."""
        for a, b in slices(offsets):
            part, starts = raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
            whole = self._whole(part, starts)
            if whole.all():
                ids, lens = np.zeros(0, np.uint32), np.zeros(b - a, np.int64)
                parts = [ids]
            else:
                ids, lens = self._pieces(part, starts, whole)
                parts = np.split(ids, np.cumsum(lens)[:-1]) if whole.any() else [ids]
            if whole.any():
                parts = parts if len(parts) == b - a else [np.zeros(0, np.uint32)] * (b - a)
                for i in np.flatnonzero(whole):
                    text = part[starts[i]:starts[i + 1]].tobytes().decode()
                    parts[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
                    lens[i] = len(parts[i])
            yield a, b, np.concatenate(parts), np.concatenate(([0], np.cumsum(lens)))

    def _whole(self, part: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Which texts need the library's own pass."""
        n = len(starts) - 1
        if not self.fast:
            return np.ones(n, bool)
        odd = ODD[part]
        lead = np.flatnonzero(part == 0xC2)
        lead = lead[lead + 1 < len(part)]
        odd[lead] |= part[lead + 1] <= 0xA0  # U+0080-U+00A0
        where = np.flatnonzero(odd)
        data = part.tobytes()
        found = []
        for s in self.specials:
            k = data.find(s)
            while k >= 0:
                found.append(k)
                k = data.find(s, k + 1)
        out = np.zeros(n, bool)
        out[np.searchsorted(starts, np.concatenate((where, np.array(found, np.int64))), side="right") - 1] = True
        return out

    def _pieces(self, part: np.ndarray, starts: np.ndarray, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(part)
        if n == 0:
            return np.zeros(0, np.uint32), np.zeros(len(starts) - 1, np.int64)
        low = LOWER[part]
        kind = ASCII[part]
        two = np.flatnonzero((part == 0xC2) | (part == 0xC3))
        two = two[two + 1 < n]
        code = ((part[two] & 3) << 6) | (part[two + 1] & 0x3F)
        kind[two] = kind[two + 1] = LATIN[code]
        upper = (code >= 0xC0) & (code <= 0xDE) & (code != 0xD7)
        low[two[upper] + 1] += 0x20
        inner = np.zeros(n, bool)
        inner[two + 1] = True
        for i in np.flatnonzero(skip):
            kind[starts[i]:starts[i + 1]] = 0
        first = np.empty(n, bool)
        first[0] = True
        first[1:] = (kind[1:] != kind[:-1]) | ((kind[1:] == NUMBER) & ~inner[1:])
        first[starts[(starts > 0) & (starts < n)]] = True
        # 's, 't, 're ... as pieces of their own, where the apostrophe starts a piece and stands alone
        marks = np.flatnonzero((part == 39) & first)
        ends = np.append(starts[1:], n)
        for k in marks.tolist():
            if k + 1 >= n or kind[k + 1] != LETTER or not first[k + 1] or k + 1 in starts:
                continue
            stop = int(ends[np.searchsorted(starts, k, side="right") - 1])
            tail = low[k + 1:min(k + 3, stop)].tobytes()
            end = next((e for e in ENDINGS if tail.startswith(e)), None)
            if end:
                first[k + 1] = False
                if k + 1 + len(end) < n:
                    first[k + 1 + len(end)] = True
        first &= kind > 0
        s = np.flatnonzero(first)
        stop = np.zeros(n + 1, bool)
        stop[:n] = first | (kind == 0)
        stop[starts] = True
        stop[n] = True
        cuts = np.flatnonzero(stop)
        e = cuts[np.searchsorted(cuts, s, side="right")]
        with np.errstate(over="ignore"):
            h = span_hash(running(low, KEEP_ALL), s, e)
        uniq, index, inverse = np.unique(h, return_index=True, return_inverse=True)
        slot = self._slots(uniq, low, s[index], e[index])
        size, at = self.size[slot][inverse], self.at[slot][inverse]
        total = np.cumsum(size)
        ids = self.flat[np.repeat(at - (total - size), size) + np.arange(total[-1] if len(total) else 0)]
        doc = np.searchsorted(starts, s, side="right") - 1
        return ids, np.bincount(doc, weights=size, minlength=len(starts) - 1).astype(np.int64)

    def _slots(self, uniq: np.ndarray, low: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        if len(self.keys) + len(uniq) > CACHE_PIECES:
            self._forget()
        pos = np.searchsorted(self.keys, uniq)
        known = np.zeros(len(uniq), bool)
        inside = pos < len(self.keys)
        known[inside] = self.keys[pos[inside]] == uniq[inside]
        new = np.flatnonzero(~known)
        if len(new):
            data, model, letters = low.tobytes(), self.tokenizer.model, self.letters
            found = [[t.id for t in model.tokenize(data[a:b].decode("latin-1").translate(letters))] for a, b in zip(s[new].tolist(), e[new].tolist())]
            size = np.array([len(x) for x in found], np.int64)
            add = np.array([i for x in found for i in x], np.uint32)
            while self.used + len(add) > len(self.flat):
                self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
            self.flat[self.used:self.used + len(add)] = add
            at = self.used + np.concatenate(([0], np.cumsum(size)[:-1]))
            self.used += len(add)
            spot = pos[new]
            self.keys, self.at, self.size = (np.insert(old, spot, x) for old, x in ((self.keys, uniq[new]), (self.at, at), (self.size, size)))
            pos = np.searchsorted(self.keys, uniq)
        return pos


KEEP_ALL = np.arange(256, dtype=np.uint8)
_OPEN: dict[str, CorpusTokenizer] = {}


def tokenizer(path: str) -> CorpusTokenizer:
    """One for each file and Python worker, so that its cache lives across tasks."""
    if path not in _OPEN:
        _OPEN[path] = CorpusTokenizer(path)
    return _OPEN[path]
