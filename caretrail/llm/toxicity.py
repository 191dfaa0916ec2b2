"""Toxicity by noisy-channel restoration: undo leetspeak, spacing and repetition, then score the result.

1. A character trigram model is counted over every document (letters a-z and Latin-1 accented ones, all
   else is a word border). Tasks add up dense counts; what is gathered is one row a trigram seen.
2. A token with a letter and something odd in it (digit or symbol inside, a letter three times in a row) and
   a run of three or more single characters are lattices: each character may stand for itself, for the
   letters it imitates, or for nothing (separators, repetitions), at a channel cost. Between the characters
   of such a run a word may end, at a cost: it counts as one word and as the most probable several. Viterbi decoding finds
   the most probable letters under the trigram model; no state is left out. Tokens without such signs have one path, themselves.
3. Features of the restored words, as hashed indicators: the whole word and
   its beginnings of 3 to 8 bytes. From a bounded sample of labelled documents (``PER_CLASS`` ids a class,
   none of the held-out fold) the features that occur clearly more often in one class are kept, and a
   logistic model is fitted on them, with its intercept set for the class shares of all training labels.

Scoring reads the whole text of every document and nothing but the text. Defined results: null and empty
texts score the intercept. Without labels of both classes every score is the class share (0.5 without any).
Repeated rows are each scored; null doc_ids are scored and in no fold (held_out null). Extra columns are not
read. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caretrail.llm.common import SLICE_BYTES, fold, label_sample, slices, table, text_arrays
from caretrail.llm.hashing import KEEP, SPACE, pieces, running, span_hash, word_spans

PER_CLASS = 2500
FOLDS, HELD = 5, 0
BITS = 20
STARTS = (3, 4, 5, 6, 7, 8)
EPOCHS, RATE, RIDGE = 30, 0.3, 1e-3
LETTERS = 64
#: fixed values: what a character may imitate
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
#: log costs of the channel: imitation, a blot ("*" for any letter), a separator dropped, any other sign dropped, one that could imitate dropped, the third and later of a run dropped, a word border in a run of single characters
IMITATE, BLOT, SEPARATOR, DROP, UNLIKELY, REPEAT, BORDER = -1.0, -3.0, -0.3, -3.0, -7.0, -0.2, -1.0
SEPARATORS = frozenset(".-_*,~'`/\\:;+=^ ")


def _codes() -> np.ndarray:
    """Letter code of each byte: a-z 1-26, second byte of U+00C0-U+00FF 27-58, all else 0."""
    out = np.zeros(256, np.uint8)
    out[97:123] = np.arange(1, 27)
    out[65:91] = np.arange(1, 27)
    return out


CODE = _codes()


def letter_codes(raw: np.ndarray) -> np.ndarray:
    """One code a character of a utf-8 text; runs of other characters stay as zeros."""
    code = CODE[raw]
    lead = np.flatnonzero(raw[:-1] == 0xC3) if len(raw) > 1 else np.zeros(0, np.int64)
    code[lead + 1] = 27 + (raw[lead + 1] & 0x1F)
    keep = np.ones(len(raw), bool)
    keep[lead] = False
    return code[keep]


def code_of(ch: str) -> int:
    ch = ch.lower()
    if "a" <= ch <= "z":
        return ord(ch) - 96
    return 27 + (ord(ch) & 0x1F) if 0xE0 <= ord(ch) <= 0xFF and ch != "÷" else 0


def _trigrams(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(LETTERS ** 3, np.int64)
    for batch in it:
        raw, offsets = text_arrays(batch.column(0))
        for a, b in slices(offsets):
            for part in pieces(raw[offsets[a]:offsets[b]]):
                c = letter_codes(np.concatenate((np.full(2, 32, np.uint8), part, np.full(1, 32, np.uint8)))).astype(np.int64)
                total += np.bincount((c[:-2] * LETTERS + c[1:-1]) * LETTERS + c[2:], minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["gram", "n"])


class CharModel:
    """log P(letter | two before), trigram interpolated with bigram and unigram."""

    def __init__(self, counts: np.ndarray) -> None:
        c3 = counts.reshape(LETTERS, LETTERS, LETTERS).astype(float)
        c3[0, 0, 0] = 0  # runs of other characters say nothing
        c2, c1 = c3.sum(axis=0), c3.sum(axis=(0, 1))
        p1 = (c1 + 1) / (c1 + 1).sum()
        p2 = (c2 + 20 * p1) / (c2.sum(axis=1, keepdims=True) + 20)
        p3 = (c3 + 5 * p2[None]) / (c3.sum(axis=2, keepdims=True) + 5)
        self.log = np.log(p3).astype(np.float32)

    def decode(self, token: str, spaced: bool = False) -> str:
        """Viterbi over the token's lattice; the state is the last two letters. A spaced token is a run of single
        characters: any two may have a word border between them, a space of the result."""
        states = {(0, 0): (0.0, "")}
        log = self.log
        for ch, often, again in [(c, n, k > 0) for c, n in ((c, len(list(g))) for c, g in groupby(token.lower())) for k in range(n)]:
            options = []
            if code_of(ch):
                options.append((ch, 0.0))
            for x in LEET.get(ch, ""):
                options.append((x, IMITATE))
            if again and often > 2:
                drop = REPEAT
            elif ch in SEPARATORS:
                drop = SEPARATOR
            else:
                drop = None if code_of(ch) else UNLIKELY if ch in LEET else DROP
            if spaced:
                for (a, b), (score, text) in list(states.items()):
                    s = score + BORDER + float(log[a, b, 0])
                    if b and ((b, 0) not in states or states[b, 0][0] < s):
                        states[b, 0] = (s, text + " ")
            new: dict = {}
            for (a, b), (score, text) in states.items():
                if drop is not None and ((a, b) not in new or new[a, b][0] < score + drop):
                    new[a, b] = (score + drop, text)
                for x, cost in options:
                    k = code_of(x)
                    s = score + cost + float(log[a, b, k])
                    if (b, k) not in new or new[b, k][0] < s:
                        new[b, k] = (s, text + x)
            if ch == "*":  # any letter: for each pair of last letters the best one before it
                a, b = np.array(list(states)).T
                ways = np.full((LETTERS, LETTERS, 26), -np.inf)
                ways[a, b] = np.array([s for s, _ in states.values()])[:, None] + BLOT + log[a, b, 1:27]
                first, top = ways.argmax(axis=0), ways.max(axis=0)
                for y, k in np.argwhere(top > -np.inf).tolist():
                    if (y, k + 1) not in new or new[y, k + 1][0] < top[y, k]:
                        new[y, k + 1] = (float(top[y, k]), states[int(first[y, k]), y][1] + chr(97 + k))
            states = new  # at most 59 * 59, none is left out
        return max(((s + float(log[a, b, 0]), t) for (a, b), (s, t) in states.items()), default=(0.0, ""))[1]


def char_model(docs: DataFrame, text_col: str = "text") -> CharModel:
    counts = docs.select(F.col(text_col).cast("string")).mapInArrow(_trigrams, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    total = np.zeros(LETTERS ** 3, np.int64)
    for r in counts.collect():  # one row a trigram of the fixed alphabet at most
        total[r[0]] = r[1]
    return CharModel(total)


ALPHA = CODE > 0
HIGH = np.arange(256) >= 128
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32


def _lower(part: np.ndarray) -> np.ndarray:
    out = LOWERED[part]
    lead = np.flatnonzero(part[:-1] == 0xC3) if len(part) > 1 else np.zeros(0, np.int64)
    up = lead[(part[lead + 1] < 0xA0) & (part[lead + 1] >= 0x80) & (part[lead + 1] != 0x97)]
    out[up + 1] += 0x20
    return out


def _word_features(low: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of each word's features; spans are trimmed of what is no letter at the ends."""
    letter = ALPHA[low] | HIGH[low]
    n = len(low)
    place = np.where(letter, np.arange(n), n)
    nxt = np.minimum.accumulate(place[::-1])[::-1]
    last = np.maximum.accumulate(np.where(letter, np.arange(n), -1))
    first, end = nxt[s], last[e - 1] + 1
    ok = np.flatnonzero((first < e) & (end - first >= 3))
    first, end = first[ok], end[ok]
    sums = running(low, KEEP)
    at, key = [ok], [span_hash(sums, first, end, 1)]
    for k in STARTS:
        long = end - first >= k
        at.append(ok[long])
        key.append(span_hash(sums, first[long], first[long] + k, 2))
    return np.concatenate(at), (np.concatenate(key) >> np.uint64(64 - BITS)).astype(np.int64)


def _odd_words(part: np.ndarray, low: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words that need decoding, and runs of single characters (as a flag on each of their words)."""
    letter = ALPHA[low] | HIGH[low]
    run = np.zeros(len(low) + 1, np.int64)
    triple = np.zeros(len(low), bool)
    triple[2:] = (low[2:] == low[1:-1]) & (low[1:-1] == low[:-2]) & ALPHA[low[2:]]
    np.cumsum(triple, out=run[1:])
    repeats = run[e] - run[np.minimum(s + 2, e)] > 0
    # trim sentence marks, and three or more of one sign, off both ends: decoration rather than imitation
    n = len(low)
    place = np.where(letter | _DIGIT[low], np.arange(n), n)
    first = np.minimum.accumulate(place[::-1])[::-1][s]
    last = np.maximum.accumulate(np.where(letter | _DIGIT[low], np.arange(n), -1))[e - 1] + 1
    core = first < e
    count = np.concatenate(([0], np.cumsum(letter)))
    inner = np.zeros(len(s), bool)
    f, t = first[core], last[core]
    inner[core] = (count[t] - count[f] < t - f) & (count[t] - count[f] > 0)
    # a sign that imitates a letter at an end: one or two of them, next to the core
    for edge, size in ((last, e - last), (first - 1, first - s)):
        k = np.where(core, np.clip(edge, 0, n - 1), 0)
        inner |= core & (size >= 1) & (size <= 2) & _SIGN[low[k]] & (count[np.minimum(last, n)] - count[np.minimum(first, n)] > 0)
    single = (e - s == 1) & (letter[s] | _DIGIT[low[s]] | _SIGN[low[s]])
    # characters of two and three bytes: Latin-1 letters, the pound and the euro sign
    second, third = low[np.minimum(s + 1, n - 1)], low[np.minimum(s + 2, n - 1)]
    single |= (e - s == 2) & ((low[s] == 0xC3) & (CODE_2[second] > 0) | (low[s] == 0xC2) & (second == 0xA3))
    single |= (e - s == 3) & (low[s] == 0xE2) & (second == 0x82) & (third == 0xAC)
    edge = np.flatnonzero(np.diff(np.concatenate(([0], single.astype(np.int8), [0]))))
    spaced = np.zeros(len(s), bool)
    for a, b in zip(edge[::2], edge[1::2]):
        if b - a >= 3:
            spaced[a:b] = True
    return (inner | repeats) & ~spaced, spaced


CODE_2 = np.array([0] * 0xA0 + [code_of(chr(0x40 + x)) for x in range(0xA0, 0xC0)] + [0] * 0x40)
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SIGN = np.isin(np.arange(256), [ord(c) for c in "@$|+("])


class Restorer:
    """Restored words of texts as feature buckets; decoded tokens are remembered for the next texts."""

    def __init__(self, model: CharModel, remember: int = 200_000) -> None:
        self.model, self.known, self.remember = model, {}, remember

    def decode(self, token: str, spaced: bool = False) -> str:
        got = self.known.get((token, spaced))
        if got is None:
            if len(self.known) >= self.remember:
                self.known.clear()
            got = self.known[token, spaced] = self.model.decode(token, spaced)
        return got

    def part(self, part: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document number, bucket) of all features of a run of documents."""
        s, e = word_spans(part, starts)
        if not len(s):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        doc = np.searchsorted(starts, s, side="right") - 1
        low = _lower(part)
        odd, spaced = _odd_words(part, low, s, e)
        plain = np.flatnonzero(~odd & ~spaced)
        at, key = _word_features(low, s[plain], e[plain]) if len(plain) else (np.zeros(0, np.int64),) * 2
        docs, keys = [doc[plain][at]] if len(plain) else [], [key] if len(plain) else []
        texts, owner = [], []
        data = low.tobytes()
        for i in np.flatnonzero(odd).tolist():
            texts.append(self.decode(data[s[i]:e[i]].decode("utf-8", "replace")))
            owner.append(doc[i])
        group = np.flatnonzero(spaced)
        for run in np.split(group, np.flatnonzero((np.diff(group) > 1) | (np.diff(doc[group]) > 0)) + 1) if len(group) else []:
            if len(run) >= 3:
                token = "".join(data[s[i]:e[i]].decode("utf-8", "replace") for i in run.tolist())
                words = [self.decode(token), *self.decode(token, True).split()]
                texts += words
                owner += [doc[run[0]]] * len(words)
        if texts:
            line = np.frombuffer(" ".join(texts).encode() + b" ", np.uint8)
            lens = np.array([len(t.encode()) for t in texts])
            ends = np.cumsum(lens + 1) - 1
            some = np.flatnonzero(lens > 0)
            if len(some):
                at, key = _word_features(line, (ends - lens)[some], ends[some])
                docs.append(np.array(owner)[some][at])
                keys.append(key)
        return (np.concatenate(docs), np.concatenate(keys)) if docs else (np.zeros(0, np.int64),) * 2

    def runs(self, raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        for a, b in slices(offsets):
            part = raw[offsets[a]:offsets[b]]
            if b == a + 1 and len(part) > SLICE_BYTES:
                got = [self.part(p, np.zeros(1, np.int64)) for p in pieces(part)]
                yield a, b, np.concatenate([x for x, _ in got]), np.concatenate([x for _, x in got])
            else:
                yield a, b, *self.part(part, offsets[a:b] - offsets[a])


def _by_doc(doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, bucket) pairs in order."""
    both = np.unique((doc << BITS) | key)
    return both >> BITS, both & ((1 << BITS) - 1)


def _collector(model: CharModel) -> Callable:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(model)
        for batch in it:
            raw, offsets = text_arrays(batch.column(0))
            ids: list = [b""] * batch.num_rows
            for a, b, doc, key in restore.runs(raw, offsets):
                doc, key = _by_doc(doc, key)
                cut = np.searchsorted(doc, np.arange(b - a + 1))
                for i in range(b - a):
                    ids[a + i] = key[cut[i]:cut[i + 1]].astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), batch.column(1).cast(pa.int64())], ["ids", "label"])
    return run


class Model:
    def __init__(self, chars: CharModel, bias: float, buckets: np.ndarray, weights: np.ndarray) -> None:
        self.chars, self.bias, self.buckets, self.weights = chars, bias, buckets, weights


def fit(chars: CharModel, sample: list[tuple[bytes, int]], share: float | None) -> Model:
    """Logistic model on the features that tell the classes apart; identical documents count once."""
    unique = sorted({(bytes(i), int(v)) for i, v in sample})
    labels = np.array([v for _, v in unique], float)
    none = np.zeros(0, np.int64)
    if share is None or not 0 < labels.sum() < len(labels):
        return Model(chars, 0.0 if share is None else float(np.log((share + 1e-6) / (1 - share + 1e-6))), none, none.astype(float))
    rows = [np.frombuffer(i, "<u4") for i, _ in unique]
    seen = np.zeros((2, 1 << BITS))
    for r, v in zip(rows, labels):
        seen[int(v), r] += 1
    n1, n0 = labels.sum(), len(labels) - labels.sum()
    p1, p0 = seen[1] / n1, seen[0] / n0
    spread = np.sqrt((p1 + 0.5 / n1) / n1 + (p0 + 0.5 / n0) / n0)
    buckets = np.flatnonzero(((p1 - p0) / spread > 2.2) & (seen[1] >= 3))
    place = np.full(1 << BITS, -1)
    place[buckets] = np.arange(len(buckets))
    data = [p[p >= 0] for p in (place[r] for r in rows)]
    start = np.log((seen[1][buckets] + 0.5) / (n1 + 1)) - np.log((seen[0][buckets] + 0.5) / (n0 + 1))
    w, b = np.zeros(len(buckets)), 0.0
    speed, sb = np.full(len(buckets), 1e-8), 1e-8
    rng = np.random.RandomState(0)
    weight = np.where(labels > 0, len(labels) / (2 * n1), len(labels) / (2 * n0))
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            d = data[i]
            g = weight[i] * (1 / (1 + np.exp(-np.clip((w[d] * start[d]).sum() + b, -30, 30))) - labels[i])
            step = g * start[d] + RIDGE * w[d]
            speed[d] += step * step
            w[d] -= RATE * step / np.sqrt(speed[d])
            sb += g * g
            b -= RATE * g / np.sqrt(sb)
    return Model(chars, float(b + np.log((share + 1e-6) / (1 - share + 1e-6))), buckets, w * start)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> Model:
    chars = char_model(docs, text_col)
    sample = label_sample(labels, id_col, label_col, PER_CLASS, FOLDS, HELD)
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (fold(id_col, FOLDS) != HELD))
    share = usable.agg(F.avg((F.col(label_col) > 0).cast("double"))).first()[0]
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where(F.col("text").isNotNull())
    rows = texts.join(F.broadcast(sample), "doc_id").select("text", "label").mapInArrow(_collector(chars), "ids binary, label bigint").collect()
    return fit(chars, [(r["ids"], r["label"]) for r in rows], share)


def _scorer(model: Model) -> Callable:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(model.chars)
        weight = np.zeros(1 << BITS)
        weight[model.buckets] = model.weights
        chosen = np.zeros(1 << BITS, bool)
        chosen[model.buckets] = True
        for batch in it:
            raw, offsets = text_arrays(batch.column(1))
            z = np.full(batch.num_rows, model.bias)
            for a, b, doc, key in restore.runs(raw, offsets):
                hit = chosen[key]
                doc, key = _by_doc(doc[hit], key[hit])
                z[a:b] += np.bincount(doc, weights=weight[key], minlength=b - a)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -50, 50))))], ["doc_id", "score"])
    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, score (probability of label 1)."""
    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")).mapInArrow(_scorer(model), "doc_id bigint, score double")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", (fold("doc_id", FOLDS) == HELD).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
