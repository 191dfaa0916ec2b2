"""Quality classifier: naive-Bayes-scaled n-gram indicators and a linear hinge-loss model.

Features are the presence of hashed n-grams of two kinds: 4-byte strings of the text, and runs of one to
three word shapes (case, how the word ends, length class, whether it repeats the word before), which catch
form rather than vocabulary. Each indicator is scaled by its log-count ratio between the classes, rows are
brought to unit length, and the model is fitted by dual coordinate descent (squared hinge loss, classes
weighed equally). A logistic curve fitted on documents kept back turns margins into probabilities, shifted
from the sample's class shares to those of all labels.

Training reads a bounded sample: at most ``PER_CLASS`` labelled ids a class (hash order), none of the
held-out fold; identical feature sets count once. The sample comes to the driver as Arrow and is held
once, as integers; a row's scaled values are made when they are used. The class shares are counted over all training labels.
Scoring uses the whole text of every document and nothing but the text.

Defined results: null and empty texts have no n-gram; their score is the calibrated intercept, or 0 where
that is no number. Without labels of both classes every score is the class share (0.5 without any).
Repeated rows are each scored; null doc_ids are scored and are in no fold (held_out null). Extra columns
are ignored by scoring and kept by the filter. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caretrail.llm.common import fold, label_sample, table, text_arrays
from caretrail.llm.hashing import LOWER, U, pieces, running, span_hash, word_spans

BITS = 16
SIZE = 1 << (BITS + 1)
PER_CLASS = 2500
EPOCHS, COST, SMOOTH = 15, 1.0, 1.0
FOLDS, HELD, THRESHOLD = 5, 0, 0.3


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """Case class of a word's first byte, and class of its last byte."""
    first, last = np.full(256, 3, np.uint32), np.full(256, 3, np.uint32)
    first[97:123], first[65:91], first[48:58] = 0, 1, 2
    first[128:] = 0
    last[97:123] = last[65:91] = last[128:] = last[48:58] = 0
    last[[ord(c) for c in ".,;:"]] = 1
    last[[ord(c) for c in "!?"]] = 2
    return first, last


FIRST, LAST = _kinds()


def features(raw: np.ndarray) -> np.ndarray:
    """The sorted buckets of the n-grams that occur in a text."""
    seen = np.zeros(SIZE, bool)
    for i in range(0, len(raw), 1 << 18):  # long texts in overlapping parts
        part = raw[i:i + (1 << 18) + 3].astype(np.uint32)
        if len(part) > 3:
            key = part[:-3] | part[1:-2] << np.uint32(8) | part[2:-1] << np.uint32(16) | part[3:] << np.uint32(24)
            seen[(key * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)] = True
    shape = _shapes(raw)
    if len(shape):
        for n, mul in ((1, 0x85EBCA6B), (2, 0xC2B2AE35), (3, 0x27D4EB2F)):
            if len(shape) >= n:
                key = shape[:len(shape) - n + 1].copy()
                for j in range(1, n):
                    key = key * np.uint32(509) + shape[j:len(shape) - n + 1 + j]
                seen[((key + np.uint32(n)) * np.uint32(mul) >> np.uint32(32 - BITS)) + np.uint32(1 << BITS)] = True
    return np.flatnonzero(seen)


def _shapes(raw: np.ndarray) -> np.ndarray:
    out, before = [], None
    with np.errstate(over="ignore"):
        for part in pieces(raw):
            s, e = word_spans(part, np.zeros(0, np.int64))
            if not len(s):
                continue
            h = span_hash(running(part, LOWER), s, e)
            again = np.concatenate(([U(0) if before is None else before], h[:-1])) == h
            before = h[-1]
            size = np.minimum((e - s) // 4, 4).astype(np.uint32)
            second = FIRST[part[np.minimum(s + 1, e - 1)]]
            out.append((((FIRST[part[s]] * 4 + second) * 4 + LAST[part[e - 1]]) * 5 + size) * 2 + again)
    return np.concatenate(out).astype(np.uint32) if out else np.zeros(0, np.uint32)


class Model:
    def __init__(self, weight: np.ndarray | None, ratio: np.ndarray | None, bias: float, slope: float, shift: float) -> None:
        self.weight, self.ratio, self.bias, self.slope, self.shift = weight, ratio, bias, slope, shift

    def margin(self, ids: np.ndarray) -> float:
        if self.weight is None or not len(ids):
            return self.bias
        r = self.ratio[ids]
        norm = float(np.sqrt((r * r).sum()))
        return float((self.weight[ids] * r).sum()) / norm + self.bias if norm > 0 else self.bias

    def score(self, ids: np.ndarray) -> float:
        x = self.slope * self.margin(ids) + self.shift
        return float(1 / (1 + np.exp(-np.clip(x, -50, 50)))) if np.isfinite(x) else 0.0


def _collect(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        raw, offsets = text_arrays(batch.column(0))
        ids = [features(raw[offsets[i]:offsets[i + 1]]).astype("<u4").tobytes() for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), batch.column(1).cast(pa.int64())], ["ids", "label"])


class Scaled(Sequence):
    """Rows' log-count ratios at unit length, made when asked for."""

    def __init__(self, rows: list[np.ndarray], ratio: np.ndarray) -> None:
        self.rows, self.ratio = rows, ratio
        self.norm = [np.sqrt((v * v).sum()) for v in (ratio[r] for r in rows)]

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, i: int) -> np.ndarray:
        v = self.ratio[self.rows[i]]
        return v / self.norm[i] if self.norm[i] > 0 else v


def dual_coordinate_descent(rows: list[np.ndarray], values: Sequence[np.ndarray], y: np.ndarray, cost: np.ndarray, size: int,
                            epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """min 1/2 |w|^2 + sum_i cost_i max(0, 1 - y_i w.x_i)^2, one dual variable at a time; the bias is a constant feature."""
    w, bias, alpha = np.zeros(size), 0.0, np.zeros(len(rows))
    diagonal = 1 / (2 * cost)
    square = np.array([(v * v).sum() + 1 for v in values]) + diagonal
    rng = np.random.RandomState(0)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            gradient = y[i] * (values[i] @ w[rows[i]] + bias) - 1 + diagonal[i] * alpha[i]
            new = max(alpha[i] - gradient / square[i], 0.0)
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[rows[i]] += step * values[i]
                bias += step
                alpha[i] = new
    return w, bias


def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve by Newton's method, with smoothed targets and a little ridge."""
    n1, n0 = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - target) * margin).sum() + 1e-3 * a, (p - target).sum() + 1e-3 * b])
        q = p * (1 - p)
        h = np.array([[(q * margin * margin).sum() + 1e-3, (q * margin).sum()], [(q * margin).sum(), q.sum() + 1e-3]])
        da, db = np.linalg.solve(h, g)
        a, b = a - float(np.clip(da, -2, 2)), b - float(np.clip(db, -2, 2))
    return max(a, 1e-3), b


def fit(sample: list[tuple[bytes, int]], share: float | None) -> Model:
    """The model from (feature ids, label) pairs; share: of label 1 among all training labels."""
    unique = sorted({(bytes(i), int(v)) for i, v in sample})  # bytes of bytes are no copy
    np.random.RandomState(7).shuffle(unique)
    labels = np.array([v for _, v in unique])
    if share is None or len(set(labels.tolist())) < 2:
        return Model(None, None, 0.0, 1.0, 0.0 if share is None else float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    rows = [np.frombuffer(i, "<u4") for i, _ in unique]
    back = np.zeros(len(rows), bool)
    for v in (0, 1):  # every fifth row of each label, so that the calibration sees both
        back[np.flatnonzero(labels == v)[::5]] = True
    if len(set(labels[~back].tolist())) < 2 or len(rows) < 20:
        back[:] = False
    counts = np.full((2, SIZE), SMOOTH)
    for i, r in enumerate(rows):
        if not back[i]:
            counts[labels[i], r] += 1
    ratio = np.log(counts[1] / (labels[~back].sum() + 2 * SMOOTH)) - np.log(counts[0] / ((1 - labels[~back]).sum() + 2 * SMOOTH))
    use = [i for i in range(len(rows)) if not back[i]]
    y = np.where(labels > 0, 1.0, -1.0)
    per = {v: len(use) / (2 * max(1, (y[use] == v).sum())) for v in (1.0, -1.0)}
    used = [rows[i] for i in use]
    w, bias = dual_coordinate_descent(used, Scaled(used, ratio), y[use], COST * np.array([per[v] for v in y[use]]), SIZE)
    model = Model(w, ratio, bias, 1.0, 0.0)
    held = np.flatnonzero(back) if back.any() else np.arange(len(rows))
    model.slope, model.shift = calibrate(np.array([model.margin(rows[i]) for i in held]), y[held])
    own = (y[held] > 0).mean()
    model.shift += float(np.log((share + 1e-6) / (1 - share + 1e-6)) - np.log((own + 1e-6) / (1 - own + 1e-6)))
    model.weight, model.ratio = w.astype(np.float32), ratio.astype(np.float32)
    return model


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> Model:
    sample = label_sample(labels, id_col, label_col, PER_CLASS, FOLDS, HELD)
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (fold(id_col, FOLDS) != HELD))
    share = usable.agg(F.avg((F.col(label_col) > 0).cast("double"))).first()[0]
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where(F.col("text").isNotNull())
    rows = texts.join(F.broadcast(sample), "doc_id").select("text", "label").mapInArrow(_collect, "ids binary, label bigint").toArrow()
    rows = list(zip(rows.column("ids").to_pylist(), rows.column("label").to_pylist()))
    return fit(rows, share)


def _scorer(model: Model, keep: bool, at: int) -> Callable:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            raw, offsets = text_arrays(batch.column(at))
            p = [model.score(features(raw[offsets[i]:offsets[i + 1]])) for i in range(batch.num_rows)]
            if keep:
                yield batch.filter(pa.array([x >= THRESHOLD for x in p], pa.bool_()))
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], ["doc_id", "score"])
    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, score (probability of label 1)."""
    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")).mapInArrow(_scorer(model, False, 1), "doc_id bigint, score double")


def good_quality(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents with a score of at least ``THRESHOLD``, columns as they were."""
    return docs.mapInArrow(_scorer(model, True, docs.columns.index(text_col)), docs.schema)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", (fold("doc_id", FOLDS) == HELD).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
