"""Language identification by error-correcting output codes.

Every language has a codeword; each bit of it is predicted by a binary logistic classifier over hashed
byte n-grams (2 to 4 bytes, A-Z lower-cased). Decoding weighs each bit's logistic loss by how reliable the
bit was on documents kept back from training, and picks the codeword with the least total loss. The score
is the softmax share of that codeword; a text is flagged ambiguous if the runner-up comes within
``AMBIGUOUS``.

Codes: with up to 7 languages all 2^(L-1) - 1 distinct splits; beyond, 10 log2(L) random splits, the set
with the largest smallest distance among 50 draws.

Training reads a bounded sample: at most ``PER_LANGUAGE`` documents a language, those whose id hashes
lowest, out of rows whose fold is not the held-out one; identical feature vectors count once. The sample
comes to the driver as Arrow, in the narrowest integers that hold it, and stays so. Prediction uses the
whole text of every document and nothing but the text.

Defined results: a null text, or one without a letter (Unicode), is `und` with score 0 and ambiguous. A
single known language always wins; with no labelled row at all every text is `und`. Ties go to the
language first in alphabetical order. Repeated rows are each predicted; null doc_ids are predicted and are
in no fold (held_out null). Extra columns are ignored by prediction and kept by the filter. Empty tables
give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caretrail.llm.common import fold, table, text_arrays
from caretrail.llm.hashing import LOWER

BITS = 16
BUCKET = "<u2"
GRAMS = (2, 3, 4)
PER_LANGUAGE = 600
EPOCHS, RATE = 12, 0.5
AMBIGUOUS = 0.1
REJECT = 0.4
FOLDS, HELD = 3, 1
ALPHA = np.zeros(256, bool)
ALPHA[65:91] = ALPHA[97:123] = True


def grams(raw: np.ndarray) -> np.ndarray:
    """Bucket of every byte n-gram of a text."""
    low = LOWER[raw].astype(np.uint32)
    out = []
    for n in GRAMS:
        if len(low) < n:
            continue
        m = len(low) - n + 1
        key = low[:m].copy()
        for j in range(1, n):
            key |= low[j:j + m] << np.uint32(8 * j)
        out.append((key * np.uint32(0x9E3779B1) + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) >> np.uint32(32 - BITS))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def has_letter(raw: np.ndarray) -> bool:
    if ALPHA[raw].any():
        return True
    return bool((raw > 127).any()) and any(c.isalpha() for c in raw.tobytes().decode())


def codewords(n: int) -> np.ndarray:
    """n rows of +1 / -1."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 7:
        splits = np.arange(1, 1 << (n - 1))
        return np.where((splits[None, :] >> np.arange(n)[:, None]) & 1, 1.0, -1.0)
    rng = np.random.RandomState(n)
    best, far = None, -1
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], (n, int(np.ceil(10 * np.log2(n)))))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        gap = min(int((a != b).sum()) for i, a in enumerate(code) for b in code[:i])
        if gap > far:
            best, far = code, gap
    return best


class Model:
    def __init__(self, languages: list[str], code: np.ndarray, weights: np.ndarray, bias: np.ndarray, trust: np.ndarray) -> None:
        self.languages, self.code, self.weights, self.bias, self.trust = languages, code, weights, bias, trust

    def margins(self, raw: np.ndarray) -> np.ndarray:
        ids = grams(raw)
        z = np.zeros(self.weights.shape[1])
        for i in range(0, len(ids), 1 << 16):
            z += self.weights[ids[i:i + (1 << 16)]].sum(axis=0, dtype=np.float64)
        return z * (SCALE / max(len(ids), 1)) + self.bias

    def decode(self, z: np.ndarray) -> tuple[int, float, bool]:
        loss = (self.trust * np.logaddexp(0, -self.code * z)).sum(axis=1)
        p = np.exp(loss.min() - loss)
        p /= p.sum()
        order = np.argsort(-p, kind="stable")
        return int(order[0]), float(p[order[0]]), len(p) > 1 and float(p[order[0]] - p[order[1]]) < AMBIGUOUS

    def predict(self, raw: np.ndarray) -> tuple[str, float, bool]:
        if not self.languages or not has_letter(raw):
            return "und", 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        k, p, unsure = self.decode(self.margins(raw))
        return self.languages[k], p, unsure


#: mean n-gram weight times this is a bit's margin
SCALE = 20.0


def _features(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        raw, offsets = text_arrays(batch.column(1))
        ids, counts = [], []
        for i in range(batch.num_rows):
            u, c = np.unique(grams(raw[offsets[i]:offsets[i + 1]]), return_counts=True)
            ids.append(u.astype(BUCKET).tobytes())
            counts.append(c.astype(np.min_scalar_type(c.max(initial=0))).tobytes())  # its length tells the type
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2).cast(pa.int64()), pa.array(ids, pa.binary()), pa.array(counts, pa.binary())],
                                         ["lang", "rank", "ids", "counts"])


def fit(rows: list[tuple[str, bytes, bytes]]) -> Model:
    """Train the bits on (language, n-gram buckets, counts); every fifth document is kept back to weigh bits.
    A document's weights are made from its counts each time, so that the sample stays as small as it came."""
    languages = sorted({r[0] for r in rows})
    code = codewords(len(languages))
    n_bits = code.shape[1]
    weights, bias, grad = np.zeros((1 << BITS, n_bits)), np.zeros(n_bits), np.full((1 << BITS, n_bits), 1e-8)
    seen, data = set(), []
    for lang, ids, counts in rows:
        if (ids, counts) not in seen and ids:
            seen.add((ids, counts))
            buckets = np.frombuffer(ids, BUCKET)
            c = np.frombuffer(counts, f"<u{len(counts) // len(buckets)}")
            data.append((languages.index(lang), buckets, c, SCALE / c.sum(dtype=float)))
    train, back = [d for i, d in enumerate(data) if i % 5], data[::5]
    rng = np.random.RandomState(0)
    for _ in range(EPOCHS if len(languages) > 1 else 0):
        for i in rng.permutation(len(train)):
            k, ids, c, scale = train[i]
            x, y = c * scale, code[k]
            g = -y / (1 + np.exp(np.clip(y * (x @ weights[ids] + bias), -30, 30)))
            step = x[:, None] * g + 1e-5 * weights[ids]
            grad[ids] += step * step
            weights[ids] -= RATE * step / np.sqrt(grad[ids])
            bias -= 0.01 * g
    right = np.ones(n_bits)
    for k, ids, c, scale in back:
        right += np.sign((c * scale) @ weights[ids] + bias) == code[k]
    accuracy = np.clip(right / (len(back) + 1.5), 0.51, 0.999)
    trust = np.log(accuracy / (1 - accuracy))
    return Model(languages, code, weights.astype(np.float32), bias, trust / trust.mean())


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    known = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")) \
        .where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("doc_id", FOLDS) != HELD))
    sizes = {r[0]: r[1] for r in known.groupBy("lang").count().collect()}  # one row a language
    if not sizes:
        return fit([])
    # a hash threshold for each language leaves about twice the bound; the lowest hashes of these are used
    rank = F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(1 << 30))
    limit = F.create_map(*(x for k, n in sizes.items() for x in (F.lit(k), F.lit(int(min(1.0, 1.3 * PER_LANGUAGE / n + 20 / n) * (1 << 30))))))
    picked = known.withColumn("rank", rank).where(F.col("rank") < limit[F.col("lang")])
    rows = picked.select("lang", "text", "rank").mapInArrow(_features, "lang string, rank bigint, ids binary, counts binary").toArrow()
    rows = sorted(zip(*(rows.column(c).to_pylist() for c in ("lang", "rank", "ids", "counts"))), key=lambda r: r[:3])
    taken, used = [], dict.fromkeys(sizes, 0)
    for lang, _, ids, counts in rows:
        if used[lang] < PER_LANGUAGE:
            used[lang] += 1
            taken.append((lang, ids, counts))
    del rows
    return fit(taken)


def _predictor(model: Model, keep: bool, at: int) -> Callable:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            raw, offsets = text_arrays(batch.column(at))
            got = [model.predict(raw[offsets[i]:offsets[i + 1]]) for i in range(batch.num_rows)]
            if keep:
                yield batch.filter(pa.array([lang != "und" and p >= REJECT for lang, p, _ in got], pa.bool_()))
            else:
                lang, p, unsure = zip(*got) if got else ((), (), ())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(p, pa.float64()), pa.array(unsure, pa.bool_())],
                                                 ["doc_id", "lang_pred", "score", "ambiguous"])
    return run


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, lang_pred, score, ambiguous."""
    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")).mapInArrow(
        _predictor(model, False, 1), "doc_id bigint, lang_pred string, score double, ambiguous boolean")


def known_language(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents that have a letter and whose language is decided (score at least ``REJECT``), columns as they were."""
    return docs.mapInArrow(_predictor(model, True, docs.columns.index(text_col)), docs.schema)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = identify(docs, train(docs))
    return out.select("doc_id", (fold("doc_id", FOLDS) == HELD).alias("held_out"), "lang_pred", "score", "ambiguous")
