"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation estimates how far
each can be trusted, and the posterior probability of good quality replaces an all-must-pass filter.

1. One pass over whole texts gives counts for each document (numpy on Arrow batches).
2. Each rule turns counts into a vote: good, bad or none (``RULES``, plain Column expressions).
3. Documents that pass the base rules are counted by vote pattern: at most 3^7 rows, however large the
   corpus. EM runs on these counts: a two-class model with, for each rule and class, the accuracy of its
   votes. It starts from "any bad vote is suspicious"; a few pseudo-votes keep rare rules sensible.
4. posterior = P(good | the document's votes); kept = not base_failed and posterior >= 0.5.

Words are `[^\\x20\\x09-\\x0D]+`. Defined results: null, empty or blank texts have no words, fail the base
rules, and have the posterior of their votes. Ties and repeated rows are scored alike, each on its own
row. Extra columns are not read. An empty table gives no rows. Very long texts (over ``LONG`` bytes) are
counted by a plain pass with the same results.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caretrail.llm.common import Stages, slices, table, text_arrays
from caretrail.llm.hashing import COEF, KEEP, SPACE, U, mix, running, span_hash, word_spans

LONG = 4 << 20
#: words of a window; variety is that of consecutive windows over the whole text, so long texts are judged like short ones
WINDOW = 1000
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_upper", "n_letters", "n_marks", "n_window_words")
SYMBOLS = b"#*$%&|<>"
SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
UPPER = np.isin(np.arange(256), list(range(65, 91)))
LETTER = UPPER | np.isin(np.arange(256), list(range(97, 123)))
MARK = np.isin(np.arange(256), list(b"!?"))


#: the most that a rule may vote bad on good documents. The thresholds lie well beyond ordinary prose; without
#: this bound one rule that fires alone could be explained either way, and EM would drift to "all are good"
FALSE_ALARM = 0.01
#: pseudo-votes [class bad, good][vote bad, good]
PRIOR_VOTES = np.array([[5.0, 5.0], [0.5, 9.5]])


def plain_counts(text: str | None) -> tuple[int, ...]:
    """The counts of one text, straightforwardly."""
    data = (text or "").encode()
    words = data.split()
    grams = Counter(zip(words, words[1:], words[2:]))
    covered, end = 0, 0
    for i, g in enumerate(zip(words, words[1:], words[2:])):
        if grams[g] > 1:
            covered += i + 3 - max(end, i)
            end = i + 3
    lines = [x for x in data.split(b"\n") if x.split()]
    count = lambda lut: int(lut[np.frombuffer(data, np.uint8)].sum())
    return (len(words), sum(len(w.decode()) for w in words), count(SYMBOL), len(lines) - len(set(lines)), covered, len(lines), len(set(words)),
            count(UPPER), count(LETTER), count(MARK), sum(len(set(words[i:i + WINDOW])) for i in range(0, len(words), WINDOW)))


def _repeats(key: np.ndarray) -> np.ndarray:
    """Which entries occur twice or more."""
    order = np.argsort(key)
    s = key[order]
    same = s[1:] == s[:-1]
    flag = np.zeros(len(key), bool)
    flag[order[1:]] |= same
    flag[order[:-1]] |= same
    return flag


def _distinct_by(doc: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
    """Distinct keys of each document."""
    _, first = np.unique(mix(key + doc.astype(U) * U(0x9E3779B97F4A7C15)), return_index=True)
    return np.bincount(doc[first], minlength=n)


def counts(raw: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of COUNTS for runs of documents, in order."""
    with np.errstate(over="ignore"):
        for a, b in slices(offsets):
            part, starts = raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
            n = b - a
            if len(part) > LONG:
                yield np.array([plain_counts(part.tobytes().decode())])
                continue
            sums = running(part, KEEP)
            ws, we = word_spans(part, starts[:-1])
            doc = np.searchsorted(starts, ws, side="right") - 1
            words = span_hash(sums, ws, we)
            out = np.zeros((n, len(COUNTS)), np.int64)

            def total(lut: np.ndarray) -> np.ndarray:
                run = np.concatenate(([0], np.cumsum(lut[part])))
                return run[starts[1:]] - run[starts[:-1]]

            n_words = np.bincount(doc, minlength=n)
            out[:, 0] = n_words
            out[:, 1] = total(~SPACE & ((np.arange(256) & 0xC0) != 0x80))
            out[:, 2], out[:, 7], out[:, 8], out[:, 9] = total(SYMBOL), total(UPPER), total(LETTER), total(MARK)
            # lines: between newlines and document borders; only those with a word count
            cuts = np.unique(np.concatenate((starts, np.flatnonzero(part == 10) + 1)))
            line = np.unique(np.searchsorted(cuts, ws, side="right") - 1)
            ls, le = cuts[line], cuts[line + 1] if len(line) else cuts[line]
            le = le - ((le > ls) & (part[np.maximum(le - 1, 0)] == 10)) if len(line) else le
            ldoc = np.searchsorted(starts, ls, side="right") - 1
            out[:, 5] = np.bincount(ldoc, minlength=n)
            out[:, 3] = out[:, 5] - _distinct_by(ldoc, span_hash(sums, ls, le, 7), n)
            out[:, 6] = _distinct_by(doc, words, n)
            window = (np.arange(len(words)) - np.searchsorted(doc, np.arange(n))[doc]) // WINDOW
            out[:, 10] = _distinct_by(doc, mix(words + window.astype(U) * COEF[0]), n)
            if len(words) > 2:
                gram = mix(words[:-2] * COEF[0] + words[1:-1] * COEF[1] + words[2:] * COEF[2] + doc[:-2].astype(U) * COEF[3])
                within = doc[:-2] == doc[2:]
                hit = np.zeros(len(gram), bool)
                hit[within] = _repeats(gram[within])
                cover = np.zeros(len(words), bool)
                for j in range(3):
                    cover[j:len(words) - 2 + j] |= hit
                out[:, 4] = np.bincount(doc[cover], minlength=n)
            yield out


def _count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        raw, offsets = text_arrays(batch.column(1))
        rows = np.concatenate([*counts(raw, offsets), np.zeros((0, len(COUNTS)), np.int64)])
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(rows[:, i]) for i in range(len(COUNTS)))], ["doc_id", *COUNTS])


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")).mapInArrow(
        _count, "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS))


def _vote(value: Column, good: Column, bad: Column) -> Column:
    """1 good, -1 bad, 0 no vote (also where the value is undefined)."""
    return F.when(value.isNull(), 0).when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """Each rule votes bad only well beyond what ordinary prose shows, good well within it."""
    n = F.when(F.col("n_words") > 0, F.col("n_words"))
    per_word = lambda c: F.col(c) / n
    lines = F.when(F.col("n_lines") > 0, F.col("n_lines"))
    symbols, repeat, marks, length, variety = (per_word(c) for c in ("n_symbols", "n_repeat_words", "n_marks", "word_chars", "n_window_words"))
    dup = F.col("n_dup_lines") / lines
    upper = F.col("n_upper") / F.when(F.col("n_letters") > 0, F.col("n_letters"))
    return {
        "symbols": _vote(symbols, symbols < 0.02, symbols > 0.1),
        "repetition": _vote(repeat, repeat < 0.1, repeat > 0.3),
        "dup_lines": _vote(dup, (dup == 0) & (F.col("n_lines") > 2), dup > 0.3),
        "capitals": _vote(upper, upper < 0.15, upper > 0.4),
        "marks": _vote(marks, marks < 0.05, marks > 0.25),
        "word_length": _vote(length, length.between(3, 10), (length < 2) | (length > 15)),
        "variety": _vote(variety, variety > 0.35, (n >= 50) & (variety < 0.15)),
    }


def fit(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 100) -> tuple[float, np.ndarray]:
    """EM over vote patterns and their counts: (P(good), log P(vote | class, the rule votes) as
    [class, rule, vote is good]). An abstention says nothing about the class. PRIOR_VOTES keep a rule that
    seldom votes near "good documents get good votes, bad ones either"."""
    if not patterns:
        return 0.5, np.log(np.full((2, 0, 2), 0.5))
    votes = np.array([p for p, _ in patterns])
    weight = np.array([c for _, c in patterns], float)
    one_hot = (votes[:, :, None] == np.array([-1, 1])).astype(float)
    good = np.where((votes < 0).any(axis=1), 0.05, 0.95)
    for _ in range(rounds):
        prior = (weight @ good + 1) / (weight.sum() + 2)
        seen = np.stack([np.einsum("p,prv->rv", weight * r, one_hot) for r in (1 - good, good)]) + PRIOR_VOTES[:, None, :]
        p = seen / seen.sum(axis=2, keepdims=True)
        p[1, :, 0] = np.minimum(p[1, :, 0], FALSE_ALARM)
        p[1, :, 1] = 1 - p[1, :, 0]
        logs = np.log(p)
        score = np.einsum("crv,prv->pc", logs, one_hot) + np.log([1 - prior, prior])
        good = 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -500, 500)))
    return float(prior), logs


def vote_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, the counts, base_failed, the votes (vote_<rule>), posterior, kept."""
    stages = Stages(docs.sparkSession, "rules")
    named = rules()
    table_ = stages.keep(text_counts(docs, id_col, text_col).withColumns({f"vote_{k}": v for k, v in named.items()}), "counts")
    votes = [f"vote_{k}" for k in named]
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    # 3^7 rows at most; the base rules settle the documents that fail them
    patterns = [(tuple(r[:-1]), r[-1]) for r in table_.where(~failed).groupBy(*votes).count().orderBy(*votes).collect()]
    prior, logs = fit(patterns)
    odds = F.lit(float(np.log(prior / (1 - prior))))
    if patterns:
        for i, v in enumerate(votes):
            bad, good = (logs[1, i] - logs[0, i]).tolist()
            odds = odds + F.when(F.col(v) < 0, bad).when(F.col(v) > 0, good).otherwise(0.0)
    out = table_.withColumn("base_failed", failed).withColumn("posterior", 1 / (1 + F.exp(-odds)))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = vote_quality(table(spark, sf_dir, "documents"))
    return out.select("doc_id", *COUNTS[:5], "base_failed", "kept", "posterior")
