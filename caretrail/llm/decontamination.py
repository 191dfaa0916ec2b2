"""Benchmark decontamination: size-partitioned MinHash containment search, then exact containment.

A test item leaks into a document when at least 75 % of the item's distinct 5-word shingles are among
the document's (words and lower-casing as in near_dedup). Items are short and documents long, so a
Jaccard signature of the document says little; but the minimum of a universal hash over the item's set
is a uniform draw from it, and lies in the document's full set with a probability that is exactly the
containment. So each item is searched by its minima:

* items are partitioned by set size; a partition has its own bands (``PARTITIONS``: bands of r minima,
  more minima a band for longer items, which meet more common phrases by chance);
* a document is a candidate for an item if all minima of one band are among its shingles; with the
  threshold's containment all bands miss with probability 3e-6 at most;
* each candidate is confirmed on the full sets.

The documents are read once and never shuffled. The benchmark side is broadcast only in blocks whose
number of shingles is checked (``BLOCK`` at most on average): a larger benchmark is searched block by block.

Defined results: null, empty or blank texts match nothing on either side. An item or document with fewer
than five words has one shingle, its whole sequence. Repeated items (one id and set) count once; repeated
documents give a row each. Extra columns are ignored by the search and kept by the filter. Null ids are
kept as they are. Empty tables: no matches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caretrail.llm.common import table, text_arrays
from caretrail.llm.hashing import U, distinct, mix, shingles, word_hashes

NUM, DEN = 75, 100
#: (largest set size, bands, minima a band): 0.25^10, (1 - 0.75^2)^16, (1 - 0.75^3)^24
PARTITIONS = ((15, 10, 1), (63, 16, 2), (1 << 62, 24, 3))
BLOCK = 2_000_000


def _item_sets(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        raw, offsets = text_arrays(batch.column(1))
        out = []
        for a, b, h, bounds in word_hashes(raw, offsets):
            out += [distinct(shingles(h[bounds[j]:bounds[j + 1]])).tobytes() for j in range(b - a)]
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(out, pa.binary())], ["item_id", "shingles"])


class Searcher:
    """The minima of one block of items, as sorted arrays that tasks look shingles up in."""

    def __init__(self, items: list[tuple[int | None, bytes]]) -> None:
        self.ids = [i for i, _ in items]
        self.sets = [np.frombuffer(s, U) for _, s in items]
        probes, owner, band, self.rows = [], [], [], np.ones(len(items), np.int64)
        with np.errstate(over="ignore"):
            for k, s in enumerate(self.sets):
                bands, rows = next((b, r) for top, b, r in PARTITIONS if len(s) <= top)
                seeds = mix(np.arange(bands * rows, dtype=U) * U(0x9E3779B97F4A7C15) + U(31)) | U(1)
                draws = s[(mix(s[None, :] * seeds[:, None] + (seeds[:, None] >> U(7)))).argmin(axis=1)]
                self.rows[k] = rows
                probes.append(draws)
                owner.append(np.full(bands * rows, k))
                band.append(np.repeat(np.arange(bands), rows))
        probes, owner, band = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((probes, U), (owner, np.int64), (band, np.int64)))
        order = np.argsort(probes, kind="stable")
        self.keys = np.unique(probes)
        self.owner, self.band = owner[order], band[order]
        self.bounds = np.append(np.searchsorted(probes[order], self.keys), len(probes))
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.keys >> U(44)).astype(np.int64)] = True

    def hits(self, words: np.ndarray) -> list[tuple[int, int]]:
        """(item, shared shingles) of the items that a text with these word hashes contains."""
        sh = shingles(words)
        maybe = sh[self.seen[(sh >> U(44)).astype(np.int64)]]
        if not len(maybe) or not len(self.keys):
            return []
        maybe = distinct(maybe)
        at = np.searchsorted(self.keys, maybe)
        at[at == len(self.keys)] = 0
        at = at[self.keys[at] == maybe]
        if not len(at):
            return []
        lens = self.bounds[at + 1] - self.bounds[at]
        flat = np.repeat(self.bounds[at] - np.concatenate(([0], np.cumsum(lens)[:-1])), lens) + np.arange(lens.sum())
        bands, count = np.unique(self.owner[flat] * 64 + self.band[flat], return_counts=True)
        found = np.unique((bands // 64)[count >= self.rows[bands // 64]])
        if not len(found):
            return []
        whole = distinct(sh)
        out = []
        for k in found.tolist():
            s = self.sets[k]
            pos = np.searchsorted(whole, s)
            pos[pos == len(whole)] = 0
            shared = int((whole[pos] == s).sum())
            if DEN * shared >= NUM * len(s):
                out.append((k, shared))
        return out


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[Searcher]:
    """Searchers over the benchmark, each of a checked size."""
    items = (benchmark.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"))
             .mapInArrow(_item_sets, "item_id bigint, shingles binary").where(F.length("shingles") > 0).distinct())
    total = items.agg(F.sum(F.length("shingles"))).first()[0] or 0
    blocks = max(1, -(-total // (8 * BLOCK)))
    for k in range(blocks if total else 0):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("shingles"), F.lit(blocks)) == k)
        yield Searcher([(r[0], bytes(r[1])) for r in part.orderBy("item_id", "shingles").collect()])


def _scan(search: Searcher, text: pa.Array) -> Iterator[list[tuple[int, int]]]:
    raw, offsets = text_arrays(text)
    for a, b, h, bounds in word_hashes(raw, offsets):
        for i in range(b - a):
            yield search.hits(h[bounds[i]:bounds[i + 1]])


def _matches(search: Searcher) -> Callable:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            rows = [(i, search.ids[k], len(search.sets[k]), n) for i, got in enumerate(_scan(search, batch.column(1))) for k, n in got]
            if rows:
                at, ids, sizes, shared = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).cast(pa.int64()).take(pa.array(at)), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(shared, pa.int64()),
                     pa.array([s / n for s, n in zip(shared, sizes)])], ["doc_id", "item_id", "n_shingles", "n_shared", "containment"])
    return run


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, n_shingles of the item, n_shared, containment) for every leak."""
    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id bigint, item_id bigint, n_shingles bigint, n_shared bigint, containment double"
    out = None
    for search in _blocks(benchmark, item_col, item_text):
        part = narrow.mapInArrow(_matches(search), schema)
        out = part if out is None else out.union(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents that contain no item, all columns as they were."""
    names = docs.columns
    at = names.index(text_col)
    for search in _blocks(benchmark, item_col, item_text):
        def run(it: Iterator[pa.RecordBatch], search: Searcher = search) -> Iterator[pa.RecordBatch]:
            for batch in it:
                yield batch.filter(pa.array([not got for got in _scan(search, batch.column(at))], pa.bool_()))
        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH texts AS (SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
w AS (SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x20\x09-\x0D]+') AS ws FROM texts),
s AS (SELECT DISTINCT side, id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 4], ' ') END AS sh
      FROM (SELECT side, id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT id, count(*) AS n FROM s WHERE side = 1 GROUP BY id),
p AS (SELECT d.id AS doc_id, b.id AS item_id, count(*) AS c FROM s d JOIN s b ON d.sh = b.sh AND d.side = 0 AND b.side = 1 GROUP BY ALL)
SELECT doc_id, item_id, n AS n_shingles, c AS n_shared, c / n AS containment
FROM p JOIN n ON n.id = item_id WHERE 100 * c >= 75 * n
"""
