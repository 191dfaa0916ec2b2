"""Packing into sequences: shortest-pack-first over the length histogram.

1. Tokenize every document (with its end id) and cut it: whole sequences, then one shorter rest. Only
   lengths and checksums leave the pass, unless ids are asked for.
2. Count pieces by length: at most `capacity` rows, however many documents.
3. On that histogram, place lengths longest first. A length goes to the pack with the fewest tokens in
   which it fits, whole groups of equal packs at a time, so the work depends on the number of distinct
   lengths, not of documents. A new pack is opened only if no pack has room. The result is a list of
   patterns (lengths with offsets) and how many sequences follow each.
4. Give each piece its rank among the pieces of its length: counted in salted groups (no length, however
   common, is one task), with the groups' offsets summed over the small table of counts. A pattern slot
   owns a run of ranks, so length and rank name the sequence and the offset.

Defined results: a null or empty text is the end id alone. Rows with equal ids, texts or lengths are each
packed; ties are ranked by doc_id, then start, then checksum. Null doc_ids are kept. Extra columns are not
read. An empty table gives no rows. Sequences are numbered from 0 without gaps.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caretrail.llm.common import Stages, table, text_arrays
from caretrail.llm.tokens import tokenizer

END_ID = 2
CAPACITY = 4096
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def _cutter(tokenizer_path: str, capacity: int, with_ids: bool) -> Callable:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(tokenizer_path)
        for batch in it:
            raw, offsets = text_arrays(batch.column(1))
            for a, b, got, bounds in tok.encode(raw, offsets):
                rows = []
                for i in range(b - a):
                    ids = np.append(got[bounds[i]:bounds[i + 1]], END_ID).astype("<u4")
                    for s in range(0, len(ids), capacity):
                        part = ids[s:s + capacity]
                        rows.append((a + i, s, len(part), zlib.crc32(part), len(ids), part.tobytes() if with_ids else None))
                at, start, length, crc, total, part = zip(*rows)
                out = [batch.column(0).cast(pa.int64()).take(pa.array(at)), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    out.append(pa.array(part, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)
    return run


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Patterns (lengths in order of their offsets) and the number of sequences of each."""
    levels: dict[int, list[tuple[tuple, int]]] = {}  # tokens so far -> groups of equal packs (chain of lengths, count)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            fill = min(levels, default=capacity)
            if fill + length > capacity:
                break
            chain, count = levels[fill].pop()
            used = min(left, count)
            if count > used:
                levels[fill].append((chain, count - used))
            if not levels[fill]:
                del levels[fill]
            levels.setdefault(fill + length, []).append(((chain, length, 1), used))
            left -= used
        if left:
            each = capacity // length
            for times, count in ((each, left // each), (left % each, 1)):
                if times and count:
                    levels.setdefault(times * length, []).append((((), length, times), count))
    out = []
    for fill in sorted(levels, reverse=True):
        for chain, count in levels[fill]:
            lengths = []
            while chain:
                chain, length, times = chain
                lengths += [length] * times
            out.append((lengths[::-1], count))
    return out


def _slots(patterns: list[tuple[list[int], int]]) -> tuple[np.ndarray, ...]:
    """Runs of ranks by length: (length << 40 | first rank), first sequence, offset; sorted by the first."""
    key, first, offset, next_rank, base = [], [], [], {}, 0
    for lengths, count in patterns:
        at = 0
        for length in lengths:
            rank = next_rank.get(length, 0)
            key.append((length << 40) + rank)
            first.append(base - rank)
            offset.append(at)
            next_rank[length] = rank + count
            at += length
        base += count
    order = np.argsort(np.array(key, np.int64))
    return tuple(np.array(x, np.int64)[order] for x in (key, first, offset))


def _placer(slots: tuple[np.ndarray, ...]) -> Callable:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, offset = slots
        for batch in it:
            rank = batch.column("rank").to_numpy()
            k = np.searchsorted(key, (batch.column("length").to_numpy() << 40) + rank, side="right") - 1
            keep = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(first[k] + rank), pa.array(offset[k])], [*keep, "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids)."""
    spark = docs.sparkSession
    stages = Stages(spark, "packing")
    schema = PIECES + (", ids binary" if with_ids else "")
    pieces = stages.keep(docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"))
                         .mapInArrow(_cutter(tokenizer_path, capacity, with_ids), schema), "pieces")
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # `capacity` rows at most
    slots = _slots(shortest_pack_first(histogram, capacity))

    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(salts)))
    counts = salted.groupBy("length", "salt").count()
    before = counts.select("length", "salt", (F.sum("count").over(Window.partitionBy("length").orderBy("salt")) - F.col("count")).alias("before"))
    local = salted.withColumn("local", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32")) - 1)
    ranked = local.join(before, ["length", "salt"]).select(*pieces.columns, (F.col("before") + F.col("local")).cast("bigint").alias("rank"))
    return ranked.mapInArrow(_placer(slots), schema + ", sequence_id bigint, offset bigint")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
