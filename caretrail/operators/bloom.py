"""Bloom filters over a column, made and applied with built-in functions.

Used to thin out large tables before joins whose other side is known to ask for a small part of them: a filter has a bit
array of about ten bits a value, is held by the plan as one row and joined map-side, so the large table is read once
and what can't match is never shuffled. False positives only stay in; the joins decide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASHES = 4
BITS_PER_VALUE = 10
#: 16 MB; a filter that needed more would be broadcast for little, so none is made
MOST_BITS = 1 << 27


def _places(value: Column, bits: int) -> list[Column]:
    return [F.xxhash64(value, F.lit(seed)).bitwiseAND(F.lit(bits - 1)) for seed in range(HASHES)]


def bloom_filter(values: DataFrame, column: str) -> DataFrame | None:
    """The filter of the values of a column (NULLs count as no value), one row, or None if it would be too large."""
    known = values.select(F.col(column).alias("v")).where("v IS NOT NULL")
    n = known.agg(F.approx_count_distinct("v")).first()[0]
    bits = 1 << max(10, (n * BITS_PER_VALUE - 1).bit_length())
    if bits > MOST_BITS:
        return None
    places = known.select(F.explode(F.array(*_places(F.col("v"), bits))).alias("at"))
    words = places.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("at").bitwiseAND(F.lit(63)).cast("int"))).alias("mask"))
    got = words.toArrow()  # at most bits / 64 rows
    array = np.zeros(bits // 64, np.int64)
    array[got.column("word").to_numpy()] = got.column("mask").to_numpy()
    return values.sparkSession.createDataFrame(pa.table({"_one": pa.array([1], pa.int32()), "_words": pa.array([array])}))


def may_hold(df: DataFrame, column: str | Column, bloom: DataFrame | None) -> DataFrame:
    """The rows of ``df`` whose value may be in the filter; rows with a NULL value go. Without a filter all rows stay."""
    if bloom is None:
        return df
    bits = 64 * len(bloom.first()["_words"])
    value = F.col(column) if isinstance(column, str) else column
    inside = value.isNotNull()
    for at in _places(value, bits):
        word = F.get(F.col("_words"), F.shiftright(at, 6).cast("int"))
        inside = inside & (F.call_function("shiftright", word, at.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1).cast("bigint")) == 1)
    return df.withColumn("_one", F.lit(1)).join(F.broadcast(bloom), "_one").where(inside).drop("_one", "_words")
