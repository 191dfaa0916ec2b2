"""Pieces of hot keys: where to cut the keys that hold many rows, so that no task gets one of them whole.

``Window.partitionBy(key)`` and a join on ``key`` send all rows of a key to one task. Most keys are small and want just
that. The few large ones are found in one bounded sample of (hash of the key, order), like the one that Spark's range
partitioner draws, and get cut points in their order: quantiles of the sampled rows, so a piece has about ``rows`` rows
however the times are spread. Operators then partition by ``(key, piece)``, and carry their state over the borders of
pieces with one small table that has a row a piece.

The sample decides only where rows go, never a result. It holds at most ``SAMPLE_ROWS`` rows for each piece that
fits into the input, about 100 times the number of shuffle partitions altogether.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: sampled rows that a full piece should have
SAMPLE_ROWS = 50
#: pieces that the input is cut into at most, per shuffle partition; and the fewest rows worth a cut
PIECES_PER_PARTITION = 2
LEAST_ROWS = 1000


def local(df: DataFrame) -> DataFrame:
    """A small table held by the plan itself: evaluated once, read without a scan. Types survive exactly."""
    return df.sparkSession.createDataFrame(df.toArrow(), df.schema)


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


@dataclass
class Pieces:
    """The hot keys' hashes (``_h``) with their cut points (``_cuts``), or no table if no key is hot."""
    keys: list[str]
    order: list[Column]
    cuts: DataFrame | None = None
    most: int = 0

    def assign(self, df: DataFrame) -> DataFrame:
        """``df`` with its piece ``_p``: NULL for keys that aren't cut, else the number of cut points at or before the row."""
        if self.cuts is None:
            return df.withColumn("_p", F.lit(None).cast("int"))
        at = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(self.order)])
        steps = F.array(*[F.lit(1 << b) for b in range(max(self.most.bit_length() - 1, 0), -1, -1)])
        # binary search: the largest position whose cut point isn't beyond the row
        place = F.aggregate(steps, F.lit(0), lambda p, s: F.when(F.get(F.col("_cuts"), p + s - 1) <= at, p + s).otherwise(p))
        return (df.withColumn("_h", key_hash(self.keys)).join(F.broadcast(self.cuts), "_h", "left")
                .withColumn("_p", F.when(F.col("_cuts").isNotNull(), place).cast("int")).drop("_h", "_cuts"))

    def of_hot_keys(self, df: DataFrame) -> DataFrame:
        """The rows of hot keys only, with their piece."""
        return self.assign(df.withColumn("_h", key_hash(self.keys)).join(F.broadcast(self.cuts.select("_h")), "_h", "left_semi").drop("_h"))


def find_pieces(df: DataFrame, keys: Sequence[str], order: Sequence[Column], rows: int | None = None) -> Pieces:
    """Cut points of the keys of ``df`` that hold more than ``rows`` rows (default: the input in about twice as many
    pieces as there are shuffle partitions). Reads the keys and the order columns once, and counts the rows."""
    spark = df.sparkSession
    keys = list(keys)
    n = df.count()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows or max(LEAST_ROWS, n // (PIECES_PER_PARTITION * partitions))
    none = Pieces(keys, list(order))
    if n <= rows:
        return none
    rate = min(1.0, SAMPLE_ROWS / rows)
    at = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    seen = df.select(key_hash(keys).alias("_h"), at.alias("_at"))
    if rate < 1:
        seen = seen.sample(rate, 7)
    step = max(1, round(rows * rate))
    # gathered per key, but only of the sample, whose size is bounded
    held = seen.groupBy("_h").agg(F.sort_array(F.collect_list("_at")).alias("_all")).where(F.size("_all") > step)
    points = F.transform(F.sequence(F.lit(step), F.size("_all") - 1, F.lit(step)), lambda i: F.get(F.col("_all"), i))
    held = held.select("_h", F.array_distinct(points).alias("_cuts"))
    got = held.toArrow()
    if not got.num_rows:
        return none
    return Pieces(keys, list(order), spark.createDataFrame(got, held.schema), max(len(x) for x in got.column("_cuts")))
