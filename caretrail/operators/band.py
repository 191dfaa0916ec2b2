"""Band join: pairs with equal keys whose right time lies within a length of time after the left one.

Time is cut into buckets as long as the band. A right row is in one bucket, a left row meets its own bucket and the
next, so every pair of the band has exactly one (key, bucket) cell, and only rows of two neighbouring buckets are ever
compared. A hot cell is dealt out: its left rows into ``a`` blocks and its right rows into ``b``, by a hash of the row; a
left row goes to its block's ``b`` cells and a right row to its block's ``a`` cells, so each pair still meets once and no
task gets more than about ``block_rows`` rows of either side. The table of hot cells has at most one row for every
``block_rows`` input rows; it is held by the plan and joined map-side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretrail.operators.pieces import LEAST_ROWS, PIECES_PER_PARTITION, local


def _bucket(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_timestamp(ts) / F.lit(seconds)).cast("bigint")


def band_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_ts: str, right_ts: str, seconds: int, *,
              within: Callable[[Column, Column], Column], block_rows: int | None = None) -> DataFrame:
    """Pairs of rows with equal keys for which ``within(left time, right time)`` holds; it must imply
    ``0 <= right - left <= seconds``. Left columns keep their names, right ones are under the alias ``_p``. Rows with
    a NULL key or time pair with nothing. Cells are counted (keys and times of both sides) while the plan is built."""
    l0 = left.where(F.col(left_key).isNotNull() & F.col(left_ts).isNotNull())
    r0 = right.where(F.col(right_key).isNotNull() & F.col(right_ts).isNotNull())
    own = _bucket(F.col(left_ts), seconds)
    lrows = l0.withColumn("_bucket", F.explode(F.array(own, own + 1)))
    rrows = r0.select(F.struct(*[F.col(c) for c in right.columns]).alias("_r"), F.col(right_key).alias("_rkey"), F.col(right_ts).alias("_rts"),
                      _bucket(F.col(right_ts), seconds).alias("_rbucket"))
    key_type = left.schema[left_key].dataType

    counted = (lrows.select(F.col(left_key).alias("_k"), F.col("_bucket").alias("_b"), F.lit(1).alias("_nl"), F.lit(0).alias("_nr"))
               .unionByName(rrows.select(F.col("_rkey").cast(key_type).alias("_k"), F.col("_rbucket").alias("_b"), F.lit(0).alias("_nl"), F.lit(1).alias("_nr")))
               .groupBy("_k", "_b").agg(F.sum("_nl").alias("_nl"), F.sum("_nr").alias("_nr")))
    if block_rows is None:
        partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        block_rows = max(LEAST_ROWS, (l0.count() * 2 + r0.count()) // (PIECES_PER_PARTITION * partitions))
    hot = local(counted.where((F.col("_nl") > block_rows) | (F.col("_nr") > block_rows)).select(
        "_k", "_b", F.ceil(F.greatest(F.col("_nl") / block_rows, F.lit(1))).cast("int").alias("_na"),
        F.ceil(F.greatest(F.col("_nr") / block_rows, F.lit(1))).cast("int").alias("_nb")))
    condition = [F.col(left_key) == F.col("_rkey"), F.col("_bucket") == F.col("_rbucket")]
    if hot.isEmpty():
        lcells, rcells = lrows, rrows
    else:
        few = F.broadcast(hot)
        lcells = lrows.join(few, (F.col(left_key) == F.col("_k")) & (F.col("_bucket") == F.col("_b")), "left")
        lcells = (lcells.withColumn("_i", F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.coalesce("_na", F.lit(1))))
                  .withColumn("_j", F.explode(F.sequence(F.lit(0), F.coalesce("_nb", F.lit(1)) - 1))).drop("_k", "_b", "_na", "_nb"))
        rcells = rrows.join(few, (F.col("_rkey").cast(key_type) == F.col("_k")) & (F.col("_rbucket") == F.col("_b")), "left")
        rcells = (rcells.withColumn("_rj", F.pmod(F.xxhash64("_r"), F.coalesce("_nb", F.lit(1))))
                  .withColumn("_ri", F.explode(F.sequence(F.lit(0), F.coalesce("_na", F.lit(1)) - 1))).drop("_k", "_b", "_na", "_nb"))
        condition += [F.col("_i") == F.col("_ri"), F.col("_j") == F.col("_rj")]
    for part in (*condition[1:], within(F.col(left_ts), F.col("_rts"))):
        condition[0] = condition[0] & part
    pairs = lcells.join(rcells, condition[0])
    return pairs.select(*[F.col(c) for c in left.columns], F.col("_r").alias("_p"))
