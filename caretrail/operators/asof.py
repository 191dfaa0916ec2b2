"""Nearest-in-time lookup between two tables that share a key (an as-of join in both directions).

For every left row it finds, among right rows with the same key, the latest right time at or before
the left time and the earliest right time at or after it. Equal times count on both sides.

Plan shape. No pairs are formed. Left rows (with all their columns) and the distinct right times are unioned and
shuffled once, by ``(key, piece)``: keys are whole, except for the hot ones, which are cut at quantiles of their own
times (:mod:`caretrail.operators.pieces`), so a key stays spread even if all its rows fall within one hour or one
instant (rows of an instant are cut by a hash of the row). Two windows, one forwards and one backwards in time, run
inside a piece. For hot keys a small table with the first and last right time of each piece, made by one more job over
their right rows, carries the nearest time over the borders. Each side is read once, and no answer is joined back.

Left rows that are equal altogether share a piece; rows with an id never are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caretrail.operators.pieces import find_pieces, local


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def nearest_times(left: DataFrame, right: DataFrame, left_key, right_key, left_ts: str, right_ts: str, *,
                  prev_name: str = "prev_time", next_name: str = "next_time", piece_rows: int | None = None) -> DataFrame:
    """Left rows with a non-NULL key and time, plus ``prev_name`` / ``next_name``.

    ``prev_name``: max right time <= left time; ``next_name``: min right time >= left time; NULL when
    there is none. Left rows with a NULL key or time can match nothing and are not returned.
    Times are timestamps or epoch numbers (both sides alike). ``piece_rows`` as in :func:`find_pieces`, which reads
    both sides' keys and times while the plan is built.
    """
    lk, rk = _keys(left_key), _keys(right_key)
    ts_type = left.schema[left_ts].dataType
    names = [f"_k{i}" for i in range(len(lk))]

    def known(cols):
        cond = F.lit(True)
        for c in cols:
            cond = cond & F.col(c).isNotNull()
        return cond

    rows = left.where(known([*lk, left_ts])).select(
        *[F.col(c).alias(n) for c, n in zip(lk, names)], F.col(left_ts).alias("_t"), F.lit(True).alias("_left"),
        F.xxhash64(*[F.col(c) for c in left.columns]).alias("_x"), F.struct(*[F.col(c) for c in left.columns]).alias("_row"))
    times = right.where(known([*rk, right_ts])).select(
        *[F.col(c).cast(left.schema[k].dataType).alias(n) for c, k, n in zip(rk, lk, names)], F.col(right_ts).cast(ts_type).alias("_t")).distinct()
    times = times.select("*", F.lit(False).alias("_left"), F.lit(0).cast("bigint").alias("_x"), F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"))
    both = rows.unionByName(times)
    pieces = find_pieces(both.select(*names, "_t", "_x"), names, [F.col("_t"), F.col("_x")], piece_rows)
    placed = pieces.assign(both)

    theirs = F.when(~F.col("_left"), F.col("_t"))
    w = Window.partitionBy(*names, "_p")
    range_to_here = Window.unboundedPreceding, Window.currentRow
    placed = (placed.withColumn("_next", F.min(theirs).over(w.orderBy(F.col("_t").desc()).rangeBetween(*range_to_here)))
                    .withColumn("_prev", F.max(theirs).over(w.orderBy("_t").rangeBetween(*range_to_here))).where("_left"))
    if pieces.cuts is not None:
        k = Window.partitionBy(*names).orderBy("_p")
        # every piece of a hot key has a row here, whether or not it holds a right time
        ends = pieces.of_hot_keys(both.select(*names, "_t", "_x", "_left")).groupBy(*names, "_p").agg(F.min(theirs).alias("_lo"), F.max(theirs).alias("_hi"))
        ends = local(ends).coalesce(1)
        border = local(ends.select(F.struct(*names).alias("_bk"), F.col("_p").alias("_bp"),
                                   F.max("_hi").over(k.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
                                   F.min("_lo").over(k.rowsBetween(1, Window.unboundedFollowing)).alias("_after")))
        placed = placed.join(F.broadcast(border), (F.struct(*names) == F.col("_bk")) & (F.col("_p") == F.col("_bp")), "left")
        placed = placed.withColumns({"_prev": F.coalesce("_prev", "_before"), "_next": F.coalesce("_next", "_after")})
        # an instant may lie on a border: a right row at the very time counts on both sides
        placed = placed.withColumns({"_prev": F.when(F.col("_next") == F.col("_t"), F.col("_t")).otherwise(F.col("_prev")),
                                     "_next": F.when(F.col("_prev") == F.col("_t"), F.col("_t")).otherwise(F.col("_next"))})
    return placed.select("_row.*", F.col("_prev").alias(prev_name), F.col("_next").alias(next_name))
