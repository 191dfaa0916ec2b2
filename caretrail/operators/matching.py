"""One-to-one nearest-in-time matching of calls to tickets (U17).

Semantics of the call report's match:

1. pair every (filtered) call with every ticket of the same phone, ``diff = |call time - ticket time|``;
2. per call keep the pairs with the minimum diff (ties kept);
3. per ticket id keep the single closest call (``row_number() = 1``, ties broken by call id);
4. keep pairs with ``diff < tolerance`` (10000 seconds).

Plan shape, without forming pairs. Step 4 can move before step 3: a call whose best diff is
``>= tolerance`` can only win tickets that are cut anyway. Steps 1-2 are an as-of lookup
(:func:`caretrail.operators.asof.nearest_times`): each call gets its nearest earlier and later
ticket time, hence its best diff and the one or two ticket times at that diff. Step 3 groups calls by
``(phone, target ticket time)`` and keeps ``min(struct(diff, call id))`` with map-side partial
aggregation; tickets then join that one-row-per-target table on ``(phone, time)``, so every ticket
at the target time (ties, copies) gets the same winning call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretrail.operators.asof import nearest_times

DEFAULT_TOLERANCE = 10000


def best_call_per_ticket_time(calls: DataFrame, tickets: DataFrame, *, call_id: str, call_key: str,
                              call_time: str, ticket_key: str, ticket_time: str,
                              tolerance: int = DEFAULT_TOLERANCE, piece_rows: int | None = None) -> DataFrame:
    """One row per (phone, ticket time) that is some call's nearest ticket time within tolerance:
    ``_key, _target, _call, _diff`` where ``_call`` is the closest such call (smallest call id on ties)."""
    near = nearest_times(calls.select(call_id, call_key, call_time),
                         tickets.select(ticket_key, ticket_time),
                         call_key, ticket_key, call_time, ticket_time,
                         prev_name="_before", next_name="_after", piece_rows=piece_rows)
    d_prev = F.col(call_time) - F.col("_before")
    d_next = F.col("_after") - F.col(call_time)
    near = near.withColumn("_best", F.least(d_prev, d_next)).where(F.col("_best") < F.lit(tolerance))
    targets = F.array_distinct(F.filter(
        F.array(F.when(d_prev == F.col("_best"), F.col("_before")),
                F.when(d_next == F.col("_best"), F.col("_after"))),
        lambda x: x.isNotNull()))
    cand = near.select(F.col(call_key).alias("_key"), F.explode(targets).alias("_target"),
                       F.col("_best").alias("_diff"), F.col(call_id).alias("_call"))
    best = cand.groupBy("_key", "_target").agg(F.min(F.struct("_diff", "_call")).alias("_m"))
    return best.select("_key", "_target", F.col("_m._call").alias("_call"), F.col("_m._diff").alias("_diff"))


def match_calls_to_tickets(calls: DataFrame, tickets: DataFrame, *, call_id: str, call_key: str,
                           call_time: str, ticket_key: str, ticket_time: str,
                           tolerance: int = DEFAULT_TOLERANCE, out_call: str = "aircall_id",
                           out_diff: str = "dif_between_call_and_ticket",
                           piece_rows: int | None = None) -> DataFrame:
    """Ticket rows that won a call, with ``out_call`` and ``out_diff`` appended.

    Every ticket row at a winning (phone, time) is returned, so copies of one ticket id all come
    back; :func:`one_row_per` reduces them to one per id, as ``row_number() = 1`` does.
    """
    best = best_call_per_ticket_time(calls, tickets, call_id=call_id, call_key=call_key,
                                     call_time=call_time, ticket_key=ticket_key, ticket_time=ticket_time,
                                     tolerance=tolerance, piece_rows=piece_rows)
    key_type = tickets.schema[ticket_key].dataType
    # Joined on a struct of (phone, time) rather than the aggregate's own grouping columns, so both
    # inputs are plain shuffles and AQE can split the partition of a hot (phone, time) group.
    best = best.select(F.struct(F.col("_key").cast(key_type).alias("k"), F.col("_target").alias("t")).alias("_pt"),
                       "_call", "_diff")
    rows = tickets.withColumn("_pt", F.struct(F.col(ticket_key).alias("k"), F.col(ticket_time).alias("t")))
    joined = rows.join(best, "_pt")
    return joined.select(*[F.col(c) for c in tickets.columns],
                         F.col("_call").alias(out_call), F.col("_diff").alias(out_diff))


def one_row_per(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Keep one row per ``key``: the smallest by ``order`` then by the remaining columns.

    ``row_number() over (partition by key order by ...) = 1`` as a map-side combined ``min(struct)``,
    so a key with millions of copies is reduced in parallel, never sorted in one task.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest])
    return (df.groupBy(key).agg(F.min(packed).alias("_m"))
              .select(key, *[F.col("_m")[c].alias(c) for c in order + rest])
              .select(*df.columns))
