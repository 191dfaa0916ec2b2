"""Purchase attribution within day horizons (U4), nearest purchase per ticket (U5), flags (U10).

Semantics. A ticket is paired with policy rows of the same customer id purchased at or after the ticket's creation:
:func:`attribute_purchases` keeps, per ticket, the pairs with the smallest ``|purchased - created|``, ties included;
:func:`purchases_within` keeps all pairs up to the longest horizon. On each kept pair, for every horizon ``d``:

* ``policy_number_<d>days``  the policy number when ``purchased_at < created_at + d days``;
* ``interrupted_<d>days``    the policy number when ``interrupted_at < created_at + d days``
                             (no lower bound, as written in the source);
* ``dif_between_ticket_and_purchase`` / ``..._interrupted``  absolute intervals;
* ``days_difference`` / ``days_difference_interruption``      floored whole days of epoch seconds.

Plan shapes. The argmin is an as-of lookup (:func:`caretrail.operators.asof.nearest_times`): each
ticket gets the earliest purchase time at or after it, then joins the policy rows at exactly that
(customer, time), which returns all tied rows and nothing else. No ticket x policy pairs are formed.

All purchases within the horizons are a band join (:func:`caretrail.operators.band.band_join`): time is cut into buckets as
long as the longest horizon, a ticket meets its own bucket and the next one, and the cells (customer, bucket) that hold
many rows are dealt out in blocks. Rows outside the horizons are left out inside the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretrail.functions.timeutil import SECONDS_PER_DAY, floor_days_between, plus_days
from caretrail.operators.asof import nearest_times
from caretrail.operators.band import band_join

# Horizons in days, in the source's column order.
HORIZONS = (7, 14, 1, 3)


def _horizon_columns(ticket_id: str, policies: DataFrame, purchased: str, policy_number: str, interrupted: str | None,
                     horizons: Sequence[int]) -> list[Column]:
    """The columns of a pair: ticket (``_tid``, ``_created``) and policy row (alias ``_p``)."""
    bought, made = F.col(f"_p.{purchased}"), F.col("_created")
    cols = [F.col("_tid").alias(ticket_id)]
    cols += [F.when(bought < plus_days(made, d), F.col(f"_p.{policy_number}")).alias(f"policy_number_{d}days")
             for d in horizons]
    cols.append(F.abs(bought - made).alias("dif_between_ticket_and_purchase"))
    if interrupted:
        stop = F.col(f"_p.{interrupted}")
        cols += [F.when(stop < plus_days(made, d), F.col(f"_p.{policy_number}")).alias(f"interrupted_{d}days")
                 for d in horizons]
        cols.append(F.abs(stop - made).alias("dif_between_ticket_and_interrupted"))
    cols.append(floor_days_between(made, bought).alias("days_difference"))
    if interrupted:
        cols.append(floor_days_between(made, F.col(f"_p.{interrupted}")).alias("days_difference_interruption"))
    return cols + [F.col(f"_p.{c}") for c in policies.columns]


def attribute_purchases(tickets: DataFrame, policies: DataFrame, *, ticket_id: str = "id",
                        ticket_key: str = "dni_nie", created: str = "created_at",
                        policy_key: str = "dni_nie", purchased: str = "purchased_at",
                        policy_number: str = "policy_number", interrupted: str | None = "interrupted_at",
                        horizons: Sequence[int] = HORIZONS, piece_rows: int | None = None) -> DataFrame:
    """Nearest policy rows per ticket with horizon columns, followed by all policy columns."""
    t = tickets.select(F.col(ticket_id).alias("_tid"), F.col(ticket_key).alias("_tkey"),
                       F.col(created).alias("_created"))
    near = nearest_times(t, policies.select(policy_key, purchased), "_tkey", policy_key, "_created", purchased,
                         prev_name="_before", next_name="_at", piece_rows=piece_rows)
    near = near.where(F.col("_at").isNotNull()).drop("_before")
    p = policies.alias("_p")
    joined = near.join(p, (near["_tkey"] == F.col(f"_p.{policy_key}")) & (near["_at"] == F.col(f"_p.{purchased}")))
    return joined.select(*_horizon_columns(ticket_id, policies, purchased, policy_number, interrupted, horizons))


def purchases_within(tickets: DataFrame, policies: DataFrame, *, ticket_id: str = "id",
                     ticket_key: str = "dni_nie", created: str = "created_at",
                     policy_key: str = "dni_nie", purchased: str = "purchased_at",
                     policy_number: str = "policy_number", interrupted: str | None = "interrupted_at",
                     horizons: Sequence[int] = HORIZONS, block_rows: int | None = None) -> DataFrame:
    """All policy rows bought from a ticket's creation until before its longest horizon, one row a pair, with
    horizon columns, followed by all policy columns. Rows with a NULL key or time pair with nothing."""
    t = tickets.select(F.col(ticket_id).alias("_tid"), F.col(ticket_key).alias("_tkey"), F.col(created).alias("_created"))
    pairs = band_join(t, policies, "_tkey", policy_key, "_created", purchased, max(horizons) * SECONDS_PER_DAY,
                      within=lambda made, bought: (bought >= made) & (bought < plus_days(made, max(horizons))), block_rows=block_rows)
    return pairs.select(*_horizon_columns(ticket_id, policies, purchased, policy_number, interrupted, horizons))


def conversion_flags(df: DataFrame, horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """``purchased_policy_<d>days`` = 1 when ``policy_number_<d>days`` is not NULL, else 0."""
    return df.withColumns({
        f"purchased_policy_{d}days": F.when(F.col(f"policy_number_{d}days").isNotNull(), F.lit(1)).otherwise(F.lit(0))
        for d in horizons})
