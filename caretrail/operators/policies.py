"""Policy facts per customer id (U3): left joins from customers over their policies to payments.

Plan shape. The policies' own facts are gathered first (interruption, quote, offer, payments, channel), then joined to the
customers, so a customer's row is shuffled once. Every join is an equi-join left to Catalyst and AQE: sides that are
small at run time become broadcasts, the rest sort-merge joins; nothing is broadcast on a guess. Joins whose
key is not unique (payments per offer) multiply rows, as the source does; those copies carry the
same purchase time and are all kept as ties downstream.

The reports ask for few of all customers: those who wrote. With ``wanted`` the tables are thinned out before the joins by
Bloom filters (:mod:`caretrail.operators.bloom`), from the persons to their applications, to the policies, offers, payments and
transactions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretrail.operators.bloom import bloom_filter, may_hold

#: the tables that policy facts are made of, in the order of the arguments
TABLES = ("customer_data", "policy", "interruption", "offer", "quote", "payments", "transaction")


def wanted_only(tables: Mapping[str, DataFrame], wanted: DataFrame, person: str) -> dict[str, DataFrame]:
    """The tables (names as in ``TABLES``) without most rows that lead to no person of ``wanted``. One pass over
    each table that passes the question on; filters are made while this plan is built."""
    out = dict(tables)

    def thin(name: str, column, asked: DataFrame, asked_column: str) -> None:
        out[name] = may_hold(tables[name], column, bloom_filter(asked, asked_column))

    thin("customer_data", F.upper("policyholder_dni"), wanted, person)
    thin("policy", "application_id", out["customer_data"], "application_id")
    thin("quote", "application_id", out["customer_data"], "application_id")
    thin("interruption", "policy_id", out["policy"], "policy_id")
    thin("offer", "offer_id", out["policy"], "offer_id")
    thin("payments", "offer_id", out["offer"], "customer_facing_id")
    thin("transaction", "order_id", out["payments"], "order_id")
    return out


def policy_facts(customer_data: DataFrame, policy: DataFrame, interruption: DataFrame, offer: DataFrame,
                 quote: DataFrame, payments: DataFrame, transaction: DataFrame, *, wanted: DataFrame | None = None,
                 person: str = "dni_nie") -> DataFrame:
    """One row per joined combination: dni_nie, purchase flags, purchase and interruption times. With ``wanted`` (a
    table with a column ``person``) all rows of its persons, and possibly some of others."""
    tables = dict(zip(TABLES, (customer_data, policy, interruption, offer, quote, payments, transaction)))
    if wanted is not None:
        tables = wanted_only(tables, wanted, person)
    stopped = tables["interruption"].select("policy_id", F.col("occurred_on").alias("interrupted_at"))
    channels = tables["transaction"].select("order_id", F.col("purchase_channel").alias("bo_purchase"))
    paid = tables["payments"].select(F.col("offer_id").alias("customer_facing_id"), "order_id").join(channels, "order_id", "left")
    offered = tables["offer"].select("offer_id", "customer_facing_id").join(paid, "customer_facing_id", "left").select("offer_id", "bo_purchase")
    asked = tables["quote"].select("application_id", "quote_id", F.col("source").alias("pcw_source"))
    policies = (tables["policy"].join(asked, ["application_id", "quote_id"], "left").join(offered, "offer_id", "left")
                .join(stopped, "policy_id", "left"))
    facts = tables["customer_data"].select("application_id", "policyholder_dni").join(policies, "application_id", "left")
    sold = F.length(F.col("policy_number")) > 5
    return facts.select(
        F.upper(F.col("policyholder_dni")).alias("dni_nie"),
        F.when(sold, F.lit(1)).otherwise(F.lit(0)).alias("purchased_policy"),
        F.when(sold & F.col("interrupted_at").isNull(), F.lit(1)).otherwise(F.lit(0)).alias("policy_not_interrupted"),
        "purchased_at", "policy_number", "interrupted_at", "bo_purchase", "pcw_source", "renewal_order")
