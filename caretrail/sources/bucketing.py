"""Domain tables as bucketed catalog tables, so that the joins of the reports find their sides already partitioned.

A table is bucketed and sorted by the key it is joined on; two tables with equal bucket numbers join without an
exchange. One bucket should hold some hundred megabytes. Keys that hold very many rows stay whole in a bucket, so a table with
one hot key (all tickets without a requester) is better left unbucketed; the reports give the same rows either way.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

#: the column that each table is joined on first
BUCKET_KEYS = {
    "users": "id", "tickets": "requester_id", "ticket_metrics": "ticket_id", "customer_data": "application_id", "policy": "application_id",
    "policy_interruption": "policy_id", "offer": "offer_id", "quote": "application_id", "payments": "offer_id", "transaction": "order_id",
    "calls": "call_id",
}


def save_bucketed(tables: Mapping[str, DataFrame], database: str, buckets: int) -> None:
    """Save domain tables into a catalog database, replacing tables of the same name."""
    for name, df in tables.items():
        key = BUCKET_KEYS[name]
        (df.repartition(buckets, key).write.mode("overwrite").format("parquet")
           .bucketBy(buckets, key).sortBy(key).saveAsTable(f"`{database}`.`{name}`"))
