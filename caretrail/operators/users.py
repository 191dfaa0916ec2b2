"""User normalization (U2) with national-id extraction (U1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretrail.functions.ids import national_id, national_id_type

# User columns dropped by both reports; the ticket report also drops the last two.
DROPPED = ("notes", "created_at", "updated_at", "external_id", "tags", "id")
DROPPED_TICKET_REPORT = ("organization_id", "url")


def normalize_users(users: DataFrame, *, ticket_report: bool = True) -> DataFrame:
    """Users keyed by ``requester_id`` with ``user_created_at``, ``user_updated_at``, upper-cased
    ``notes``, ``dni_nie`` and ``type_of_id``; noisy columns dropped."""
    drop = set(DROPPED) | (set(DROPPED_TICKET_REPORT) if ticket_report else set())
    kept = [F.col(c) for c in users.columns if c not in drop]
    return users.select(
        *kept,
        F.col("id").alias("requester_id"),
        F.col("created_at").alias("user_created_at"),
        F.col("updated_at").alias("user_updated_at"),
        F.upper(F.col("notes")).alias("notes"),
        national_id("notes").alias("dni_nie"),
        national_id_type("notes").alias("type_of_id"),
    )
