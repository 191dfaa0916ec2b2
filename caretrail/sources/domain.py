"""Declared schemas of the domain tables the two reports read.

The source queries ship no DDL; types were chosen from how each column is used. Readers take a
path or an existing DataFrame, never a hard-wired catalog name.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_L, _S, _TS, _I = T.LongType(), T.StringType(), T.TimestampType(), T.IntegerType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


USERS = _schema(("id", _L), ("notes", _S), ("phone", _S), ("created_at", _TS), ("updated_at", _TS),
                ("external_id", _S), ("tags", _S), ("organization_id", _L), ("url", _S), ("name", _S))

TICKETS = _schema(("id", _L), ("requester_id", _L), ("created_at", _TS), ("updated_at", _TS),
                  ("description", _S), ("channel", _S), ("tipo_de_incidencia", _S), ("ticket_form_id", _L),
                  ("subject", _S), ("assignee_id", _L), ("tags", _S), ("satisfaction_rating", _S))

TICKET_METRICS = _schema(("ticket_id", _L), ("created_at", _TS), ("updated_at", _TS), ("ingested_at", _TS),
                         ("reply_time_in_minutes", _L))

CUSTOMER_DATA = _schema(("application_id", _L), ("policyholder_dni", _S))

POLICY = _schema(("application_id", _L), ("policy_id", _L), ("offer_id", _L), ("quote_id", _L),
                 ("policy_number", _S), ("purchased_at", _TS), ("renewal_order", _I))

POLICY_INTERRUPTION = _schema(("policy_id", _L), ("occurred_on", _TS))

OFFER = _schema(("offer_id", _L), ("customer_facing_id", _S))

QUOTE = _schema(("application_id", _L), ("quote_id", _L), ("source", _S))

PAYMENTS = _schema(("offer_id", _S), ("order_id", _L))

TRANSACTION = _schema(("order_id", _L), ("purchase_channel", _S))

CALLS = _schema(("call_id", _L), ("created_time", _TS), ("answered_time", _TS), ("ended_time", _TS),
                ("from", _S), ("to", _S), ("direction", _S), ("number_name", _S),
                ("duration_in_seconds", _L), ("in_call_duration", _L), ("was_answered_yes__no", _S),
                ("full_name", _S))

SCHEMAS = {
    "users": USERS, "tickets": TICKETS, "ticket_metrics": TICKET_METRICS,
    "customer_data": CUSTOMER_DATA, "policy": POLICY, "policy_interruption": POLICY_INTERRUPTION,
    "offer": OFFER, "quote": QUOTE, "payments": PAYMENTS, "transaction": TRANSACTION, "calls": CALLS,
}


#: columns that identify or link rows; a table without them is refused
KEYS = {
    "users": ("id",), "tickets": ("id", "requester_id", "created_at"), "ticket_metrics": ("ticket_id", "updated_at"),
    "customer_data": ("application_id", "policyholder_dni"), "policy": ("application_id", "policy_id", "offer_id", "quote_id"),
    "policy_interruption": ("policy_id", "occurred_on"), "offer": ("offer_id", "customer_facing_id"),
    "quote": ("application_id", "quote_id"), "payments": ("offer_id", "order_id"), "transaction": ("order_id",),
    "calls": ("call_id", "created_time", "answered_time", "from", "to"),
}


def read_domain(spark: SparkSession, name: str, source: str, fmt: str | None = "parquet") -> DataFrame:
    """A domain table with all its columns, declared ones in their declared types (:func:`conform`).
    ``source`` is a path of the given format, or a catalog table's name when ``fmt`` is None."""
    df = spark.table(source) if fmt is None else spark.read.format(fmt).load(source)
    return conform(df, name)


def conform(df: DataFrame, name: str) -> DataFrame:
    """Cast a DataFrame to the declared schema; extra columns are kept after the declared ones. A missing
    key column is an error; any other declared column that is missing becomes NULL, with a warning."""
    schema = SCHEMAS[name]
    lost = [k for k in KEYS[name] if k not in df.columns]
    if lost:
        raise ValueError(f"table {name} lacks key columns {lost}; it has {df.columns}")
    absent = [f.name for f in schema.fields if f.name not in df.columns]
    if absent:
        warnings.warn(f"table {name} lacks columns {absent}: NULL in the result", stacklevel=2)
    declared = {f.name for f in schema.fields}
    cols = [(F.lit(None) if f.name in absent else df[f.name]).cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*cols, *[df[c] for c in df.columns if c not in declared])
