"""Tiny domain tables, one row per semantic trap (see FIXTURES.md §1)."""

from __future__ import annotations

import datetime as dt

from caretrail.sources import domain


def ts(s: str | None):
    return None if s is None else dt.datetime.fromisoformat(s)


def users(spark):
    rows = [
        (1, "cliente 12345678a ok", "+34 622 83 35 76", ts("2023-01-01 00:00:00"), ts("2023-01-02 00:00:00"), "e1", "t", 10, "u1", "Ana"),
        (2, "nie x1234567b", "622000002", ts("2023-01-01 00:00:00"), None, "e2", "t", 10, "u2", "Bea"),
        (3, "first Y7654321C then 87654321Z", "+34622000003", None, None, "e3", None, None, None, "Carl"),
        (4, "no id here", None, None, None, None, None, None, None, "Dan"),
        (5, None, "622 000 005", None, None, None, None, None, None, "Eve"),
    ]
    return spark.createDataFrame(rows, domain.USERS)


def tickets(spark):
    base = "2024-03-01 10:00:00"
    rows = [
        # id, requester, created, updated, description, channel, tipo, form, subject, assignee, tags, rating
        (101, 1, ts(base), ts("2024-03-02 00:00:00"), "Caller Phone number : +34 622 83 35 76", "api",
         "Cotización__Contratada", 1, "Consulta", 7, "x unseen", "{score=good, reason=slow, comment=x}"),
        (102, 1, ts("2024-03-10 10:00:00"), None, "hello via aircall", "api", "google", 1, "Consulta", 8, "a seen", None),
        (103, 1, ts("2024-03-26 10:00:00"), None, None, "email", "qyr", 1, "Consulta", 9, "unseen", None),
        (104, 2, ts("2024-03-05 00:00:00"), None, "Caller Phone number : 33612345678", "phone",
         "Llamada perdida", 1, None, 3, None, None),
        (105, 3, ts("2024-03-05 00:00:00"), None, "no phone", "email", "solicitud_información__cliente_potencial__pago",
         1, "Declaración de un siniestro", 4, None, None),
        (106, None, ts("2024-03-07 00:00:00"), None, None, None, None, 19015738424477, "x", 5, None, None),
        (107, 4, None, None, None, "email", "", None, "Consulta", 6, None, None),
        (108, 5, ts("2024-03-08 00:00:00"), None, "Caller Phone number : +34 622 000 005", "phone",
         "proveedores__inbound", 1, "Consulta", 2, None, None),
    ]
    return spark.createDataFrame(rows, domain.TICKETS)


def policy_facts(spark):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField(n, t) for n, t in [
        ("dni_nie", T.StringType()), ("purchased_policy", T.IntegerType()), ("policy_not_interrupted", T.IntegerType()),
        ("purchased_at", T.TimestampType()), ("policy_number", T.StringType()), ("interrupted_at", T.TimestampType()),
        ("bo_purchase", T.StringType()), ("pcw_source", T.StringType()), ("renewal_order", T.IntegerType())]])
    rows = [
        ("12345678A", 1, 1, ts("2024-03-01 10:00:00"), "POL000001", None, "web", "pcw", 0),   # at creation
        ("12345678A", 1, 1, ts("2024-03-01 10:00:00"), "POL000001", None, "web", "pcw", 0),   # payment copy (tie)
        ("12345678A", 1, 0, ts("2024-03-11 10:00:00"), "POL000002", ts("2024-03-12 00:00:00"), "tel", None, 1),
        ("X1234567B", 1, 1, ts("2024-03-12 00:00:00"), "POL000003", None, None, None, 0),     # +7 days exactly
        ("X1234567B", 1, 1, ts("2024-03-01 00:00:00"), "POL000004", None, None, None, 0),     # before creation
        ("87654321Z", 0, 0, None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, schema)


def metrics(spark):
    rows = [(101, ts("2024-03-01 10:00:00"), ts("2024-03-03 00:00:00"), ts("2024-03-04 00:00:00"), 5),
            (103, None, None, None, 7)]
    return spark.createDataFrame(rows, domain.TICKET_METRICS)


def calls(spark):
    rows = [
        # call_id, created, answered, ended, from, to, direction, number_name, duration, in_call, answered?, agent
        (1, ts("2024-03-01 11:00:00"), ts("2024-03-01 11:00:10"), ts("2024-03-01 11:05:00"), "34622833576",
         "34919012607", "inbound", "NPS Ventas", 300, 290, "Yes", "Agent A"),
        (2, ts("2024-03-05 01:00:00"), ts("2024-03-05 01:00:05"), None, "34612345678", "34910000000",
         "inbound", "Rastreator", 100, 95, "Yes", "Agent B"),
        (3, ts("2024-03-31 02:30:00"), ts("2024-03-31 02:30:05"), None, "anonymous", "34910000000",
         "inbound", "Pagina Web", 50, 45, "Yes", "Agent C"),
        (4, ts("2024-03-08 01:00:00"), ts("2024-03-08 01:00:00"), None, "34622000005", "34910000000",
         "inbound", "Pruebas", 50, 45, "Yes", "Agent D"),
        (5, ts("2024-03-08 01:10:00"), ts("2024-03-08 01:10:00"), None, "34622000005", "34910000000",
         "inbound", None, 50, 45, "Yes", "Agent D"),
        (6, ts("2024-03-08 01:20:00"), ts("2024-03-08 01:20:00"), None, "34622000005", "34910000000",
         "inbound", "Acierto", 50, 45, "yes", "Agent E"),
        (7, ts("2024-10-27 02:30:00"), ts("2024-10-27 02:30:00"), None, "34910000000", "34622000005",
         "outbound", "Acierto", 50, 45, "Yes", "Agent E"),
    ]
    return spark.createDataFrame(rows, domain.CALLS)


def sources(spark):
    from caretrail.plans.reports import Sources
    return Sources(users=users(spark), tickets=tickets(spark), policy_facts=policy_facts(spark),
                   ticket_metrics=metrics(spark), calls=calls(spark))
