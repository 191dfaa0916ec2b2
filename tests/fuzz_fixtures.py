"""Seeded, collision-heavy domain tables for cross-checking the reports against the DuckDB oracle.

Phones, customers and hours are drawn from small pools so that ties, shared keys and near-misses of
every threshold (sessions, horizons, match tolerance) are common; NULLs appear in every column the
reports test. Policies tied in time for one customer are exact copies (payment copies), the only
tie whose resolution the source leaves open and that would show in the output.
"""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import types as T

from caretrail.plans.analog_tables import INCIDENT_VOCAB, LINE_VOCAB
from caretrail.sources import domain

BASE = dt.datetime(2024, 3, 1)
CLAIMS = 19015738424477
SUBJECTS = ["Consulta", "Declaración de un siniestro", "Inbound answered call on S 1 - Apertura Siniestro", None]
NPS, WEB, BLOCKED, OFFICE = "34919012607", "34919017999", "34910602845", "34910000000"


def _t(rnd: random.Random, days: int = 25) -> dt.datetime:
    # hour resolution plus a few seconds: equal times are frequent, distances near 10000 s too
    return BASE + dt.timedelta(hours=rnd.randrange(days * 24), seconds=rnd.choice([0, 0, 0, 1, 9999 % 3600]))


def tables(spark, seed: int):
    rnd = random.Random(seed)
    phones = [f"6{rnd.randrange(10**8):08d}" for _ in range(12)]
    dnis = [f"{rnd.randrange(10**8):08d}{rnd.choice('ABCZ')}" for _ in range(10)] + \
           [f"{rnd.choice('XYZ')}{rnd.randrange(10**7):07d}{rnd.choice('BCK')}" for _ in range(5)]

    users = []
    for uid in range(1, 41):
        d = rnd.choice(dnis + [None])
        notes = None if rnd.random() < 0.1 else f"cliente {d.lower() if d and rnd.random() < .5 else d or 'sin id'}"
        ph = rnd.choice(phones)
        phone = None if rnd.random() < 0.15 else rnd.choice([ph, f"+34 {ph[:3]} {ph[3:6]} {ph[6:]}"])
        users.append((uid, notes, phone, None, None, None, None, None, None, f"U{uid}"))

    tickets, ticket_keys = [], []
    for i in range(160):
        ph = rnd.choice(phones)
        desc = rnd.choice([f"Caller Phone number : +34 {ph}", f"Caller Phone number : {ph}", "sin telefono",
                           "Caller Phone number : 336" + ph, "llamada via Aircall", None])
        tipo = rnd.choice(INCIDENT_VOCAB + ["", None, "otra cosa"])
        if tipo and rnd.random() < 0.3:
            tipo = tipo.upper()
        created = None if rnd.random() < 0.03 else _t(rnd)
        if desc and desc.endswith(ph) and "336" not in desc:
            ticket_keys.append((ph, created))   # the description carries the join phone
        tickets.append((5000 + i, rnd.choice(list(range(1, 46)) + [None]), created,
                        created and created + dt.timedelta(hours=rnd.randrange(48)), desc,
                        rnd.choice(["api", "email", "phone", None]), tipo,
                        rnd.choice([1, 1, 1, CLAIMS, None]), rnd.choice(SUBJECTS), rnd.choice([1, 2, 3, None]),
                        rnd.choice(["a unseen", "x seen", "unseen", None]),
                        rnd.choice(["{score=good, reason=slow, comment=x}", "score=bad", None])))

    policy_schema = T.StructType([T.StructField(n, t) for n, t in [
        ("dni_nie", T.StringType()), ("purchased_policy", T.IntegerType()), ("policy_not_interrupted", T.IntegerType()),
        ("purchased_at", T.TimestampType()), ("policy_number", T.StringType()), ("interrupted_at", T.TimestampType()),
        ("bo_purchase", T.StringType()), ("pcw_source", T.StringType()), ("renewal_order", T.IntegerType())]])
    policies, seen = [], set()
    for j in range(70):
        d = rnd.choice(dnis + [None])
        at = None if rnd.random() < 0.05 else _t(rnd)
        if (d, at) in seen:
            continue
        seen.add((d, at))
        num = rnd.choice([f"POL{j:05d}", f"P{j}", None])
        stop = None if rnd.random() < 0.6 else (at or BASE) + dt.timedelta(hours=rnd.randrange(400))
        row = (d, int(bool(num and len(num) > 5)), int(bool(num and len(num) > 5 and stop is None)), at, num, stop,
               rnd.choice(["web", None]), rnd.choice(["pcw", None]), rnd.choice([0, 1, None]))
        policies.append(row)
        if rnd.random() < 0.2:
            policies.append(row)  # payment copy

    metrics = [(5000 + i, None, _t(rnd), None, rnd.randrange(100)) for i in range(0, 160, 3)]

    calls = []
    for c in range(220):
        created = None if rnd.random() < 0.02 else _t(rnd)
        ph = rnd.choice(phones)
        if rnd.random() < 0.4:
            # a call near a ticket of the same phone, at the edges of the 10000 s tolerance
            ph, near = rnd.choice(ticket_keys)
            if near is not None:
                offset = rnd.choice([-10001, -10000, -9999, -5000, -1, 0, 1, 3600, 9999, 10000, 10001])
                created = near + dt.timedelta(seconds=offset)
        inbound = rnd.random() < 0.8
        client = rnd.choice(["34" + ph] * 6 + ["anonymous", WEB, BLOCKED])
        frm, to = (client, rnd.choice([NPS, OFFICE, OFFICE])) if inbound else (rnd.choice([OFFICE, NPS]), client)
        ans = None if (created is None or rnd.random() < 0.05) else created + dt.timedelta(seconds=rnd.choice([0, 0, 5]))
        dur = rnd.randrange(0, 600)
        calls.append((700000 + c, created, ans, created and created + dt.timedelta(seconds=dur), frm, to,
                      "inbound" if inbound else "outbound", rnd.choice(LINE_VOCAB + [None]), dur,
                      max(0, dur - rnd.randrange(40)), rnd.choice(["Yes"] * 5 + ["yes", "No", None]),
                      rnd.choice(["Agent A", "Agent B", None])))

    return {"users": spark.createDataFrame(users, domain.USERS),
            "tickets": spark.createDataFrame(tickets, domain.TICKETS),
            "policies": spark.createDataFrame(policies, policy_schema),
            "metrics": spark.createDataFrame(metrics, domain.TICKET_METRICS),
            "calls": spark.createDataFrame(calls, domain.CALLS)}
