"""Policy facts, whole and for the persons asked for."""

import datetime as dt
import random
from collections import Counter

from pyspark.sql import functions as F

from caretrail.operators import bloom
from caretrail.operators.policies import TABLES, policy_facts, wanted_only
from caretrail.sources import domain
from tests.helpers import bag


def chain(spark, n=400):
    rng, t = random.Random(9), dt.datetime(2024, 1, 1)
    rows = {
        "customer_data": [(i, None if i % 11 == 0 else f"{i:08d}a") for i in range(n)],
        "policy": [(i % n if i % 13 else None, 5000 + i, 9000 + i if i % 7 else None, i % 3, f"POL{i:05d}" if i % 4 else "Q1", t, i % 2) for i in range(2 * n)],
        "interruption": [(5000 + i, t) for i in range(0, 2 * n, 5)],
        "offer": [(9000 + i, f"OF{i}") for i in range(2 * n)],
        "quote": [(i, q, rng.choice(["pcw", None])) for i in range(n) for q in (0, 1)],
        "payments": [(f"OF{i}", 10 * i + k if k else None) for i in range(0, 2 * n, 2) for k in range(3)],
        "transaction": [(10 * i + k, rng.choice(["web", "phone"])) for i in range(2 * n) for k in (1, 2)],
    }
    schema = {"customer_data": domain.CUSTOMER_DATA, "policy": domain.POLICY, "interruption": domain.POLICY_INTERRUPTION, "offer": domain.OFFER,
              "quote": domain.QUOTE, "payments": domain.PAYMENTS, "transaction": domain.TRANSACTION}
    return rows, {k: spark.createDataFrame(v, schema[k]) for k, v in rows.items()}


def plain(rows):
    """The left joins, one after the other."""
    def by(name, i):
        out = {}
        for r in rows[name]:
            out.setdefault(r[i], []).append(r)
        return out

    policy, stop, offer, pay, tr = by("policy", 0), by("interruption", 0), by("offer", 0), by("payments", 0), by("transaction", 0)
    quote = {}
    for a, q, s in rows["quote"]:
        quote.setdefault((a, q), []).append(s)
    out = []
    for app, dni in rows["customer_data"]:
        for p in policy.get(app, [(None,) * 7]):
            for s in stop.get(p[1], [(None, None)]) if p[1] is not None else [(None, None)]:
                for o in offer.get(p[2], [(None, None)]) if p[2] is not None else [(None, None)]:
                    for src in quote.get((app, p[3]), [None]) if p[3] is not None else [None]:
                        for y in pay.get(o[1], [(None, None)]) if o[1] is not None else [(None, None)]:
                            for ch in tr.get(y[1], [(None, None)]) if y[1] is not None else [(None, None)]:
                                sold = p[4] is not None and len(p[4]) > 5
                                out.append((dni and dni.upper(), int(sold), int(sold and s[1] is None), p[5], p[4], s[1], ch[1], src, p[6]))
    return Counter(out)


def test_facts_equal_plain_joins(spark):
    rows, tables = chain(spark)
    got = policy_facts(*(tables[t] for t in TABLES))
    assert bag(got, got.columns) == plain(rows)


def test_wanted_persons_keep_all_their_rows(spark):
    rows, tables = chain(spark)
    asked = [f"{i:08d}A" for i in range(3, 400, 40)]
    wanted = spark.createDataFrame([(x,) for x in [*asked, None, "nobody"]], "dni_nie string")
    got = policy_facts(*(tables[t] for t in TABLES), wanted=wanted)
    assert bag(got.where(F.col("dni_nie").isin(asked)), got.columns) == Counter({k: v for k, v in plain(rows).items() if k[0] in asked})
    thin = wanted_only(tables, wanted, "dni_nie")
    entering = {t: (tables[t].count(), thin[t].count()) for t in TABLES}
    assert all(after <= 0.15 * before for before, after in entering.values()), entering


def test_bloom_filter_holds_its_values(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("v"))
    f = bloom.bloom_filter(df.where("v % 2 = 0"), "v")
    kept = {r.v for r in bloom.may_hold(df, "v", f).collect()}
    assert {str(i) for i in range(0, 2000, 2)} <= kept and len(kept) < 1100
    assert bloom.may_hold(df.limit(0), "v", bloom.bloom_filter(df.limit(0), "v")).count() == 0
    assert bloom.may_hold(df, "v", None).count() == 2000


def test_too_large_a_filter_is_left_out(spark, monkeypatch):
    monkeypatch.setattr(bloom, "MOST_BITS", 1 << 10)
    assert bloom.bloom_filter(spark.range(5000), "id") is None
