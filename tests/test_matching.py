import random

from pyspark.sql import functions as F

from caretrail.operators.asof import nearest_times
from caretrail.operators.matching import match_calls_to_tickets
from tools.naive import attribution_naive, match_naive
from caretrail.operators.attribution import attribute_purchases
from tests.conftest import SF
from tests.helpers import assert_same


def test_nearest_times_brute_force(spark):
    rnd = random.Random(7)
    left = [(i, rnd.randint(0, 3), rnd.randint(0, 50000)) for i in range(300)]
    right = [(rnd.randint(0, 3), rnd.randint(0, 50000)) for _ in range(200)] + [(1, left[0][2])]
    L = spark.createDataFrame(left, "lid long, k int, t long")
    R = spark.createDataFrame(right, "k int, rt long")
    got = {r["lid"]: (r["p"], r["n"]) for r in
           nearest_times(L, R, "k", "k", "t", "rt", prev_name="p", next_name="n", piece_rows=9).collect()}
    for lid, k, t in left:
        before = [x for kk, x in right if kk == k and x <= t]
        after = [x for kk, x in right if kk == k and x >= t]
        assert got[lid] == (max(before) if before else None, min(after) if after else None)


def _events(spark, root):
    ev = spark.read.parquet(f"{root}/events.parquet")
    calls = ev.where("event_type = 'click'").select(F.col("event_id").alias("call_id"), F.col("user_id").alias("ph"),
                                                    F.unix_timestamp("ts").alias("a"))
    tickets = ev.where("event_type = 'error'").select(F.col("event_id").alias("id"), F.col("user_id").alias("tph"),
                                                      F.unix_timestamp("ts").alias("b"))
    return calls, tickets


def test_match_equals_pairs_form(spark):
    calls, tickets = _events(spark, SF)
    got = match_calls_to_tickets(calls, tickets, call_id="call_id", call_key="ph", call_time="a",
                                 ticket_key="tph", ticket_time="b")
    want = match_naive(calls, tickets, call_id="call_id", call_key="ph", call_time="a",
                       ticket_id="id", ticket_key="tph", ticket_time="b").drop("ranking_ticket_id")
    assert got.count() == 198
    assert_same(got, want)


def test_match_edges(spark):
    # diffs 9999 / 10000 / 10001; one ticket nearest to two calls; a call with two equally near tickets
    calls = spark.createDataFrame([(1, 5, 100000), (2, 5, 100010), (3, 6, 0), (4, 7, 50000), (5, 8, 0)],
                                  "call_id long, ph int, a long")
    tickets = spark.createDataFrame([(10, 5, 100004), (11, 6, 9999), (12, 7, 45000), (13, 7, 55000),
                                     (14, 8, 10000), (15, 8, 10001)], "id long, tph int, b long")
    got = {r["id"]: (r["aircall_id"], r["dif_between_call_and_ticket"]) for r in
           match_calls_to_tickets(calls, tickets, call_id="call_id", call_key="ph", call_time="a",
                                  ticket_key="tph", ticket_time="b").collect()}
    assert got == {10: (1, 4), 11: (3, 9999), 12: (4, 5000), 13: (4, 5000)}
    want = match_naive(calls, tickets, call_id="call_id", call_key="ph", call_time="a", ticket_id="id",
                       ticket_key="tph", ticket_time="b")
    assert {r["id"] for r in want.collect()} == set(got)


def test_attribution_equals_pairs_form(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    tickets = ev.where("event_type = 'error'").select(F.col("event_id").alias("id"), F.col("user_id").alias("tk"),
                                                      F.col("ts").alias("created_at"))
    pol = ev.where("event_type = 'purchase'").select(F.col("user_id").alias("dni_nie"), F.col("ts").alias("purchased_at"),
                                                     F.col("event_id").cast("string").alias("policy_number"))
    pol = pol.unionByName(pol.where("policy_number like '%7'"))  # copies: ties kept
    got = attribute_purchases(tickets, pol, ticket_key="tk", interrupted=None).select("id", "policy_number")
    want = attribution_naive(tickets, pol, ticket_id="id", ticket_key="tk", created="created_at",
                             policy_key="dni_nie", purchased="purchased_at").select("id", "policy_number")
    assert_same(got, want)
