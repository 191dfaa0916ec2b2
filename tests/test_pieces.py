"""Hot keys in pieces: sessions, as-of lookup, first touch and band join with and without cuts, against plain forms."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from caretrail.operators.asof import nearest_times
from caretrail.operators.attribution import purchases_within
from caretrail.operators.band import band_join
from caretrail.operators.first_touch import first_touch, first_touch_nested
from caretrail.operators.pieces import find_pieces
from caretrail.operators.sessions import session_table, sessionize
from tests.conftest import SF
from tests.helpers import assert_same, bag
from tools.naive import first_touch_naive, rollups_naive, sessions_naive

BASE = dt.datetime(2024, 1, 1)


def contacts(spark, seed=1, n=900, copies=False):
    """A hot key with a third of the rows within one hour, a hot instant, NULL keys, NULL times, and ordinary keys."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.3:
            k, t = "hot", BASE + dt.timedelta(seconds=rng.randrange(3600))
        elif kind < 0.45:
            k, t = "instant", BASE + dt.timedelta(days=3)
        elif kind < 0.6:
            k, t = "wide", BASE + dt.timedelta(hours=rng.randrange(24 * 900))
        elif kind < 0.75:
            k, t = None, BASE + dt.timedelta(hours=rng.randrange(24 * 200))
        else:
            k, t = f"k{rng.randrange(30)}", BASE + dt.timedelta(hours=rng.randrange(24 * 200))
        rows.append((i, k, None if rng.random() < 0.08 else t, rng.choice(["x", "y", None])))
    rows += [(n + i, "timeless", None, "z") for i in range(60)]
    if copies:
        rows += [rows[0]] * 70 + [rows[-1]] * 5 + [(5000, None, None, "q")] * 40
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "id long, k string, t timestamp_ntz, v string")


@pytest.mark.parametrize("piece_rows", [7, 25, 10_000])
@pytest.mark.parametrize("copies", [False, True])
def test_sessions_in_pieces(spark, piece_rows, copies):
    df = contacts(spark, copies=copies)
    got = sessionize(df, "k", "t", (2, 15), tiebreak=["id"], tiebreak_unique=not copies, first_ts_fmt="first_{gap}",
                     group_count_fmt="cnt_{gap}", firsts={"fv_{gap}": "v"}, piece_rows=piece_rows)
    want = sessions_naive(df, "k", "t", (2, 15), tiebreak=["id"])
    for g in (2, 15):
        want = rollups_naive(want, f"client_{g}", "t", {f"fv_{g}": "v"}, tiebreak=["id"], first_ts_name=f"first_{g}", count_name=f"cnt_{g}")
    assert_same(got, want)


def test_sessions_without_tiebreak_in_pieces(spark):
    df = contacts(spark, seed=4, copies=True).select("k", "t", "v")
    got = sessionize(df, "k", "t", (15,), piece_rows=9)
    # which of several rows at one instant comes first is open
    assert_same(got.drop("v"), sessions_naive(df, "k", "t", (15,)).drop("v"))


def test_session_table_in_pieces(spark):
    df = contacts(spark, seed=5)
    whole, cut = (session_table(df, "k", "t", 15, tiebreak=["id"], tiebreak_unique=True, firsts={"fv": "v"}) for _ in range(2))
    assert_same(whole, cut)


def test_pieces_are_even(spark):
    """A hot key and a hot instant are cut into pieces of about the wanted size, ordinary keys aren't."""
    df = contacts(spark, n=6000)
    pieces = find_pieces(df, ["k"], [F.col("t"), F.col("id")], rows=100)
    held = {(r.k, r._p): r.n for r in pieces.assign(df).groupBy("k", "_p").agg(F.count("*").alias("n")).collect()}
    per_key = Counter(k for k, _ in held)
    assert max(held.values()) <= 250 and per_key["hot"] >= 10 and per_key["instant"] >= 5
    assert all(p is None for k, p in held if k and k.startswith("k"))
    assert find_pieces(df, ["k"], [F.col("t")], rows=10_000).cuts is None


def test_sessions_read_once_and_shuffle_once(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate")
    for hot in (False, True):
        k = F.when(F.col("o_custkey") % 3 == 0, 0).otherwise(F.col("o_custkey")) if hot else F.col("o_custkey")
        df = orders.withColumn("o_custkey", k)
        plan = sessionize(df, "o_custkey", "o_orderdate", (15, 30), tiebreak=["o_orderkey"], tiebreak_unique=True)
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1


def brute_nearest(left, right):
    out = []
    for i, k, t in left:
        if k is None or t is None:
            continue
        times = [x for kk, x in right if kk == k and x is not None]
        out.append((i, max((x for x in times if x <= t), default=None), min((x for x in times if x >= t), default=None)))
    return Counter(out)


@pytest.mark.parametrize("piece_rows", [5, 40, 10_000])
def test_nearest_times_in_pieces(spark, piece_rows):
    rng = random.Random(2)
    keys = ["hot"] * 6 + ["a", "b", None]
    left = [(i, rng.choice(keys), rng.choice([None, 50, 50, 50, *range(0, 100, 3)])) for i in range(500)]
    right = [(rng.choice(keys), rng.choice([None, 50, 51, *range(1, 400, 7)])) for _ in range(300)] + [("hot", 50)] * 50
    got = nearest_times(spark.createDataFrame(left, "id int, k string, t int"), spark.createDataFrame(right, "rk string, rt int"),
                        "k", "rk", "t", "rt", prev_name="p", next_name="n", piece_rows=piece_rows)
    assert bag(got, ["id", "p", "n"]) == brute_nearest(left, right)


def test_nearest_times_read_each_side_once(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    got = nearest_times(events.where("event_type = 'click'").select("event_id", "user_id", "ts"), events.where("event_type = 'error'").select("user_id", "ts"),
                        "user_id", "user_id", "ts", "ts")
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2


@pytest.mark.parametrize("group_rows", [20, 10_000])
def test_first_touch_of_hot_groups(spark, group_rows):
    df = contacts(spark, seed=3)
    got = first_touch(df, ["k"], ["t"], {"f": "v"}, tiebreak=["id"], group_rows=group_rows)
    assert_same(got, first_touch_naive(df, ["k"], ["t", "id"], "v", "f"))


def test_hot_group_is_answered_without_a_shuffle(spark):
    """With AQE's skew join off: rows of the hot group meet their value in a broadcast join only."""
    df = contacts(spark, seed=3, n=3000)
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        plan = first_touch(df, ["k"], ["t"], {"f": "v"}, tiebreak=["id"], group_rows=100)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan and "LeftAnti" in plan


def test_nested_first_touch_of_hot_groups(spark):
    df = contacts(spark, seed=8).withColumns({"a": F.concat("k", F.lit("-"), F.dayofyear("t").cast("string")), "b": F.col("k"), "c": F.substring("k", 1, 1)})
    for rows in (20, 10_000):
        got = first_touch_nested(df, ["a", "b", "c"], ["t"], "v", ["fa", "fb", "fc"], tiebreak=["id"], group_rows=rows)
        want = df
        for g in "abc":
            # groups without a label are one group of the finest label, so they nest only when all labels are missing
            want = first_touch_naive(want, [g], ["t", "id"], "v", f"f{g}")
        assert_same(got.where("a IS NOT NULL").select("id", "fa"), want.where("a IS NOT NULL").select("id", "fa"))


@pytest.mark.parametrize("block_rows", [3, 30, None])
def test_band_join(spark, block_rows):
    rng = random.Random(6)
    at = lambda: None if rng.random() < 0.05 else BASE + dt.timedelta(minutes=rng.randrange(60 * 24 * 40))
    left = [(i, rng.choice(["hot"] * 5 + ["a", None]), at()) for i in range(150)]
    right = [(1000 + i, rng.choice(["hot"] * 5 + ["a", None]), at()) for i in range(120)]
    right += [(2000 + i, "a", left[0][2]) for i in range(20)]
    got = band_join(spark.createDataFrame(left, "id int, k string, t timestamp_ntz"), spark.createDataFrame(right, "rid int, rk string, rt timestamp_ntz"),
                    "k", "rk", "t", "rt", 5 * 86400, within=lambda a, b: (b >= a) & (b < a + F.make_dt_interval(F.lit(5))), block_rows=block_rows)
    want = Counter((i, r) for i, k, t in left for r, rk, rt in right if k is not None and k == rk and t and rt and dt.timedelta(0) <= rt - t < dt.timedelta(days=5))
    assert bag(got.select("id", "_p.rid"), ["id", "rid"]) == want


def test_purchases_within_keeps_horizon_edges(spark):
    t = BASE
    tickets = spark.createDataFrame([(1, "p", t), (2, None, t), (3, "p", None)], "id int, dni_nie string, created_at timestamp_ntz")
    days = [0, 1, 3, 7, 14]
    policies = spark.createDataFrame([(f"P{d}", "p", t + dt.timedelta(days=d), None) for d in days] + [("Pb", "p", t - dt.timedelta(seconds=1), t)],
                                     "policy_number string, dni_nie string, purchased_at timestamp_ntz, interrupted_at timestamp_ntz")
    rows = {r.policy_number: r for r in purchases_within(tickets, policies).collect()}
    assert sorted(rows) == ["P0", "P1", "P3", "P7"]  # 14 days is out, and so is a purchase before the ticket
    assert rows["P0"].policy_number_1days == "P0" and rows["P1"].policy_number_1days is None and rows["P1"].policy_number_3days == "P1"
    assert rows["P7"].days_difference == 7 and rows["P7"].policy_number_14days == "P7"
