from pyspark.sql import functions as F

from caretrail.operators.first_touch import first_touch
from tools.naive import first_touch_naive
from tests.conftest import SF
from tests.helpers import assert_same


def test_first_touch_equals_first_value(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet").select(
        "o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus",
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("pk"),
        F.when(F.col("o_totalprice") > 300000, F.col("o_orderpriority")).alias("maybe"))
    got = first_touch(orders, ["pk", "o_orderstatus"], ["o_orderdate"], {"f": "maybe"}, tiebreak=["o_orderkey"])
    want = first_touch_naive(orders, ["pk", "o_orderstatus"], ["o_orderdate", "o_orderkey"], "maybe", "f")
    assert_same(got, want)
    # the NULL key group (status P) has one shared value
    assert got.where("pk is null").select("f").distinct().count() == 1


def test_null_order_sorts_first(spark):
    df = spark.createDataFrame([(1, "k", None, "a"), (2, "k", 5, "b")], "id long, k string, o int, v string")
    got = {r["id"]: r["f"] for r in first_touch(df, ["k"], ["o"], {"f": "v"}, tiebreak=["id"]).collect()}
    assert got == {1: "a", 2: "a"}


def test_nested_equals_separate(spark):
    from caretrail.operators.first_touch import first_touch_nested
    from caretrail.operators.sessions import sessionize
    orders = spark.read.parquet(f"{SF}/orders.parquet").select(
        "o_orderkey", "o_orderdate", "o_orderpriority",
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k"))
    s = sessionize(orders, "k", "o_orderdate", (15, 30, 60), tiebreak=["o_orderkey"], tiebreak_unique=True,
                   lag_name=None, diff_name=None)
    got = first_touch_nested(s, ["client_15", "client_30", "client_60"], ["o_orderdate"], "o_orderpriority",
                             ["f15", "f30", "f60"], tiebreak=["o_orderkey"])
    want = s
    for g in (15, 30, 60):
        want = first_touch(want, [f"client_{g}"], ["o_orderdate"], {f"f{g}": "o_orderpriority"},
                           tiebreak=["o_orderkey"])
    assert_same(got, want)
