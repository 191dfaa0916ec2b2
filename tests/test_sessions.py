import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from caretrail.operators.pieces import find_pieces
from caretrail.operators.sessions import sessionize
from tools.naive import rollups_naive, sessions_naive
from tests.conftest import SF
from tests.helpers import assert_same

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("k", T.StringType()),
                       T.StructField("t", T.TimestampNTZType()), T.StructField("v", T.StringType())])


def d(s):
    return None if s is None else dt.datetime.fromisoformat(s)


def edge_rows():
    # gaps of 15d 23:59:59, exactly 16 d, 31 d, 61 d; ties; two NULL times; a NULL key
    return [
        (1, "a", d("2024-01-01 00:00:00"), "x"), (2, "a", d("2024-01-16 23:59:59"), "y"),
        (3, "a", d("2024-02-01 23:59:59"), "z"), (4, "a", d("2024-03-03 23:59:59"), None),
        (5, "a", d("2024-05-03 23:59:59"), "w"), (6, "a", d("2024-05-03 23:59:59"), "u"),
        (7, "a", None, "n1"), (8, "a", None, "n2"),
        (9, None, d("2024-01-01 00:00:00"), "p"), (10, None, d("2024-06-01 00:00:00"), "q"),
        (11, "b", d("2024-01-01 00:00:00"), None),
    ]


def copy_rows():
    # exact copies (same key, time and id), and a tie of distinct ids at one instant
    return edge_rows() + [(2, "a", d("2024-01-16 23:59:59"), "y"), (2, "a", d("2024-01-16 23:59:59"), "y"),
                          (12, "b", d("2024-01-01 00:00:00"), "t"), (13, "b", d("2024-01-01 00:00:00"), None)]


def test_edges_match_window_form(spark):
    df = spark.createDataFrame(edge_rows(), SCHEMA)
    got = sessionize(df, "k", "t", (15, 30, 60), tiebreak=["id"])
    want = sessions_naive(df, "k", "t", (15, 30, 60), tiebreak=["id"])
    assert_same(got, want)
    by_id = {r["id"]: r for r in got.collect()}
    assert by_id[7]["n_contact_15"] == 2 and by_id[8]["n_contact_15"] == 2   # RANGE peers share
    assert by_id[1]["n_contact_15"] == 3                                     # after the two NULLs
    assert by_id[2]["n_contact_15"] == 3 and by_id[2]["date_diff_lag"] == 15
    assert by_id[3]["n_contact_15"] == 4 and by_id[3]["date_diff_lag"] == 16
    assert by_id[3]["n_contact_30"] == 3
    assert by_id[4]["n_contact_30"] == 4 and by_id[4]["n_contact_60"] == 3
    assert by_id[5]["n_contact_60"] == 4 and by_id[6]["n_contact_60"] == 4
    assert by_id[9]["client_15"] is None and by_id[11]["client_15"] == "b-1"
    assert by_id[1]["num_contacts"] == 8


def test_copies_and_ties_match_window_form(spark):
    df = spark.createDataFrame(copy_rows(), SCHEMA)
    got = sessionize(df, "k", "t", (15, 30), tiebreak=["id"], first_ts_fmt="first_{gap}",
                     group_count_fmt="cnt_{gap}", firsts={"fv_{gap}": "v"})
    naive = sessions_naive(df, "k", "t", (15, 30), tiebreak=["id"])
    for g in (15, 30):
        naive = rollups_naive(naive, f"client_{g}", "t", {f"fv_{g}": "v"}, tiebreak=["id"],
                              first_ts_name=f"first_{g}", count_name=f"cnt_{g}")
    assert_same(got, naive)
    lags = sorted(str(r["lag"]) for r in got.where("id = 2").collect())
    assert lags == ["2024-01-01 00:00:00", "2024-01-16 23:59:59", "2024-01-16 23:59:59"]


def test_rollups_match_label_windows(spark):
    df = spark.createDataFrame(edge_rows(), SCHEMA)
    got = sessionize(df, "k", "t", (15,), tiebreak=["id"], first_ts_fmt="first_{gap}",
                     group_count_fmt="cnt_{gap}", firsts={"fv_{gap}": "v"})
    naive = sessions_naive(df, "k", "t", (15,), tiebreak=["id"])
    naive = rollups_naive(naive, "client_15", "t", {"fv_15": "v"}, tiebreak=["id"],
                          first_ts_name="first_15", count_name="cnt_15")
    assert_same(got, naive)
    by_id = {r["id"]: r for r in got.collect()}
    assert by_id[9]["cnt_15"] == 2 and by_id[10]["fv_15"] == "p"           # NULL key: one group
    assert by_id[11]["fv_15"] is None                                        # NULL value kept
    assert by_id[4]["fv_15"] is None


def test_orders_match_window_form(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate")
    got = sessionize(orders, "o_custkey", "o_orderdate", (15, 30, 60), tiebreak=["o_orderkey"])
    want = sessions_naive(orders, "o_custkey", "o_orderdate", (15, 30, 60), tiebreak=["o_orderkey"])
    assert_same(got, want)


def test_hot_key_is_spread(spark):
    """A key holding a third of the rows: same answer, and the key is cut into pieces."""
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    hot = orders.select("o_orderkey", "o_orderdate",
                        F.when(F.col("o_orderstatus") == "P", F.lit(-1)).otherwise(F.col("o_custkey")).alias("k"))
    got = sessionize(hot, "k", "o_orderdate", (15,), tiebreak=["o_orderkey"])
    want = sessions_naive(hot, "k", "o_orderdate", (15,), tiebreak=["o_orderkey"])
    assert_same(got, want)
    pieces = find_pieces(hot, ["k"], [F.col("o_orderdate"), F.col("o_orderkey")])
    assert pieces.assign(hot).where("k = -1").select("_p").distinct().count() > 1


def test_copies_expand_in_blocks(spark, monkeypatch):
    """Units of identical rows larger than a block are re-expanded block by block."""
    import caretrail.operators.sessions as sessions_mod
    monkeypatch.setattr(sessions_mod, "EXPAND_BLOCK", 2)
    rows = copy_rows() + [(2, "a", d("2024-01-16 23:59:59"), "y")] * 3
    df = spark.createDataFrame(rows, SCHEMA)
    got = sessionize(df, "k", "t", (15, 30), tiebreak=["id"])
    want = sessions_naive(df, "k", "t", (15, 30), tiebreak=["id"])
    assert_same(got, want)
    assert got.where("id = 2").count() == 6
