"""Property tests: the rewritten operators equal their source-shaped forms on random small tables."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from caretrail.operators.first_touch import first_touch
from caretrail.operators.sessions import sessionize
from tools.naive import first_touch_naive, rollups_naive, sessions_naive
from tests.helpers import assert_same

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("k", T.StringType()),
                       T.StructField("t", T.TimestampNTZType()), T.StructField("v", T.StringType())])
BASE = dt.datetime(2024, 1, 1)

# id repeats make copies; the value is a function of the id, so the first row's value is
# determined even where the window form's order among copies is not
row = st.tuples(
    st.integers(0, 40),                                    # id
    st.sampled_from(["a", "b", None]),                     # key, with NULL
    st.one_of(st.none(), st.integers(0, 200 * 24).map(lambda h: BASE + dt.timedelta(hours=h))),
).map(lambda r: (r[0], r[1], r[2], ["x", "y", None][r[0] % 3]))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=1, max_size=40))
def test_sessions_random(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = sessionize(df, "k", "t", (2, 15), tiebreak=["id"], first_ts_fmt="first_{gap}",
                     group_count_fmt="cnt_{gap}", firsts={"fv_{gap}": "v"})
    want = sessions_naive(df, "k", "t", (2, 15), tiebreak=["id"])
    for g in (2, 15):
        want = rollups_naive(want, f"client_{g}", "t", {f"fv_{g}": "v"}, tiebreak=["id"],
                             first_ts_name=f"first_{g}", count_name=f"cnt_{g}")
    assert_same(got, want)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=1, max_size=40))
def test_first_touch_random(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = first_touch(df, ["k"], ["t"], {"f": "v"}, tiebreak=["id"])
    want = first_touch_naive(df, ["k"], ["t", "id"], "v", "f")
    assert_same(got, want)


ev_row = st.tuples(st.integers(0, 3), st.integers(0, 60000))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ev_row, min_size=1, max_size=30), st.lists(ev_row, min_size=1, max_size=30))
def test_match_random(spark, calls, tickets):
    from caretrail.operators.matching import match_calls_to_tickets
    from tools.naive import match_naive
    c = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(calls)], "call_id long, ph int, a long")
    k = spark.createDataFrame([(100 + i, p, t) for i, (p, t) in enumerate(tickets)], "id long, tph int, b long")
    got = match_calls_to_tickets(c, k, call_id="call_id", call_key="ph", call_time="a",
                                 ticket_key="tph", ticket_time="b")
    rows = got.collect()
    assert len({r.id for r in rows}) == len(rows)                       # each ticket at most once
    assert all(r.dif_between_call_and_ticket < 10000 for r in rows)
    want = match_naive(c, k, call_id="call_id", call_key="ph", call_time="a", ticket_id="id",
                       ticket_key="tph", ticket_time="b").drop("ranking_ticket_id")
    assert_same(got, want)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=1, max_size=40))
def test_session_counts_sum_to_rows(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = sessionize(df, "k", "t", (15,), tiebreak=["id"], group_count_fmt="cnt_{gap}", label_fmt="label_{gap}")
    per_key = {}
    for r in got.collect():
        per_key.setdefault(r.k, set()).add((r.n_contact_15, r.cnt_15))
    for key, sessions in per_key.items():
        n_rows = sum(1 for x in rows if x[1] == key)
        if key is None:       # NULL key: all its sessions form one rollup group
            assert all(c == n_rows for _, c in sessions)
        else:
            assert sum(c for _, c in sessions) == n_rows
