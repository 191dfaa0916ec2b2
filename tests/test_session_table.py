"""The streamed session table against the batch one: out-of-order batches, restarts, repeated batches, hot and NULL keys."""

import datetime as dt
import random
import tempfile
import time

import pytest

from caretrail.operators.sessions import session_table
from caretrail.streaming.session_table import SessionTable, start_session_table
from tests.helpers import assert_same

SCHEMA = "id long, k string, t timestamp_ntz, v string"
BASE = dt.datetime(2024, 1, 1)


def rows_of(seed, n=240):
    rng = random.Random(seed)
    return [(seed * 1000 + i, rng.choice(["hot"] * 4 + ["a", "b", "c", None]), rng.choice([None] + [BASE + dt.timedelta(hours=rng.randrange(24 * 160))] * 14),
             rng.choice(["x", "y", None])) for i in range(n)]


def table_at(spark, path):
    return SessionTable(spark, path, "k", "t", 2, firsts={"first_v": "v"}, tiebreak=["id"], tiebreak_unique=True, buckets=5)


def batch(df):
    return session_table(df, "k", "t", 2, tiebreak=["id"], tiebreak_unique=True, firsts={"first_v": "v"})


def test_merged_batches_equal_the_batch_table(spark):
    path = tempfile.mkdtemp(prefix="caretrail-sessions-") + "/table"
    table = table_at(spark, path)
    assert table.read() is None
    parts = [spark.createDataFrame(rows_of(s), SCHEMA) for s in (3, 1, 2)]
    so_far = None
    for n, part in enumerate(parts):
        table.merge(part, n)
        so_far = part if so_far is None else so_far.unionByName(part)
        assert_same(table.read(), batch(so_far))
    table.merge(parts[0].limit(0), 3)  # an empty batch changes nothing
    assert_same(table.read(), batch(so_far))
    assert all(len(v) <= 2 for v in table.versions().values())


def test_a_batch_may_run_again(spark):
    """A version that was written, or only begun, is replaced by running its batch once more."""
    path = tempfile.mkdtemp(prefix="caretrail-sessions-") + "/table"
    table = table_at(spark, path)
    first, second = (spark.createDataFrame(rows_of(s), SCHEMA) for s in (5, 6))
    table.merge(first, 0)
    table.merge(second, 1)
    table.merge(second, 1)
    assert_same(table.read(), batch(first.unionByName(second)))
    # the driver is lost before the version is complete: the state before it counts
    at, fs = table._fs()
    fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/v=1/_SUCCESS"), False)
    assert_same(table_at(spark, path).read(), batch(first))
    table_at(spark, path).merge(second, 1)
    assert_same(table.read(), batch(first.unionByName(second)))


def test_stream_with_restart(spark):
    src, path, place = (tempfile.mkdtemp(prefix="caretrail-stream-") + x for x in ("/in", "/table", "/checkpoint"))
    table, everything = table_at(spark, path), None
    for seeds in ((11, 9), (10, 12)):  # files come in no order of time
        for s in seeds:
            df = spark.createDataFrame(rows_of(s), SCHEMA)
            df.coalesce(1).write.mode("append").parquet(src)
            time.sleep(1.1)  # files are taken in order of modification
            everything = df if everything is None else everything.unionByName(df)
        q = start_session_table(spark, src, everything.schema, table, name="contacts", checkpoint_location=place, max_files_per_trigger=1, available_now=True)
        assert q.awaitTermination(240)
        assert_same(table_at(spark, path).read(), batch(everything))


@pytest.mark.parametrize("rows", [[], [(1, None, None, "x")], [(1, "a", None, "x"), (2, "a", None, "y")]])
def test_awkward_batches(spark, rows):
    table = table_at(spark, tempfile.mkdtemp(prefix="caretrail-sessions-") + "/table")
    df = spark.createDataFrame(rows, SCHEMA)
    table.merge(df, 0)
    got = table.read()
    assert (got.count() if got is not None else 0) == batch(df).count()
    if rows:
        assert_same(got, batch(df))
