"""Both reports on the trap fixtures, against the DuckDB oracle of the same shape as the driver check."""

import os
import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caretrail.plans import oracle_sql
from caretrail.plans.analogs import _seconds_instead_of_intervals
from caretrail.plans.reports import Sources, call_report, ticket_base, ticket_report
from tests import domain_fixtures as fx
from tools.check_oracle import rows_of


def ntz(df):
    """Wall-clock timestamps (timestamp_ntz), as the driver's parquet tables carry them."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType)
                       else F.col(f.name) for f in df.schema.fields])


def setup(spark, tables=None):
    tables = tables or {"users": fx.users(spark), "tickets": fx.tickets(spark), "policies": fx.policy_facts(spark),
                        "metrics": fx.metrics(spark), "calls": fx.calls(spark)}
    tables = {k: ntz(v) for k, v in tables.items()}
    root = tempfile.mkdtemp(prefix="caretrail-fixtures-")
    con = duckdb.connect()
    for name, df in tables.items():
        path = os.path.join(root, name)
        df.write.parquet(path)
        con.execute(f"CREATE VIEW fx_{name} AS SELECT * FROM read_parquet('{path}/*.parquet')")
    src = Sources(users=tables["users"], tickets=tables["tickets"], policy_facts=tables["policies"],
                  ticket_metrics=tables["metrics"], calls=tables["calls"])
    sql_src = {k: f"SELECT * FROM fx_{k}" for k in tables}
    return src, sql_src, con


def check(spark_df, con, sql):
    got = spark_df.toPandas()
    want = con.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)
    return len(got)


def test_reports_match_oracle_on_fixtures(spark):
    src, sql_src, con = setup(spark)
    n = check(_seconds_instead_of_intervals(ticket_base(src, ticket_report=True)), con,
              oracle_sql.ticket_base_events(sql_src))
    assert n == 7
    n = check(_seconds_instead_of_intervals(ticket_report(src, checkpoint=False)), con,
              oracle_sql.ticket_report_events(sql_src))
    assert n == 5
    n = check(_seconds_instead_of_intervals(call_report(src, checkpoint=False)), con,
              oracle_sql.call_report_events(sql_src))
    assert n == 3


@pytest.mark.parametrize("seed", [1, 2])
def test_reports_match_oracle_on_random_tables(spark, seed):
    from tests.fuzz_fixtures import tables
    src, sql_src, con = setup(spark, tables(spark, seed))
    assert check(_seconds_instead_of_intervals(ticket_base(src, ticket_report=True)), con,
                 oracle_sql.ticket_base_events(sql_src)) > 50
    assert check(_seconds_instead_of_intervals(ticket_report(src, checkpoint=False)), con,
                 oracle_sql.ticket_report_events(sql_src)) > 15   # claim or NULL subjects leave
    assert check(_seconds_instead_of_intervals(call_report(src, checkpoint=False)), con,
                 oracle_sql.call_report_events(sql_src)) > 20
