"""The driver's correctness gate, in the test suite: every registered query against its DuckDB
oracle on the sf0.001 tables (column names, SQL types, order-insensitive values)."""

import os

import duckdb

import __spark_entry__ as entry
from caretrail.sources.tables import TABLES
from tests.conftest import SMOKE
from tools.check_oracle import rows_of, type_mismatches


def test_every_query_matches_its_oracle(spark):
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(SMOKE, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    sqls = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if name not in sqls:
            continue
        sdf = fn(spark, SMOKE)
        rel = con.sql(sqls[name])
        got, want = sdf.toPandas(), rel.df()
        assert sorted(got.columns) == sorted(want.columns), name
        assert not type_mismatches(sdf, rel), (name, type_mismatches(sdf, rel))
        assert rows_of(got) == rows_of(want), name
