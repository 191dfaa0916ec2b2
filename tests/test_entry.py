import __spark_entry__ as entry


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == len(set(df.columns))


def test_every_query_has_an_oracle():
    from caretrail.plans.registry import QUERIES
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_queries_run_on_smoke_data(spark):
    from tests.conftest import SMOKE
    for name, fn in entry.queries().items():
        df = fn(spark, SMOKE)
        assert len(df.columns) == len(set(df.columns)), name
        df.write.format("noop").mode("overwrite").save()
