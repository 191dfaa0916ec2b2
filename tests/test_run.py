import os
import subprocess
import sys
import tempfile

import pytest
from pyspark.sql import functions as F

from caretrail.plans import reports, run
from caretrail.plans.stages import StageManager, fingerprint
from caretrail.sources import domain
from caretrail.sources.bucketing import save_bucketed
from tests import domain_fixtures as fx
from tests.helpers import assert_same


def domain_tables(spark):
    ts = fx.ts
    tables = {
        "users": fx.users(spark), "tickets": fx.tickets(spark), "ticket_metrics": fx.metrics(spark),
        "calls": fx.calls(spark),
        "customer_data": spark.createDataFrame([(1, "12345678a"), (2, "x1234567b")], domain.CUSTOMER_DATA),
        "policy": spark.createDataFrame([(1, 10, 100, 7, "POL000001", ts("2024-03-01 10:00:00"), 0),
                                         (2, 20, 200, 8, "POL000003", ts("2024-03-12 00:00:00"), 0)], domain.POLICY),
        "policy_interruption": spark.createDataFrame([(10, ts("2024-03-05 00:00:00"))], domain.POLICY_INTERRUPTION),
        "offer": spark.createDataFrame([(100, "OF100"), (200, "OF200")], domain.OFFER),
        "quote": spark.createDataFrame([(1, 7, "pcw"), (2, 8, None)], domain.QUOTE),
        "payments": spark.createDataFrame([("OF100", 1000), ("OF100", 1001)], domain.PAYMENTS),
        "transaction": spark.createDataFrame([(1000, "web"), (1001, "web")], domain.TRANSACTION),
    }
    tables["ticket_metrics"] = tables["ticket_metrics"].withColumn("group_name", F.lit("north"))
    tables["calls"] = tables["calls"].withColumn("queue_name", F.lit("q1"))
    return tables


def check_reports(tr, cr):
    rows = {r.id: r for r in tr.collect()}
    # ticket 101: policy bought at creation, paid twice -> two tied copies
    assert tr.where("id = 101").count() == 2 and rows[101].policy_number == "POL000001"
    assert rows[101].interrupted_7days == "POL000001" and rows[101].pcw_source == "pcw"
    assert cr.count() == 3
    # columns that the schemas don't name reach the reports
    assert tr.where("group_name = 'north'").count() > 0 and cr.where("queue_name = 'q1'").count() == 3


def stage_folders():
    """Stage folders of runs below this session's shared folder."""
    from pyspark.sql import SparkSession
    top = StageManager(SparkSession.getActiveSession(), "any").top.removeprefix("file://").removeprefix("file:")
    return set(os.listdir(top)) if os.path.isdir(top) else set()


def test_run_reports_from_folders(spark):
    root = tempfile.mkdtemp(prefix="caretrail-domain-")
    out = tempfile.mkdtemp(prefix="caretrail-out-")
    for name, df in domain_tables(spark).items():
        df.write.parquet(os.path.join(root, name))
    before = stage_folders()
    run.main(["--tables", root, "--out", out])
    check_reports(spark.read.parquet(os.path.join(out, "ticket_report")), spark.read.parquet(os.path.join(out, "call_report")))
    assert stage_folders() <= before  # nothing of the run is left


def test_run_reports_from_catalog_tables(spark):
    """The reports on tables by name, saved bucketed by this session; equal to the reports from folders."""
    root, out, place = (tempfile.mkdtemp(prefix=f"caretrail-{x}-") for x in ("folders", "out", "database"))
    tables = domain_tables(spark)
    spark.sql(f"CREATE DATABASE care LOCATION '{place}'")
    try:
        save_bucketed(tables, "care", 4)
        run.main(["--database", "care", "--out", f"{out}/named"])
        for name, df in tables.items():
            df.write.parquet(os.path.join(root, name))
        run.main(["--tables", root, "--out", f"{out}/folders"])
        named, folders = ({r: spark.read.parquet(f"{out}/{kind}/{r}") for r in run.REPORTS} for kind in ("named", "folders"))
        check_reports(named["ticket_report"], named["call_report"])
        for r in run.REPORTS:
            assert_same(named[r], folders[r])
        # bucketed sides are joined as they lie
        customers, policies = (domain.read_domain(spark, t, f"care.{t}", None) for t in ("customer_data", "policy"))
        plan = customers.join(policies, "application_id", "left")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("Bucketed: true") == 2
        moved = [src.policy_facts._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
                 for src in (run.load_sources(spark, "care", None), run.load_sources(spark, root))]
        assert moved[0] < moved[1], moved
    finally:
        spark.sql("DROP DATABASE care CASCADE")


def test_stages_are_shared_and_taken_up_again(spark):
    """Two reports write their common stage once; a run that failed leaves its stages, and the next one uses them."""
    root = tempfile.mkdtemp(prefix="caretrail-stages-")
    for name, df in domain_tables(spark).items():
        df.write.parquet(os.path.join(root, name))
    src, before, name = run.load_sources(spark, root), stage_folders(), root  # a run is named by its folder
    with pytest.raises(RuntimeError), StageManager(spark, name) as first:
        reports.ticket_report(src, stages=first).count()
        assert first.written == 1
        reports.call_report(src, stages=first).count()
        assert first.written == 3
        raise RuntimeError("the driver is lost")
    assert stage_folders() - before
    src = run.load_sources(spark, root)
    with StageManager(spark, name) as again:
        rows = reports.call_report(src, stages=again).count()
        assert again.written == 0 and rows == 3
        # other inputs, other stages
        src.tickets.where("id <> 101").write.parquet(f"{root}/fewer")
        src.tickets = src.inputs["tickets"] = domain.read_domain(spark, "tickets", f"{root}/fewer")
        reports.ticket_report(src, stages=again).count()
        assert again.written == 1
    assert stage_folders() <= before
    in_memory = fingerprint({"users": fx.users(spark)}), fingerprint({"users": fx.users(spark)})
    assert in_memory[0] != in_memory[1]


def test_conform_casts_to_declared_schema(spark):
    df = spark.createDataFrame([("7", "1", "2024-01-01 10:00:00", "extra")],
                               "id string, requester_id string, created_at string, other string")
    with pytest.warns(UserWarning, match="description"):
        out = domain.conform(df, "tickets")
    types = dict(out.dtypes)
    assert types["id"] == "bigint" and types["created_at"] == "timestamp" and out.columns[-1] == "other"


def test_missing_key_column_is_refused(spark):
    with pytest.raises(ValueError, match="requester_id"):
        domain.conform(spark.createDataFrame([(1,)], "id long"), "tickets")


def test_catalog_table(spark):
    spark.createDataFrame([(1, "a", "more")], "id long, notes string, other string").createOrReplaceTempView("users_by_name")
    with pytest.warns(UserWarning):
        assert domain.read_domain(spark, "users", "users_by_name", None).columns[-1] == "other"


def test_submitted_settings_win():
    """Master, partitions and thresholds given as submit arguments survive build_session."""
    code = ("from caretrail.session import build_session; s = build_session(); c = s.conf.get; "
            "print('GOT', s.sparkContext.master, c('spark.sql.shuffle.partitions'), c('spark.sql.autoBroadcastJoinThreshold'))")
    args = "--master local[2] --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=777 --conf spark.sql.autoBroadcastJoinThreshold=20m pyspark-shell"
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], cwd=top, env=os.environ | {"PYSPARK_SUBMIT_ARGS": args}, capture_output=True, text=True, timeout=120)
    assert "GOT local[2] 777 20m" in out.stdout, out.stderr[-500:]
