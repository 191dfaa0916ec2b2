"""Plan properties of every reporting query, and of each stage that a report writes on its way."""

import re

from caretrail.plans import registry, reports
from tests.conftest import SMOKE
from tools.plan_report import summary


def test_no_python_no_cartesian_and_pushdown(spark, monkeypatch):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    plans, write = [], reports.materialize

    def note(name, df):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))

    for name, fn in registry.QUERIES.items():
        monkeypatch.setattr(reports, "materialize", lambda df, *rest, name=name: (note(f"{name} (stage)", df), write(df, *rest))[1])
        note(name, fn(spark, SMOKE))
    stages = [name for name, _ in plans if name.endswith("(stage)")]
    assert stages.count("ticket_report_events (stage)") == 1 and stages.count("call_report_events (stage)") == 3
    for name, plan in plans:
        s = summary(plan)
        assert s["python"] == 0 and s["cartesian"] == 0, name
        for line in plan.splitlines():
            if "FileScan" not in line:
                continue
            data = re.search(r"DataFilters: \[([^\]]*)\]", line)
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
            # a predicate on a plain column must reach the parquet reader
            plain = re.search(r"isnotnull\(\w+#\d+L?\)|\(\w+#\d+L? (=|<|>|<=|>=) ", data.group(1)) if data else None
            if plain:
                assert pushed and pushed.group(1), (name, line[:200])
