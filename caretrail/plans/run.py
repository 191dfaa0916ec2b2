"""Run the reports on domain tables stored as parquet (or any Spark format).

    python -m caretrail.plans.run --tables /data/care --out /data/reports [--format parquet]
    python -m caretrail.plans.run --database care --out /data/reports

``--tables`` holds one folder per domain table, ``--database`` is a catalog database with these tables; the
names are those of :mod:`caretrail.sources.domain` (users, tickets, ticket_metrics, customer_data, policy, policy_interruption, offer, quote, payments,
transaction, calls). Each report is written to ``<out>/<report>``. Stage tables are deleted once all reports are written; a
run that failed and is started again with the same ``--out`` and inputs takes up the stages it had finished.
"""

from __future__ import annotations

import argparse
import os

from caretrail.operators.policies import policy_facts
from caretrail.operators.users import normalize_users
from caretrail.plans.reports import Sources, call_report, ticket_report
from caretrail.plans.stages import StageManager
from caretrail.session import build_session
from caretrail.sources.domain import SCHEMAS, read_domain

REPORTS = {"ticket_report": ticket_report, "call_report": call_report}


def load_sources(spark, root: str, fmt: str | None = "parquet") -> Sources:
    """The domain tables below a folder, or in a catalog database when ``fmt`` is None."""
    def t(name: str):
        return read_domain(spark, name, f"{root}.{name}" if fmt is None else os.path.join(root, name), fmt)

    tables = {name: t(name) for name in SCHEMAS}
    # only persons who may have written are followed to their payments
    persons = normalize_users(tables["users"], ticket_report=False).select("dni_nie")
    facts = policy_facts(*(tables[n] for n in ("customer_data", "policy", "policy_interruption", "offer", "quote", "payments", "transaction")),
                         wanted=persons)
    inputs = {name: df for name, df in tables.items() if name not in ("calls", "ticket_metrics")}
    return Sources(users=tables["users"], tickets=tables["tickets"], policy_facts=facts, ticket_metrics=tables["ticket_metrics"],
                   calls=tables["calls"], inputs=inputs)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n\n")[0])
    where = ap.add_mutually_exclusive_group(required=True)
    where.add_argument("--tables")
    where.add_argument("--database")
    ap.add_argument("--out", required=True)
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--reports", nargs="*", default=list(REPORTS))
    args = ap.parse_args(argv)
    spark = build_session(app_name="caretrail-reports")
    src = load_sources(spark, args.tables, args.format) if args.tables else load_sources(spark, args.database, None)
    with StageManager(spark, run=args.out) as stages:
        for name in args.reports:
            REPORTS[name](src, stages=stages).write.mode("overwrite").parquet(os.path.join(args.out, name))


if __name__ == "__main__":
    main()
