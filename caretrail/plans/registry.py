"""The registered queries (one per operator on the driver's tables) and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from caretrail.plans import analogs, oracle_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "sessions_orders": analogs.sessions_orders,
    "sessions_events": analogs.sessions_events,
    "session_rollups_orders": analogs.session_rollups_orders,
    "first_touch_orders": analogs.first_touch_orders,
    "nearest_match_events": analogs.nearest_match_events,
    "nearest_match_copies_events": analogs.nearest_match_copies_events,
    "attribution_events": analogs.attribution_events,
    "attribution_all_events": analogs.attribution_all_events,
    "categorize_tickets": analogs.categorize_tickets,
    "users_customer": analogs.users_customer,
    "caller_phones_tickets": analogs.caller_phones_tickets,
    "calls_events": analogs.calls_events,
    "policy_facts_orders": analogs.policy_facts_orders,
    "ticket_base_events": analogs.ticket_base_events,
    "ticket_report_events": analogs.ticket_report_events,
    "call_report_events": analogs.call_report_events,
    "session_window_rollups_orders": analogs.session_window_rollups_orders,
}

ORACLES: dict[str, Callable[[], str]] = {
    "sessions_orders": oracle_sql.sessions_orders,
    "sessions_events": oracle_sql.sessions_events,
    "session_rollups_orders": oracle_sql.session_rollups_orders,
    "first_touch_orders": oracle_sql.first_touch_orders,
    "nearest_match_events": oracle_sql.nearest_match_events,
    "nearest_match_copies_events": oracle_sql.nearest_match_copies_events,
    "attribution_events": oracle_sql.attribution_events,
    "attribution_all_events": oracle_sql.attribution_all_events,
    "categorize_tickets": oracle_sql.categorize_tickets,
    "users_customer": oracle_sql.users_customer,
    "caller_phones_tickets": oracle_sql.caller_phones_tickets,
    "calls_events": oracle_sql.calls_events,
    "policy_facts_orders": oracle_sql.policy_facts_orders,
    "ticket_base_events": oracle_sql.ticket_base_events,
    "ticket_report_events": oracle_sql.ticket_report_events,
    "call_report_events": oracle_sql.call_report_events,
    "session_window_rollups_orders": oracle_sql.session_window_rollups_orders,
}
