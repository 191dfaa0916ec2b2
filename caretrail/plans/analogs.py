"""Operators run on the driver's tables (see FIXTURES.md §3 for the mapping).

Each function takes ``(spark, sf_dir)`` and returns a DataFrame (the two reports write their shared stages while being built) over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caretrail.operators.sessions import sessionize
from caretrail.sources.tables import read_table

ORDER_GAPS = (15, 30, 60)
EVENT_GAPS = (1, 2, 3)


def sessions_orders(spark: SparkSession, root: str) -> DataFrame:
    """U13 on orders: repeat-contact sessions per customer at 15/30/60 days."""
    orders = read_table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return sessionize(orders, "o_custkey", "o_orderdate", ORDER_GAPS, tiebreak=["o_orderkey"], tiebreak_unique=True,
                      count_name="num_calls", number_fmt="n_call_{gap}", label_fmt="client_{gap}")


def sessions_events(spark: SparkSession, root: str) -> DataFrame:
    """U13 on events: sessions per user at 1/2/3 days (events span one month)."""
    ev = read_table(spark, root, "events").select("event_id", "user_id", "ts")
    return sessionize(ev, "user_id", "ts", EVENT_GAPS, tiebreak=["event_id"], tiebreak_unique=True,
                      count_name="num_contacts", number_fmt="n_contact_{gap}", label_fmt="client_{gap}")


def session_rollups_orders(spark: SparkSession, root: str) -> DataFrame:
    """U14 on orders: per-session first date, count, first priority and status.

    Orders still in status 'P' carry no customer key (NULL), like tickets without a requester:
    a NULL key holding about a third of all rows, whose sessions collapse into one rollup group.
    """
    orders = read_table(spark, root, "orders").select(
        "o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus",
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("client_key"))
    return sessionize(orders, "client_key", "o_orderdate", ORDER_GAPS, tiebreak=["o_orderkey"], tiebreak_unique=True,
                      count_name="num_calls", number_fmt="n_call_{gap}", label_fmt="client_{gap}",
                      lag_name=None, diff_name=None,
                      first_ts_fmt="first_call_date_{gap}", group_count_fmt="Num_calls_{gap}",
                      firsts={"first_user_client_{gap}": "o_orderpriority",
                              "first_number_name_client_{gap}": "o_orderstatus"})


def _epoch(col: str):
    return F.unix_timestamp(F.col(col))


def first_touch_orders(spark: SparkSession, root: str) -> DataFrame:
    """U12 on orders: first priority per (customer, status) by (date, key).

    Orders in status 'P' carry no customer (NULL), like unconverted tickets without a policy
    number: one NULL group with about a third of all rows.
    """
    from caretrail.operators.first_touch import first_touch
    orders = read_table(spark, root, "orders").select(
        F.col("o_orderkey").alias("id"), "o_orderdate", "o_orderpriority", "o_orderstatus",
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("policy_key"))
    out = first_touch(orders, ["policy_key", "o_orderstatus"], ["o_orderdate"],
                      {"first_priority": "o_orderpriority"}, tiebreak=["id"])
    return out.select("id", "policy_key", "o_orderstatus", "first_priority")


def _event_calls(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type") == "click").select(
        F.col("event_id").alias("call_id"), F.col("user_id").alias("from_to_join"),
        _epoch("ts").alias("answered_at_utc_unix"))


def _event_tickets(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type") == "error").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("zdk_phone_to_join"),
        _epoch("ts").alias("ticket_created_at_unix"))


def nearest_match_events(spark: SparkSession, root: str) -> DataFrame:
    """U17 on events: clicks are calls, errors are tickets, the user id is the phone."""
    from caretrail.operators.matching import match_calls_to_tickets
    ev = read_table(spark, root, "events")
    m = match_calls_to_tickets(_event_calls(ev), _event_tickets(ev), call_id="call_id", call_key="from_to_join",
                               call_time="answered_at_utc_unix", ticket_key="zdk_phone_to_join",
                               ticket_time="ticket_created_at_unix")
    return m.withColumn("ranking_ticket_id", F.lit(1).cast("bigint"))


def nearest_match_copies_events(spark: SparkSession, root: str) -> DataFrame:
    """U17 with both of its argmin steps: tickets tied to several policies come in copies, and each ticket that won
    a call keeps one row. Errors are tickets; every third has two copies, every seventh three."""
    from caretrail.operators.matching import match_calls_to_tickets, one_row_per
    ev = read_table(spark, root, "events")
    copies = F.when(F.col("id") % 7 == 0, 3).when(F.col("id") % 3 == 0, 2).otherwise(1)
    tickets = (_event_tickets(ev).withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
               .withColumn("policy_number", F.concat(F.lit("P"), (F.col("id") % 10 * 7 % 10 + F.lit(4) - F.col("copy")).cast("string"))).drop("copy"))
    m = match_calls_to_tickets(_event_calls(ev), tickets, call_id="call_id", call_key="from_to_join",
                               call_time="answered_at_utc_unix", ticket_key="zdk_phone_to_join",
                               ticket_time="ticket_created_at_unix")
    return one_row_per(m, "id", ["dif_between_call_and_ticket", "aircall_id"])


def _event_policies(ev: DataFrame) -> DataFrame:
    """Purchases as policies; an interruption follows ``floor(value)`` hours later when value >= 40."""
    return ev.where(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("dni_nie"),
        F.concat(F.lit("POL"), F.col("event_id").cast("string")).alias("policy_number"),
        F.col("ts").alias("purchased_at"),
        F.when(F.col("value") >= 40,
               F.col("ts") + F.make_dt_interval(F.lit(0), F.floor("value").cast("int"))).alias("interrupted_at"))


def attribution_events(spark: SparkSession, root: str) -> DataFrame:
    """U4 + U5 + U10 on events: errors are tickets, purchases are policies, same user."""
    from caretrail.operators.attribution import attribute_purchases, conversion_flags
    ev = read_table(spark, root, "events")
    tickets = ev.where(F.col("event_type") == "error").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("dni_nie"), F.col("ts").alias("created_at"))
    att = attribute_purchases(tickets, _event_policies(ev))
    # Intervals leave as whole seconds between epoch seconds (portable to the oracle).
    att = att.join(tickets.select("id", "created_at"), "id")
    att = att.withColumns({
        "dif_purchase_seconds": F.abs(_epoch("purchased_at") - _epoch("created_at")),
        "dif_interrupted_seconds": F.abs(_epoch("interrupted_at") - _epoch("created_at")),
    }).drop("dif_between_ticket_and_purchase", "dif_between_ticket_and_interrupted", "created_at")
    return conversion_flags(att)


def attribution_all_events(spark: SparkSession, root: str) -> DataFrame:
    """U4 + U10 on events: every purchase of the same user within 14 days after an error."""
    from caretrail.operators.attribution import conversion_flags, purchases_within
    ev = read_table(spark, root, "events")
    tickets = ev.where(F.col("event_type") == "error").select(
        F.struct(F.col("event_id").alias("id"), F.col("ts").alias("created_at")).alias("ticket"), F.col("user_id").alias("dni_nie"), F.col("ts").alias("created_at"))
    pairs = purchases_within(tickets, _event_policies(ev), ticket_id="ticket")
    return conversion_flags(pairs.withColumns({
        "id": F.col("ticket.id"),
        "dif_purchase_seconds": F.abs(_epoch("purchased_at") - _epoch("ticket.created_at")),
        "dif_interrupted_seconds": F.abs(_epoch("interrupted_at") - _epoch("ticket.created_at")),
    }).drop("ticket", "dif_between_ticket_and_purchase", "dif_between_ticket_and_interrupted"))


# ---- operators on domain-shaped tables derived from the driver's tables -------------------------

def categorize_tickets(spark: SparkSession, root: str) -> DataFrame:
    """U8 both rulesets, U7 channel rewrite, U9 mail flag on tickets derived from events."""
    from caretrail.functions.categories import CALL_INCIDENTS, TICKET_INCIDENTS
    from caretrail.functions.text import mail_seen, rewrite_channel
    from caretrail.operators.categorize import categorize
    from caretrail.plans import analog_tables as at
    t = at.tickets(spark, root).select("id", "tipo_de_incidencia", "channel", "description", "tags")
    t = categorize(t, "tipo_de_incidencia", TICKET_INCIDENTS, "incidencia_grouped")
    t = categorize(t, "tipo_de_incidencia", CALL_INCIDENTS, "incidencia_grouped_call")
    return t.select("id", "tipo_de_incidencia", "incidencia_grouped", "incidencia_grouped_call",
                    rewrite_channel("channel", "description").alias("channel"), mail_seen("tags").alias("mail_seen"))


def users_customer(spark: SparkSession, root: str) -> DataFrame:
    """U2 + U1 on users derived from customer (the call report's variant keeps organization and url)."""
    from caretrail.operators.users import normalize_users
    from caretrail.plans import analog_tables as at
    return normalize_users(at.users(spark, root), ticket_report=False)


def caller_phones_tickets(spark: SparkSession, root: str) -> DataFrame:
    """U6: caller phone from the description, else the user's phone, for every ticket."""
    from caretrail.functions.phones import caller_phone, phone_to_join, user_phone
    from caretrail.plans import analog_tables as at
    t = at.tickets(spark, root).select("id", "requester_id", "description")
    u = at.users(spark, root).select(F.col("id").alias("requester_id"), "phone")
    j = t.join(u, "requester_id", "left")
    return j.select("id", caller_phone("description").alias("CallerPhoneNumber"),
                    user_phone("phone").alias("user_phone"),
                    phone_to_join(caller_phone("description"), user_phone("phone")).alias("zdk_phone_to_join"))


def calls_events(spark: SparkSession, root: str) -> DataFrame:
    """U15 + U16: normalized and filtered calls derived from click/view events."""
    from caretrail.operators.calls import filter_calls, normalize_calls
    from caretrail.plans import analog_tables as at
    return filter_calls(normalize_calls(at.calls(spark, root)))


def policy_facts_orders(spark: SparkSession, root: str) -> DataFrame:
    """U3 on orders: customers -> policies (orders) -> interruption (an order's first returned line)
    -> offers -> quotes -> payments (one per line of the order, so payment copies) -> transactions."""
    from caretrail.operators.policies import policy_facts
    from caretrail.plans.analog_tables import dni_of
    cust = read_table(spark, root, "customer")
    orders = read_table(spark, root, "orders")
    lines = read_table(spark, root, "lineitem")
    customer_data = cust.select(F.col("c_custkey").alias("application_id"),
                                F.lower(dni_of("c_custkey")).alias("policyholder_dni"))
    number = (F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("POL"), F.col("o_orderkey").cast("string")))
               .when(F.col("o_orderstatus") == "O", F.concat(F.lit("Q"), (F.col("o_orderkey") % 1000).cast("string"))))
    policy = orders.select(F.col("o_custkey").alias("application_id"), F.col("o_orderkey").alias("policy_id"),
                           F.col("o_orderkey").alias("offer_id"), (F.col("o_orderkey") % 4).alias("quote_id"),
                           number.alias("policy_number"), F.col("o_orderdate").alias("purchased_at"),
                           (F.col("o_orderkey") % 3).cast("int").alias("renewal_order"))
    interruption = (lines.where(F.col("l_returnflag") == "R").groupBy(F.col("l_orderkey").alias("policy_id"))
                         .agg(F.min("l_shipdate").alias("occurred_on")))
    offer = orders.select(F.col("o_orderkey").alias("offer_id"),
                          F.concat(F.lit("OF"), F.col("o_orderkey").cast("string")).alias("customer_facing_id"))
    quote = (orders.groupBy(F.col("o_custkey").alias("application_id"), (F.col("o_orderkey") % 4).alias("quote_id"))
                   .agg(F.min("o_orderpriority").alias("source")))
    payments = lines.select(
        F.concat(F.lit("OF"), F.col("l_orderkey").cast("string")).alias("offer_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_id"))
    transaction = lines.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_id"),
                               F.concat(F.col("l_linestatus"), F.col("l_returnflag")).alias("purchase_channel"))
    return policy_facts(customer_data, policy, interruption, offer, quote, payments, transaction)


def _seconds_instead_of_intervals(df: DataFrame, created: str = "created_at") -> DataFrame:
    return df.withColumns({
        "dif_purchase_seconds": F.abs(_epoch("purchased_at") - _epoch(created)),
        "dif_interrupted_seconds": F.abs(_epoch("interrupted_at") - _epoch(created)),
    }).drop("dif_between_ticket_and_purchase", "dif_between_ticket_and_interrupted")


def ticket_base_events(spark: SparkSession, root: str) -> DataFrame:
    """U11: the ticket report's base on the derived tables."""
    from caretrail.plans import analog_tables as at
    from caretrail.plans.reports import ticket_base
    return _seconds_instead_of_intervals(ticket_base(at.sources(spark, root), ticket_report=True))


def ticket_report_events(spark: SparkSession, root: str) -> DataFrame:
    """U18: the ticket report on the derived tables."""
    from caretrail.plans import analog_tables as at
    from caretrail.plans.reports import ticket_report
    return _seconds_instead_of_intervals(ticket_report(at.sources(spark, root)))


def call_report_events(spark: SparkSession, root: str) -> DataFrame:
    """U19: the call report on the derived tables."""
    from caretrail.plans import analog_tables as at
    from caretrail.plans.reports import call_report
    return _seconds_instead_of_intervals(call_report(at.sources(spark, root)))


def session_window_rollups_orders(spark: SparkSession, root: str) -> DataFrame:
    """U14 as a table, on orders at 15 days: one row per customer session with its bounds, first date,
    size and first priority (the streaming route gives the same rows)."""
    from caretrail.operators.sessions import session_table
    orders = read_table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    return session_table(orders, "o_custkey", "o_orderdate", 15, firsts={"first_priority": "o_orderpriority"},
                         tiebreak=["o_orderkey"], tiebreak_unique=True)
