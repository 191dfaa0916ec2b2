"""Source-shaped plans of the custom operators (P1-P4 "naive" forms).

They follow the source queries literally: windows partitioned by the whole key or session label,
all phone / customer pairs, argmin by self-join. They are kept for equivalence tests and for the
bench's baseline column, never used by the reports: each of them puts a hot key in one task or
forms all pairs within a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caretrail.functions.timeutil import whole_days


def sessions_naive(df: DataFrame, key: str, ts: str, gaps: Sequence[int], *, tiebreak: Sequence[str] = (),
                   count_name: str = "num_contacts", number_fmt: str = "n_contact_{gap}",
                   label_fmt: str = "client_{gap}") -> DataFrame:
    lag_w = Window.partitionBy(key).orderBy(F.col(ts), *[F.col(c) for c in tiebreak])
    sum_w = Window.partitionBy(key).orderBy(F.col(ts))  # default RANGE frame: peers share
    out = df.withColumn("lag", F.lag(ts).over(lag_w))
    out = out.withColumn("date_diff_lag", whole_days("lag", ts))
    for g in gaps:
        flag = F.when(F.col("lag").isNull() | (F.col("date_diff_lag") > g), 1).otherwise(0)
        out = out.withColumn(f"_f{g}", flag)
    out = out.withColumn(count_name, F.count(F.lit(1)).over(Window.partitionBy(key)))
    for g in gaps:
        out = out.withColumn(number_fmt.format(gap=g), F.sum(f"_f{g}").over(sum_w))
        out = out.withColumn(label_fmt.format(gap=g),
                             F.concat(F.col(key), F.lit("-"), F.col(number_fmt.format(gap=g))))
    return out.drop(*[f"_f{g}" for g in gaps])


def rollups_naive(df: DataFrame, label: str, ts: str, firsts: dict[str, str], *, tiebreak: Sequence[str] = (),
                  first_ts_name: str | None = None, count_name: str | None = None) -> DataFrame:
    w_all = Window.partitionBy(label)
    w = Window.partitionBy(label).orderBy(F.col(ts), *[F.col(c) for c in tiebreak])
    out = df
    if first_ts_name:
        out = out.withColumn(first_ts_name, F.min(ts).over(w_all))
    if count_name:
        out = out.withColumn(count_name, F.count(F.lit(1)).over(w_all))
    for name, col in firsts.items():
        out = out.withColumn(name, F.first(col).over(w))
    return out


def first_touch_naive(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*[F.col(c) for c in order])
    return df.withColumn(out, F.first(value).over(w))


def match_naive(calls: DataFrame, tickets: DataFrame, *, call_id: str, call_key: str, call_time: str,
                ticket_id: str, ticket_key: str, ticket_time: str, tolerance: int = 10000) -> DataFrame:
    pairs = (calls.join(tickets, calls[call_key] == tickets[ticket_key], "left")
                  .select(F.col(call_id).alias("aircall_id"),
                          F.abs(F.col(call_time) - F.col(ticket_time)).alias("dif_between_call_and_ticket"),
                          *[tickets[c] for c in tickets.columns]))
    best = pairs.groupBy("aircall_id").agg(F.min("dif_between_call_and_ticket").alias("dif_between_call_and_ticket"))
    kept = pairs.join(best, ["aircall_id", "dif_between_call_and_ticket"])
    w = Window.partitionBy(ticket_id).orderBy("dif_between_call_and_ticket", "aircall_id")
    ranked = kept.withColumn("ranking_ticket_id", F.row_number().over(w))
    return ranked.where((F.col("ranking_ticket_id") == 1) & (F.col("dif_between_call_and_ticket") < tolerance))


def attribution_naive(tickets: DataFrame, policies: DataFrame, *, ticket_id: str, ticket_key: str, created: str,
                      policy_key: str, purchased: str) -> DataFrame:
    pairs = (tickets.join(policies, tickets[ticket_key] == policies[policy_key], "left")
                    .where(F.col(purchased) >= F.col(created))
                    .withColumn("_dif", F.abs(F.col(purchased) - F.col(created))))
    best = pairs.groupBy(ticket_id).agg(F.min("_dif").alias("_dif"))
    return pairs.join(best, [ticket_id, "_dif"]).drop("_dif")


def horizon_columns(near: DataFrame, *, created: str, purchased: str, interrupted: str, horizons: Sequence[int] = (7, 14, 1, 3)) -> DataFrame:
    """The columns that the registered attribution query adds to its nearest purchases."""
    out = near
    for at, name in ((purchased, "policy_number"), (interrupted, "interrupted")):
        for d in horizons:
            within = F.col(at) < F.col(created) + F.make_dt_interval(F.lit(d))
            out = out.withColumn(f"{name}_{d}days", F.when(within, F.col("policy_number")))
    for d in horizons:
        out = out.withColumn(f"purchased_policy_{d}days", F.col(f"policy_number_{d}days").isNotNull().cast("int"))
    for at, days, secs in ((purchased, "days_difference", "dif_purchase_seconds"),
                           (interrupted, "days_difference_interruption", "dif_interrupted_seconds")):
        apart = F.unix_timestamp(at) - F.unix_timestamp(created)
        out = out.withColumn(days, F.floor(apart / 86400)).withColumn(secs, F.abs(apart))
    return out


# ---- the two reports, shaped like the source ------------------------------------------------------

def _base_naive(src, ticket_report: bool) -> DataFrame:
    """Ticket base: all later purchases of the ticket's customer, argmin by a self-join, the CASE ladder row by row."""
    from caretrail.functions.categories import CALL_INCIDENTS, TICKET_INCIDENTS, ladder
    from caretrail.functions.phones import caller_phone, phone_to_join, user_phone
    from caretrail.functions.text import mail_seen, rewrite_channel
    from caretrail.operators.users import normalize_users
    from caretrail.plans.reports import CLAIMS_FORM_ID, FLAGS

    users = normalize_users(src.users, ticket_report=ticket_report).select("requester_id", "dni_nie", "phone")
    tickets = src.tickets.join(users, "requester_id", "left")
    asked = tickets.select("id", F.col("created_at").alias("_created"), F.col("dni_nie").alias("_person"))
    pairs = (asked.join(src.policy_facts, F.col("_person") == F.col("dni_nie"), "left").where(F.col("purchased_at") >= F.col("_created"))
             .withColumn("_dif", F.abs(F.col("purchased_at") - F.col("_created"))))
    near = pairs.join(pairs.groupBy("id").agg(F.min("_dif").alias("_dif")), ["id", "_dif"])
    near = horizon_columns(near, created="_created", purchased="purchased_at", interrupted="interrupted_at").drop("_created", "_person", "_dif")
    caller, uphone = caller_phone("description"), user_phone("phone")
    own = [c for c in src.tickets.columns if not (ticket_report and c == "channel")]
    base = tickets.select(
        caller.alias("CallerPhoneNumber"), uphone.alias("user_phone"), phone_to_join(caller, uphone).alias("zdk_phone_to_join"),
        F.unix_timestamp("created_at").alias("ticket_created_at_unix"), *own,
        *([rewrite_channel("channel", "description").alias("channel"), mail_seen("tags").alias("mail_seen")] if ticket_report else []))
    base = base.withColumn("incidencia_grouped", ladder(F.col("tipo_de_incidencia"), TICKET_INCIDENTS if ticket_report else CALL_INCIDENTS))
    base = base.join(near, "id", "left").withColumns({f: F.coalesce(F.col(f), F.lit(0)) for f in FLAGS})
    return base.where(F.col("ticket_form_id") != F.lit(CLAIMS_FORM_ID))


def _touch_naive(base: DataFrame) -> DataFrame:
    from caretrail.plans.reports import CLAIM_SUBJECTS, FIRST_TOUCH_LEAD_DAYS
    lead = F.col("purchased_at") - F.make_dt_interval(F.lit(FIRST_TOUCH_LEAD_DAYS))
    rows = base.where(~F.col("subject").isin(*CLAIM_SUBJECTS) & (F.col("channel") != "api") & (F.col("incidencia_grouped") == "purchase support")
                      & ((lead <= F.col("created_at")) | F.col("purchased_at").isNull()))
    out = first_touch_naive(rows, ["policy_number", "renewal_order"], ["created_at", "id"], "assignee_id", "first_assignee_id_3_days_criteria")
    return out.select("id", "first_assignee_id_3_days_criteria")


def ticket_report_naive(src) -> DataFrame:
    from caretrail.functions.text import satisfaction_reason, satisfaction_score
    from caretrail.plans.reports import CLAIM_SUBJECTS
    base = _base_naive(src, True)
    firsts = {"first_agent_client_15": "assignee_id", "first_channel_client_15": "channel",
              "first_tipo_de_incidencia_client_15": "tipo_de_incidencia", "first_incidencia_grouped_client_15": "incidencia_grouped"}
    rows = base.where(F.col("channel") != "api").select("id", "requester_id", "created_at", *firsts.values())
    rec = rollups_naive(sessions_naive(rows, "requester_id", "created_at", (15,), tiebreak=["id"]), "client_15", "created_at", firsts,
                        tiebreak=["id"], first_ts_name="first_contact_date_15", count_name="Num_contacts_15")
    rec = rec.drop("requester_id", "created_at", *firsts.values())
    metrics = src.ticket_metrics.drop("ingested_at", "created_at").withColumnRenamed("updated_at", "_changed")
    out = (base.join(rec, "id", "left").join(_touch_naive(base), "id", "left").join(metrics, F.col("ticket_id") == F.col("id"), "left")
           .where(~F.col("subject").isin(*CLAIM_SUBJECTS)))
    return out.withColumns({"updated_at": F.greatest("_changed", "updated_at"), "Score": satisfaction_score("satisfaction_rating"),
                            "Reason": satisfaction_reason("satisfaction_rating")}).drop("_changed")


def call_report_naive(src, tolerance: int = 10000) -> DataFrame:
    from caretrail.functions.timeutil import ntz_from_epoch
    from caretrail.operators.calls import filter_calls, normalize_calls, report_calls
    base = _base_naive(src, False)
    calls = sessions_naive(filter_calls(normalize_calls(src.calls)), "client_number_calculated", "created_time_utc", (15, 30, 60), tiebreak=["call_id"],
                           count_name="num_calls", number_fmt="n_call_{gap}")
    for g in (15, 30, 60):
        calls = rollups_naive(calls, f"client_{g}", "created_time_utc", {f"first_user_client_{g}": "full_name", f"first_number_name_client_{g}": "number_name"},
                              tiebreak=["call_id"], first_ts_name=f"first_call_date_{g}", count_name=f"Num_calls_{g}")
    ringing = report_calls(calls).select(F.col("call_id").alias("aircall_id"), "from_to_join", "answered_at_utc_unix")
    pairs = ringing.join(base, F.col("from_to_join") == F.col("zdk_phone_to_join").try_cast("int"), "left")
    pairs = pairs.withColumn("dif_between_call_and_ticket", F.abs(F.col("answered_at_utc_unix") - F.col("ticket_created_at_unix")))
    pairs = pairs.drop("from_to_join", "answered_at_utc_unix")
    best = pairs.groupBy("aircall_id").agg(F.min("dif_between_call_and_ticket").alias("dif_between_call_and_ticket"))
    kept = pairs.join(best, ["aircall_id", "dif_between_call_and_ticket"])
    # the source leaves copies of a ticket untold apart; the package takes the smallest row
    w = Window.partitionBy("id").orderBy("dif_between_call_and_ticket", "aircall_id", "policy_number", "purchased_at")
    one = kept.withColumn("ranking_ticket_id", F.row_number().over(w).cast("bigint")).where(
        (F.col("ranking_ticket_id") == 1) & (F.col("dif_between_call_and_ticket") < tolerance))
    one = one.withColumns({"ticket_created_at_from_unix": ntz_from_epoch("ticket_created_at_unix"),
                           "ticket_created_at_unix_left9": F.left(F.col("ticket_created_at_unix").cast("string"), F.lit(9))})
    out = report_calls(calls.join(one.join(_touch_naive(base), "id", "left"), F.col("call_id") == F.col("aircall_id"), "left"))
    for g, name in ((15, "first_incidencia_client_15"), (30, "first_incidencia_30"), (60, "first_incidencia_client_60")):
        out = first_touch_naive(out, [f"client_{g}"], ["created_time_utc", "call_id", "id"], "incidencia_grouped", name)
    return out
