"""The two wide reports, composed from the operators.

* :func:`ticket_base`   (U11) tickets + users + nearest purchase, categories and flags;
* :func:`ticket_report` (U18) one row per ticket with recontact sessions, first touch and metrics;
* :func:`call_report`   (U19) one row per answered inbound call with recall sessions and its ticket.

Bag semantics are kept as in the source: a ticket tied to two equally near policies appears twice
in the base, and joins by ticket id multiply such copies.

Both reports start from one core (:func:`ticket_core`): tickets with phones, purchases and the columns of either
variant. It is read several times, so it is a stage table (:mod:`caretrail.plans.stages`), written once for both.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretrail.functions.categories import CALL_INCIDENTS, TICKET_INCIDENTS
from caretrail.functions.phones import caller_phone, phone_to_join, user_phone
from caretrail.functions.text import mail_seen, rewrite_channel, satisfaction_reason, satisfaction_score
from caretrail.functions.timeutil import epoch_seconds, ntz_from_epoch, plus_days
from caretrail.operators.attribution import attribute_purchases, conversion_flags
from caretrail.operators.calls import filter_calls, normalize_calls, report_calls
from caretrail.operators.categorize import categorize
from caretrail.operators.first_touch import first_touch, first_touch_nested
from caretrail.operators.matching import match_calls_to_tickets, one_row_per
from caretrail.operators.sessions import sessionize
from caretrail.operators.users import normalize_users
from caretrail.plans.stages import StageManager, fingerprint, of_application

# The claims form left out of every report, and the claim subjects.
CLAIMS_FORM_ID = 19015738424477
CLAIM_SUBJECTS = ("Declaración de un siniestro", "Inbound answered call on S 2 - Seguimiento Siniestro",
                  "Inbound answered call on Numero Test Siniestros", "Inbound answered call on S 1 - Apertura Siniestro")
FIRST_TOUCH_LEAD_DAYS = 3
RECONTACT_GAP_DAYS = 15
RECALL_GAPS_DAYS = (15, 30, 60)
MATCH_TOLERANCE_SECONDS = 10000


@dataclass
class Sources:
    """The domain tables (see :mod:`caretrail.sources.domain`)."""
    users: DataFrame
    tickets: DataFrame
    policy_facts: DataFrame
    ticket_metrics: DataFrame | None = None
    calls: DataFrame | None = None
    #: the stored tables that users, tickets and policy_facts come from, if they are known: they name the stages
    inputs: dict[str, DataFrame] | None = None


def materialize(df: DataFrame, stages: StageManager | None, name: str, of: str | None = None) -> DataFrame:
    """``df`` as a stage table, or as it is without a manager."""
    return df if stages is None else stages.keep(df, name, of)


FLAGS = ("purchased_policy_7days", "purchased_policy_14days", "purchased_policy_3days", "purchased_policy_1days")
#: columns of the core that only one variant shows, under other names
VARIANTS = ("_rewritten_channel", "_ticket_incident", "_call_incident", "_mail_seen")


def ticket_core(src: Sources) -> DataFrame:
    """U11 for both reports: tickets with phones, nearest purchase and flags, and either variant's own columns."""
    users = normalize_users(src.users, ticket_report=False).select("requester_id", "dni_nie", "phone")
    tickets = src.tickets.where(F.col("ticket_form_id") != F.lit(CLAIMS_FORM_ID)).join(users, "requester_id", "left")
    att = conversion_flags(attribute_purchases(
        tickets.select("id", "dni_nie", "created_at"), src.policy_facts,
        ticket_id="id", ticket_key="dni_nie", created="created_at",
        policy_key="dni_nie", purchased="purchased_at", policy_number="policy_number",
        interrupted="interrupted_at"))
    caller = caller_phone("description")
    uphone = user_phone("phone")
    core = tickets.select(
        caller.alias("CallerPhoneNumber"), uphone.alias("user_phone"),
        phone_to_join(caller, uphone).alias("zdk_phone_to_join"),
        epoch_seconds("created_at").alias("ticket_created_at_unix"), *[F.col(c) for c in src.tickets.columns],
        rewrite_channel("channel", "description").alias("_rewritten_channel"), mail_seen("tags").alias("_mail_seen"))
    core = categorize(core, "tipo_de_incidencia", TICKET_INCIDENTS, "_ticket_incident")
    core = categorize(core, "tipo_de_incidencia", CALL_INCIDENTS, "_call_incident")
    core = core.join(att, "id", "left")
    return core.withColumns({f: F.coalesce(F.col(f), F.lit(0)) for f in FLAGS})


def ticket_base(src: Sources, *, ticket_report: bool = True, dedupe: str = "reference", core: DataFrame | None = None) -> DataFrame:
    """U11: tickets with caller phone, category, nearest purchase and conversion flags.

    ``ticket_report=True`` is the ticket report's variant (channel rewrite, its ruleset, mail flag);
    False is the call report's (raw channel, the call ruleset). ``dedupe='reference'`` keeps one row
    per tied nearest policy row, as the source does; ``'strict'`` keeps one row per ticket (the tied
    row with the smallest policy number, then purchase time, then the other columns). ``core`` is
    :func:`ticket_core` of the same sources, if it is there already.
    """
    if dedupe not in ("reference", "strict"):
        raise ValueError("dedupe must be 'reference' or 'strict'")
    core = ticket_core(src) if core is None else core
    first = ["CallerPhoneNumber", "user_phone", "zdk_phone_to_join", "ticket_created_at_unix"]
    own = [c for c in src.tickets.columns if not (ticket_report and c == "channel")]
    bought = [c for c in core.columns if c not in (*first, *src.tickets.columns, *VARIANTS, *FLAGS)]
    shown = ([F.col("_rewritten_channel").alias("channel"), F.col("_ticket_incident").alias("incidencia_grouped"), F.col("_mail_seen").alias("mail_seen")]
             if ticket_report else [F.col("_call_incident").alias("incidencia_grouped")])
    base = core.select(*first, *own, *shown, *bought, *FLAGS)
    if dedupe == "strict":
        base = one_row_per(base, "id", ["policy_number", "purchased_at"])
    return base


def _core_stage(src: Sources, stages: StageManager | None) -> tuple[DataFrame, str | None]:
    if stages is None:
        return ticket_core(src), None
    of = fingerprint(src.inputs or {"users": src.users, "tickets": src.tickets, "policy_facts": src.policy_facts})
    return materialize(ticket_core(src), stages, "core", of), of


def _not_claim(df: DataFrame) -> F.Column:
    return ~F.col("subject").isin(*CLAIM_SUBJECTS)


def first_touch_criteria(base: DataFrame) -> DataFrame:
    """U12 instance: first assignee per (policy_number, renewal_order) among purchase-support,
    non-API, non-claim tickets created no earlier than 3 days before the purchase (or unpurchased)."""
    rows = base.where(
        _not_claim(base) & (F.col("channel") != "api") & (F.col("incidencia_grouped") == "purchase support")
        & ((plus_days(F.col("purchased_at"), -FIRST_TOUCH_LEAD_DAYS) <= F.col("created_at"))
           | F.col("purchased_at").isNull()))
    out = first_touch(rows.select("id", "policy_number", "renewal_order", "created_at", "assignee_id"),
                      ["policy_number", "renewal_order"], ["created_at"],
                      {"first_assignee_id_3_days_criteria": "assignee_id"}, tiebreak=["id"])
    return out.select("id", "first_assignee_id_3_days_criteria")


def recontact_sessions(base: DataFrame) -> DataFrame:
    """Ticket report's 15-day recontact sessions per requester over non-API tickets, with rollups."""
    rows = base.where(F.col("channel") != "api").select(
        "id", "requester_id", "created_at", "assignee_id", "channel", "tipo_de_incidencia", "incidencia_grouped")
    s = sessionize(rows, "requester_id", "created_at", (RECONTACT_GAP_DAYS,), tiebreak=["id"],
                   count_name="num_contacts", number_fmt="n_contact_{gap}", label_fmt="client_{gap}",
                   first_ts_fmt="first_contact_date_{gap}", group_count_fmt="Num_contacts_{gap}",
                   firsts={"first_agent_client_{gap}": "assignee_id",
                           "first_channel_client_{gap}": "channel",
                           "first_tipo_de_incidencia_client_{gap}": "tipo_de_incidencia",
                           "first_incidencia_grouped_client_{gap}": "incidencia_grouped"})
    g = RECONTACT_GAP_DAYS
    return s.select("id", "num_contacts", f"n_contact_{g}", "date_diff_lag", "lag", f"client_{g}",
                    f"first_contact_date_{g}", f"Num_contacts_{g}", f"first_agent_client_{g}",
                    f"first_channel_client_{g}", f"first_tipo_de_incidencia_client_{g}",
                    f"first_incidencia_grouped_client_{g}")


def ticket_report(src: Sources, *, checkpoint: bool = True, dedupe: str = "reference", stages: StageManager | None = None) -> DataFrame:
    """U18: the ticket report (``dedupe`` as in :func:`ticket_base`). ``checkpoint=False`` writes no stages."""
    stages = (stages or of_application(src.tickets.sparkSession)) if checkpoint else None
    core, _ = _core_stage(src, stages)
    base = ticket_base(src, ticket_report=True, dedupe=dedupe, core=core)
    rec = recontact_sessions(base)
    crit = first_touch_criteria(base)
    m = src.ticket_metrics
    metric_cols = [c for c in m.columns if c not in ("updated_at", "ingested_at", "created_at")]
    m = m.select(*metric_cols, F.col("updated_at").alias("_metrics_updated_at"))
    out = (base.join(rec, "id", "left").join(crit, "id", "left")
               .join(m, m["ticket_id"] == base["id"], "left"))
    cols = [c for c in out.columns if c not in ("updated_at", "_metrics_updated_at")]
    return out.where(_not_claim(out)).select(
        *cols,
        F.greatest(F.col("_metrics_updated_at"), F.col("updated_at")).alias("updated_at"),
        satisfaction_score("satisfaction_rating").alias("Score"),
        satisfaction_reason("satisfaction_rating").alias("Reason"))


def recall_sessions(calls: DataFrame) -> DataFrame:
    """Call report's recall sessions at 15/30/60 days per client number, with rollups."""
    return sessionize(calls, "client_number_calculated", "created_time_utc", RECALL_GAPS_DAYS,
                      tiebreak=["call_id"], tiebreak_unique=True, count_name="num_calls", number_fmt="n_call_{gap}",
                      label_fmt="client_{gap}", first_ts_fmt="first_call_date_{gap}",
                      group_count_fmt="Num_calls_{gap}",
                      firsts={"first_user_client_{gap}": "full_name",
                              "first_number_name_client_{gap}": "number_name"})


def matched_tickets(calls: DataFrame, base: DataFrame) -> DataFrame:
    """U17 on report calls: one row per ticket id that won a call within the tolerance."""
    cand = report_calls(calls).select("call_id", "from_to_join", "answered_at_utc_unix")
    tickets = base.withColumn("_phone", F.col("zdk_phone_to_join").try_cast("int"))
    m = match_calls_to_tickets(cand, tickets, call_id="call_id", call_key="from_to_join",
                               call_time="answered_at_utc_unix", ticket_key="_phone",
                               ticket_time="ticket_created_at_unix", tolerance=MATCH_TOLERANCE_SECONDS)
    m = one_row_per(m.drop("_phone"), "id", ["dif_between_call_and_ticket", "aircall_id"])
    return m.select(
        F.lit(1).cast("bigint").alias("ranking_ticket_id"), "aircall_id", "dif_between_call_and_ticket",
        ntz_from_epoch("ticket_created_at_unix").alias("ticket_created_at_from_unix"),
        F.left(F.col("ticket_created_at_unix").cast("string"), F.lit(9)).alias("ticket_created_at_unix_left9"),
        *[c for c in base.columns])


def call_report(src: Sources, *, checkpoint: bool = True, dedupe: str = "reference", stages: StageManager | None = None,
                drop_anonymous: bool = False) -> DataFrame:
    """U19: the call report (``dedupe`` as in :func:`ticket_base`, ``drop_anonymous`` as in
    :func:`caretrail.operators.calls.filter_calls`). ``checkpoint=False`` writes no stages."""
    stages = (stages or of_application(src.tickets.sparkSession)) if checkpoint else None
    core, of = _core_stage(src, stages)
    base = ticket_base(src, ticket_report=False, dedupe=dedupe, core=core)
    heard = fingerprint({"calls": src.calls}, f"{drop_anonymous}") if stages else None
    calls = materialize(recall_sessions(filter_calls(normalize_calls(src.calls), drop_anonymous=drop_anonymous)), stages, "calls", heard)
    matched = matched_tickets(calls, base)
    # First touch joins the few matched tickets, not the calls: unmatched calls have no ticket id, and as one
    # NULL key they would all meet in one partition.
    matched = matched.join(first_touch_criteria(base), "id", "left")
    out = calls.join(matched, calls["call_id"] == matched["aircall_id"], "left")
    # Read twice below (the group aggregate and the join back): cut it once.
    out = materialize(report_calls(out), stages, "joined", f"{of}{heard}-{dedupe}" if stages else None)
    # Sessions nest (a 60-day session is a union of 30-day ones, of 15-day ones): one aggregate over
    # the 15-day labels, rolled up to 30 and 60 days on that small table, one join back.
    return first_touch_nested(out, ["client_15", "client_30", "client_60"], ["created_time_utc"],
                              "incidencia_grouped",
                              ["first_incidencia_client_15", "first_incidencia_30", "first_incidencia_client_60"],
                              tiebreak=["call_id", "id"])
