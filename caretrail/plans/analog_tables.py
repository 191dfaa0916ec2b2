"""Domain-shaped tables derived from the driver's tables, for running the reports on them.

The domain tables (users, tickets, policies, calls) do not exist among the driver's tables, so
they are derived row by row from ``customer`` and ``events``: every derived table grows with its
source. Free-text fields are built from keys so that the extraction rules have something to find.
The same derivations are written in SQL in :mod:`caretrail.plans.oracle_sql`.

* users     <- customer (id = c_custkey; notes carry a DNI, a NIE or nothing; a phone)
* tickets   <- events of type 'error' (requester = user_id)
* metrics   <- events of type 'error' with value > 20
* policies  <- events of type 'purchase' (customer id from user_id; purchases of value >= 100 have two
               payment rows, i.e. a tied copy; of every third, the second row is another policy)
* calls     <- events of type 'click' (inbound) and 'view' (outbound)

So that every rule meets rows, some customers' notes hold both kinds of identity number, some ticket phones
are too long for a number, and some calls fall in summer, run across the change to summer time, come from
the survey line, go from the web line to it, or have a blocked number at either end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caretrail.functions.categories import CALL_INCIDENTS, CALL_LINES, TICKET_INCIDENTS, Ruleset
from caretrail.sources.tables import read_table

CLAIMS_FORM = 19015738424477
NPS = "34919012607"
OFFICE = "34910000000"
WEB = "34919017999"
BLOCKED_FROM, BLOCKED_TO = "34910602845", "34917374762"
CLOCK_CHANGE = "2024-03-31 01:59:30"


def _vocabulary(*rulesets: Ruleset) -> list[str]:
    """Category texts derived from the rulesets: every literal, and every wildcard's core with '_' as
    is and as a blank, in ruleset order."""
    out: list[str] = []
    for rs in rulesets:
        for r in rs.rules:
            for p in r.patterns:
                if r.test in ("eq", "in"):
                    cands = [p]
                else:
                    core = p.replace("%", "").strip()
                    cands = [core + " x", core.replace("_", " ")] if "%" in p else [p]
                out += [c for c in cands if c not in out]
    return out


INCIDENT_VOCAB = _vocabulary(TICKET_INCIDENTS, CALL_INCIDENTS)
LINE_VOCAB = _vocabulary(CALL_LINES) + ["NPS Soporte", "Numero Test Siniestros", "Otra linea"]


def _pick(vocab: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in vocab]), (idx % F.lit(len(vocab))).cast("int") + 1)


def _pad(col: str, n: int) -> Column:
    return F.lpad(F.col(col).cast("string"), n, "0")


def dni_of(col: str) -> Column:
    """Customer id -> the identity number written in that customer's notes (NULL for every 5th)."""
    return (F.when(F.col(col) % 5 == 0, F.lit(None).cast("string"))
             .when(F.col(col) % 2 == 0, F.concat(_pad(col, 8), F.lit("Z")))
             .otherwise(F.concat(F.lit("X"), _pad(col, 7), F.lit("B"))))


def users(spark: SparkSession, root: str) -> DataFrame:
    c = read_table(spark, root, "customer")
    notes = (F.when(F.col("c_custkey") % 5 == 0, F.col("c_name"))
              .when(F.col("c_custkey") % 22 == 0, F.concat(F.lit("x"), _pad("c_custkey", 7), F.lit("b "), _pad("c_custkey", 8), F.lit("z")))
              .when(F.col("c_custkey") % 2 == 0, F.concat(F.col("c_name"), F.lit(" "), _pad("c_custkey", 8), F.lit("z")))
              .otherwise(F.concat(F.col("c_name"), F.lit(" x"), _pad("c_custkey", 7), F.lit("b"))))
    phone = F.when(F.col("c_custkey") % 7 != 0, F.concat(F.lit("+34 6"), _pad("c_custkey", 8)))
    return c.select(
        F.col("c_custkey").alias("id"), notes.alias("notes"), phone.alias("phone"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"), F.lit(None).cast("timestamp_ntz").alias("updated_at"),
        F.col("c_name").alias("external_id"), F.col("c_mktsegment").alias("tags"),
        F.col("c_nationkey").cast("bigint").alias("organization_id"), F.lit(None).cast("string").alias("url"),
        F.col("c_name").alias("name"))


def tickets(spark: SparkSession, root: str) -> DataFrame:
    e = read_table(spark, root, "events").where(F.col("event_type") == "error")
    v = F.col("value")
    mod3 = F.col("event_id") % 3
    description = (F.when(mod3 == 0, F.lit("no phone given"))
                    .when(mod3 == 1, F.concat(F.lit("Caller Phone number : +34 6"), _pad("user_id", 8), F.lit(" via Aircall")))
                    .when(F.col("event_id") % 17 == 0, F.concat(F.lit("Caller Phone number : 6"), _pad("user_id", 10)))
                    .otherwise(F.concat(F.lit("Caller Phone number : 6"), _pad("user_id", 8))))
    channel = F.when(v < 15, F.lit("api")).when(v < 20, F.lit(None).cast("string")).when(v < 60, F.lit("email")).otherwise(F.lit("phone"))
    word = _pick(INCIDENT_VOCAB, F.col("event_id"))
    tipo = F.when(v < 2, F.lit(None).cast("string")).when(v > 250, F.upper(word)).otherwise(word)
    form = F.when(v > 450, F.lit(CLAIMS_FORM)).when(v > 400, F.lit(None).cast("bigint")).otherwise(F.lit(360001)).cast("bigint")
    subject = (F.when(v < 5, F.lit("Declaración de un siniestro")).when(v < 6, F.lit(None).cast("string"))
                .otherwise(F.concat(F.lit("Consulta "), F.col("props"))))
    mod4 = F.col("event_id") % 4
    tags = F.when(mod4 == 0, F.lit("vip unseen")).when(mod4 == 1, F.lit("x seen")).when(mod4 == 2, F.lit("unseen"))
    rating = (F.when(v > 100, F.lit("{score=good, reason=fast answer, comment=ok}"))
               .when(v > 50, F.lit("score=bad")))
    return e.select(
        F.col("event_id").alias("id"), F.col("user_id").alias("requester_id"), F.col("ts").alias("created_at"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.floor(v).cast("int"))).alias("updated_at"),
        description.alias("description"), channel.alias("channel"), tipo.alias("tipo_de_incidencia"),
        form.alias("ticket_form_id"), subject.alias("subject"),
        (F.floor(v).cast("bigint") % 13).alias("assignee_id"), tags.alias("tags"), rating.alias("satisfaction_rating"))


def metrics(spark: SparkSession, root: str) -> DataFrame:
    e = read_table(spark, root, "events").where((F.col("event_type") == "error") & (F.col("value") > 20))
    return e.select(
        F.col("event_id").alias("ticket_id"), F.col("ts").alias("created_at"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.floor("value").cast("int"))).alias("updated_at"),
        F.col("ts").alias("ingested_at"), F.floor("value").cast("bigint").alias("reply_time_in_minutes"))


def policy_facts(spark: SparkSession, root: str) -> DataFrame:
    e = read_table(spark, root, "events").where(F.col("event_type") == "purchase")
    # large purchases are paid in two instalments: two payment rows, hence two tied copies or two policies
    e = e.select("*", F.explode(F.sequence(F.lit(0), F.when(F.col("value") >= 100, F.lit(1)).otherwise(F.lit(0)))).alias("_pay"))
    initial = F.when((F.col("_pay") == 1) & (F.col("event_id") % 3 == 1), F.lit("Q")).otherwise(F.lit("P"))
    number = F.when(F.col("event_id") % 10 == 0, F.concat(initial, (F.col("event_id") % 100).cast("string"))) \
              .otherwise(F.concat(initial, F.lit("OL"), F.col("event_id").cast("string")))
    stop = F.when(F.col("value") >= 40, F.col("ts") + F.make_dt_interval(F.lit(0), F.floor("value").cast("int")))
    sold = F.length(number) > 5
    return e.select(
        dni_of("user_id").alias("dni_nie"),
        F.when(sold, F.lit(1)).otherwise(F.lit(0)).alias("purchased_policy"),
        F.when(sold & stop.isNull(), F.lit(1)).otherwise(F.lit(0)).alias("policy_not_interrupted"),
        F.col("ts").alias("purchased_at"), number.alias("policy_number"), stop.alias("interrupted_at"),
        F.when(F.col("value") < 100, F.lit("web")).otherwise(F.lit("phone")).alias("bo_purchase"),
        F.col("props").alias("pcw_source"), (F.col("event_id") % 2).cast("int").alias("renewal_order"))


def calls(spark: SparkSession, root: str) -> DataFrame:
    e = read_table(spark, root, "events").where(F.col("event_type").isin("click", "view"))
    v = F.col("value")
    inbound = F.col("event_type") == "click"
    number = F.concat(F.lit("346"), _pad("user_id", 8))
    every = lambda n: F.col("event_id") % n == 0
    client = (F.when(every(29), F.lit(WEB)).when(every(41), F.lit(BLOCKED_FROM))
               .when(F.col("user_id") % 37 == 0, F.lit("anonymous")).otherwise(number))
    frm = F.when(inbound, client).when(every(31), F.lit(NPS)).otherwise(F.lit(OFFICE))
    to = (F.when(inbound, F.when(every(29) | (v > 300), F.lit(NPS)).otherwise(F.lit(OFFICE)))
           .when(every(43), F.lit(BLOCKED_TO)).otherwise(number))
    secs = F.floor(v).cast("int")
    edge = F.lit(CLOCK_CHANGE).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)
    e = e.withColumn("ts", F.when(every(53), edge).when(every(11), F.col("ts") + F.make_dt_interval(F.lit(180))).otherwise(F.col("ts")))
    line = F.when(v < 4, F.lit(None).cast("string")).otherwise(_pick(LINE_VOCAB, F.col("event_id")))
    answered = F.when(v >= 3, F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs % 40))
    return e.select(
        F.col("event_id").alias("call_id"), F.col("ts").alias("created_time"), answered.alias("answered_time"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs * 3)).alias("ended_time"),
        frm.alias("from"), to.alias("to"),
        F.when(inbound, F.lit("inbound")).otherwise(F.lit("outbound")).alias("direction"),
        line.alias("number_name"), (secs * 3).cast("bigint").alias("duration_in_seconds"),
        (secs * 3 - secs % 40).cast("bigint").alias("in_call_duration"),
        F.when(v < 3, F.lit("No")).when(v < 8, F.lit("yes")).otherwise(F.lit("Yes")).alias("was_answered_yes__no"),
        F.concat(F.lit("Agent "), (F.col("event_id") % 9).cast("string")).alias("full_name"))


def sources(spark: SparkSession, root: str):
    from caretrail.plans.reports import Sources
    return Sources(users=users(spark, root), tickets=tickets(spark, root), policy_facts=policy_facts(spark, root),
                   ticket_metrics=metrics(spark, root), calls=calls(spark, root))
