"""The derived tables hold rows for every rule that the registered queries claim to run (sf0.01)."""

from pyspark.sql import functions as F

from caretrail.functions.ids import DNI_PATTERN, NIE_PATTERN
from caretrail.operators.calls import BLOCKED_NUMBERS, NPS_LINE, WEB_LINE
from caretrail.plans import analog_tables as at
from tests.conftest import SF


def counts(df, **tests):
    return df.agg(*(F.count_if(c).alias(n) for n, c in tests.items())).first().asDict()


def test_calls_meet_every_rule(spark):
    frm, to = F.col("from"), F.col("to")
    blocked = {f"blocked_{i}": (frm == n) | (to == n) for i, n in enumerate(BLOCKED_NUMBERS)}
    got = counts(at.calls(spark, SF), from_survey=frm == NPS_LINE, to_survey=to == NPS_LINE, web=(frm == WEB_LINE) & (to == NPS_LINE),
                 summer=F.month("created_time").isin(7, 8), before_change=F.col("created_time").between(F.lit("2024-03-31 01:00:00"), F.lit("2024-03-31 01:59:59")),
                 across_change=(F.col("created_time") < F.lit("2024-03-31 02:00:00")) & (F.col("ended_time") >= F.lit("2024-03-31 02:00:00")), **blocked)
    assert all(got.values()), got


def test_people_and_policies_meet_every_rule(spark):
    up = F.upper("notes")
    both = up.rlike(DNI_PATTERN) & up.rlike(NIE_PATTERN)
    first = F.regexp_instr(up, F.lit(NIE_PATTERN)) < F.regexp_instr(up, F.lit(DNI_PATTERN))
    got = counts(at.users(spark, SF), both=both & first)
    got |= counts(at.tickets(spark, SF), too_long=F.col("description").rlike(r": \d{11}$"))
    policies = at.policy_facts(spark, SF).groupBy("dni_nie", "purchased_at").agg(
        F.count("*").alias("n"), F.count_distinct("policy_number").alias("numbers"))
    got |= counts(policies, two=F.col("numbers") > 1, copies=F.col("n") > F.col("numbers"))
    assert all(got.values()), got
