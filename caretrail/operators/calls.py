"""Call normalization (U15) and call filters (U16) of the call report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretrail.functions.categories import CALL_LINES, ladder
from caretrail.functions.phones import last9_as_int
from caretrail.functions.timeutil import epoch_seconds, madrid_to_utc

# The NPS line, excluded line names, blocked number pairs and report cut-offs.
NPS_LINE = "34919012607"
WEB_LINE = "34919017999"
BLOCKED_NUMBERS = ("34910602845", "34917374762")
EXCLUDED_LINES = ("Asistencia en Carretera", "Inbound Proveedores", "Pruebas", "Pruebas 2", "Pruebas 3",
                  "Siniestros", "Numero Test Siniestros")
REPORT_START = "2022-10-26"
MIN_IN_CALL_SECONDS = 2


def normalize_calls(calls: DataFrame, *, source_zone: str = "Europe/Madrid") -> DataFrame:
    """Client number, line classification, join phone, waits, UTC times and epochs; then all call columns."""
    frm, to = F.col("from"), F.col("to")
    client = (F.when(frm == NPS_LINE, to).when(to == NPS_LINE, frm)
               .when(F.col("direction") == "inbound", frm).otherwise(to))
    wait = F.col("duration_in_seconds") - F.col("in_call_duration")
    created_utc = madrid_to_utc(F.col("created_time"), source_zone)
    answered_utc = madrid_to_utc(F.col("answered_time"), source_zone)
    return calls.select(
        F.col("created_time").alias("date"),
        F.dayofweek("created_time").alias("dow"),
        client.alias("client_number_calculated"),
        ladder(F.col("number_name"), CALL_LINES).alias("Classification"),
        last9_as_int("from").alias("from_to_join"),
        wait.alias("wait_time"),
        (epoch_seconds("answered_time") - epoch_seconds("created_time")).alias("wait_time_calc_with_dates"),
        created_utc.alias("created_time_utc"),
        madrid_to_utc(F.col("ended_time"), source_zone).alias("ended_time_utc"),
        answered_utc.alias("answered_time_utc"),
        (epoch_seconds(created_utc) + F.coalesce(wait, F.lit(0))).alias("updated_timestamp_unix"),
        epoch_seconds(answered_utc).alias("answered_at_utc_unix"),
        *[F.col(f"`{c}`") for c in calls.columns],
    )


#: what the telephone system writes for a caller without a number
ANONYMOUS = "anonymous"


def filter_calls(calls: DataFrame, *, drop_anonymous: bool = False) -> DataFrame:
    """Answered calls outside test/operations lines, web->NPS transfers and blocked numbers.

    Written as the source's negations: a NULL line name or number makes the test NULL and drops the row.
    ``drop_anonymous`` leaves out calls without a number on either side, which otherwise share one client.
    """
    frm, to = F.col("from"), F.col("to")
    cond = F.lower(F.col("was_answered_yes__no")).ilike("%yes%")
    cond = cond & ~F.col("number_name").isin(*EXCLUDED_LINES)
    cond = cond & ~((frm == WEB_LINE) & (to == NPS_LINE))
    for n in (*BLOCKED_NUMBERS, *((ANONYMOUS,) if drop_anonymous else ())):
        cond = cond & ~((frm == n) | (to == n))
    return calls.where(cond)


def report_calls(df: DataFrame) -> DataFrame:
    """The report's own cut: since opening, more than 2 s in call, answered 'Yes', inbound."""
    return df.where((F.col("date") >= F.lit(REPORT_START).cast(df.schema["date"].dataType))
                    & (F.col("in_call_duration") > MIN_IN_CALL_SECONDS)
                    & (F.col("was_answered_yes__no") == "Yes")
                    & (F.col("direction") == "inbound"))
