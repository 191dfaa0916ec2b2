"""Phone numbers from ticket text and user records (U6), and call numbers (U15)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ticket-description phrase and the country prefix that is removed.
CALLER_PATTERN = r"Caller Phone number : ([+0-9 ]+)"
COUNTRY_PREFIX = "+34"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def caller_phone(description="description") -> Column:
    """Digits after the phrase, blanks and every '+34' removed, as int; NULL when absent or too long."""
    raw = F.regexp_extract(_c(description), CALLER_PATTERN, 1)
    cleaned = F.replace(F.replace(raw, F.lit(" "), F.lit("")), F.lit(COUNTRY_PREFIX), F.lit(""))
    return cleaned.try_cast("int")


def user_phone(phone="phone") -> Column:
    """Rightmost 9 characters of the blank-stripped user phone (string)."""
    return F.right(F.replace(_c(phone), F.lit(" "), F.lit("")), F.lit(9))


def phone_to_join(caller: Column, user: Column) -> Column:
    """The caller number when present, else the user phone, as a string."""
    return F.coalesce(caller.cast("string"), user)


def last9_as_int(number="from") -> Column:
    """Rightmost 9 characters as int; NULL for text such as 'anonymous'."""
    return F.right(_c(number), F.lit(9)).try_cast("int")
