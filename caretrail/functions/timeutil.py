"""Time expressions with the source queries' exact semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400


def whole_days(start, end) -> Column:
    """Whole elapsed days from ``start`` to ``end`` (``date_diff(DAY, start, end)``).

    Jan 1 00:00 -> Jan 16 23:59:59 is 15, -> Jan 17 00:00 is 16. Not a calendar-day difference.
    """
    return F.timestamp_diff("DAY", _c(start), _c(end))


def epoch_seconds(ts) -> Column:
    """Whole epoch seconds of a timestamp (``unix_timestamp``); timestamp_ntz is read as UTC."""
    return F.unix_timestamp(_c(ts))


def plus_days(ts, days: int) -> Column:
    """``ts + interval <days> days``."""
    return _c(ts) + F.make_dt_interval(F.lit(days))


def madrid_to_utc(ts, source_zone: str = "Europe/Madrid") -> Column:
    """Wall-clock time in ``source_zone`` to UTC wall-clock time (``convert_timezone`` then ``::timestamp``).

    Returns timestamp_ntz. On the DST overlap the earlier offset is taken (02:30 -> 00:30 UTC); a
    wall time inside the spring gap is read one hour later (02:30 -> 01:30 UTC).
    """
    return F.convert_timezone(F.lit(source_zone), F.lit("UTC"), _c(ts).cast("timestamp_ntz"))


def floor_days_between(start, end) -> Column:
    """``floor((unix_timestamp(end) - unix_timestamp(start)) / 86400)`` as bigint."""
    return F.floor((epoch_seconds(end) - epoch_seconds(start)) / F.lit(SECONDS_PER_DAY)).cast("bigint")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ntz_from_epoch(seconds) -> Column:
    """Epoch seconds to a UTC wall-clock timestamp_ntz, independent of the session time zone
    (``from_unixtime(n)::timestamp`` read in UTC)."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), _c(seconds).cast("decimal(18,6)"))
