"""Small text rules of the reports: channel rewrite (U7), mail seen flag (U9), satisfaction fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rewrite_channel(channel="channel", description="description") -> Column:
    """'aircall' for API tickets whose description mentions aircall, else the channel unchanged."""
    ch = _c(channel)
    return F.when((ch == F.lit("api")) & _c(description).ilike("%aircall%"), F.lit("aircall")).otherwise(ch)


def mail_seen(tags="tags") -> Column:
    """'unseen' / 'seen' when the tag list has the word after a space, else NULL."""
    t = _c(tags)
    return F.when(t.ilike("% unseen%"), F.lit("unseen")).when(t.ilike("% seen%"), F.lit("seen"))


def satisfaction_score(rating="satisfaction_rating") -> Column:
    """Word after ``score=`` ('' when absent, NULL on NULL)."""
    return F.regexp_extract(_c(rating), r"score=(\w+)", 1)


def satisfaction_reason(rating="satisfaction_rating") -> Column:
    """Text after ``reason=`` up to the next comma ('' when absent, NULL on NULL)."""
    return F.regexp_extract(_c(rating), r"reason=([^,]+)", 1)
