"""Spanish national identity numbers in free text (U1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two identity-number shapes (8 digits + letter; X/Y/Z + 7 digits + letter).
DNI_PATTERN = r"\b\d{8}[A-Z]\b"
NIE_PATTERN = r"\b[XYZ]\d{7}[A-Z]\b"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def national_id(notes="notes") -> Column:
    """First DNI in the upper-cased text, else first NIE, else NULL (a DNI wins wherever it is)."""
    up = F.upper(_c(notes))
    return F.coalesce(F.regexp_substr(up, F.lit(DNI_PATTERN)), F.regexp_substr(up, F.lit(NIE_PATTERN)))


def national_id_type(notes="notes") -> Column:
    """'DNI', 'NIE' or NULL, by the same precedence as :func:`national_id`."""
    up = F.upper(_c(notes))
    return (F.when(up.rlike(DNI_PATTERN), F.lit("DNI"))
             .when(up.rlike(NIE_PATTERN), F.lit("NIE")))
