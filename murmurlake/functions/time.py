"""Clock columns: one usable epoch-millisecond value out of several clocks and formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Epoch seconds of 2010-01-01 and 2030-01-01 UTC.
FIRST_SECOND = 1_262_304_000
END_SECOND = 1_893_456_000

# The four accepted date-time layouts; the fraction only with T and Z.
_LAYOUT = (
    r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{1,2}:\d{1,2}$"
    r"|^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}\.\d{1,6}Z$"
    r"|^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"
)


def _as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_millis(text: Column | str) -> Column:
    """Epoch milliseconds of a date-time text in one of the four layouts (UTC), else null."""
    t = _as_column(text)
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, "/", "-"), "T", " "), "Z$", "")
    return F.when(t.rlike(_LAYOUT), F.unix_millis(F.concat(plain, F.lit("Z")).try_cast("timestamp")))


def in_years(millis: Column) -> Column:
    return (millis >= F.lit(FIRST_SECOND * 1000)) & (millis < F.lit(END_SECOND * 1000))


def usable_millis(number: Column | str, text: Column | str) -> Column:
    """Usable time: ``number`` as milliseconds, else as seconds, else ``text``; 2010–2029 only.

    Null or useless clocks give null.
    """
    n, t = _as_column(number).cast("long"), text_millis(text)
    seconds = (n >= F.lit(FIRST_SECOND)) & (n < F.lit(END_SECOND))
    return F.when(in_years(n), n).when(seconds, n * 1000).when(in_years(t), t)
