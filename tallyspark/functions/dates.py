"""As-of dates and reporting periods."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = Column | date | datetime | str | None

# The first day of history, and the text form dates arrive in.
HISTORY_START = date(1970, 1, 1)
US_DATE = "MM/dd/yyyy"


def as_of_column(value: AsOf) -> Column:
    """The as-of moment as a column; ``None`` means now, text is read as MM/dd/yyyy.

    A ``datetime`` keeps its time of day, so a midnight bound leaves out later moments of that day.
    """
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.to_date(F.lit(value), US_DATE)
    return F.lit(value)


def year_start(value: AsOf) -> Column:
    return F.trunc(as_of_column(value), "year")


def period_key(value: AsOf, kind: str = "monthly") -> Column:
    """``yyyyMM`` for a monthly run, ``yyyy`` for a yearly one."""
    patterns = {"monthly": "yyyyMM", "yearly": "yyyy"}
    if kind not in patterns:
        raise ValueError(f"period kind must be one of {sorted(patterns)}, not {kind!r}")
    return F.date_format(as_of_column(value), patterns[kind])
