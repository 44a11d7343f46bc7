"""Point-in-time predicates and date arithmetic as column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

FAR_FUTURE = dt.date(9999, 12, 31)


def as_of_instant(as_of: dt.date | dt.datetime) -> dt.datetime:
    """A date means the end of that day; a naive datetime means UTC."""
    if isinstance(as_of, dt.datetime):
        return as_of if as_of.tzinfo else as_of.replace(tzinfo=dt.timezone.utc)
    return dt.datetime(as_of.year, as_of.month, as_of.day, 23, 59, 59, tzinfo=dt.timezone.utc)


def known_by(as_of: dt.date | dt.datetime, knowledge_time: str = "knowledge_time") -> Column:
    """Row was known at as_of. A plain column-to-literal comparison, so it is pushed to the scan."""
    if isinstance(as_of, dt.datetime):
        return F.col(knowledge_time) <= F.lit(as_of_instant(as_of))
    next_day = as_of_instant(as_of) + dt.timedelta(seconds=1)
    return F.col(knowledge_time) < F.lit(next_day)


def valid_on(day, valid_from="valid_from", valid_to="valid_to") -> Column:
    """Half-open containment: valid_from <= day < valid_to, open when valid_to is null."""
    day = day if isinstance(day, Column) else F.lit(day)
    return (F.col(valid_from) <= day) & (F.col(valid_to).isNull() | (day < F.col(valid_to)))


def listed_on(day: dt.date, valid_from="valid_from", valid_to="valid_to") -> Column:
    """Closed-end containment used by listings: the last valid day still counts."""
    day = F.lit(day)
    return (F.col(valid_from) <= day) & (F.col(valid_to).isNull() | (F.col(valid_to) >= day))


def date_range(column: str, start: dt.date | None, end: dt.date | None) -> Column:
    """Inclusive range; a missing bound does not restrict."""
    out = F.lit(True)
    if start is not None:
        out = out & (F.col(column) >= F.lit(start))
    if end is not None:
        out = out & (F.col(column) <= F.lit(end))
    return out


def day_start(day: Column) -> Column:
    """Midnight UTC of a date."""
    return day.cast("timestamp")
