"""Session calendar as a table.

A calendar has one row per day of a pinned period, so its size is bounded by the
period (about 25,000 days) and never by the data. `bounded` enforces that bound
and only then marks the table for broadcast.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintagelake.operators.intervals import attach, latest_start_segments
from vintagelake.operators.select import first_per_key, upsert

# First and last session of the pinned calendar.
FIRST_SESSION = dt.date(1962, 1, 1)
LAST_SESSION = dt.date(2030, 12, 31)


def _pinned(sessions: DataFrame) -> DataFrame:
    """Sessions of the pinned period; one outside it is an error."""
    outside = F.raise_error(
        F.concat(F.lit("session outside the calendar: "), F.coalesce(F.col("session_date").cast("string"), F.lit("no date")))
    )
    inside = F.col("session_date").between(F.lit(FIRST_SESSION), F.lit(LAST_SESSION))
    return sessions.withColumn("session_date", F.when(inside, F.col("session_date")).otherwise(outside.cast("date")))


def bounded(sessions: DataFrame) -> DataFrame:
    """One row per date: at most 25,202 rows, safe to broadcast. A session outside the pinned period is an error.

    In a table keyed by exchange, two exchanges on one date are an error too: choose one by of_exchange.
    """
    pinned = _pinned(sessions)
    if "exchange" in sessions.columns:
        here = Window.partitionBy("session_date")
        several = F.min("exchange").over(here) != F.max("exchange").over(here)
        mixed = F.raise_error(F.lit("sessions of several exchanges: choose one")).cast("string")
        pinned = pinned.withColumn("exchange", F.when(several, mixed).otherwise(F.col("exchange")))
    return F.broadcast(first_per_key(pinned, ["session_date"], [F.col("close_utc").desc()]))


def of_exchange(sessions: DataFrame, exchange: str) -> DataFrame:
    """Sessions of one exchange, from a table that is keyed by exchange and session."""
    return sessions.where(F.col("exchange") == exchange)


def on_exchange(bars: DataFrame, listings: DataFrame, home: str | None = None) -> DataFrame:
    """Add the exchange that lists each bar's security on its day.

    listings: security_id, exchange, valid_from, valid_to (half-open, null while it lasts). Of overlapping listings the
    one that began last counts. A security without a listing on that day trades at `home`; null if none is given.
    """
    rules = latest_start_segments(listings, "security_id", ["exchange"])
    listed = attach(bars.drop("exchange"), rules, "security_id", "session_date", ["exchange"])
    return listed.withColumn("exchange", F.coalesce("exchange", F.lit(home).cast("string")))


def with_close(bars: DataFrame, sessions: DataFrame, listings: DataFrame | None = None, home: str | None = None) -> DataFrame:
    """Add close_utc of each bar's session; null on a day without a session.

    With listings, the session is that of the exchange of the bar (on_exchange), and sessions is keyed by exchange and
    session_date. Its size is exchanges x 25,202 rows, so Spark chooses the join by the measured size.
    """
    if listings is None:
        return bars.join(bounded(sessions).select("session_date", "close_utc"), "session_date", "left")
    one = first_per_key(_pinned(sessions), ["exchange", "session_date"], [F.col("close_utc").desc()])
    closes = one.select("exchange", "session_date", "close_utc")
    timed = on_exchange(bars, listings, home).join(closes, ["exchange", "session_date"], "left")
    return timed if "exchange" in bars.columns else timed.drop("exchange")


def stamp_knowledge(
    bars: DataFrame, sessions: DataFrame, listings: DataFrame | None = None, home: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Bars with knowledge_time = close of their (exchange's) session, and the bars of non-session days as anomalies."""
    timed = with_close(bars, sessions, listings, home)
    kept = timed.where(F.col("close_utc").isNotNull()).withColumn("knowledge_time", F.col("close_utc"))
    skipped = timed.where(F.col("close_utc").isNull()).select(
        "security_id", "symbol", "session_date", F.lit("non_session_date").alias("reason")
    )
    return kept.drop("close_utc"), skipped


def latest_completed_session(sessions: DataFrame, now: dt.datetime, look_back_days: int = 10) -> DataFrame:
    """Last session closed by now. Fails when none closed within the look-back."""
    oldest = now - dt.timedelta(days=look_back_days)
    closed = sessions.where(
        (F.col("close_utc") <= F.lit(now)) & (F.col("session_date") >= F.lit(oldest.date()))
    )
    last = closed.agg(F.max("session_date").alias("d"))
    none = F.raise_error(F.lit("no completed session in the look-back")).cast("date")
    return last.select(F.coalesce(F.col("d"), none).alias("session_date"))


def sessions_between(sessions: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Inclusive; empty when start lies after end."""
    return sessions.where(F.col("session_date").between(F.lit(start), F.lit(end)))


def upsert_sessions(existing: DataFrame, new: DataFrame) -> DataFrame:
    """New rows replace rows of the same (exchange, session)."""
    return upsert(existing, new, ["exchange", "session_date"])


def upsert_exchanges(existing: DataFrame, new: DataFrame) -> DataFrame:
    return upsert(existing, new, ["mic"])


def _every_day(sessions: DataFrame, first: dt.date | None = None) -> DataFrame:
    """Every calendar day from `first` (default: the first session) to the last session, with its session or null."""
    days = bounded(sessions).select("session_date")
    span = days.agg(F.min("session_date").alias("lo"), F.max("session_date").alias("hi"))
    every = span.select(F.explode(F.sequence("lo" if first is None else F.lit(first), "hi")).alias("day"))
    return every.join(days, F.col("day") == F.col("session_date"), "left")


def session_index(sessions: DataFrame) -> DataFrame:
    """Every calendar day of the pinned span with the number of sessions up to and including it.

    The running count is one window over the calendar; its size is the pinned period.
    """
    running = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return _every_day(sessions).select(
        "day",
        F.col("session_date").isNotNull().alias("is_session"),
        F.count("session_date").over(running).alias("sessions_upto"),
    )


def next_sessions(sessions: DataFrame) -> DataFrame:
    """Every day from the start of the pinned period to the last session, with the first session at or after it.

    One window over the calendar, as above; at most 25,202 rows, marked for broadcast. It runs from the last day
    backwards, since a frame that ends with the table is read again for each row.
    """
    onward = Window.orderBy(F.col("day").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.last("session_date", ignorenulls=True).over(onward)
    return F.broadcast(_every_day(sessions, FIRST_SESSION).select("day", first.alias("next_session")))
