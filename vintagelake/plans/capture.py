"""Bar ingest: replay of stored documents, backfill, and session-wise capture."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagelake import session
from vintagelake.operators import calendar, identity, quality
from vintagelake.operators.asof import BAR_KEY
from vintagelake.operators.select import beside, first_per_key
from vintagelake.sources import bronze, lake

NON_SESSION, MALFORMED = "bars_non_session_date", "bars_malformed_row"


def resolved_bars(found: DataFrame, symbols: DataFrame) -> DataFrame:
    """Bars of symbols that resolve (symbol, security_id); others are dropped."""
    return found.join(symbols.select("symbol", "security_id"), "symbol")


def replay(docs: DataFrame, symbols: DataFrame) -> DataFrame:
    """Bars of paged documents (doc, text): the latest fetch of a (security, session) wins."""
    rows = resolved_bars(bronze.paged_bars(docs), symbols)
    newest = [F.col(c).desc() for c in ("fetched_at", "doc", "page", "entry")]
    return first_per_key(rows, BAR_KEY, newest).select(*bronze.BAR_FIELDS)


def capture_plan(bars: DataFrame, sessions: DataFrame, identifiers: DataFrame, now: dt.datetime) -> DataFrame:
    """One row: what is stored, what is complete, how many sessions and bars are due.

    Stored bars after the last completed session are an error.
    """
    stored = bars.agg(F.max("session_date").alias("last_stored"))
    done = calendar.latest_completed_session(sessions, now).select(F.col("session_date").alias("latest"))
    active = identity.listed_tickers(identifiers, now.date()).agg(F.count(F.lit(1)).alias("active"))
    base = beside(stored, done, active)
    ahead = F.raise_error(F.lit("stored bars lie after the latest completed session")).cast("date")
    checked = base.withColumn(
        "last_stored", F.when(F.col("last_stored") > F.col("latest"), ahead).otherwise(F.col("last_stored"))
    )
    due = due_sessions(bars, sessions, now).agg(F.count(F.lit(1)).alias("sessions_due"))
    return beside(checked, due).withColumn("expected_bars", F.col("sessions_due") * F.col("active"))


def due_sessions(bars: DataFrame, sessions: DataFrame, now: dt.datetime) -> DataFrame:
    """Completed sessions after the last stored one; none when nothing is stored yet."""
    last = bars.agg(F.max("session_date").alias("d")).scalar()
    return sessions.where((F.col("session_date") > last) & (F.col("close_utc") <= F.lit(now))).select("session_date")


def parsed_rows(docs: DataFrame) -> DataFrame:
    """Rows of vendor documents (security_id, symbol, text), with the reason why a row is unusable, or null."""
    rows = bronze.vendor_rows(docs)
    return rows.select(*bronze.BAR_FIELDS, "raw_date", "reason")


# What becomes of a parsed row; each has exactly one.
KEPT, REFUSED, OFF_SESSION, STORED, NOT_DUE = "kept", "refused", "non_session", "already_stored", "not_due"
STATES = (KEPT, REFUSED, OFF_SESSION, STORED, NOT_DUE)


def graded(rows: DataFrame, sessions: DataFrame) -> DataFrame:
    """Parsed rows with their state, where no session is due more than another: refused, on a day without a session, or kept."""
    state = (
        F.when(F.col("reason").isNotNull(), REFUSED).when(F.col("close_utc").isNull(), OFF_SESSION).otherwise(KEPT)
    )
    return calendar.with_close(rows, sessions).withColumn("state", state).drop("close_utc")


def assigned(rows: DataFrame, sessions: DataFrame, due: list[dt.date], first_batch: int) -> DataFrame:
    """Parsed rows with the batch_id of one due session and one state each. No row is dropped.

    due: sorted sessions; the n-th has batch first_batch + n. A row belongs to the first due session at or after its
    day, later rows to the last one, rows without a readable date to the first. Days whose session, or for a day
    without one the next session, lies before the first due one are already stored. Sessions that are not
    in the list, between or after the due ones, are not due.
    """
    first, last = due[0], due[-1]
    starts = [first, *[d + dt.timedelta(days=1) for d in due[:-1]]]
    spans = [(a, b, first_batch + n) for n, (a, b) in enumerate(zip(starts, due, strict=True))]
    spans = rows.sparkSession.createDataFrame(spans, "since date, due date, batch_id bigint")
    # Every day from the first to the last due session: at most the calendar's days.
    days = F.broadcast(spans.select(F.explode(F.sequence("since", "due")).alias("due_day"), "due", "batch_id"))
    day = F.col("session_date")
    held = F.when(day.isNull(), F.lit(first)).otherwise(F.greatest(F.least(day, F.lit(last)), F.lit(first)))
    timed = rows.join(calendar.next_sessions(sessions), day == F.col("day"), "left").withColumn("held", held)
    state = (
        F.when((day < F.lit(first)) & (F.col("next_session") < F.lit(first)), STORED)
        .when(F.col("reason").isNotNull(), REFUSED)
        .when(F.col("next_session").isNull() | (F.col("next_session") != day), OFF_SESSION)
        .when(F.col("due") != day, NOT_DUE)
        .otherwise(KEPT)
    )
    return timed.join(days, F.col("held") == F.col("due_day")).select(*rows.columns, "batch_id", state.alias("state"))


def accounts(rows: DataFrame, batches: list[int]) -> DataFrame:
    """For each batch the number of parsed rows and how many of them are in each state."""
    named = rows.sparkSession.createDataFrame([(b,) for b in batches], "batch_id bigint")
    counts = rows.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("parsed"), *[F.count_if(F.col("state") == s).alias(s) for s in STATES]
    )
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("parsed", *STATES)]
    return named.join(counts, "batch_id", "left").select("batch_id", *zero)


def stored_rows(rows: DataFrame) -> tuple[DataFrame, str]:
    """Parsed rows with their state, computed once into the shared folder, and that folder.

    Each keeps what is read of its state: a kept row its bar, a refused one why, all of them whose day they are.
    """
    kept, refused = F.col("state") == KEPT, F.col("state") == REFUSED
    held = {c: F.when(kept, F.col(c)).alias(c) for c in bronze.BAR_FIELDS if c not in ("security_id", "symbol", "session_date")}
    held |= {c: F.when(refused, F.col(c)).alias(c) for c in ("raw_date", "reason")}
    return session.staged(rows.select(*[held.get(c, F.col(c)) for c in rows.columns]), "parsed")


def usable(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("state") == KEPT).drop("raw_date", "reason", "state")


def batch_quality(rows: DataFrame, checks: DataFrame, batches: list[int]) -> DataFrame:
    """Quality rows of batches: bars on non-session days and rows the parser refused.

    rows: parsed rows with their batch_id and state. The size of a batch is its readable bars. A batch without rows
    is reported with size 0.
    """
    refused, off = F.col("state") == REFUSED, F.col("state") == OFF_SESSION
    label = F.when(refused, F.concat_ws(" ", "symbol", "raw_date", "reason")).otherwise(
        F.concat_ws(" ", "symbol", F.col("session_date").cast("string"), F.lit("non_session_date"))
    )
    marked = rows.select("batch_id", "state", label.alias("label"), off.alias(NON_SESSION), refused.alias(MALFORMED))
    named = rows.sparkSession.createDataFrame([(b,) for b in batches], "batch_id bigint")
    counts = quality.anomaly_counts(
        marked, [NON_SESSION, MALFORMED], F.col("state").isin(KEPT, OFF_SESSION), batches=named
    )
    return quality.dq_results(counts, checks)


def backfill(
    docs: DataFrame, identifiers: DataFrame, sessions: DataFrame, checks: DataFrame, root: str,
    version: int, batch_id: int, source: str = "TIINGO",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Parse vendor documents (symbol, text) and stage them as a candidate version.

    Returns the staged bars, the quality rows and the ambiguous symbols. Tickers are
    resolved without a date; ambiguous ones are left out and reported. Documents are parsed once, into
    the shared folder; bars, counts and samples are read from there.
    """
    _, ambiguous = identity.resolve_any_time(docs.select("symbol").distinct(), identifiers)
    named, _ = identity.resolve_any_time(docs, identifiers)
    rows = graded(parsed_rows(named), sessions).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    parsed, path = stored_rows(rows)
    kept, _ = calendar.stamp_knowledge(usable(parsed), sessions)
    staged = lake.stage(kept.withColumn("source", F.lit(source)), root, version)
    results = session.stored(batch_quality(parsed, checks, [batch_id]))
    session.discard(docs.sparkSession, path)
    return staged, results, ambiguous


def capture_sessions(
    docs: DataFrame, identifiers: DataFrame, sessions: DataFrame, checks: DataFrame, path: str,
    targets: list[dt.date], first_batch: int, source: str = "TIINGO",
) -> tuple[DataFrame, DataFrame]:
    """Capture all due sessions in one merge, each session its own batch. Returns the quality rows and the accounts.

    Only the list of session dates is on the driver. Every parsed row is counted with one due session in one
    state (`assigned`); those of due sessions are merged. A stopped run leaves the old months or the new ones, and
    is repeated.
    """
    spark, days = docs.sparkSession, sorted(targets)
    named, _ = identity.resolve_batch(docs, identifiers, days[-1])
    rows = assigned(parsed_rows(named), sessions, days, first_batch)
    parsed, staged = stored_rows(rows)
    lake.merge_batches(usable(parsed), sessions, path, source)
    batches = [first_batch + n for n in range(len(days))]
    results = session.stored(batch_quality(parsed, checks, batches))
    counted = session.stored(accounts(parsed, batches))
    session.discard(spark, staged)
    return results, counted
