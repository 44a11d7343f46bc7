"""Tickers and securities over validity intervals.

A ticker is an attribute of a security for a while; security_id is the only key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagelake.functions.temporal import FAR_FUTURE, known_by, listed_on, valid_on
from vintagelake.operators.asof import members_asof
from vintagelake.operators.intervals import attach, earliest_start_segments, latest_start_segments
from vintagelake.operators.select import first_per_key


def tickers(identifiers: DataFrame) -> DataFrame:
    return identifiers.where(F.col("id_type") == "TICKER").select(
        "security_id", F.col("id_value").alias("ticker"), "valid_from", "valid_to"
    )


def ticker_segments(identifiers: DataFrame) -> DataFrame:
    """Which security a (case-folded) ticker means on each day; the latest start wins."""
    folded = tickers(identifiers).withColumn("ticker_key", F.upper("ticker"))
    return latest_start_segments(folded, "ticker_key", ["security_id"])


def resolve(requests: DataFrame, identifiers: DataFrame, ticker: str, day: str) -> DataFrame:
    """Add security_id for (ticker, day) rows; null where nothing was valid."""
    keyed = requests.withColumn("ticker_key", F.upper(F.col(ticker)))
    return attach(keyed, ticker_segments(identifiers), "ticker_key", day, ["security_id"]).drop("ticker_key")


def resolve_on(identifiers: DataFrame, day: dt.date) -> DataFrame:
    """All tickers that resolve on one day, with the identifier window that decided."""
    valid = tickers(identifiers).where(valid_on(day)).withColumn("ticker_key", F.upper("ticker"))
    order = [
        F.col("valid_from").desc(),
        F.coalesce("valid_to", F.lit(FAR_FUTURE)).desc(),
        F.col("security_id"),
    ]
    return first_per_key(valid, ["ticker_key"], order).select(
        "ticker_key", "security_id", "valid_from", "valid_to"
    )


def resolve_batch(symbols: DataFrame, identifiers: DataFrame, today: dt.date) -> tuple[DataFrame, DataFrame]:
    """Symbols resolved as of today, and those to skip and report; other columns of symbols (documents) are kept."""
    now = resolve_on(identifiers, today).select("ticker_key", "security_id")
    keyed = symbols.withColumn("ticker_key", F.upper("symbol"))
    found = keyed.join(now, "ticker_key").select(*symbols.columns, "security_id")
    skipped = keyed.join(now, "ticker_key", "left_anti").select(*symbols.columns)
    return found, skipped


def resolve_any_time(
    symbols: DataFrame, identifiers: DataFrame, distinct_securities: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Resolve without a date. A ticker with several identifier rows is ambiguous and left out.

    With distinct_securities, several rows of one security are not ambiguous.
    The lookup is case-sensitive, unlike the dated one. Other columns of symbols (documents) are kept.
    """
    use = tickers(identifiers).groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("security_id").alias("n_securities"),
        F.min("security_id").alias("security_id"),
    )
    hits = symbols.join(use, F.col("symbol") == F.col("ticker")).drop("ticker")
    size = F.col("n_securities" if distinct_securities else "n_rows")
    return (
        hits.where(size == 1).select(*symbols.columns, "security_id"),
        hits.where(size > 1).select(*symbols.columns, "n_rows", "n_securities"),
    )


def symbol_segments(identifiers: DataFrame) -> DataFrame:
    """The ticker a security carried on each day; the earliest valid interval wins."""
    return earliest_start_segments(tickers(identifiers), "security_id", ["ticker"])


def attach_symbol(rows: DataFrame, identifiers: DataFrame, day: str = "session_date") -> DataFrame:
    """Add the ticker valid on each row's day, null if none was."""
    return attach(rows, symbol_segments(identifiers), "security_id", day, ["ticker"])


def current_symbol_segments(identifiers: DataFrame) -> DataFrame:
    """As symbol_segments, but the latest valid_from wins."""
    return latest_start_segments(tickers(identifiers), "security_id", ["ticker"])


def listed_tickers(identifiers: DataFrame, today: dt.date, limit: int | None = None) -> DataFrame:
    """Tickers listed today, sorted; the last listed day counts."""
    out = tickers(identifiers).where(listed_on(today)).select("ticker").distinct().orderBy("ticker")
    return out.limit(limit) if limit else out


def display_symbol(identifiers: DataFrame) -> DataFrame:
    """Most recent ticker a security ever had."""
    latest = F.max(F.struct("valid_from", "ticker"))
    return tickers(identifiers).groupBy("security_id").agg(latest.alias("t")).select(
        "security_id", F.col("t.ticker").alias("ticker")
    )


def universe_history(
    membership: DataFrame, identifiers: DataFrame, universe: str | None, known: dt.date
) -> DataFrame:
    """Every interval ever recorded, with the ticker at its start."""
    out = membership.where(known_by(known))
    if universe is not None:
        out = out.where(F.col("universe") == universe)
    named = attach(out, current_symbol_segments(identifiers), "security_id", "valid_from", ["ticker"])
    return named.select("universe", "security_id", "valid_from", "valid_to", "ticker")


def universe_history_counts(history: DataFrame) -> DataFrame:
    return history.groupBy("universe").agg(
        F.count(F.lit(1)).alias("interval_count"),
        F.countDistinct("security_id").alias("security_count"),
    )


def universe_members(membership: DataFrame, identifiers: DataFrame, universe: str | None, day: dt.date) -> DataFrame:
    """Members of an index on a day with their symbol of that day (null allowed)."""
    members = members_asof(membership, day, universe).withColumn("_day", F.lit(day))
    return attach(members, current_symbol_segments(identifiers), "security_id", "_day", ["ticker"]).select(
        "universe", "security_id", "ticker", "valid_from", "valid_to"
    )
