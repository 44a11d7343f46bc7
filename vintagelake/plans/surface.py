"""Reads by symbol or id: the query shapes a client asks for.

A single symbol is resolved first with a point lookup on the identifier table.
The security id then is a literal in the scan of the large table, where it
prunes row groups.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagelake.functions.temporal import date_range
from vintagelake.operators import adjust, asof, fundamentals, identity


class NotFound(LookupError):
    """The name is unknown; an empty range of a known name is an empty result instead."""


def check_range(start: dt.date | None, end: dt.date | None) -> None:
    if start is not None and end is not None and start > end:
        raise ValueError("start lies after end")


def security_of(identifiers: DataFrame, symbol: str, as_of: dt.date) -> int:
    hit = identity.resolve_on(identifiers.where(F.upper("id_value") == symbol.upper()), as_of).select("security_id")
    row = hit.first()
    if row is None:
        raise NotFound(f"symbol {symbol.upper()} is unknown as of {as_of}")
    return row[0]


def bars(
    bars_: DataFrame, actions: DataFrame, identifiers: DataFrame, symbol: str, as_of: dt.date,
    start: dt.date | None = None, end: dt.date | None = None, adjustment: str | None = None,
    segments: DataFrame | None = None,
) -> DataFrame:
    """segments: stored adjust.total_return_segments of the same as_of, so that a range reads its own months alone."""
    check_range(start, end)
    security_id = security_of(identifiers, symbol, as_of)
    rows = adjust.bars_asof(bars_, actions, as_of, [security_id], start, end, adjustment, segments)
    return rows.withColumn("symbol", F.lit(symbol.upper())).orderBy("session_date")


def bars_by_id(
    bars_: DataFrame, actions: DataFrame, identifiers: DataFrame, securities: DataFrame, security_id: int,
    as_of: dt.date, start: dt.date | None = None, end: dt.date | None = None, adjustment: str | None = None,
) -> DataFrame:
    """By id, so delisted names and reused tickers are reachable; shown under the latest ticker."""
    check_range(start, end)
    if securities.where(F.col("security_id") == security_id).isEmpty():
        raise NotFound(f"security {security_id} is unknown")
    rows = adjust.bars_asof(bars_, actions, as_of, [security_id], start, end, adjustment).drop("symbol")
    shown = identity.display_symbol(identifiers.where(F.col("security_id") == security_id))
    label = shown.agg(F.max("ticker").alias("t")).scalar()
    return rows.withColumn("symbol", label).orderBy("session_date")


def features(
    gold: DataFrame, identifiers: DataFrame, as_of: dt.date, symbols: DataFrame | None = None,
    start: dt.date | None = None, end: dt.date | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Feature rows of the symbols and the symbols that did not resolve; no symbols means everything."""
    check_range(start, end)
    if symbols is None:
        return asof.gold_asof(gold, as_of, start=start, end=end), None
    found, unresolved = identity.resolve_batch(symbols, identifiers, as_of)
    ids = found.select("security_id").distinct()
    return asof.gold_asof(gold.join(ids, "security_id", "left_semi"), as_of, start=start, end=end), unresolved


def features_by_id(
    gold: DataFrame, security_id: int, as_of: dt.date, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    check_range(start, end)
    return asof.gold_asof(gold, as_of, [security_id], start, end)


PERIOD_TYPES = {"annual": fundamentals.ANNUAL_DAYS, "quarterly": fundamentals.QUARTER_DAYS, "instant": None}


def fundamentals_rows(
    facts: DataFrame, concepts: DataFrame, as_of: dt.date, period_type: str,
    concept: str | None = None, statement: str | None = None, security_id: int | None = None,
) -> DataFrame:
    """Known facts of core concepts. Instants ride along with annual and quarterly flows."""
    if period_type not in PERIOD_TYPES:
        raise ValueError(f"unknown period type {period_type!r}")
    rules = concepts.where(F.col("research_status") == "core").select("concept", "statement")
    if concept is not None:
        rules = rules.where(F.col("concept") == concept)
    if statement is not None:
        rules = rules.where(F.col("statement") == statement)
    if security_id is not None:
        facts = facts.where(F.col("security_id") == security_id)
    known = asof.fundamentals_asof(facts, as_of).join(rules, "concept")
    days = fundamentals.duration_days()
    band = PERIOD_TYPES[period_type]
    keep = F.col("period_start").isNull()
    if band is not None:
        keep = keep | days.between(*band)
    return known.where(keep).select(
        "security_id", "concept", "statement", "period_start", "period_end", days.alias("duration_days"),
        "fiscal_period", "value", "unit", F.col("filed_at").alias("knowledge_time"),
    )


def fundamentals_of(
    facts: DataFrame, concepts: DataFrame, identifiers: DataFrame, symbol: str, as_of: dt.date,
    period_type: str = "annual", concept: str | None = None, statement: str | None = None,
) -> DataFrame:
    security_id = security_of(identifiers, symbol, as_of)
    rows = fundamentals_rows(facts, concepts, as_of, period_type, concept, statement, security_id)
    return rows.orderBy("concept", "period_end")


def macro(
    observations: DataFrame, series: DataFrame, series_id: str, as_of: dt.date,
    start: dt.date | None = None, end: dt.date | None = None,
) -> DataFrame:
    """Known values of one series with its metadata, oldest first."""
    check_range(start, end)
    code = series_id.upper()
    meta = series.where(F.upper("series_id") == code)
    # Looked up on the small table first: the large one is then filtered by plain values.
    names = [r.series_id for r in meta.select("series_id").distinct().collect()]
    if not names:
        raise NotFound(f"series {code} is unknown")
    rows = observations.where(F.col("series_id").isin(names) & date_range("obs_date", start, end))
    return asof.observations_asof(rows, as_of).join(meta, "series_id").orderBy("obs_date")
