"""Feature refresh: split-adjusted bars, point-in-time symbols, features, chosen months."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintagelake.operators.adjust import bars_asof
from vintagelake.operators.features import gold
from vintagelake.operators.identity import attach_symbol

HEAL_DAYS = 5  # early in a month the previous one is emitted again
PRICE_LOOKBACK = 252
EMA_LOOKBACK = 400  # weight left out: (19/21)^400, about 4e-18


def refresh(
    bars: DataFrame,
    actions: DataFrame,
    identifiers: DataFrame,
    as_of: dt.date,
    start: dt.date | None = None,
    months: list[tuple[int, int]] | None = None,
    security_ids: list[int] | None = None,
    knowledge: str = "own",
) -> DataFrame:
    """Feature rows. `start` bounds the bars read (look-back included); `months` what is emitted."""
    adjusted = bars_asof(bars, actions, as_of, security_ids, start=start, adjustment="split")
    named = attach_symbol(adjusted.drop("symbol"), identifiers).withColumnRenamed("ticker", "symbol")
    rows = gold(
        named.select("security_id", "symbol", "session_date", "knowledge_time", "close", "volume"), knowledge
    )
    return rows if months is None else rows.where(in_months(months))


def in_months(months: list[tuple[int, int]]) -> Column:
    keep = F.lit(False)
    for y, m in months:
        first = dt.date(y, m, 1)
        following = dt.date(y + m // 12, m % 12 + 1, 1)
        keep = keep | ((F.col("session_date") >= F.lit(first)) & (F.col("session_date") < F.lit(following)))
    return keep


def months_to_emit(today: dt.date) -> list[tuple[int, int]]:
    """The current month, and the previous one during the first days of a month."""
    months = [(today.year, today.month)]
    if today.day <= HEAL_DAYS:
        last = dt.date(today.year, today.month, 1) - dt.timedelta(days=1)
        months.insert(0, (last.year, last.month))
    return months


def nightly_plan(sessions: DataFrame, today: dt.date, lookback: int = PRICE_LOOKBACK) -> DataFrame:
    """Months to emit and the first session to read: `lookback` sessions strictly before the earliest month."""
    months = months_to_emit(today)
    first = dt.date(*months[0], 1)
    before = (
        sessions.where(F.col("session_date") < F.lit(first))
        .orderBy(F.col("session_date").desc())
        .limit(lookback)
        .agg(F.coalesce(F.min("session_date"), F.lit(first)).alias("lookback_start"))
    )
    listed = F.array(*[F.struct(F.lit(y).alias("year"), F.lit(m).alias("month")) for y, m in months])
    return before.select("lookback_start", F.explode(listed).alias("p")).select(
        "lookback_start", "p.year", "p.month"
    )


def nightly(
    bars: DataFrame, actions: DataFrame, identifiers: DataFrame, sessions: DataFrame, today: dt.date,
    as_of: dt.date | None = None, lookback: int = EMA_LOOKBACK, knowledge: str = "own",
) -> DataFrame:
    """The nightly refresh: months and first session as planned, so older bars are never read.

    With bars from lake.scan_months the date bound prunes month partitions. The plan is two rows at most.
    """
    plan = nightly_plan(sessions, today, lookback).collect()
    months = [(r.year, r.month) for r in plan]
    return refresh(
        bars, actions, identifiers, as_of or today, start=plan[0].lookback_start, months=months, knowledge=knowledge
    )
