"""As-of reads: the latest version of each fact known at a moment."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintagelake.functions.temporal import date_range, known_by, valid_on
from vintagelake.operators.select import first_per_key

BAR_KEY = ["security_id", "session_date"]


def bar_order() -> list[Column]:
    """Latest knowledge, then latest batch; the payload settles exact ties so a read is repeatable."""
    return [
        F.col("knowledge_time").desc(),
        F.col("batch_id").desc(),
        F.col("source").asc(),
        *[
            F.col(c).desc()
            for c in ("close", "volume", "open", "high", "low", "trade_count", "vwap")
        ],
    ]


def latest_rank() -> Column:
    """bar_order as one value, whose maximum is the first row; so a plain sum on the map side finds it.

    A source that sorts earlier has the larger mirror. The payload is part of the value.
    """
    mirrored = F.translate(F.hex("source"), "0123456789ABCDEF", "FEDCBA9876543210")
    mirror = F.coalesce(F.concat(mirrored, F.lit("G")), F.lit("H"))
    payload = ("close", "volume", "open", "high", "low", "trade_count", "vwap")
    return F.struct("knowledge_time", "batch_id", mirror.alias("mirror"), *payload)


def bars_asof_raw(
    bars: DataFrame,
    as_of: dt.date | dt.datetime,
    security_ids: Iterable[int] | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Unadjusted bars as known at as_of. All filters sit below the de-duplication."""
    out = bars.where(known_by(as_of)).where(date_range("session_date", start, end))
    if security_ids is not None:
        out = out.where(F.col("security_id").isin(list(security_ids)))
    return first_per_key(out, BAR_KEY, bar_order())


def latest_bars(bars: DataFrame) -> DataFrame:
    """Latest-known bar with no cut-off, as the quality checks use it."""
    return first_per_key(bars, BAR_KEY, bar_order())


def gold_asof(
    gold: DataFrame,
    as_of: dt.date | dt.datetime,
    security_ids: Iterable[int] | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Feature rows as known at as_of."""
    out = gold.where(known_by(as_of)).where(date_range("session_date", start, end))
    if security_ids is not None:
        out = out.where(F.col("security_id").isin(list(security_ids)))
    order = [F.col("knowledge_time").desc(), F.col("adj_close").desc(), F.col("adj_volume").desc()]
    return first_per_key(out, BAR_KEY, order)


FACT_KEY = ["security_id", "concept", "period_end", "period_start"]


def fundamentals_asof(facts: DataFrame, as_of: dt.date | dt.datetime) -> DataFrame:
    """Latest filing per fact; an instant (null period_start) is a key of its own."""
    order = [F.col("filed_at").desc(), F.col("accession").desc(), F.col("value").desc(), F.col("unit").desc()]
    return first_per_key(facts.where(known_by(as_of, "filed_at")), FACT_KEY, order)


def observations_asof(observations: DataFrame, as_of: dt.date) -> DataFrame:
    """Latest vintage of every observation."""
    out = observations.where(F.col("vintage_date") <= F.lit(as_of))
    return first_per_key(out, ["series_id", "obs_date"], [F.col("vintage_date").desc(), F.col("value").desc()])


def macro_value_asof(observations: DataFrame, series_id: str, obs_date: dt.date, as_of: dt.date) -> DataFrame:
    """Point lookup of one observation; no row when nothing was known."""
    hit = observations.where(
        (F.col("series_id") == series_id)
        & (F.col("obs_date") == F.lit(obs_date))
        & (F.col("vintage_date") <= F.lit(as_of))
    )
    return (
        hit.groupBy("series_id", "obs_date")
        .agg(F.max_by("value", "vintage_date").alias("value"), F.max("vintage_date").alias("vintage_date"))
    )


def world_state(
    observations: DataFrame, facts: DataFrame, securities: DataFrame, series_id: str, as_of: dt.date
) -> DataFrame:
    """Latest total assets of each security beside one macro value, both as of one day.

    Without a macro value there is no context and the result is empty.
    """
    context = (
        observations_asof(observations.where(F.col("series_id") == series_id), as_of)
        .agg(F.max_by(F.struct("value"), "obs_date").alias("latest"))
        .scalar()
    )
    assets = facts.where(
        (F.col("concept") == "total_assets") & F.col("period_start").isNull() & known_by(as_of, "filed_at")
    )
    assets = first_per_key(
        assets,
        ["security_id"],
        [F.col("period_end").desc(), F.col("filed_at").desc(), F.col("accession").desc(), F.col("value").desc()],
    )
    return (
        assets.join(securities.select("security_id", "figi", "description"), "security_id")
        .withColumn("_context", context)
        .where(F.col("_context").isNotNull())
        .select(
            "security_id", "figi", "description", F.col("value").alias("total_assets"),
            "period_end", F.col("_context.value").alias("context_value"),
        )
    )


def members_asof(membership: DataFrame, day: dt.date, universe: str | None = None) -> DataFrame:
    """Event-time membership: who was in the index on that day."""
    out = membership.where(valid_on(day))
    if universe is not None:
        out = out.where(F.col("universe") == universe)
    return out.select("universe", "security_id", "valid_from", "valid_to")


def members_asof_bitemporal(
    membership: DataFrame, day: dt.date, known: dt.date | dt.datetime, universe: str | None = None
) -> DataFrame:
    """Membership of a day, restricted to what had been loaded by the known moment."""
    return members_asof(membership.where(known_by(known)), day, universe)


def members_asof_strict(membership: DataFrame, day: dt.date, universe: str | None = None) -> DataFrame:
    """First form of the read: the knowledge date may not lie after the day itself."""
    return members_asof(membership.where(F.to_date("knowledge_time") <= F.lit(day)), day, universe)


def member_bars(membership: DataFrame, bars: DataFrame, universe: str | None, as_of: dt.date) -> DataFrame:
    """Bars, as of a day, of the securities that were index members on that day."""
    ids = members_asof(membership, as_of, universe).select("security_id").distinct()
    # The semi-join runs below the de-duplication: non-member bars never reach the shuffle.
    return bars_asof_raw(bars.join(ids, "security_id", "left_semi"), as_of)
