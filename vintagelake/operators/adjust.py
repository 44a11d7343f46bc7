"""Split and dividend adjustment on read.

A bar on session s carries the product of the factors of all actions with an
ex-date strictly after s. Factors depend on the whole history, so a date range
is cut only after adjustment. After the as-of read a security has at most one
bar per day, which bounds every per-security window by the length of the
calendar however large the raw table is.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintagelake.functions.pricing import adjusted_volume, dividend_price_factor, split_price_factor
from vintagelake.functions.temporal import as_of_instant, date_range
from vintagelake.operators.actions import effective_actions
from vintagelake.operators.asof import bars_asof_raw

MODES = (None, "split", "total_return")
PRICES = ("open", "high", "low", "close", "vwap")


def check_mode(mode: str | None) -> None:
    if mode not in MODES:
        raise ValueError(f"adjustment mode must be one of {MODES}, got {mode!r}")


def split_segments(actions: DataFrame) -> DataFrame:
    """Cumulative split factor per security as date segments [after, before)."""
    daily = (
        actions.where(F.col("action_type") == "SPLIT")
        .groupBy("security_id", "ex_date")
        .agg(F.product(split_price_factor()).alias("f"))
    )
    later = Window.partitionBy("security_id").orderBy(F.col("ex_date").desc())
    running = later.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select(
        "security_id",
        F.lead("ex_date").over(later).alias("after"),
        F.col("ex_date").alias("before"),
        F.product("f").over(running).alias("cumulative"),
    )


def _with_split_factors(bars: DataFrame, actions: DataFrame) -> DataFrame:
    """Only actions are windowed; bars take part in one join and are not reshuffled when it is broadcast."""
    seg = split_segments(actions).withColumnRenamed("security_id", "_sec")
    hit = (
        (F.col("security_id") == F.col("_sec"))
        & (F.col("session_date") < F.col("before"))
        & (F.col("after").isNull() | (F.col("session_date") >= F.col("after")))
    )
    factor = F.coalesce("cumulative", F.lit(1.0))
    return (
        bars.join(seg, hit, "left")
        .withColumn("price_factor", factor)
        .withColumn("volume_factor", F.when(factor != 0, 1.0 / factor).otherwise(1.0))
        .drop("_sec", "after", "before", "cumulative")
    )


def dividend_references(bars: DataFrame, actions: DataFrame) -> DataFrame:
    """Close of the last session strictly before each ex-date; null when there is none."""
    return (
        _events(bars.select("security_id", "session_date", "close"), actions)
        .withColumn("ref_close", _previous_close())
        .where(F.col("_bar") == 0)
        .select("security_id", F.col("session_date").alias("ex_date"), "ref_close")
    )


def _events(bars: DataFrame, actions: DataFrame) -> DataFrame:
    """Bars and one action row per (security, ex-date) on a common time line."""
    daily = (
        actions.groupBy("security_id", F.col("ex_date").alias("session_date"))
        .agg(
            F.product(F.when(F.col("action_type") == "SPLIT", split_price_factor())).alias("_split"),
            # One entry per dividend of the day; each has its own factor.
            F.sort_array(
                F.collect_list(F.when(F.col("action_type") == "CASH_DIVIDEND", F.coalesce("cash_amount", F.lit(0.0))))
            ).alias("_cash"),
        )
        .withColumn("_bar", F.lit(0))
    )
    return bars.withColumn("_bar", F.lit(1)).unionByName(daily, allowMissingColumns=True)


def _previous_close():
    """Rows before an action row on the time line are exactly the strictly earlier sessions."""
    line = Window.partitionBy("security_id").orderBy("session_date", "_bar")
    return F.last("close", ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, -1))


def dividend_product() -> Column:
    """Product of the factors of a day's dividends."""
    step = lambda acc, c: acc * F.coalesce(dividend_price_factor(F.col("_ref"), c), F.lit(1.0))
    return F.coalesce(F.aggregate("_cash", F.lit(1.0), step), F.lit(1.0))


def _with_total_return_factors(bars: DataFrame, actions: DataFrame) -> DataFrame:
    """One shuffle by security: reference closes forward, then factor products backward."""
    timed = _events(bars, actions).withColumn("_ref", _previous_close())
    split = F.coalesce("_split", F.lit(1.0))
    timed = timed.withColumn("_f", split * dividend_product()).withColumn("_s", split)
    # From the end of the line backwards, a bar sees exactly the actions of later days.
    back = (
        Window.partitionBy("security_id")
        .orderBy(F.col("session_date").desc(), F.col("_bar").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    splits = F.product("_s").over(back)
    return (
        timed.withColumn("price_factor", F.product("_f").over(back))
        .withColumn("_splits", splits)
        .where(F.col("_bar") == 1)
        .withColumn("volume_factor", F.when(F.col("_splits") != 0, 1.0 / F.col("_splits")).otherwise(1.0))
        .drop("_bar", "_split", "_cash", "_ref", "_f", "_s", "_splits")
    )


def total_return_segments(bars: DataFrame, actions: DataFrame, as_of: dt.date | dt.datetime) -> DataFrame:
    """Suffix products of a security's actions as date segments [after, before), for storing.

    Every action day has one row: the factors of a bar on a day before it and not before the action day ahead of
    it. They are what bars and actions known at as_of give, and the row says so (known_at). A range read with these
    rows needs no bar outside the range.
    """
    known = bars_asof_raw(bars, as_of).select("security_id", "session_date", "close")
    timed = _events(known, effective_actions(actions, as_of)).withColumn("_ref", _previous_close()).where("_bar = 0")
    later = Window.partitionBy("security_id").orderBy(F.col("session_date").desc())
    back = later.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    split = F.coalesce("_split", F.lit(1.0))
    splits = F.product(split).over(back)
    return timed.select(
        "security_id",
        F.lead("session_date").over(later).alias("after"),
        F.col("session_date").alias("before"),
        F.product(split * dividend_product()).over(back).alias("price_factor"),
        F.when(splits != 0, 1.0 / splits).otherwise(1.0).alias("volume_factor"),
        F.lit(as_of_instant(as_of)).cast("timestamp").alias("known_at"),
    )


def with_stored_factors(bars: DataFrame, segments: DataFrame, as_of: dt.date | dt.datetime) -> DataFrame:
    """Bars with the factors of the one segment that holds their day; segments made for another as_of are an error."""
    wrong = F.raise_error(F.concat(F.lit("factors are stored as of "), F.col("known_at").cast("string"))).cast("double")
    fits = F.col("known_at") == F.lit(as_of_instant(as_of))
    seg = segments.select(
        F.col("security_id").alias("_sec"), "after", "before",
        *[F.when(fits, F.col(c)).otherwise(wrong).alias(f"_{c}") for c in ("price_factor", "volume_factor")],
    )
    hit = (
        (F.col("security_id") == F.col("_sec"))
        & (F.col("session_date") < F.col("before"))
        & (F.col("after").isNull() | (F.col("session_date") >= F.col("after")))
    )
    one = F.lit(1.0)
    return bars.join(seg, hit, "left").select(
        *bars.columns, F.coalesce("_price_factor", one).alias("price_factor"), F.coalesce("_volume_factor", one).alias("volume_factor")
    )


def with_factors(bars: DataFrame, actions: DataFrame, mode: str | None) -> DataFrame:
    """Bars (one per security and session) with price_factor and volume_factor."""
    check_mode(mode)
    if mode is None:
        return bars.withColumn("price_factor", F.lit(1.0)).withColumn("volume_factor", F.lit(1.0))
    if mode == "split":
        return _with_split_factors(bars, actions)
    return _with_total_return_factors(bars, actions)


def adjustment_factors(bars: DataFrame, actions: DataFrame, mode: str | None) -> DataFrame:
    return with_factors(bars, actions, mode).select(
        "security_id", "session_date", "price_factor", "volume_factor"
    )


def apply_factors(bars: DataFrame) -> DataFrame:
    """Scale prices and volume; trade count, knowledge time and source stay."""
    scaled = {c: (F.col(c) * F.col("price_factor")).alias(c) for c in PRICES}
    scaled["volume"] = adjusted_volume(F.col("volume"), F.col("volume_factor")).alias("volume")
    keep = [c for c in bars.columns if c not in ("price_factor", "volume_factor")]
    return bars.select(*[scaled.get(c, F.col(c)) for c in keep])


def bars_asof(
    bars: DataFrame,
    actions: DataFrame | None,
    as_of: dt.date | dt.datetime,
    security_ids: Iterable[int] | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    adjustment: str | None = None,
    segments: DataFrame | None = None,
) -> DataFrame:
    """As-of bars, adjusted on read.

    Unadjusted reads push the date range into the scan. Split factors come from
    actions alone, so there the range is also safe below the factor join. A
    total-return read needs the closes of the full history and is cut last, unless stored
    total_return_segments of the same as_of are given: then it too reads the range alone.
    """
    check_mode(adjustment)
    ids = list(security_ids) if security_ids is not None else None
    if adjustment is None:
        return bars_asof_raw(bars, as_of, ids, start, end)
    if adjustment == "total_return" and segments is not None:
        own = segments if ids is None else segments.where(F.col("security_id").isin(ids))
        return apply_factors(with_stored_factors(bars_asof_raw(bars, as_of, ids, start, end), own, as_of))
    if actions is None:
        raise ValueError("adjusted reads need the actions")
    acts = effective_actions(actions, as_of)
    if ids is not None:
        acts = acts.where(F.col("security_id").isin(ids))
    if adjustment == "split":
        return apply_factors(with_factors(bars_asof_raw(bars, as_of, ids, start, end), acts, adjustment))
    adjusted = apply_factors(with_factors(bars_asof_raw(bars, as_of, ids), acts, adjustment))
    return adjusted.where(date_range("session_date", start, end))
