"""Rolling price features per security.

Input: security_id, session_date, close with one row per (security, session).
Warm-up rows are null. All features share one partitioning by security; a
security holds at most one row per calendar day, so no partition outgrows it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRADING_DAYS = 252
GOLD_COLUMNS = [
    "security_id", "symbol", "session_date", "knowledge_time", "adj_close", "adj_volume",
    "return_1d", "log_return_1d", "sma20", "sma50", "ema20", "realized_vol20", "roc20", "momentum_12_1",
]


def series(ahead: Sequence[str] = ()):
    """Rows of a security by session. `ahead` names columns that ascend with it: the same order, as another step sorts."""
    return Window.partitionBy("security_id").orderBy(*ahead, "session_date")


def _last(n: int, ahead: Sequence[str] = ()):
    return series(ahead).rowsBetween(-(n - 1), Window.currentRow)


def _lag(n: int, ahead: Sequence[str] = ()) -> Column:
    return F.lag("close", n).over(series(ahead))


def simple_return(period: int = 1, ahead: Sequence[str] = ()) -> Column:
    return F.try_divide(F.col("close"), _lag(period, ahead)) - 1.0


def log_return(period: int = 1, ahead: Sequence[str] = ()) -> Column:
    return F.ln(F.try_divide(F.col("close"), _lag(period, ahead)))


def sma(window: int, ahead: Sequence[str] = ()) -> Column:
    full = F.count("close").over(_last(window, ahead)) == window
    return F.when(full, F.avg("close").over(_last(window, ahead)))


def realized_vol(log_returns: str, window: int = 20, ahead: Sequence[str] = ()) -> Column:
    """Annualised sample deviation of a log-return column; null until it is full."""
    frame = _last(window, ahead)
    full = F.count(log_returns).over(frame) == window
    return F.when(full, F.stddev_samp(log_returns).over(frame) * math.sqrt(TRADING_DAYS))


def roc(window: int = 20, ahead: Sequence[str] = ()) -> Column:
    return simple_return(window, ahead)


def momentum_12_1(ahead: Sequence[str] = ()) -> Column:
    return F.try_divide(_lag(21, ahead), _lag(252, ahead)) - 1.0


def with_ema(
    df: DataFrame, span: int, name: str, value: str = "close", keys: Sequence[str] = ("security_id",)
) -> DataFrame:
    """Exponential moving average, recursive from the first value of each key (no warm-up).

    EMA_i = q^i * sum(term_j * q^-j) is a running sum, so it stays linear where a
    sliding fold would not. Blocks keep q^-j inside the range of a double; a
    block's start adds the decayed value of the block before it. Two blocks back
    the weight is below exp(-600) and cannot change a double.
    """
    return _averaged(_placed(df, span, keys), span, name, value, keys).drop("_block", "_k")


def _decay(span: int) -> tuple[float, int]:
    """The weight a value keeps from one row to the next, and the rows of a block."""
    q = 1.0 - 2.0 / (span + 1)
    return q, int(600 / -math.log(q))


def _placed(df: DataFrame, span: int, keys: Sequence[str]) -> DataFrame:
    """Add the block of each row and its place in the block."""
    _, block = _decay(span)
    ordinal = F.row_number().over(Window.partitionBy(*keys).orderBy("session_date")) - 1
    return (
        df.withColumn("_i", ordinal)
        .withColumn("_block", F.floor(F.col("_i") / block))
        .withColumn("_k", F.col("_i") % block)
        .drop("_i")
    )


def _averaged(df: DataFrame, span: int, name: str, value: str, keys: Sequence[str]) -> DataFrame:
    """The average of placed rows, which are sorted by key, block and session."""
    q, block = _decay(span)
    alpha = 2.0 / (span + 1)
    inside = Window.partitionBy(*keys, "_block").orderBy("session_date")
    across = Window.partitionBy(*keys).orderBy("_block", "session_date")
    power = F.pow(F.lit(q), F.col("_k"))
    seed = (F.col("_block") == 0) & (F.col("_k") == 0)
    term = F.when(seed, F.col(value)).otherwise(F.col(value) * alpha / power)
    carry = F.last(F.when(F.col("_k") == block - 1, F.col("_own")), ignorenulls=True).over(
        across.rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        df.withColumn("_own", power * F.sum(term).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn(name, F.col("_own") + power * q * F.coalesce(carry, F.lit(0.0)))
        .drop("_own")
    )


def gold(bars: DataFrame, knowledge: str = "own", seeded: bool = False) -> DataFrame:
    """Wide feature rows from adjusted bars (security_id, symbol, session_date, close, volume, knowledge_time).

    knowledge='own' keeps each bar's knowledge time; 'max_inputs' takes the latest
    knowledge time of the closes the longest look-back touches. Seeded bars also carry `ema_input`, the
    average on the last row of a stored look-back and the close elsewhere, and `warm`, true on rows before it.
    """
    if knowledge not in ("own", "max_inputs"):
        raise ValueError(f"unknown knowledge rule {knowledge!r}")
    # Rows are sorted twice, before they carry a feature: by session to place them, then by what the average is summed
    # by. In that order sessions still ascend, so all windows use it.
    keys, value = ["security_id"], "close"
    if seeded:
        # Exchanged by security alone; behind it a look-back is a key of its own, and its rows come first.
        bars, value = bars.repartition("security_id").withColumn("_live", ~F.col("warm")), "ema_input"
        keys.append("_live")
    ahead = [*keys[1:], "_block"]
    averaged = _averaged(_placed(bars, 20, keys), 20, "ema20", value, keys)
    out = averaged.withColumn("log_return_1d", log_return(1, ahead)).select(
        "*",
        simple_return(1, ahead).alias("return_1d"),
        sma(20, ahead).alias("sma20"),
        sma(50, ahead).alias("sma50"),
        realized_vol("log_return_1d", 20, ahead).alias("realized_vol20"),
        roc(20, ahead).alias("roc20"),
        momentum_12_1(ahead).alias("momentum_12_1"),
    )
    if knowledge == "max_inputs":
        out = out.withColumn("knowledge_time", F.max("knowledge_time").over(_last(253, ahead)))
    return out.withColumnRenamed("close", "adj_close").withColumnRenamed("volume", "adj_volume").select(
        *GOLD_COLUMNS
    )


def breadth(members: DataFrame, gold_rows: DataFrame) -> DataFrame:
    """Share of index members above their 50-session average, per session."""
    above = F.when(F.col("adj_close") > F.col("sma50"), 1.0).otherwise(0.0)
    ids = members.select("security_id").distinct()
    return (
        gold_rows.join(ids, "security_id", "left_semi")
        .where(F.col("sma50").isNotNull())
        .groupBy("session_date")
        .agg(F.avg(above).alias("breadth"), F.count(F.lit(1)).alias("members"))
    )
