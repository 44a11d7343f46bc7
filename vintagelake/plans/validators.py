"""Oracles for the adjustment: against a vendor's own adjusted series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintagelake.functions.pricing import dividend_price_factor, split_price_factor
from vintagelake.operators import actions, adjust, asof
from vintagelake.operators.stats import error_stats, evenly_spaced

# Acceptance gates.
TOTAL_RETURN_TOLERANCE = 1e-3
CORRELATION_FLOOR = 0.9999
SPLIT_TOLERANCE = 1e-9


STATS = ("n", "mean", "median", "p95", "max", "worst_date", "correlation", "r2")


def _sampled(pairs: DataFrame, sample: int | None) -> DataFrame:
    return pairs if sample is None else evenly_spaced(pairs, "security_id", "session_date", sample)


def _stats(pairs: DataFrame, kinds: dict[str, tuple[str, str]], keep: tuple[str, ...] = ()) -> DataFrame:
    """Error figures of several (ours, reference) column pairs, one row per security.

    The pairs are stacked and measured together, so what produced them runs once. Columns to keep hold one value
    in all rows of a security.
    """
    stacked = F.array(
        *[
            F.struct(F.lit(k).alias("kind"), F.col(ours).alias("ours"), F.col(ref).alias("reference"))
            for k, (ours, ref) in kinds.items()
        ]
    )
    rows = pairs.select("security_id", *keep, "session_date", F.explode(stacked).alias("s"))
    figures = error_stats(rows.select("security_id", *keep, "session_date", "s.*"), "security_id", *keep, "kind")
    one = figures.groupBy("security_id", *keep).agg(
        *[F.max(F.when(F.col("kind") == k, F.struct(*STATS))).alias(k) for k in kinds]
    )
    return one.select("security_id", *keep, *[F.col(f"{k}.{c}").alias(f"{k}_{c}") for k in kinds for c in STATS])


def self_contained(vendor: DataFrame, sample: int | None = None) -> DataFrame:
    """Vendor raw prices, adjusted with actions derived from the same rows, against the vendor's adjusted close.

    vendor holds one row per (security, session), and an action lies on its day's row: prices are adjusted by
    running products over a security's rows and actions counted there, without a join. Every day is compared, or about `sample` days per
    security where given. Split-only prices are gated only
    where no dividend was paid, since the vendor series contains dividends.
    """
    is_split, split = actions.row_split()
    pays = F.col("div_cash") > 0
    line = Window.partitionBy("security_id").orderBy("session_date").rowsBetween(Window.unboundedPreceding, -1)
    # From the end of the line backwards: the product over strictly later days.
    later = Window.partitionBy("security_id").orderBy(F.col("session_date").desc()).rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce("_split", F.lit(1.0))
    paid = F.when(pays, dividend_price_factor(F.last("close", ignorenulls=True).over(line), F.col("div_cash")))
    own_rows = Window.partitionBy("security_id")
    both = (
        vendor.withColumn("_split", split)
        .withColumn("_own", own)
        .withColumn("_all", own * F.coalesce(paid, F.lit(1.0)))
        .withColumn("_splits", F.coalesce(F.product("_own").over(later), F.lit(1.0)))
        .select(
            "security_id", "session_date", "close", "adj_close",
            (F.col("close") * F.coalesce(F.product("_all").over(later), F.lit(1.0))).alias("total_return"),
            (F.col("close") * F.col("_splits")).alias("split_only"),
            F.count_if(is_split).over(own_rows).alias("splits"), F.count_if(pays).over(own_rows).alias("dividends"),
        )
    )
    kinds = {"split": ("split_only", "adj_close"), "total": ("total_return", "adj_close")}
    return (
        _stats(_sampled(both, sample), kinds, ("splits", "dividends"))
        .withColumn(
            "total_ok",
            (F.col("total_n") > 0) & (F.col("total_max") < TOTAL_RETURN_TOLERANCE)
            & (F.col("total_correlation") > CORRELATION_FLOOR),
        )
        .withColumn(
            "split_ok",
            (F.col("dividends") > 0) | ((F.col("split_n") > 0) & (F.col("split_max") < SPLIT_TOLERANCE)),
        )
        .withColumn("passed", F.col("total_ok") & F.col("split_ok"))
    )


def _time_line(lake: DataFrame, known: DataFrame, vendor: DataFrame) -> DataFrame:
    """One row per (security, day) with what the lake, the stored actions and the vendor say of that day.

    The three are sent to the security's task once, tagged; days are put together there. A security has at most a
    few rows for each day, so its task is bounded by the calendar.
    """
    is_split, _ = actions.row_split()
    derived = is_split.cast("int") + F.coalesce((F.col("div_cash") > 0).cast("int"), F.lit(0))
    bars = lake.select("security_id", "session_date", F.col("close").alias("lake_close"), F.lit(True).alias("in_lake"))
    theirs = vendor.select(
        "security_id", "session_date", F.struct(F.col("close").alias("raw"), F.col("adj_close").alias("adj")).alias("theirs"),
        derived.cast("bigint").alias("derived"),
    )
    dated = known.select(
        "security_id", F.col("ex_date").alias("session_date"), F.lit(1).cast("bigint").alias("stored"),
        F.when(F.col("action_type") == "SPLIT", split_price_factor()).alias("split"),
        F.when(F.col("action_type") == "CASH_DIVIDEND", F.coalesce("cash_amount", F.lit(0.0))).alias("cash"),
    )
    tagged = bars.unionByName(theirs, allowMissingColumns=True).unionByName(dated, allowMissingColumns=True)
    return tagged.repartition("security_id").groupBy("security_id", "session_date").agg(
        F.max("lake_close").alias("close"), F.coalesce(F.max("in_lake"), F.lit(False)).alias("in_lake"),
        F.max("theirs").alias("theirs"), F.sum("derived").alias("derived"), F.sum("stored").alias("stored"),
        F.product("split").alias("_split"), F.sort_array(F.collect_list("cash")).alias("_cash"),
    )


def against_vendor(
    bars: DataFrame, stored_actions: DataFrame, vendor: DataFrame, as_of: dt.date, sample: int | None = None
) -> DataFrame:
    """The lake's raw and adjusted closes against the vendor's, per security, with action coverage.

    vendor holds one row per (security, session). After the as-of reads of bars and actions all of it happens in one
    partitioning by security: factors, coverage of actions (expected ones lie on vendor rows; applicable ones have
    a lake bar before and one at or after them) and the error figures.
    """
    known = actions.effective_actions(stored_actions, as_of)
    days = _time_line(asof.bars_asof_raw(bars, as_of), known, vendor)
    own = Window.partitionBy("security_id")
    earlier = own.orderBy("session_date").rowsBetween(Window.unboundedPreceding, -1)
    backwards = own.orderBy(F.col("session_date").desc())
    later, onward = (backwards.rowsBetween(Window.unboundedPreceding, end) for end in (-1, Window.currentRow))
    placed = (
        days.withColumn("_ref", F.last("close", ignorenulls=True).over(earlier))
        .withColumn("_started", F.max("in_lake").over(earlier))
        .withColumn("_factor", F.coalesce("_split", F.lit(1.0)) * adjust.dividend_product())
        .withColumn("_goes_on", F.max("in_lake").over(onward))
        .withColumn("price_factor", F.coalesce(F.product("_factor").over(later), F.lit(1.0)))
    )
    applicable = F.when(F.col("_started") & F.col("_goes_on"), F.col("derived"))
    counted = placed.select(
        "*",
        *[
            F.coalesce(F.sum(c).over(own), F.lit(0)).alias(name)
            for name, c in {"expected": F.col("derived"), "applicable": applicable, "retrieved": F.col("stored")}.items()
        ],
    )
    common = counted.where(F.col("in_lake") & F.col("theirs").isNotNull()).select(
        "security_id", "session_date", "expected", "applicable", "retrieved",
        F.col("close").alias("lake_raw"), (F.col("close") * F.col("price_factor")).alias("lake_adj"),
        F.col("theirs.raw").alias("vendor_raw"), F.col("theirs.adj").alias("vendor_adj"),
    )
    kinds = {"raw": ("lake_raw", "vendor_raw"), "adj": ("lake_adj", "vendor_adj")}
    return (
        _stats(_sampled(common, sample), kinds, ("expected", "applicable", "retrieved"))
        .withColumn("boundary", F.col("expected") - F.col("applicable"))
        .withColumn("delta_max", F.col("adj_max") - F.col("raw_max"))
        .withColumn("delta_mean", F.col("adj_mean") - F.col("raw_mean"))
        .withColumn(
            "passed",
            (F.col("adj_n") > 0) & (F.col("adj_correlation") > CORRELATION_FLOOR)
            & (F.col("adj_r2") > CORRELATION_FLOOR) & (F.col("adj_max") < TOTAL_RETURN_TOLERANCE),
        )
    )
