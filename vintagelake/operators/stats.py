"""Agreement of a series with a reference, per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def evenly_spaced(df: DataFrame, group: str, order: str, k: int) -> DataFrame:
    """About k rows per group, evenly spread: positions floor(i * n / k) for i < k; all rows when n <= k.

    Whether a position is one of them is decided by arithmetic on its row, without a join.
    """
    w = Window.partitionBy(group)
    pos, n = F.col("_pos"), F.col("_n")
    near = F.floor(pos * k / n)
    hit = F.exists(
        F.sequence(near - 1, near + 2),
        lambda i: (i >= 0) & (i < k) & (F.floor(i * (n / F.lit(k))) == pos),
    )
    return (
        df.withColumn("_pos", F.row_number().over(w.orderBy(order)) - 1)
        .withColumn("_n", F.count(F.lit(1)).over(w))
        .where((n <= k) | hit)
        .drop("_pos", "_n")
    )


def _correlation() -> Column:
    """Pearson r with fixed answers where it is undefined: 1 for fewer than two pairs or two
    constant sides, 0 for one constant side."""
    vx, vy = F.var_pop("ours"), F.var_pop("reference")
    r = F.try_divide(F.covar_pop("ours", "reference"), F.sqrt(vx * vy))
    constant = (vx == 0) | (vy == 0)
    return (
        F.when(F.count("ours") < 2, 1.0)
        .when(constant, F.when(vx == vy, 1.0).otherwise(0.0))
        .otherwise(r)
    )


def error_stats(pairs: DataFrame, *group: str) -> DataFrame:
    """Relative error of `ours` against `reference` per group; pairs with reference 0 are left out.

    pairs has one row per (group, session_date), so a group is bounded by the calendar.
    """
    # Groups that lose all their pairs still report the empty answer.
    usable = F.col("reference") != 0
    rel = F.when(usable, F.abs(F.col("ours") - F.col("reference")) / F.abs("reference"))
    kept = pairs.withColumn("rel", rel).withColumn("ours", F.when(usable, F.col("ours"))).withColumn(
        "reference", F.when(usable, F.col("reference"))
    )
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    # Largest error, the earliest day among equals.
    worst = F.max(F.when(F.col("rel").isNotNull(), F.struct("rel", (-F.unix_date("session_date")).alias("day"))))
    out = kept.groupBy(*group).agg(
        F.count("rel").alias("n"),
        zero(F.avg("rel")).alias("mean"),
        # Both from one table of counts.
        F.percentile("rel", F.array(F.lit(0.5), F.lit(0.95))).alias("_ranks"),
        zero(F.max("rel")).alias("max"),
        worst.alias("_worst"),
        _correlation().alias("correlation"),
    )
    return (
        out.withColumn("worst_date", F.date_from_unix_date(-F.col("_worst.day")))
        .withColumn("r2", F.col("correlation") * F.col("correlation"))
        .withColumns({c: zero(F.get("_ranks", F.lit(i))) for i, c in enumerate(("median", "p95"))})
        .drop("_worst", "_ranks")
    )
