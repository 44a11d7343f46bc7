"""Macro series with vintages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagelake.operators.select import append_missing

VINTAGE_KEY = ["series_id", "obs_date", "vintage_date"]


def new_observations(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Vintages to append: known keys and rows without a date are ignored."""
    dated = incoming.where(F.col("obs_date").isNotNull() & F.col("vintage_date").isNotNull())
    return append_missing(existing, dated, VINTAGE_KEY, [F.col("value").asc_nulls_last()])


def upsert_series(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """New metadata wins where given; series_id and source of a stored row stay."""
    stays = ("series_id", "source")
    new = incoming.alias("n").withColumn("_in", F.lit(True))
    old = existing.alias("o").withColumn("_have", F.lit(True))
    both = old.join(new, F.col("o.series_id") == F.col("n.series_id"), "full_outer")
    cols = [F.coalesce("o.series_id", "n.series_id").alias("series_id")]
    cols.append(F.when(F.col("_have"), F.col("o.source")).otherwise(F.col("n.source")).alias("source"))
    for c in existing.columns:
        if c not in stays:
            cols.append(F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c))
    return both.select(*cols)


def revision_depth(observations: DataFrame) -> DataFrame:
    return observations.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("vintage_rows"), F.countDistinct("obs_date").alias("obs_dates")
    )


def revised_observations(observations: DataFrame) -> DataFrame:
    """Observations whose value changed, with the first and the last vintage's value."""
    return (
        observations.groupBy("series_id", "obs_date")
        .agg(
            F.countDistinct("value").alias("values"),
            F.min_by("value", "vintage_date").alias("first_value"),
            F.max_by("value", "vintage_date").alias("last_value"),
        )
        .where(F.col("values") > 1)
    )
