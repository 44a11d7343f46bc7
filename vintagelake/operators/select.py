"""Top-one-per-key and null-safe append, the two shapes most operators need."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of every key.

    row_number() = 1 is planned with a map-side group limit, so each map task
    sends at most one row per key to the shuffle: a key that holds a third of
    the table costs one row per map task, not a third of the table.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def first_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """Keep n rows per key with their position; same map-side limit as above."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("position", F.row_number().over(w)).where(F.col("position") <= n)


def null_safe(left: str, right: str, keys: Sequence[str]) -> Column:
    """Conjunction of <=> over keys; Spark still plans it as an equi-join."""
    out = F.lit(True)
    for key in keys:
        out = out & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return out


def absent_from(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of new whose key, nulls included, is not in existing."""
    have = existing.select(*keys).distinct()
    return new.alias("n").join(have.alias("e"), null_safe("n", "e", keys), "left_anti")


def append_missing(
    existing: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Insert-or-ignore: the rows of new to append, one per key, first in order wins."""
    return first_per_key(absent_from(new, existing, keys), keys, order)


def upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """New rows replace existing rows of the same key."""
    both = new.withColumn("_new", F.lit(0)).unionByName(existing.withColumn("_new", F.lit(1)))
    return first_per_key(both, keys, [F.col("_new"), *order]).drop("_new")


def beside(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Put one-row aggregates next to each other as scalar subqueries; no join is planned."""
    for other in others:
        first = first.withColumns({c: other.select(c).scalar() for c in other.columns})
    return first
