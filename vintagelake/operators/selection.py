"""Exact order statistics by histogram passes: no sort, and nothing gathered but bucket sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Buckets for each doubling of a value in the first pass, and buckets of each later pass.
PER_DOUBLING = 16
BUCKETS = 1 << 14
# Above the exponents of all doubles.
_SHIFT = 1100 * PER_DOUBLING


def _by_size(x: Column) -> Column:
    """Signed bucket by magnitude: grows with x, zero for zero. At most 2 * 2200 * PER_DOUBLING + 1 of them."""
    step = F.floor(F.log2(F.abs(x)) * PER_DOUBLING).cast("bigint") + _SHIFT
    return F.when(x == 0, F.lit(0).cast("bigint")).when(x > 0, step).otherwise(-step)


def _between(x: Column, lo: float, hi: float) -> Column:
    """Bucket of equal width inside [lo, hi]; grows with x."""
    return F.floor((x - F.lit(lo)) / F.lit(hi - lo) * (BUCKETS - 1)).cast("bigint")


def upper_median(rows: DataFrame, value: str, weight: str | None = None) -> float | None:
    """The element floor(n / 2), from 0, of the sorted finite values; nulls are left out, None without values.

    weight: how often a row's value counts (default once). Each pass sums up buckets that keep the order of the
    values, and the next one looks into the bucket that holds the element: first by magnitude, then in equal
    widths, until a bucket holds one value. Widths shrink 16,000-fold, so four passes reach the last bit of a double.
    rows is read once a pass and should be stored; the driver sees one row for each bucket, at most 70,401.
    """
    times = F.lit(1) if weight is None else F.col(weight)
    x = rows.select(F.col(value).cast("double").alias("x"), times.cast("bigint").alias("n")).where("abs(x) <= 1.7976931348623157e308D AND n > 0")
    part, bucket, rank = x, _by_size(F.col("x")), None
    while True:
        sums = (
            part.groupBy(bucket.alias("bucket"))
            .agg(F.sum("n").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
            .collect()
        )
        if not sums:
            return None
        sums.sort(key=lambda r: r.bucket)
        if rank is None:
            rank = sum(r.n for r in sums) // 2
        for r in sums:
            if rank < r.n:
                break
            rank -= r.n
        if r.lo == r.hi:
            return r.lo
        bucket = _between(F.col("x"), r.lo, r.hi)
        part = x.where((F.col("x") >= F.lit(r.lo)) & (F.col("x") <= F.lit(r.hi)))
