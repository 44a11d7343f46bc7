"""Price and corporate-action expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Read-time precedence of action sources.
SOURCE_PRECEDENCE = {"MANUAL": 0, "SEC": 1, "TIINGO": 2, "BOOTSTRAP": 3}
OTHER_PRECEDENCE = 99

SPLIT_EPSILON = 1e-9
RATIO_TOLERANCE = 1e-6
MAX_DENOMINATOR = 1000


def source_rank(source: str = "source") -> Column:
    out = F.lit(OTHER_PRECEDENCE)
    for name, rank in SOURCE_PRECEDENCE.items():
        out = F.when(F.col(source) == name, rank).otherwise(out)
    return out


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def best_ratio(factor: Column) -> Column:
    """Closest fraction with a denominator up to 1000, as struct(err, d, n); the smallest denominator among equals."""
    denominators = F.sequence(F.lit(1), F.lit(MAX_DENOMINATOR)).cast("array<double>")

    def search(f: Column) -> Column:
        errors = F.transform(denominators, lambda d: F.abs(f - F.rint(f * d) / d))
        at = lambda e, least: F.struct(least.alias("err"), F.array_position(e, least).cast("double").alias("d"))
        nearest = bound(errors, lambda e: bound(F.array_min(e), lambda least: at(e, least)))
        return bound(nearest, lambda x: F.struct(x["err"].alias("err"), x["d"].alias("d"), F.rint(f * x["d"]).alias("n")))

    return bound(factor, search)


def ratio_is_exact(ratio: Column, factor: Column) -> Column:
    limit = F.lit(RATIO_TOLERANCE) * F.greatest(F.lit(1.0), F.abs(factor))
    return F.abs(ratio["n"] / ratio["d"] - factor) <= limit


def split_price_factor(split_from: str = "split_from", split_to: str = "split_to") -> Column:
    """split_from / split_to; a missing or zero side is an error, never a silent 1."""
    a, b = F.col(split_from), F.col(split_to)
    bad = a.isNull() | b.isNull() | (a == 0) | (b == 0)
    return F.when(bad, F.raise_error(F.lit("SPLIT without a ratio")).cast("double")).otherwise(a / b)


def dividend_price_factor(close: Column, cash: Column) -> Column:
    """(C - D) / C with the close before the ex-date; no effect without a positive close."""
    return F.when(close > 0, (close - F.coalesce(cash, F.lit(0.0))) / close).otherwise(F.lit(1.0))


def adjusted_volume(volume: Column, factor: Column) -> Column:
    """Whole shares, ties to even."""
    return F.rint(volume * factor).cast("bigint")
