"""Comparison of a rebuilt bar dataset with the one it replaces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintagelake import session
from vintagelake.operators.asof import BAR_KEY, latest_bars, latest_rank
from vintagelake.operators.calendar import bounded
from vintagelake.operators.select import beside
from vintagelake.operators.selection import upper_median

# Size of a sample, where one is asked for, and relative price tolerance.
SAMPLE_SIZE = 5000
PRICE_TOLERANCE = 0.001
SAMPLE_SEED = 420
PRICES = ("open", "high", "low", "close")


def row_counts(old: DataFrame, new: DataFrame) -> DataFrame:
    return beside(old.agg(F.count(F.lit(1)).alias("old_rows")), new.agg(F.count(F.lit(1)).alias("new_rows")))


def coverage_missing(old: DataFrame, new: DataFrame) -> DataFrame:
    """(security, session) pairs the rebuild lost."""
    return old.select(*BAR_KEY).distinct().join(new.select(*BAR_KEY).distinct(), BAR_KEY, "left_anti")


def bad_sessions(new: DataFrame, sessions: DataFrame) -> DataFrame:
    """Dates with any knowledge time other than the session close; a date without a session is bad too."""
    pairs = new.select("session_date", "knowledge_time").distinct()
    closes = bounded(sessions).select("session_date", "close_utc")
    off = F.col("close_utc").isNull() | (F.col("knowledge_time") != F.col("close_utc"))
    return pairs.join(closes, "session_date", "left").where(off).select("session_date").distinct()


def knowledge_violations(new: DataFrame, sessions: DataFrame) -> DataFrame:
    """All rows of every offending date."""
    return new.join(bad_sessions(new, sessions), "session_date", "left_semi")


def duplicate_pairs(new: DataFrame) -> DataFrame:
    return new.groupBy(*BAR_KEY).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def shared_pairs(old: DataFrame, new: DataFrame) -> DataFrame:
    """All pairs that both sides hold. Old rows are reduced to the latest version, new rows are taken as they are."""
    values = [*PRICES, "volume"]
    left = latest_bars(old).select(*BAR_KEY, *[F.col(c).alias(f"old_{c}") for c in values])
    right = new.select(*BAR_KEY, *[F.col(c).alias(f"new_{c}") for c in values])
    return left.join(right, BAR_KEY)


def sampled(pairs: DataFrame, size: int = SAMPLE_SIZE, seed: int = SAMPLE_SEED) -> DataFrame:
    """Fixed-size repeatable sample of pairs: the lowest hashes of seed and key, a top-n per task, not a full sort."""
    draw = F.md5(F.concat_ws("|", F.lit(seed), "security_id", "session_date"))
    values = [f"new_{c}" for c in (*PRICES, "volume")]
    return pairs.withColumn("draw", draw).orderBy("draw", *BAR_KEY, *values).limit(size).drop("draw")


def _price_differs(old: Column, new: Column, tolerance: float) -> Column:
    scale = F.greatest(F.abs(old), F.abs(new), F.lit(1e-9))
    one_null = old.isNull() != new.isNull()
    return one_null | F.coalesce(F.abs(old - new) > scale * tolerance, F.lit(False))


def price_diffs(pairs: DataFrame, tolerance: float = PRICE_TOLERANCE) -> DataFrame:
    """Prices that differ by more than the tolerance, one row per field."""
    fields = F.array(
        *[
            F.struct(F.lit(c).alias("field"), F.col(f"old_{c}").alias("old_value"), F.col(f"new_{c}").alias("new_value"))
            for c in PRICES
        ]
    )
    rows = pairs.select(*BAR_KEY, F.explode(fields).alias("p")).select(*BAR_KEY, "p.*")
    return rows.where(_price_differs(F.col("old_value"), F.col("new_value"), tolerance))


def _volume_differs() -> Column:
    return ~F.col("old_volume").eqNullSafe(F.col("new_volume"))


def volume_diffs(pairs: DataFrame) -> DataFrame:
    return pairs.where(_volume_differs()).select(*BAR_KEY, "old_volume", "new_volume")


def _differences(old: str, new: str, tolerance: float) -> Column:
    """How many of the four prices differ."""
    each = [_price_differs(F.col(f"{old}{c}"), F.col(f"{new}{c}"), tolerance).cast("int") for c in PRICES]
    return sum(each[1:], each[0])


def _volume_rel(old: Column, new: Column) -> Column:
    """Relative volume difference; null where the old volume is null or 0 or the new one is null."""
    return F.when((old != 0) & new.isNotNull(), F.abs(old - new) / old)


def pairs_summary(pairs: DataFrame, tolerance: float = PRICE_TOLERANCE) -> DataFrame:
    """One row: number of pairs, difference counts, and the upper median of the relative volume difference.

    The pairs are computed once, into the shared folder.
    """
    rel = _volume_rel(F.col("old_volume"), F.col("new_volume"))
    seen, path = session.staged(
        pairs.select(
            _differences("old_", "new_", tolerance).alias("prices"), _volume_differs().cast("int").alias("volumes"), rel.alias("rel")
        ),
        "pairs",
    )
    counts = seen.agg(
        F.count(F.lit(1)).alias("compared"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("prices", "volumes")]
    ).first()
    median = upper_median(seen, "rel")
    session.discard(pairs.sparkSession, path)
    return pairs.sparkSession.createDataFrame(
        [(counts.compared, counts.prices, counts.volumes, median)],
        "compared bigint, price_diffs bigint, volume_diffs bigint, volume_rel_median double",
    )


def tagged(old: DataFrame, new: DataFrame, sessions: DataFrame, tolerance: float = PRICE_TOLERANCE) -> DataFrame:
    """Both lakes by (security, session), from one scan of each: a row for each pair of the old lake and for each
    distinct version of the new one.

    copies: rows it stands for. is_new: its side. lost: a pair without a new row. repeated: the first version of a pair
    with several new rows. off: its knowledge time is not the session's close. shared: a version with an old row;
    prices, volumes, rel: its differences from the latest old row. Rows meet by a flag in one grouping, whose
    sums start on the map side, then by pair; null keys are equal.
    """
    version = F.struct(*PRICES, "volume", "knowledge_time")
    sides = (
        old.select(*BAR_KEY, F.lit(False).alias("is_new"), F.lit(None).cast(new.select(version.alias("v")).schema["v"].dataType).alias("v"),
                   latest_rank().alias("rank"))
        .unionByName(
            new.select(*BAR_KEY, F.lit(True).alias("is_new"), version.alias("v"), F.lit(None).cast(old.select(latest_rank().alias("r")).schema["r"].dataType).alias("rank"))
        )
    )
    reduced = sides.groupBy(*BAR_KEY, "is_new", "v").agg(F.count(F.lit(1)).alias("copies"), F.max("rank").alias("rank"))
    pair = Window.partitionBy(*BAR_KEY)
    news = F.sum(F.when(F.col("is_new"), F.col("copies"))).over(pair)
    met = reduced.select(
        "*", news.alias("news"), F.max("rank").over(pair).alias("last"), F.max(~F.col("is_new")).over(pair).alias("has_old"),
        F.row_number().over(pair.orderBy("is_new", "v")).alias("at"), F.count_if(~F.col("is_new")).over(pair).alias("olds"),
    )
    closes = bounded(sessions).select("session_date", "close_utc")
    met = met.join(closes, "session_date", "left")
    is_new, shared = F.col("is_new"), F.col("is_new") & F.col("has_old")
    off = F.col("close_utc").isNull() | F.coalesce(F.col("v.knowledge_time") != F.col("close_utc"), F.lit(True))
    return met.select(
        "session_date", "copies", "is_new", (~is_new & F.col("news").isNull()).alias("lost"),
        (is_new & (F.col("news") > 1) & (F.col("at") == F.col("olds") + 1)).alias("repeated"), (is_new & off).alias("off"),
        shared.alias("shared"),
        F.when(shared, _differences("last.", "v.", tolerance)).alias("prices"),
        F.when(shared, (~F.col("last.volume").eqNullSafe(F.col("v.volume"))).cast("int")).alias("volumes"),
        F.when(shared, _volume_rel(F.col("last.volume"), F.col("v.volume"))).alias("rel"),
    )


def report(
    old: DataFrame, new: DataFrame, sessions: DataFrame, sample: int | None = None,
    seed: int = SAMPLE_SEED, tolerance: float = PRICE_TOLERANCE,
) -> DataFrame:
    """All stages in one row, over all shared pairs or a sample of them. Lost pairs, duplicates and wrong knowledge times fail; value differences do not.

    Both lakes are read once; what they say of each pair is stored in the shared folder and summed from there.
    """
    spark = old.sparkSession
    seen, path = session.staged(tagged(old, new, sessions, tolerance), "rebuild")
    n = F.col("copies")
    count = lambda cond: F.sum(F.when(cond, n).otherwise(0))
    dates = seen.groupBy("session_date").agg(
        count(~F.col("is_new")).alias("old_rows"), count(F.col("is_new")).alias("new_rows"),
        F.count_if("lost").alias("coverage_missing"), F.count_if("repeated").alias("duplicate_pairs"), F.max("off").alias("off"),
        count(F.col("shared")).alias("compared"),
        *[F.coalesce(F.sum(F.col(c) * n), F.lit(0)).alias(to) for c, to in (("prices", "price_diffs"), ("volumes", "volume_diffs"))],
    )
    names = ["old_rows", "new_rows", "coverage_missing", "duplicate_pairs", "knowledge_violations", "compared", "price_diffs", "volume_diffs"]
    # One wrong knowledge time makes all new rows of its date wrong.
    dates = dates.withColumn("knowledge_violations", F.when(F.col("off"), F.col("new_rows")).otherwise(0))
    totals = dates.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]).first().asDict()
    if sample is None:
        totals["volume_rel_median"] = upper_median(seen, "rel", "copies")
    else:
        totals |= pairs_summary(sampled(shared_pairs(old, new), sample, seed), tolerance).first().asDict()
    session.discard(spark, path)
    kinds = ", ".join(f"{c} bigint" for c in names)
    order = [*names, "volume_rel_median"]
    one = spark.createDataFrame([tuple(totals[c] for c in order)], f"{kinds}, volume_rel_median double")
    return one.withColumn("passed", gate())


def gate() -> Column:
    return (
        (F.col("coverage_missing") == 0) & (F.col("duplicate_pairs") == 0) & (F.col("knowledge_violations") == 0)
    )
