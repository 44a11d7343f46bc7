"""Validity intervals turned into disjoint segments.

Overlapping intervals of one key are resolved once, on the small interval side.
A row with a date then matches at most one segment, so attaching an attribute to
a large table is one left join with no de-duplication shuffle behind it. Spark
picks broadcast or sort-merge by the measured size of the segment side, and
adaptive execution splits a hot key of the large side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintagelake.functions.temporal import FAR_FUTURE
from vintagelake.operators.select import first_per_key


def _closed(df: DataFrame) -> DataFrame:
    """Replace an open end by a far date and drop windows that contain no day."""
    end = F.coalesce(F.col("valid_to"), F.lit(FAR_FUTURE))
    return df.withColumn("_end", end).where(F.col("valid_from") < F.col("_end"))


def earliest_start_segments(intervals: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """On each day the interval with the smallest valid_from wins.

    An interval rules from the moment every earlier-starting one has ended, so a
    running maximum of the ends yields the segments in one ordered pass.
    """
    w = Window.partitionBy(key).orderBy(
        "valid_from", F.col("_end").desc(), *[F.col(v) for v in values]
    )
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    ruled = _closed(intervals).withColumn("_taken", F.max("_end").over(before))
    return (
        ruled.withColumn("seg_from", F.greatest("valid_from", F.coalesce("_taken", "valid_from")))
        .where(F.col("seg_from") < F.col("_end"))
        .select(key, "seg_from", F.col("_end").alias("seg_to"), "valid_from", "valid_to", *values)
    )


def latest_start_segments(intervals: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """On each day the interval with the largest valid_from wins.

    Equal starts: the longer window covers the shorter one on every day, so one row per (key, valid_from) is
    enough. The starts and ends of a key cut its time line into numbered segments. An interval is laid out as a
    few aligned blocks of 2**k segments, two for each k at most; a block keeps its latest interval, and a segment
    asks the one block of each k that holds it. So n windows of one key cost about n log n rows, however many of
    them overlap, and the blocks are dealt by (key, k, number), not by key.
    """
    one = first_per_key(
        _closed(intervals),
        [key, "valid_from"],
        [F.col("_end").desc(), *[F.col(v) for v in values]],
    )
    ruler = F.struct("valid_from", "valid_to", *values)
    ends = one.select(key, ruler.alias("_ruler"), F.explode(F.array("valid_from", "_end")).alias("_cut"))
    along = Window.partitionBy(key).orderBy("_cut")
    placed = ends.withColumn("_place", F.dense_rank().over(along) - 1)
    spans = placed.groupBy(key, "_ruler").agg(F.min("_place").alias("_lo"), F.max("_place").alias("_hi"))
    return _ruled(_segments(placed, key, along), _blocks(spans, key), key).select(
        key, "seg_from", "seg_to", "_ruler.valid_from", "_ruler.valid_to", *[f"_ruler.{v}" for v in values]
    )


def _log2(n: Column) -> Column:
    """The whole part of log2, without rounding."""
    return F.length(F.bin(n)) - 1


def _segments(placed: DataFrame, key: str, along: Window) -> DataFrame:
    """Segments between neighbouring cuts of a key: place, seg_from, seg_to, and the largest k a block can have."""
    cuts = placed.select(key, "_cut", "_place").distinct()
    return (
        cuts.withColumn("seg_to", F.lead("_cut").over(along))
        .withColumn("_top", _log2(F.count(F.lit(1)).over(Window.partitionBy(key))))
        .where(F.col("seg_to").isNotNull())
        .select(key, "_place", F.col("_cut").alias("seg_from"), "seg_to", "_top")
    )


def _blocks(spans: DataFrame, key: str) -> DataFrame:
    """The latest ruler of every block (k, number) that intervals [lo, hi) are laid out as."""
    sized = spans.withColumn("_level", F.explode(F.sequence(F.lit(0), _log2(F.col("_hi") - F.col("_lo")))))
    # Blocks of 2**k inside [lo, hi); what a larger k covers needs no smaller block.
    first, after = F.expr("shiftright(_lo + shiftleft(1, _level) - 1, _level)"), F.expr("shiftright(_hi, _level)")
    edge = F.array(F.when(first % 2 == 1, first), F.when(after % 2 == 1, after - 1))
    blocks = sized.where(first < after).select(key, "_ruler", "_level", F.explode(edge).alias("_number"))
    return blocks.where("_number IS NOT NULL").groupBy(key, "_level", "_number").agg(F.max("_ruler").alias("_ruler"))


def _ruled(segments: DataFrame, blocks: DataFrame, key: str) -> DataFrame:
    """Each segment with the latest ruler among the blocks that hold it; segments in no block are left out."""
    asked = segments.withColumn("_level", F.explode(F.sequence(F.lit(0), "_top"))).withColumn("_number", F.expr("shiftright(_place, _level)"))
    found = asked.join(blocks, [key, "_level", "_number"])
    return found.groupBy(key, "_place", "seg_from", "seg_to").agg(F.max("_ruler").alias("_ruler"))


def attach(
    rows: DataFrame, segments: DataFrame, key: str, day: str, values: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join each row to the one segment of its key that contains its day."""
    seg = segments.select(F.col(key).alias("_key"), "seg_from", "seg_to", *values)
    hit = (
        (F.col(key) == F.col("_key"))
        & (F.col("seg_from") <= F.col(day))
        & (F.col(day) < F.col("seg_to"))
    )
    return rows.join(seg, hit, how).drop("_key", "seg_from", "seg_to")
