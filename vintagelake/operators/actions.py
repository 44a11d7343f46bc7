"""Corporate actions: derivation, point-in-time reads, append policy."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintagelake.functions.pricing import (
    SPLIT_EPSILON,
    best_ratio,
    bound,
    ratio_is_exact,
    source_rank,
)
from vintagelake.functions.temporal import day_start, known_by
from vintagelake.operators.select import first_per_key

ACTION_KEY = ["security_id", "action_type", "ex_date"]
PAYLOAD_TOLERANCE = 1e-9


def _factor() -> Column:
    """Missing and zero split factors mean no split."""
    f = F.coalesce(F.col("split_factor"), F.lit(1.0))
    return F.when(f == 0, F.lit(1.0)).otherwise(f)


def row_split() -> tuple[Column, Column]:
    """Of a vendor row: whether it carries a split, and the price factor of that split (null without one)."""
    f = _factor()
    is_split = F.abs(f - 1.0) > SPLIT_EPSILON
    factor = bound(best_ratio(f), lambda r: F.when(ratio_is_exact(r, f), r["d"] / r["n"]).otherwise(1.0 / f))
    return is_split, F.when(is_split, factor)


def derive_actions(vendor: DataFrame) -> DataFrame:
    """Splits and cash dividends found in vendor daily rows, one row per action.

    The ratio search runs only on rows that carry a split. `warning` is set where
    no small fraction reproduces the factor; the raw factor is then kept as 1 -> f.
    """
    ex = F.col("session_date").alias("ex_date")
    splits = (
        vendor.withColumn("_f", _factor())
        .where(F.abs(F.col("_f") - 1.0) > SPLIT_EPSILON)
        .withColumn("_r", best_ratio(F.col("_f")))
        .withColumn("_exact", ratio_is_exact(F.col("_r"), F.col("_f")))
        .select(
            "security_id",
            F.lit("SPLIT").alias("action_type"),
            ex,
            F.when(F.col("_exact"), F.col("_r.d")).otherwise(F.lit(1.0)).alias("split_from"),
            F.when(F.col("_exact"), F.col("_r.n")).otherwise(F.col("_f")).alias("split_to"),
            F.lit(None).cast("double").alias("cash_amount"),
            F.when(~F.col("_exact"), F.lit("ratio not exact")).alias("warning"),
        )
    )
    dividends = vendor.where(F.col("div_cash") > 0).select(
        "security_id",
        F.lit("CASH_DIVIDEND").alias("action_type"),
        ex,
        F.lit(None).cast("double").alias("split_from"),
        F.lit(None).cast("double").alias("split_to"),
        F.col("div_cash").alias("cash_amount"),
        F.lit(None).cast("string").alias("warning"),
    )
    return splits.unionByName(dividends)


def known_actions(actions: DataFrame, as_of: dt.date | dt.datetime, sources: DataFrame | None = None) -> DataFrame:
    """Actions effective and known at as_of; rows without a known source are dropped."""
    day = as_of.date() if isinstance(as_of, dt.datetime) else as_of
    out = actions.where((F.col("ex_date") <= F.lit(day)) & known_by(as_of) & F.col("source").isNotNull())
    if sources is not None:
        out = out.join(sources.select(F.col("name").alias("source")), "source", "left_semi")
    return out


def by_precedence(actions: DataFrame) -> DataFrame:
    """One action per (security, type, ex-date): best source, then latest knowledge."""
    return first_per_key(
        actions,
        ACTION_KEY,
        [source_rank(), F.col("knowledge_time").desc(), F.col("action_id").desc()],
    )


def effective_actions(actions: DataFrame, as_of: dt.date | dt.datetime) -> DataFrame:
    return by_precedence(known_actions(actions, as_of))


def _same_number(a: Column, b: Column) -> Column:
    both_null = a.isNull() & b.isNull()
    return both_null | F.coalesce(F.abs(a - b) <= PAYLOAD_TOLERANCE, F.lit(False))


def same_payload(left: str, right: str) -> Column:
    """Equal ratio for a split, equal amount for a dividend."""
    split = _same_number(F.col(f"{left}.split_from"), F.col(f"{right}.split_from")) & _same_number(
        F.col(f"{left}.split_to"), F.col(f"{right}.split_to")
    )
    cash = _same_number(F.col(f"{left}.cash_amount"), F.col(f"{right}.cash_amount"))
    return F.when(F.col(f"{left}.action_type") == "SPLIT", split).otherwise(cash)


def _slot() -> Column:
    """Slot of the leading payload number, two tolerances wide; rows without one share slot 0."""
    lead = F.when(F.col("action_type") == "SPLIT", F.col("split_to")).otherwise(F.col("cash_amount"))
    return F.coalesce(F.floor(lead / (2 * PAYLOAD_TOLERANCE)).cast("bigint"), F.lit(0))


def write_outcomes(existing: DataFrame, incoming: DataFrame, order: Sequence[str]) -> DataFrame:
    """Outcome of appending each incoming action: inserted, skipped_exact or conflict.

    Keyed per source. Stored rows decide first: a stored equal payload skips, any
    other stored payload conflicts. Where nothing is stored the first row of the
    batch is inserted and the rest compare with it. `order` must be unique.
    """
    key = [*ACTION_KEY, "source"]
    pay = ["split_from", "split_to", "cash_amount"]
    stored = existing.select(*key, *pay).distinct().withColumn("_slot", _slot())
    # Equal payloads lie in the same or a neighbouring slot, so a key with many stored
    # payloads is met only where the numbers nearly agree, never pair by pair.
    near = incoming.withColumn(
        "_slot", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: _slot() + d))
    )
    same_slot = [F.col(f"i.{k}") == F.col(f"s.{k}") for k in [*key, "_slot"]]
    equal = (
        near.alias("i").join(stored.alias("s"), [*same_slot, same_payload("i", "s")], "left_semi")
        .select(*order).distinct().withColumn("_equal", F.lit(True))
    )
    known = existing.select(*key).distinct().withColumn("_any", F.lit(True))
    seen = incoming.join(known, key, "left").join(equal, list(order), "left")
    first = first_per_key(incoming, key, [F.col(c) for c in order]).select(*key, *pay, *order)
    flagged = seen.alias("n").join(
        first.alias("f"), [F.col(f"n.{k}") == F.col(f"f.{k}") for k in key]
    )
    is_first = F.lit(True)
    for c in order:
        is_first = is_first & (F.col(f"n.{c}") == F.col(f"f.{c}"))
    outcome = (
        F.when(F.col("n._equal"), "skipped_exact")
        .when(F.col("n._any"), "conflict")
        .when(is_first, "inserted")
        .when(same_payload("n", "f"), "skipped_exact")
        .otherwise("conflict")
    )
    return flagged.select("n.*", outcome.alias("outcome")).drop("_any", "_equal")


def outcome_tallies(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("source", "outcome").agg(F.count(F.lit(1)).alias("n"))


def _told() -> Column:
    """Payload of an action as text."""
    return F.when(F.col("action_type") == "SPLIT", F.concat_ws("->", "split_from", "split_to")).otherwise(
        F.concat(F.lit("$"), F.col("cash_amount"))
    )


def conflict_messages(outcomes: DataFrame, existing: DataFrame) -> DataFrame:
    """Readable line for each conflicting action: what is stored under its key, and what came in.

    Stored are the existing rows and those that the batch inserts; only keys in conflict are looked up.
    """
    key = [*ACTION_KEY, "source"]
    bad = outcomes.where(F.col("outcome") == "conflict")
    pay = [*key, "split_from", "split_to", "cash_amount"]
    held = existing.select(*pay).unionByName(outcomes.where(F.col("outcome") == "inserted").select(*pay))
    stored = (
        held.join(bad.select(*key).distinct(), key, "left_semi")
        .select(*key, _told().alias("told")).distinct()
        .groupBy(*key).agg(F.array_join(F.sort_array(F.collect_list("told")), "; ").alias("stored"))
    )
    line = F.format_string("CONFLICT %s %s: existing [%s] != incoming [%s]", "action_type", F.col("ex_date").cast("string"), "stored", _told())
    return bad.join(stored, key).select("action_id", line.alias("message"))


# Start of the full load and length of the rolling window.
HISTORY_START = dt.date(2016, 1, 1)
ROLLING_DAYS = 10


def stamp_bootstrap(actions: DataFrame) -> DataFrame:
    """History load: an action counts as known from its ex-date."""
    return actions.withColumn("knowledge_time", day_start(F.col("ex_date"))).withColumn(
        "source", F.lit("BOOTSTRAP")
    )


def stamp_canonical(actions: DataFrame, ingested_at: dt.datetime, source: str = "TIINGO") -> DataFrame:
    """Regular load: one ingest time for the batch."""
    return actions.withColumn("knowledge_time", F.lit(ingested_at)).withColumn("source", F.lit(source))


def load_window(today: dt.date, full: bool, history_start: dt.date = HISTORY_START) -> dt.date:
    """First ex-date of a load: the whole history, or the last days."""
    return history_start if full else today - dt.timedelta(days=ROLLING_DAYS)


def load_status(symbols: DataFrame) -> DataFrame:
    """Batch status from per-symbol failures: partial when any symbol failed."""
    return symbols.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("symbols"),
        F.count_if("failed").alias("symbols_failed"),
        F.when(F.count_if("failed") > 0, "partial").otherwise("succeeded").alias("status"),
    )
