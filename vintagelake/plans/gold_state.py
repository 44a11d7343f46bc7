"""The nightly refresh from stored window state.

A state holds, for each security, what the features of later sessions need of the earlier ones: the last 252
split-adjusted closes, the average that runs over all of them, and the splits that went into both. A night reads the
state and the sessions from its boundary on. Closes are stored as of a moment, so two things decide whether they hold:

* a split whose ex-date lies at or after the boundary scales every stored close alike, and is applied as a factor;
* a bar of a stored session that became known or was stored later, or another split before the boundary, makes the
  state of its security void. That security alone is read from its beginning.

Late bars are found by knowledge time or batch: batch ids ascend, so a bar of a stored session that arrives later has
a larger batch than any the state has seen. Both bounds are pushed into the scan. A state is a plain table, one row
for each security; write it with Parquet and read it for the next night.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintagelake import session
from vintagelake.functions.pricing import split_price_factor
from vintagelake.functions.temporal import as_of_instant, date_range, known_by
from vintagelake.operators.actions import effective_actions
from vintagelake.operators.adjust import bars_asof
from vintagelake.operators.features import gold, with_ema
from vintagelake.operators.identity import attach_symbol
from vintagelake.operators.select import first_n_per_key
from vintagelake.plans.gold import in_months, months_to_emit

TAIL = 252  # sessions; the longest look-back of a feature
FEW = 1000  # void securities up to here are named in the scan's filter, more of them are joined
_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
_SPLITS = "array<struct<ex_date:date,f:double>>"


class Header(NamedTuple):
    """The boundary of a state (sessions before it are stored), its as-of in microseconds, the largest batch it has seen."""

    before: dt.date
    known_at: int
    upto_batch: int


def _micros(as_of: dt.date | dt.datetime) -> int:
    moment = as_of_instant(as_of)
    moment = moment if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc)
    return (moment - _EPOCH) // dt.timedelta(microseconds=1)


def header(state: DataFrame) -> Header | None:
    """None for a state without securities; a table of mixed states is an error."""
    found = state.select("before", "known_at", "upto_batch").distinct().limit(2).collect()
    if len(found) > 1:
        raise ValueError("rows of several states in one table")
    return Header(*found[0]) if found else None


def _splits(actions: DataFrame, as_of: dt.date | dt.datetime, before: dt.date) -> DataFrame:
    """Of each security: its splits before the boundary, and the product of those at or after it."""
    daily = (
        effective_actions(actions, as_of).where(F.col("action_type") == "SPLIT")
        .groupBy("security_id", "ex_date").agg(F.product(split_price_factor()).alias("f"))
    )
    earlier = F.col("ex_date") < F.lit(before)
    return daily.groupBy("security_id").agg(
        F.sort_array(F.collect_list(F.when(earlier, F.struct("ex_date", "f")))).alias("splits"),
        F.product(F.when(~earlier, F.col("f"))).alias("scale"),
    )


def _adjusted(bars: DataFrame, actions: DataFrame, as_of, start: dt.date | None, before: dt.date | None) -> DataFrame:
    last = before - dt.timedelta(days=1) if before else None
    rows = bars_asof(bars, actions, as_of, start=start, end=last, adjustment="split")
    return rows.select("security_id", "session_date", "knowledge_time", "close", "volume")


def _late(bars: DataFrame, head: Header, as_of: dt.date | dt.datetime) -> DataFrame:
    """Bars of stored sessions that the state has not seen."""
    seen = F.lit(_EPOCH + dt.timedelta(microseconds=head.known_at))
    later = (F.col("knowledge_time") > seen) | (F.col("batch_id") > F.lit(head.upto_batch))
    return bars.where((F.col("session_date") < F.lit(head.before)) & later & known_by(as_of))


def _compared(state: DataFrame, actions: DataFrame, head: Header, as_of: dt.date | dt.datetime) -> DataFrame:
    """The state with the factor that brings its closes to as_of, null where its splits have changed."""
    now = _splits(actions, as_of, head.before).select("security_id", F.col("splits").alias("_splits"), F.col("scale").alias("_scale"))

    def listed(name: str) -> Column:
        return F.coalesce(F.col(name), F.array().cast(_SPLITS))

    factor = F.try_divide(F.coalesce("_scale", F.lit(1.0)), F.coalesce("scale", F.lit(1.0)))
    holds = listed("splits") == listed("_splits")
    return state.join(now, "security_id", "left").withColumn("_factor", F.when(holds, factor)).drop("_splits", "_scale")


def void_securities(state: DataFrame, bars: DataFrame, actions: DataFrame, as_of: dt.date | dt.datetime) -> DataFrame:
    """security_id of those whose stored windows no longer hold as of that moment, and of those only late bars tell of."""
    head = header(state)
    if head is None:
        return bars.where(known_by(as_of)).select("security_id").distinct()
    changed = _compared(state, actions, head, as_of).where("_factor IS NULL").select("security_id")
    return _late(bars, head, as_of).select("security_id").unionByName(changed).distinct()


def _unstored(rows: DataFrame) -> DataFrame:
    """Rows that are no stored look-back: each takes part in the average with its own close."""
    return rows.withColumn("warm", F.lit(False)).withColumn("ema_input", F.col("close"))


def _tails(state: DataFrame, actions: DataFrame, head: Header, as_of: dt.date | dt.datetime) -> DataFrame:
    """The stored closes as rows. The last one hands on the average; those before it are look-back alone."""
    held = _compared(state, actions, head, as_of).where("_factor IS NOT NULL")
    rows = held.select("security_id", "ema20", "_factor", F.size("tail").alias("_n"), F.posexplode("tail").alias("_i", "_bar"))
    warm = F.col("_i") < F.col("_n") - 1
    return rows.select(
        "security_id", "_bar.session_date", "_bar.knowledge_time", (F.col("_bar.close") * F.col("_factor")).alias("close"),
        F.lit(None).cast("bigint").alias("volume"), warm.alias("warm"), (F.col("ema20") * F.col("_factor")).alias("ema_input"),
    )


def _line(
    state: DataFrame | None, bars: DataFrame, actions: DataFrame, as_of: dt.date | dt.datetime, before: dt.date | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """Sessions from the state's boundary on (to `before`), and what lies behind them: tails, or history of the void."""
    head = header(state) if state is not None else None
    if head is None:
        return _unstored(_adjusted(bars, actions, as_of, None, before)), None
    if _micros(as_of) < head.known_at:
        raise ValueError("the state knows more than as_of")
    new = _unstored(_adjusted(bars, actions, as_of, head.before, before))
    void = session.stored(void_securities(state, bars, actions, as_of))
    named = [r.security_id for r in void.limit(FEW + 1).collect()]
    if not named:
        return new, _tails(state, actions, head, as_of)
    few = len(named) <= FEW
    own = bars.where(F.col("security_id").isin(named)) if few else bars.join(void, "security_id", "left_semi")
    kept = state.join(void, "security_id", "left_anti")
    history = _unstored(_adjusted(own, actions, as_of, None, head.before))
    return new, _tails(kept, actions, head, as_of).unionByName(history)


def advance(
    state: DataFrame | None, bars: DataFrame, actions: DataFrame, as_of: dt.date | dt.datetime, before: dt.date
) -> DataFrame:
    """The state of all sessions before a boundary, from an earlier state (None: from the beginning) and later sessions."""
    head = header(state) if state is not None else None
    if head is not None and before < head.before:
        raise ValueError("a state cannot go back")
    new, behind = _line(state, bars, actions, as_of, before)
    line = new if behind is None else new.unionByName(behind)
    averaged = with_ema(line, 20, "ema20", value="ema_input", keys=("security_id", "warm"))
    last = first_n_per_key(averaged, ["security_id"], [F.col("session_date").desc()], TAIL)
    windows = last.groupBy("security_id").agg(
        F.sort_array(F.collect_list(F.struct("session_date", "close", "knowledge_time"))).alias("tail"),
        F.max(F.when(F.col("position") == 1, F.col("ema20"))).alias("ema20"),
    )
    unseen = bars.where(date_range("session_date", None, before - dt.timedelta(days=1)))
    if head is not None:
        unseen = unseen.where((F.col("session_date") >= F.lit(head.before)) | (F.col("batch_id") > F.lit(head.upto_batch)))
    batches = unseen.where(known_by(as_of)).agg(
        F.greatest(F.max("batch_id"), F.lit(head.upto_batch if head else None).cast("bigint")).alias("b")
    )
    return windows.join(_splits(actions, as_of, before), "security_id", "left").select(
        "security_id", "tail", "ema20", F.col("splits").cast(_SPLITS).alias("splits"), F.coalesce("scale", F.lit(1.0)).alias("scale"),
        F.lit(before).alias("before"), F.lit(_micros(as_of)).cast("bigint").alias("known_at"),
        batches.select("b").scalar().alias("upto_batch"),
    )


def nightly(
    state: DataFrame, bars: DataFrame, actions: DataFrame, identifiers: DataFrame, today: dt.date,
    as_of: dt.date | dt.datetime | None = None, knowledge: str = "own",
) -> DataFrame:
    """Feature rows of the months of a night, equal to a refresh over all bars. The boundary must not lie after them."""
    months = months_to_emit(today)
    head = header(state)
    if head is not None and head.before > dt.date(*months[0], 1):
        raise ValueError("the state ends inside the months to emit")
    new, behind = _line(state, bars, actions, as_of or today)
    line = attach_symbol(new, identifiers).withColumnRenamed("ticker", "symbol")
    if behind is not None:
        line = line.unionByName(behind.withColumn("symbol", F.lit(None).cast("string")))
    return gold(line, knowledge, seeded=behind is not None).where(in_months(months))
