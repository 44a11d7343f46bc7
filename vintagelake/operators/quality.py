"""Data-quality checks on bars and corporate actions."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintagelake import session
from vintagelake.functions.temporal import listed_on
from vintagelake.operators.asof import BAR_KEY, latest_rank
from vintagelake.operators.calendar import bounded, session_index
from vintagelake.operators.identity import tickers
from vintagelake.operators.select import beside, first_n_per_key

# Gates of the bar checks.
COVERAGE_FLOOR_PCT = 99.0
FRESH_TOLERANCE_SESSIONS = 1
SAMPLE_CAP = 20
DUPLICATE_EXAMPLES = 10
ZERO_VOLUME_EXAMPLES = 50


def with_bars_ids(bars: DataFrame) -> DataFrame:
    return bars.select("security_id").distinct()


def coverage(bars: DataFrame, securities: DataFrame) -> DataFrame:
    """Seeded securities, those with bars, and the rate; ids with bars but no master row are counted apart."""
    have = with_bars_ids(bars)
    seeded = securities.agg(F.count(F.lit(1)).alias("seeded"))
    found = have.agg(F.count(F.lit(1)).alias("with_bars"))
    orphan = have.join(securities, "security_id", "left_anti").agg(F.count(F.lit(1)).alias("orphan_ids"))
    one = beside(seeded, found, orphan)
    pct = F.when(F.col("seeded") > 0, F.round(F.col("with_bars") * 100.0 / F.col("seeded"), 2)).otherwise(0.0)
    return one.select(
        "seeded", "with_bars", (F.col("seeded") - F.col("with_bars")).alias("missing"),
        pct.alias("coverage_pct"), "orphan_ids",
    )


def coverage_missing(bars: DataFrame, securities: DataFrame, identifiers: DataFrame, today: dt.date) -> DataFrame:
    """Listed tickers of securities without any bar."""
    bare = securities.select("security_id").join(with_bars_ids(bars), "security_id", "left_anti")
    listed = tickers(identifiers).where(listed_on(today))
    return listed.join(bare, "security_id", "left_semi").select("security_id", "ticker")


def _violations() -> dict[str, Column]:
    """Price-order violations; null prices violate nothing."""
    outside = (
        (F.col("close") < F.col("low")) | (F.col("close") > F.col("high"))
        | (F.col("open") < F.col("low")) | (F.col("open") > F.col("high"))
    )
    nonpos = (F.col("open") <= 0) | (F.col("high") <= 0) | (F.col("low") <= 0) | (F.col("close") <= 0)
    return {"high_lt_low": F.col("high") < F.col("low"), "ohlc_outside": outside, "nonpositive": nonpos}


def sanity(latest: DataFrame) -> DataFrame:
    """Price-order violations of the latest bars, in one pass."""
    counts = [F.count_if(cond).alias(name) for name, cond in _violations().items()]
    return latest.agg(*counts, F.count(F.lit(1)).alias("total")).withColumn(
        "violations", F.col("high_lt_low") + F.col("ohlc_outside") + F.col("nonpositive")
    )


def duplicates(bars: DataFrame) -> DataFrame:
    """Raw rows that repeat (security, session, knowledge time)."""
    return (
        bars.groupBy("security_id", "session_date", "knowledge_time")
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )


def duplicate_examples(bars: DataFrame, n: int = DUPLICATE_EXAMPLES) -> DataFrame:
    order = [F.col("copies").desc(), "security_id", "session_date", "knowledge_time"]
    return duplicates(bars).orderBy(*order).limit(n)


def zero_volume(latest: DataFrame) -> DataFrame:
    return latest.where(F.col("volume").isNull() | (F.col("volume") <= 0))


def zero_volume_examples(latest: DataFrame, n: int = ZERO_VOLUME_EXAMPLES) -> DataFrame:
    return (
        zero_volume(latest)
        .select("symbol", "session_date", "security_id")
        .orderBy("session_date", "symbol", "security_id")
        .limit(n)
    )


def _session_flags(sessions: DataFrame) -> DataFrame:
    """session_date, is_session: one row per session of the pinned calendar, hence bounded."""
    days = bounded(sessions).select("session_date")
    return F.broadcast(days.withColumn("is_session", F.lit(True)))


def _with_expected(own: DataFrame, index: DataFrame) -> DataFrame:
    """Add missing = sessions in [first_bar, last_bar] minus observed, from a running session count (session_index).

    The count has one row per calendar day, so both look-ups are broadcast; nothing
    of size securities x sessions is built. Days outside the calendar are clamped.
    """
    first = index.select(
        F.col("day").alias("_first"),
        (F.col("sessions_upto") - F.col("is_session").cast("bigint")).alias("before_first"),
    )
    last = index.select(F.col("day").alias("_last"), F.col("sessions_upto").alias("upto_last"))
    ends = index.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    clamped = (
        beside(own, ends)
        .withColumn("_first", F.least(F.greatest("first_bar", "lo"), "hi"))
        .withColumn("_last", F.least(F.greatest("last_bar", "lo"), "hi"))
    )
    return (
        clamped.join(F.broadcast(first), "_first", "left").join(F.broadcast(last), "_last", "left")
        .withColumn("missing", F.col("upto_last") - F.col("before_first") - F.col("observed"))
        .drop("lo", "hi", "_first", "_last", "upto_last", "before_first")
    )


def gaps(latest: DataFrame, sessions: DataFrame) -> DataFrame:
    """Number of missing sessions inside each security's own first-to-last window."""
    own = latest.join(_session_flags(sessions), "session_date", "left").groupBy("security_id").agg(
        F.min("symbol").alias("symbol"),
        F.min("session_date").alias("first_bar"),
        F.max("session_date").alias("last_bar"),
        F.count("is_session").alias("observed"),
    )
    return _with_expected(own, session_index(sessions)).select("security_id", "symbol", "missing").where(F.col("missing") > 0)


def gap_dates(latest: DataFrame, sessions: DataFrame) -> DataFrame:
    """The missing sessions themselves."""
    own = latest.groupBy("security_id").agg(
        F.min("session_date").alias("first_bar"), F.max("session_date").alias("last_bar")
    )
    days = bounded(sessions).select("session_date")
    own = own.withColumn("session_date", F.explode(F.sequence("first_bar", "last_bar")))
    expected = own.join(days, "session_date", "left_semi")
    seen = latest.select("security_id", "session_date")
    return expected.join(seen, ["security_id", "session_date"], "left_anti")


def gap_totals(latest: DataFrame, sessions: DataFrame) -> DataFrame:
    """Number of interior gaps over all securities, from a running session count.

    listing_era_leak counts securities with more sessions than their window holds, 0 unless windows are wrong.
    """
    own = latest.join(_session_flags(sessions), "session_date", "left").groupBy("security_id").agg(
        F.min("session_date").alias("first_bar"), F.max("session_date").alias("last_bar"), F.count("is_session").alias("observed")
    )
    return _with_expected(own, session_index(sessions)).agg(
        F.coalesce(F.sum(F.greatest(F.col("missing"), F.lit(0))), F.lit(0)).alias("interior_total"),
        F.count_if(F.col("missing") < 0).alias("listing_era_leak"),
    )


def freshness(bars: DataFrame, sessions: DataFrame, today: dt.date) -> DataFrame:
    """Sessions the lake is behind the calendar."""
    lake = bars.agg(F.max("session_date").alias("lake_max"))
    past = bounded(sessions).where(F.col("session_date") <= F.lit(today))
    behind = F.count_if(F.col("session_date") > F.col("lake_max"))
    return beside(past, lake).agg(
        F.max("lake_max").alias("lake_max"),
        F.max("session_date").alias("calendar_max"),
        F.when(F.max("lake_max").isNull(), F.lit(0)).otherwise(behind).alias("sessions_behind"),
    ).withColumn(
        "status",
        F.when(F.col("lake_max").isNull(), "empty")
        .when(F.col("sessions_behind") <= FRESH_TOLERANCE_SESSIONS, "current")
        .otherwise("stale"),
    )


def _per_security(bars: DataFrame, index: DataFrame) -> DataFrame:
    """Everything the summary needs, in one pass over the raw bars: one row per security.

    Versions of equal knowledge time are counted and reduced on the map side, then the versions of a session.
    """
    versions = bars.groupBy(*BAR_KEY, "knowledge_time").agg(F.count(F.lit(1)).alias("copies"), F.max(latest_rank()).alias("last"))
    latest = versions.groupBy(*BAR_KEY).agg(F.max("last").alias("last"), F.count_if(F.col("copies") > 1).alias("repeats"))
    days = F.broadcast(index.where("is_session").select(F.col("day").alias("session_date"), "is_session"))
    marked = latest.select(*BAR_KEY, "repeats", "last.*").join(days, "session_date", "left")
    return marked.groupBy("security_id").agg(
        F.min("session_date").alias("first_bar"),
        F.max("session_date").alias("last_bar"),
        F.count("is_session").alias("observed"),
        *[F.count_if(cond).alias(name) for name, cond in _violations().items()],
        F.count_if(F.col("volume").isNull() | (F.col("volume") <= 0)).alias("zero_volume"),
        F.sum("repeats").alias("repeats"),
    )


def run_all(bars: DataFrame, securities: DataFrame, sessions: DataFrame, today: dt.date) -> DataFrame:
    """One row per check with its verdict; gaps, zero volume and freshness only report.

    The bars are read once. The calendar is counted once and stored: one row for each of its days. listing_era_leak
    counts securities with more sessions observed than their window holds, which is 0 unless windows are wrong.
    """
    index = session.stored(session_index(sessions))
    own = _with_expected(_per_security(bars, index), index)
    names = list(_violations())
    totals = own.agg(
        F.count(F.lit(1)).alias("with_bars"),
        F.sum(sum((F.col(n) for n in names[1:]), F.col(names[0]))).alias("sanity_violations"),
        F.sum("zero_volume").alias("zero_volume"),
        F.sum(F.greatest(F.col("missing"), F.lit(0))).alias("interior_gaps"),
        F.count_if(F.col("missing") < 0).alias("listing_era_leak"),
        F.coalesce(F.sum("repeats"), F.lit(0)).alias("duplicates"),
        F.max("last_bar").alias("lake_max"),
    )
    upto = lambda day: F.coalesce(F.max(F.when(F.col("day") <= day, F.col("sessions_upto"))), F.lit(0))
    seeded = securities.agg(F.count(F.lit(1)).alias("seeded"))
    one = beside(totals, seeded, index.agg(upto(F.lit(today)).alias("upto_today")))
    # The last stored day is known only here: it meets the calendar's few rows in a broadcast join.
    day = F.least("lake_max", index.agg(F.max("day").alias("d")).scalar())
    one = one.withColumn("at", day).join(
        F.broadcast(index.select(F.col("day").alias("at"), F.col("sessions_upto").alias("upto_lake"))), "at", "left"
    )
    pct = F.when(F.col("seeded") > 0, F.round(F.col("with_bars") * 100.0 / F.col("seeded"), 2)).otherwise(0.0)
    behind = F.greatest(F.col("upto_today") - F.coalesce("upto_lake", F.lit(0)), F.lit(0))

    def metric(name: str, value: Column, passed: Column):
        return F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"), passed.alias("passed"))

    def none(name: str):
        return metric(name, F.col(name), F.col(name) == 0)

    yes = F.lit(True)
    rows = F.array(
        metric("coverage_pct", pct, (F.col("seeded") == 0) | (pct >= COVERAGE_FLOOR_PCT)),
        none("sanity_violations"), none("duplicates"), none("listing_era_leak"),
        metric("interior_gaps", F.col("interior_gaps"), yes),
        metric("zero_volume", F.col("zero_volume"), yes),
        metric("sessions_behind", behind, yes),
    )
    return one.select(F.explode(rows).alias("m")).select("m.*")


def check_policy(checks: DataFrame) -> DataFrame:
    """Enabled checks with the tolerated anomaly fraction (1.0 when not given)."""
    fraction = F.coalesce(F.get_json_object("spec", "$.fail_fraction").cast("double"), F.lit(1.0))
    return checks.where(F.col("enabled")).select(F.col("name").alias("check_name"), "severity", fraction.alias("fail_fraction"))


def with_policy(counts: DataFrame, checks: DataFrame) -> DataFrame:
    """Attach the policy; a check without an enabled definition is an error."""
    joined = counts.join(check_policy(checks).drop("severity"), "check_name", "left")
    unknown = F.raise_error(F.concat(F.lit("no enabled check named "), F.col("check_name"))).cast("double")
    return joined.withColumn("fail_fraction", F.coalesce("fail_fraction", unknown))


def verdicts(counts: DataFrame) -> DataFrame:
    """Verdict for (check, batch) rows with anomalies, batch_size and fail_fraction."""
    fraction = F.when(F.col("batch_size") > 0, F.col("anomalies") / F.col("batch_size")).otherwise(0.0)
    ok = F.col("fraction") <= F.col("fail_fraction")
    return (
        counts.withColumn("fraction", fraction)
        .withColumn("passed", (F.col("anomalies") == 0) | ok)
        .withColumn(
            "severity", F.when(F.col("anomalies") == 0, "info").when(ok, "warn").otherwise("error")
        )
    )


def anomaly_counts(
    rows: DataFrame, names: list[str], counts: Column | None = None, sample: int = SAMPLE_CAP, batches: DataFrame | None = None
) -> DataFrame:
    """Anomalies per (check, batch) beside the batch size, clean batches included.

    rows: batch_id, label, and a flag for each check name; null is false. counts tells which rows make up the
    batch size (all by default). batches: batch_id of batches to report even without rows. One
    grouping gives sizes and counts; the sample keeps the first labels, and its limit runs before the
    shuffle, so the collected list never exceeds it.
    """
    size = F.count(F.lit(1)) if counts is None else F.count_if(counts)
    one = rows.groupBy("batch_id").agg(size.alias("batch_size"), *[F.count_if(F.col(n)).alias(n) for n in names])
    if batches is not None:
        one = batches.join(one, "batch_id", "left")
    zero = F.lit(0)
    each = F.array(*[F.struct(F.lit(n).alias("check_name"), F.coalesce(n, zero).alias("anomalies")) for n in names])
    total = one.select("batch_id", F.coalesce("batch_size", zero).alias("batch_size"), F.explode(each).alias("c")).select(
        "c.check_name", "batch_id", "batch_size", "c.anomalies"
    )
    key = ["check_name", "batch_id"]
    # An array of plain values, so that scan, filter and explode are one compiled loop.
    some = reduce(or_, [F.col(n) for n in names])
    hit = F.array(*[F.when(F.col(n), F.lit(n)) for n in names])
    found = rows.where(some).select("batch_id", "label", F.explode(hit).alias("check_name")).where("check_name IS NOT NULL")
    head = (
        first_n_per_key(found, key, [F.col("label")], sample)
        .groupBy(*key)
        .agg(F.sort_array(F.collect_list("label")).alias("sample"))
    )
    return total.join(head, key, "left").withColumn("sample", F.coalesce("sample", F.array().cast("array<string>")))


def dq_results(counts: DataFrame, checks: DataFrame) -> DataFrame:
    """Rows for the result table: verdict, observed JSON and a line of text."""
    judged = verdicts(with_policy(counts, checks))
    observed = F.to_json(
        F.struct(
            F.col("anomalies").alias("count"), "batch_size", F.round("fraction", 6).alias("fraction"),
            "severity", "sample",
        )
    )
    details = F.format_string(
        "%s: %d anomalies in %d bars; %s (%s)", "check_name", "anomalies", "batch_size",
        F.when(F.col("passed"), "PASS").otherwise("FAIL"), "severity",
    )
    return judged.select("check_name", "batch_id", "passed", observed.alias("observed"), details.alias("details"))


def action_counts(actions: DataFrame) -> DataFrame:
    return actions.groupBy("source", "action_type").agg(F.count(F.lit(1)).alias("n"))


def action_totals(actions: DataFrame) -> DataFrame:
    return actions.agg(
        F.count(F.lit(1)).alias("total_actions"), F.countDistinct("security_id").alias("securities_with_actions")
    )


def without_actions(securities: DataFrame, identifiers: DataFrame, actions: DataFrame, today: dt.date) -> DataFrame:
    """Listed tickers whose security has no action."""
    bare = securities.select("security_id").join(actions.select("security_id").distinct(), "security_id", "left_anti")
    listed = tickers(identifiers).where(listed_on(today))
    return listed.join(bare, "security_id", "left_semi").select("ticker")


def action_conflicts(actions: DataFrame) -> DataFrame:
    """Keys that several sources report with different payloads."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    payload = F.concat_ws("|", part("split_from"), part("split_to"), part("cash_amount"))
    return (
        actions.groupBy("security_id", "action_type", "ex_date")
        .agg(F.countDistinct(payload).alias("payloads"), F.countDistinct("source").alias("sources"))
        .where((F.col("sources") > 1) & (F.col("payloads") > 1))
    )

