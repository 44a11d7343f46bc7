"""Security master and universe maintenance as set operations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintagelake import seeds
from vintagelake.functions.temporal import FAR_FUTURE, listed_on
from vintagelake.operators.identity import current_symbol_segments, resolve, resolve_on, tickers
from vintagelake.operators.intervals import attach
from vintagelake.operators.select import absent_from, beside, first_per_key

OPEN_START = dt.date(1900, 1, 1)
# Index removal may lag the last trade; a recent last trade means still trading.
REMOVAL_GRACE_DAYS = 15
ACTIVE_TOLERANCE_DAYS = 7


def share_class_symbol(symbol: str | Column) -> Column:
    """Vendor spelling of a share class: dot to dash."""
    c = F.col(symbol) if isinstance(symbol, str) else symbol
    return F.translate(c, ".", "-")


def load_coverage(entries: DataFrame) -> DataFrame:
    """Combined manifests: the first registered source that lists a ticker wins, then its first line.

    entries: registry_ord, line_no, source and the manifest columns.
    """
    return first_per_key(entries, ["ticker"], [F.col("registry_ord"), F.col("line_no")])


def coverage_counts(entries: DataFrame) -> DataFrame:
    """Tickers each source added; a source that added none is listed with 0."""
    added = load_coverage(entries).groupBy("source").agg(F.count(F.lit(1)).alias("added"))
    listed = entries.groupBy("source").agg(F.count(F.lit(1)).alias("listed"))
    return listed.join(added, "source", "left").withColumn("added", F.coalesce("added", F.lit(0)))


def lookup_cik(requests: DataFrame, ciks: DataFrame, ticker: str = "ticker") -> DataFrame:
    """Add cik: the ticker as written, then dot as dash, dash as dot, and without dots."""
    t = F.upper(F.trim(F.col(ticker)))
    spellings = F.array(t, F.translate(t, ".", "-"), F.translate(t, "-", "."), F.regexp_replace(t, r"\.", ""))
    keys = requests.select(ticker).distinct()
    tried = keys.select(ticker, F.posexplode(spellings).alias("_try", "_spelling"))
    known = ciks.select(F.col("ticker").alias("_spelling"), "cik")
    best = tried.join(known, "_spelling").groupBy(ticker).agg(F.min_by("cik", "_try").alias("cik"))
    return requests.join(best, ticker, "left")


def next_ids(new: DataFrame, key: str, last_id: Column, name: str) -> DataFrame:
    """Consecutive ids after last_id, in the order of md5(key).

    Rows are numbered inside 256 hash ranges; a range starts where the counts of
    the ranges before it end. No step sees more than one range, and the window
    over range counts has at most 256 rows.
    """
    hashed = new.withColumn("_h", F.md5(F.col(key))).withColumn("_range", F.substring("_h", 1, 2))
    sizes = hashed.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_range").orderBy("_h", key)
    return (
        hashed.withColumn("_n", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_range")
        .withColumn(name, last_id + F.col("_offset") + F.col("_n"))
        .drop("_h", "_range", "_n", "_offset")
    )


def reconcile(entries: DataFrame, identifiers: DataFrame, securities: DataFrame, today: dt.date) -> DataFrame:
    """Match coverage entries (ticker, security_type, cik) to existing securities.

    An entry that resolves today is `reconciled` and can only fill the CIK; any
    other becomes a new security valid from 1900-01-01.
    """
    now = resolve_on(identifiers, today).select("ticker_key", "security_id")
    keyed = entries.withColumn("ticker_key", F.upper("ticker")).join(now, "ticker_key", "left").drop("ticker_key")
    old = (
        keyed.where(F.col("security_id").isNotNull())
        .join(securities.select("security_id", F.col("cik").alias("_cik")), "security_id", "left")
        .withColumn("cik", F.coalesce("cik", "_cik"))
        .drop("_cik")
        .withColumn("outcome", F.lit("reconciled"))
        .withColumn("valid_from", F.lit(None).cast("date"))
    )
    last = securities.agg(F.coalesce(F.max("security_id"), F.lit(0)).alias("m")).scalar()
    fresh = keyed.where(F.col("security_id").isNull()).drop("security_id")
    created = (
        next_ids(fresh, "ticker", last, "security_id")
        .withColumn("outcome", F.lit("created"))
        .withColumn("valid_from", F.lit(OPEN_START))
    )
    return old.unionByName(created.select(*old.columns))


def filled_ciks(securities: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Securities after reconciliation: a new CIK replaces the stored one where given."""
    new = outcomes.where((F.col("outcome") == "reconciled") & F.col("cik").isNotNull())
    one = new.groupBy("security_id").agg(F.max("cik").alias("_cik"))
    return securities.join(one, "security_id", "left").withColumn("cik", F.coalesce("_cik", "cik")).drop("_cik")


def _overlap(a: str, b: str) -> Column:
    """Closed windows of the same ticker; adjacent days touch, a missing end is open."""
    far = F.lit(FAR_FUTURE)
    return (
        (F.col(f"{a}.ticker") == F.col(f"{b}.ticker"))
        & (F.col(f"{b}.valid_from") <= F.coalesce(F.col(f"{a}.valid_to"), far))
        & (F.coalesce(F.col(f"{b}.valid_to"), far) >= F.col(f"{a}.valid_from"))
    )


def colliding(entries: DataFrame, identifiers: DataFrame) -> DataFrame:
    """Entries whose ticker already has an identifier with an overlapping window (case-sensitive).

    A semi-join stops at the first overlap and never lists the pairs.
    """
    return entries.alias("e").join(tickers(identifiers).alias("i"), _overlap("e", "i"), "left_semi")


def dated_outcomes(entries: DataFrame, identifiers: DataFrame) -> DataFrame:
    """Outcome of creating each dated entry: created, skipped_exists or COLLISION.

    entries: entry_no (unique), ticker, valid_from, valid_to. An equal (ticker,
    valid_from) that is stored, or earlier in the batch, counts as done. Any other
    overlap, and a missing start, is a collision. An overlap with an earlier entry
    of the batch counts whatever became of that entry.
    """
    own = tickers(identifiers).select("ticker", "valid_from").distinct().withColumn("_same", F.lit(True))
    first = entries.groupBy("ticker", "valid_from").agg(F.min("entry_no").alias("_first"))
    marked = entries.join(own, ["ticker", "valid_from"], "left").join(first, ["ticker", "valid_from"], "left")
    stored_hit = colliding(entries, identifiers).select("entry_no").withColumn("_stored", F.lit(True))
    earlier = _overlap("e", "o") & (F.col("o.entry_no") < F.col("e.entry_no"))
    batch_hit = (
        entries.alias("e").join(entries.alias("o"), earlier, "left_semi")
        .select("entry_no").withColumn("_batch", F.lit(True))
    )
    outcome = (
        F.when(F.col("valid_from").isNull(), "COLLISION")
        .when(F.col("_same"), "skipped_exists")
        .when(F.col("_stored"), "COLLISION")
        .when(F.col("_first") < F.col("entry_no"), "skipped_exists")
        .when(F.col("_batch"), "COLLISION")
        .otherwise("created")
    )
    return (
        marked.join(stored_hit, "entry_no", "left").join(batch_hit, "entry_no", "left")
        .withColumn("outcome", outcome)
        .drop("_same", "_first", "_stored", "_batch")
    )


def expansion_writes(outcomes: DataFrame, commit: bool = False) -> DataFrame:
    """Rows an expansion run writes: all created ones, or none when any entry collided or it is a dry run."""
    bad = outcomes.where(F.col("outcome") == "COLLISION").agg(F.count(F.lit(1)).alias("n")).scalar()
    return outcomes.where((F.col("outcome") == "created") & F.lit(commit) & (bad == 0))


def tallies(outcomes: DataFrame, column: str = "outcome") -> DataFrame:
    return outcomes.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def recommend(status: str = "vendor_status", multi: str = "multi_interval") -> Column:
    """Several index stays may be a reused ticker and always go to review."""
    return (
        F.when(F.col(multi), "REVIEW")
        .when(F.col(status) == "ok", "add")
        .when(F.col(status) == "ok(translated)", "translate")
        .otherwise("unavailable")
    )


def classify_unresolved(
    intervals: DataFrame, identifiers: DataFrame, vendor: DataFrame, ciks: DataFrame, today: dt.date
) -> DataFrame:
    """Index tickers that do not resolve today, with their stays, vendor window, CIK and a recommendation.

    vendor: ticker, vendor_status, vendor_start, vendor_end; a ticker without a row has no vendor data.
    """
    now = resolve_on(identifiers, today).select(F.col("ticker_key"))
    keyed = intervals.withColumn("ticker_key", F.upper("ticker"))
    stays = (
        keyed.join(now, "ticker_key", "left_anti")
        .groupBy("ticker")
        .agg(
            F.count(F.lit(1)).alias("intervals"),
            F.min("valid_from").alias("index_first"),
            F.max("valid_to").alias("index_last"),
        )
        .withColumn("multi_interval", F.col("intervals") > 1)
    )
    known = stays.join(vendor, "ticker", "left").join(ciks, "ticker", "left")
    return known.withColumn("vendor_status", F.coalesce("vendor_status", F.lit("404"))).withColumn(
        "recommendation", recommend()
    )


def corroborate(classified: DataFrame) -> DataFrame:
    """Verdict on each recommended addition: does the vendor window overlap the index stay?"""
    far, early = F.lit(FAR_FUTURE), F.lit("0001-01-01").cast("date")
    overlap = (F.col("vendor_start") <= F.coalesce("index_last", far)) & (
        F.coalesce("index_first", early) <= F.coalesce("vendor_end", far)
    )
    verdict = (
        F.when(F.col("recommendation") != "add", F.concat(F.lit("passthrough:"), F.col("recommendation")))
        .when(F.col("vendor_start").isNull(), "review:blank_window")
        .when(overlap, "add:overlap_ok")
        .otherwise("review:modern_reuse")
    )
    return classified.withColumn("corroboration", verdict)


ADMITTING = ("new_identity", "verified_continuous", "overlap_ok", "translate")


def decide(corroborated: DataFrame, overrides: DataFrame | None, today: dt.date) -> DataFrame:
    """Decision per candidate with its rationale: a decision by hand first, then the corroboration verdict.

    overrides: ticker, decision; None stands for the fixed decisions of seeds.hand_decisions. An admitted candidate without a start date is an
    error, since no date may be invented for it.
    """
    verdict, start = F.col("corroboration"), F.col("vendor_start")
    by_rule = (
        F.when(verdict == "add:overlap_ok", "overlap_ok")
        .when(verdict == "passthrough:translate", F.when(start.isNull(), "excluded_blank").otherwise("translate"))
        .when(verdict == "review:modern_reuse", "excluded_reuse")
        .when(verdict == "review:blank_window", "excluded_blank")
        .when(verdict == "passthrough:unavailable", "excluded_unavailable")
        .when(verdict == "passthrough:REVIEW", "excluded_review")
        .otherwise("excluded_other")
    )
    if overrides is None:
        overrides = seeds.hand_decisions(corroborated.sparkSession)
    by_hand = overrides.select("ticker", F.col("decision").alias("_hand"))
    decided = corroborated.join(by_hand, "ticker", "left").withColumn("decision", F.coalesce("_hand", by_rule))
    reason = F.when(F.col("_hand").isNotNull(), "decided by hand").otherwise(F.concat(F.lit("by rule: "), verdict))
    decided = decided.withColumn("rationale", reason).drop("_hand")
    admitted = F.col("decision").isin(*ADMITTING)
    undated = F.raise_error(F.concat(F.lit("admitted without a start date: "), F.col("ticker"))).cast("boolean")
    active = F.col("vendor_end") >= F.lit(today - dt.timedelta(days=ACTIVE_TOLERANCE_DAYS))
    return (
        decided.withColumn("admitted", F.when(admitted & start.isNull(), undated).otherwise(admitted))
        .withColumn("valid_from", F.when(F.col("admitted"), start))
        .withColumn("valid_to", F.when(F.col("admitted") & ~F.coalesce(active, F.lit(True)), F.col("vendor_end")))
    )


def candidate_manifest(decided: DataFrame) -> DataFrame:
    """Admitted candidates with what led to their admission; a vendor name where the candidates carry one."""
    name = F.col("vendor_name") if "vendor_name" in decided.columns else F.lit(None).cast("string")
    return decided.where("admitted").select(
        "ticker", F.lit("EQUITY").alias("security_type"), name.alias("name"), "valid_from", "valid_to", "decision", "rationale"
    )


def decision_summary(decided: DataFrame) -> DataFrame:
    """Counts by decision with the total they must add up to."""
    total = decided.agg(F.count(F.lit(1)).alias("total"))
    return beside(tallies(decided, "decision"), total)


def membership_outcomes(
    intervals: DataFrame, identifiers: DataFrame, existing: DataFrame, universe: str | Column, today: dt.date
) -> DataFrame:
    """Resolve index stays (ticker, valid_from, valid_to) at their start and check them.

    A stay may outlast its ticker's window by 15 days, no more; an open stay needs
    a ticker that is valid now or ended within 15 days. Stored stays are skipped.
    """
    code = F.lit(universe) if isinstance(universe, str) else universe
    with_code = intervals.withColumn("universe", code)
    windows = _with_identity_window(with_code, identifiers)
    grace = F.date_add("id_to", REMOVAL_GRACE_DAYS)
    late = F.col("id_to").isNotNull() & F.when(
        F.col("valid_to").isNull(), grace < F.lit(today)
    ).otherwise(F.col("valid_to") > grace)
    have = existing.select("universe", "security_id", "valid_from").distinct().withColumn("_have", F.lit(True))
    status = (
        F.when(F.col("security_id").isNull(), "no_identity")
        .when(late, "containment_violation")
        .when(F.col("_have"), "already_exists")
        .otherwise("insert")
    )
    return (
        windows.join(have, ["universe", "security_id", "valid_from"], "left")
        .withColumn("status", status)
        .drop("_have", "id_to")
    )


def _with_identity_window(stays: DataFrame, identifiers: DataFrame) -> DataFrame:
    """security_id valid at the start of the stay, and the end of that ticker window."""
    found = resolve(stays, identifiers, "ticker", "valid_from")
    segments = current_symbol_segments(identifiers).select(
        "security_id", "seg_from", "seg_to", F.col("valid_to").alias("id_to")
    )
    return attach(found, segments, "security_id", "valid_from", ["id_to"])


def figi_targets(securities: DataFrame, identifiers: DataFrame, today: dt.date, limit: int | None = None) -> DataFrame:
    """Listed tickers of securities without a FIGI, sorted."""
    bare = securities.where(F.col("figi").isNull()).select("security_id")
    listed = tickers(identifiers).where(listed_on(today))
    out = listed.join(bare, "security_id", "left_semi").select("ticker").orderBy("ticker")
    return out.limit(limit) if limit else out


def figi_outcomes(
    targets: DataFrame, answers: DataFrame, identifiers: DataFrame, securities: DataFrame, today: dt.date
) -> DataFrame:
    """Outcome per target: enriched, clashed (another security has the FIGI), unresolved or no_mapping.

    Two targets of one batch that ask for the same FIGI: the first ticker gets it.
    """
    now = resolve_on(identifiers, today).select("ticker_key", "security_id")
    asked = (
        targets.join(answers, "ticker", "left")
        .withColumn("ticker_key", F.upper("ticker"))
        .join(now, "ticker_key", "left").drop("ticker_key")
    )
    owner = securities.where(F.col("figi").isNotNull()).select("figi", F.col("security_id").alias("_owner"))
    first = (
        asked.where(F.col("figi").isNotNull() & F.col("security_id").isNotNull())
        .groupBy("figi").agg(F.min_by("security_id", "ticker").alias("_first"))
    )
    outcome = (
        F.when(F.col("figi").isNull(), "no_mapping")
        .when(F.col("security_id").isNull(), "unresolved")
        .when(F.col("_owner") != F.col("security_id"), "clashed")
        .when(F.col("_owner").isNull() & (F.col("_first") != F.col("security_id")), "clashed")
        .otherwise("enriched")
    )
    return asked.join(owner, "figi", "left").join(first, "figi", "left").withColumn("outcome", outcome).drop("_owner", "_first")


def enriched_securities(securities: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Securities with figi, composite_figi and description filled; the creating source stays."""
    one = first_per_key(outcomes.where(F.col("outcome") == "enriched"), ["security_id"], [F.col("ticker").desc()])
    new = one.select(
        "security_id", F.col("figi").alias("_figi"), F.col("share_class_figi").alias("_share"),
        F.coalesce("name", "ticker").alias("_name"), F.lit(True).alias("_hit"),
    )

    def pick(new_col: str, old: str) -> Column:
        return F.when(F.col("_hit"), F.col(new_col)).otherwise(F.col(old))

    return (
        securities.join(new, "security_id", "left")
        .withColumn("figi", pick("_figi", "figi"))
        .withColumn("composite_figi", pick("_share", "composite_figi"))
        .withColumn("description", pick("_name", "description"))
        .withColumn("country", F.when(F.col("_hit"), F.coalesce("country", F.lit("US"))).otherwise(F.col("country")))
        .drop("_figi", "_share", "_name", "_hit")
    )


def assign_creator(
    securities: DataFrame, identifiers: DataFrame, symbols: DataFrame, source_id: int, today: dt.date
) -> DataFrame:
    """Set the creating source of the securities some tickers resolve to today."""
    now = resolve_on(identifiers, today).select("ticker_key", "security_id")
    ids = symbols.select(F.upper("symbol").alias("ticker_key")).join(now, "ticker_key").select("security_id").distinct()
    marked = securities.join(ids.withColumn("_hit", F.lit(True)), "security_id", "left")
    return marked.withColumn(
        "source_id", F.when(F.col("_hit"), F.lit(source_id)).otherwise(F.col("source_id"))
    ).drop("_hit")


def new_memberships(outcomes: DataFrame, existing: DataFrame) -> DataFrame:
    """Stays to append, one per (universe, security, start)."""
    key = ["universe", "security_id", "valid_from"]
    rows = outcomes.where(F.col("status") == "insert").select(*key, "valid_to", "ticker")
    one = first_per_key(rows, key, [F.col("valid_to").asc_nulls_last(), F.col("ticker")])
    return absent_from(one, existing, key)
