"""Parquet datasets: scans, idempotent sinks, staged publication.

Batches are whole-partition replacements, so a job that is retried after a lost executor leaves the same data as one
that ran through. Month datasets have a log of snapshots: a write puts its months into a folder of their own, then one
commit names the folder of every month. Readers see the months before the write or after it, never some of each.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintagelake import schemas, session
from vintagelake.functions.temporal import date_range
from vintagelake.operators.asof import BAR_KEY, bar_order
from vintagelake.operators.calendar import stamp_knowledge, with_close
from vintagelake.operators.select import first_per_key
from vintagelake.sources import snapshots
from vintagelake.sources.registry_files import exists

MONTH = ["year", "month"]


def scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Declared columns of a dataset, of the last snapshot where it has any; a dataset that does not exist yet is empty."""
    version, months = snapshot(spark, path)
    if version:
        return _read_months(spark, path, schema, months).drop(*MONTH)
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, dict[str, str]]:
    """The last version of a month dataset, or a named one, and the folder of each of its months (`2020-01`); (0, {}) before the first."""
    log = f"{path.rstrip('/')}/{snapshots.MONTHS}"
    return snapshots.latest(spark, log) if version is None else (version, snapshots.entry(spark, log, version))


def _read_months(spark: SparkSession, path: str, schema: T.StructType, months: dict[str, str]) -> DataFrame:
    """Rows of some months' folders, with year and month as partition columns; their number is bounded by the calendar."""
    full = _with_month_fields(schema)
    if not months:
        return spark.createDataFrame([], full)
    root = path.rstrip("/")
    folders = [f"{root}/{months[m]}/{_folder(m)}" for m in sorted(months)]
    return spark.read.schema(full).option("basePath", root).parquet(*folders).select(*full.names)


def _folder(month: str) -> str:
    year, number = month.split("-")
    return f"year={int(year)}/month={int(number)}"


def _name(year: int, month: int) -> str:
    return f"{year:04d}-{month:02d}"


def scan_bars(spark: SparkSession, path: str) -> DataFrame:
    return scan(spark, path, schemas.BARS)


def scan_months(
    spark: SparkSession, path: str, schema: T.StructType, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """Rows of a month-partitioned dataset in a date range; months outside it are pruned by the partition columns."""
    _, months = snapshot(spark, path)
    lo = "" if start is None else _name(start.year, start.month)
    hi = "9999-99" if end is None else _name(end.year, end.month)
    rows = _read_months(spark, path, schema, {m: f for m, f in months.items() if lo <= m <= hi})
    number = F.col("year") * 12 + F.col("month")
    keep = F.lit(True)
    if start is not None:
        keep = keep & (number >= start.year * 12 + start.month)
    if end is not None:
        keep = keep & (number <= end.year * 12 + end.month)
    return rows.where(keep).where(date_range("session_date", start, end)).drop(*MONTH)


def _with_month_fields(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [*schema.fields, T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())]
    )


def save_bucketed(df: DataFrame, table: str, path: str, buckets: int) -> None:
    """Store per-security data in buckets of security_id.

    Reads that window or join by security (and by security and session) then need no
    exchange. Meant for reduced data, where a security holds one row per day at most.
    """
    (
        df.write.mode("overwrite").option("path", path)
        .bucketBy(buckets, "security_id").sortBy(*BAR_KEY).saveAsTable(table)
    )


def scan_gold(spark: SparkSession, path: str) -> DataFrame:
    return scan(spark, path, schemas.GOLD)


def scan_sessions(spark: SparkSession, path: str) -> DataFrame:
    return scan(spark, path, schemas.SESSIONS)


def _with_month(df: DataFrame) -> DataFrame:
    return df.withColumn("year", F.year("session_date")).withColumn("month", F.month("session_date"))


def export_observations(observations: DataFrame, path: str) -> None:
    """Snapshot of all vintages, replacing the previous one."""
    observations.select("series_id", "obs_date", "vintage_date", "value").write.mode("overwrite").parquet(path)


def write_bars(
    bars: DataFrame, sessions: DataFrame, path: str, source: str, batch_id: int,
    listings: DataFrame | None = None, home: str | None = None,
) -> DataFrame:
    """Store a batch and return the skipped non-session bars; with listings, sessions are those of each exchange.

    The batch is a partition of its own: running it again replaces it. A batch whose bars are all skipped
    writes nothing. The bars are computed once, into the shared folder, and counted while they are written there.
    """
    counts = Observation()
    timed = with_close(bars, sessions, listings, home).observe(counts, F.count("close_utc").alias("kept"))
    held, staged = session.staged(timed, "timed")
    if counts.get["kept"]:
        kept = held.where("close_utc IS NOT NULL").withColumn("knowledge_time", F.col("close_utc")).drop("close_utc")
        out = kept.withColumn("source", F.lit(source)).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)
    skipped = held.where("close_utc IS NULL").select(
        "security_id", "symbol", "session_date", F.lit("non_session_date").alias("reason")
    )
    skipped = session.stored(skipped)
    session.discard(bars.sparkSession, staged)
    return skipped


def write_months(df: DataFrame, path: str, base: tuple[int, dict[str, str]] | None = None) -> int:
    """Replace the months that df carries in one commit and return the new version; without rows nothing changes.

    base: the snapshot that df was computed from (default: the last one). If another writer has committed since,
    the commit raises snapshots.LostRace, and the work is to be done again from the new version. Rows are sorted by
    security and session inside each file. Rebalancing sizes the write tasks by bytes at run time: a large month is
    split over many tasks, small ones share a task.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    version, months = snapshot(spark, path) if base is None else base
    part = f"part={uuid.uuid4().hex}"
    (
        _with_month(df)
        .hint("rebalance", *MONTH)
        .sortWithinPartitions(*MONTH, *BAR_KEY)
        .write.partitionBy(*MONTH)
        .parquet(f"{root}/{part}")
    )
    new = {}
    for year in (n for n in snapshots.names(spark, f"{root}/{part}") if n.startswith("year=")):
        for month in (n for n in snapshots.names(spark, f"{root}/{part}/{year}") if n.startswith("month=")):
            new[_name(int(year[5:]), int(month[6:]))] = part
    if not new:
        session.discard(spark, f"{root}/{part}")
        return version
    try:
        return snapshots.commit(spark, f"{root}/{snapshots.MONTHS}", version, months | new)
    except snapshots.LostRace:
        session.discard(spark, f"{root}/{part}")
        raise


def vacuum_months(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Forget all but the last `keep` versions, delete folders that none of them names, and return how many.

    Also deletes what a stopped writer has left, so no writer may be at work meanwhile.
    """
    root = path.rstrip("/")
    kept = snapshots.forget(spark, f"{root}/{snapshots.MONTHS}", keep)
    held = {f"{part}/{_folder(m)}" for e in kept for m, part in e.items()}
    gone = 0
    for part in (n for n in snapshots.names(spark, root) if n.startswith("part=")):
        for year in (n for n in snapshots.names(spark, f"{root}/{part}") if n.startswith("year=")):
            for month in (n for n in snapshots.names(spark, f"{root}/{part}/{year}") if n.startswith("month=")):
                if f"{part}/{year}/{month}" not in held:
                    session.discard(spark, f"{root}/{part}/{year}/{month}")
                    gone += 1
        if not any(h.startswith(f"{part}/") for h in held):
            session.discard(spark, f"{root}/{part}")
    return gone


def _months_of(df: DataFrame) -> list[str]:
    """Months present in df; their number is bounded by the calendar."""
    rows = _with_month(df).select(*MONTH).distinct().collect()
    return sorted(_name(r.year, r.month) for r in rows)


def _stored_months(
    spark: SparkSession, path: str, schema: T.StructType, base: tuple[int, dict[str, str]], months: list[str]
) -> DataFrame:
    """Rows of some months of a snapshot. Only their folders are listed and read."""
    return _read_months(spark, path, schema, {m: base[1][m] for m in months if m in base[1]}).drop(*MONTH)


def merge_bars(
    bars: DataFrame, sessions: DataFrame, path: str, source: str, batch_id: int, one_month: bool = False
) -> DataFrame:
    """Merge bars into the months they touch and return the skipped non-session bars.

    Latest knowledge, then the later batch wins per (security, session).
    """
    return merge_batches(bars.withColumn("batch_id", F.lit(batch_id).cast("bigint")), sessions, path, source, one_month)


def merge_batches(
    bars: DataFrame, sessions: DataFrame, path: str, source: str, one_month: bool = False
) -> DataFrame:
    """As merge_bars, for bars that name their batch_id: all batches in one rewrite of the months they touch.

    The stamped bars are computed once; their months and rows are read from the shared folder. All months change in one
    commit; a merge that another writer overtook raises snapshots.LostRace and has changed nothing.
    """
    spark = bars.sparkSession
    kept, skipped = stamp_knowledge(bars, sessions)
    new, staged = session.staged(kept.withColumn("source", F.lit(source)), "stamped")
    try:
        months = _months_of(new)
        if one_month and len(months) > 1:
            raise ValueError(f"expected one month, got {months}")
        if months:
            base = snapshot(spark, path)
            old = _stored_months(spark, path, schemas.BARS, base, months)
            merged = first_per_key(old.unionByName(new.select(*old.columns)), BAR_KEY, bar_order())
            write_months(merged, path, base)
    finally:
        session.discard(spark, staged)
    return skipped


def update_month(bars: DataFrame, sessions: DataFrame, path: str, source: str, batch_id: int) -> DataFrame:
    """As merge_bars for a batch that must lie in one month; more than one is an error."""
    return merge_bars(bars, sessions, path, source, batch_id, one_month=True)


def merge_gold(rows: DataFrame, path: str, months: list[tuple[int, int]], security_ids: list[int]) -> None:
    """Replace the rows of some securities inside months, in one commit, and leave all others in place.

    A month that loses its last row stays as it was.
    """
    base = snapshot(rows.sparkSession, path)
    others = _stored_months(rows.sparkSession, path, schemas.GOLD, base, [_name(y, m) for y, m in months])
    others = others.where(~F.col("security_id").isin(security_ids))
    inside = F.lit(False)
    for year, month in months:
        inside = inside | ((F.year("session_date") == year) & (F.month("session_date") == month))
    write_months(others.unionByName(rows.where(inside).select(*others.columns)), path, base)


_POINTER = "version bigint, published_at timestamp, reason string"


def _pointer_log(root: str) -> str:
    return f"{root.rstrip('/')}/_published"


def version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/v={version}"


def stage(df: DataFrame, root: str, version: int) -> DataFrame:
    """Write a candidate version and read it back; nothing is live yet."""
    target = version_path(root, version)
    df.write.mode("overwrite").parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


def publish(
    spark: SparkSession, root: str, version: int, passed: bool, at: dt.datetime, force_reason: str | None = None
) -> bool:
    """Make a staged version live if its validation passed or a reason overrides it.

    Going live is one entry in the log of publications, committed atomically: of two publications at once
    one raises snapshots.LostRace. Earlier versions stay readable.
    """
    if not passed and not force_reason:
        return False
    last, _ = snapshots.latest(spark, _pointer_log(root))
    stamp = at.astimezone(dt.timezone.utc).isoformat()
    snapshots.commit(
        spark, _pointer_log(root), last, {"version": version, "published_at": stamp, "reason": None if passed else force_reason}
    )
    return True


def pointers(spark: SparkSession, root: str) -> DataFrame:
    """Publication history, overrides with their reason included."""
    found = snapshots.versions(spark, _pointer_log(root))
    if not found:
        return spark.createDataFrame([], _POINTER)
    return spark.read.schema(_POINTER).json(f"{_pointer_log(root)}/[0-9]*.json")


def live(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The version published last; empty before the first publication."""
    last, pointer = snapshots.latest(spark, _pointer_log(root))
    return scan(spark, version_path(root, pointer["version"]), schema) if last else spark.createDataFrame([], schema)
