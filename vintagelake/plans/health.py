"""Pipeline health and catalog reads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 500
SUMMARY_ROWS = 20
MAX_SENT = 10_000  # check names that are sent to every task; more of them are joined by name


def check_limit(limit: int) -> int:
    if not 1 <= limit <= MAX_ROWS:
        raise ValueError(f"limit must be between 1 and {MAX_ROWS}")
    return limit


def freshness(pipelines: DataFrame, sources: DataFrame, batches: DataFrame, now: dt.datetime) -> DataFrame:
    """One row per declared pipeline, run or not: last success, status of the latest batch, lag in seconds.

    Batches are reduced to one row per (source, dataset) before they meet the pipelines.
    """
    done = F.when(F.col("status") == "succeeded", F.col("finished_at"))
    newest = F.struct("started_at", "batch_id", "status")
    seen = batches.groupBy("source_id", "dataset").agg(
        F.max(done).alias("last_success"), F.max(newest).alias("_last")
    )
    lag = F.lit(now).cast("bigint") - F.col("last_success").cast("bigint")
    return (
        pipelines.join(sources, "source_id")
        .join(seen, ["source_id", "dataset"], "left")
        .select(
            "name", "dataset", "kind", "cadence", "retired", "critical", "last_success",
            F.col("_last.status").alias("last_status"), lag.alias("lag_seconds"),
        )
        .orderBy(F.col("critical").desc(), "name", "dataset")
    )


def _older(time: str, number: str, before: tuple[dt.datetime | None, int] | None) -> Column:
    """Rows that come after a page's last row, newest first; rows without a time come last. Plain comparisons, so scans skip."""
    if before is None:
        return F.lit(True)
    at, last = before
    if at is None:
        return F.col(time).isNull() & (F.col(number) < last)
    same = (F.col(time) == F.lit(at)) & (F.col(number) < last)
    return (F.col(time) < F.lit(at)) | same | F.col(time).isNull()


def recent_jobs(
    batches: DataFrame, limit: int = 50, only_failed: bool = False, before: tuple[dt.datetime | None, int] | None = None
) -> DataFrame:
    """Newest batches first; a top-n per task. before: (started_at, batch_id) of the last row of the page before."""
    rows = batches.where(F.col("status") == "failed") if only_failed else batches
    rows = rows.where(_older("started_at", "batch_id", before))
    return rows.orderBy(F.col("started_at").desc(), F.col("batch_id").desc()).limit(check_limit(limit))


def _of_checks(results: DataFrame, names: DataFrame) -> DataFrame:
    """Results of named checks. A few names hold all results and would gather them in as many tasks, so few names go to the results."""
    few = names.limit(MAX_SENT + 1).count() <= MAX_SENT
    return results.join(F.broadcast(names) if few else names, "check_name", "left_semi")


def recent_dq(
    results: DataFrame, checks: DataFrame, limit: int = 50, only_failed: bool = False,
    before: tuple[dt.datetime | None, int] | None = None,
) -> DataFrame:
    """Newest quality results first, with severity and count from the observed JSON. before: (run_at, result_id) of the last row of the page before."""
    rows = results.where(~F.col("passed")) if only_failed else results
    rows = rows.where(_older("run_at", "result_id", before))
    known = _of_checks(rows, checks.select(F.col("name").alias("check_name")).distinct())
    top = known.orderBy(F.col("run_at").desc(), F.col("result_id").desc()).limit(check_limit(limit))
    return top.select(
        "result_id", "check_name", "batch_id", "run_at", "passed",
        F.get_json_object("observed", "$.severity").alias("severity"),
        F.get_json_object("observed", "$.count").cast("int").alias("count"),
        "details",
    )


def summary(
    pipelines: DataFrame, sources: DataFrame, batches: DataFrame, results: DataFrame, checks: DataFrame, now: dt.datetime
) -> dict[str, DataFrame]:
    """The parts of the operator view, each bounded."""
    return {
        "sources": freshness(pipelines, sources, batches, now),
        "recent_jobs": recent_jobs(batches, SUMMARY_ROWS),
        "recent_failures": recent_jobs(batches, SUMMARY_ROWS, only_failed=True),
        "recent_dq_failures": recent_dq(results, checks, SUMMARY_ROWS, only_failed=True),
    }


def feature_catalog(definitions: DataFrame) -> DataFrame:
    """Definitions in force, by name and version."""
    return definitions.where(F.col("deprecated_at").isNull()).drop("deprecated_at").orderBy("name", "version")


def dataset_catalog(datasets: DataFrame, sizes: DataFrame) -> DataFrame:
    """Published datasets with their row counts (null where not counted)."""
    return datasets.join(sizes, "name", "left").select("name", "storage", "rows")
