"""Ingest batches, sources and definitions as append-only tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagelake import seeds
from vintagelake.operators.select import absent_from, first_n_per_key, first_per_key, upsert
from vintagelake.operators.universe import next_ids
from vintagelake.sources.registry_files import exists

# How many messages the JSON of a batch shows. All are kept as rows of the messages table.
WARNING_HEAD = 200
FAILURE_HEAD = 50


def ensure_sources(existing: DataFrame, names: DataFrame) -> DataFrame:
    """Sources with an id for every name; only missing names are added."""
    missing = absent_from(names.select("name").distinct(), existing, ["name"])
    last = existing.agg(F.coalesce(F.max("source_id"), F.lit(0)).alias("m")).scalar()
    new = next_ids(missing, "name", last, "source_id")
    return existing.select("source_id", "name").unionByName(new.select("source_id", "name"))


def open_events(batches: DataFrame) -> DataFrame:
    """The event that opens each batch."""
    return batches.select(
        "batch_id", F.col("started_at").alias("event_time"), F.lit("running").alias("status"),
        F.lit(None).cast("bigint").alias("rows_in"), F.lit(None).cast("bigint").alias("rows_out"),
        F.lit(None).cast("string").alias("error"),
    )


def close_events(batches: DataFrame) -> DataFrame:
    """The event that closes each finished batch."""
    return batches.where(F.col("finished_at").isNotNull()).select(
        "batch_id", F.col("finished_at").alias("event_time"), "status", "rows_in", "rows_out", "error"
    )


def batch_state(events: DataFrame) -> DataFrame:
    """Current state of every batch: its last event; at the same moment a closing event is later."""
    running_last = (F.col("status") == "running").cast("int")
    return first_per_key(events, ["batch_id"], [F.col("event_time").desc(), running_last, F.col("status")])


def batch_stats(messages: DataFrame, totals: DataFrame) -> DataFrame:
    """Operational figures of each batch as JSON, with the first warnings and failures and the number of all.

    messages: batch_id, kind (warning or failure), ord, text; they stay stored as rows. The heads are cut
    per batch before anything is collected.
    """

    def head(kind: str, cap: int, name: str) -> DataFrame:
        rows = first_n_per_key(messages.where(F.col("kind") == kind), ["batch_id"], [F.col("ord"), F.col("text")], cap)
        listed = F.sort_array(F.collect_list(F.struct("position", "text")))
        return rows.groupBy("batch_id").agg(F.transform(listed, lambda m: m["text"]).alias(name))

    empty = F.array().cast("array<string>")
    joined = totals.join(head("warning", WARNING_HEAD, "warnings"), "batch_id", "left").join(
        head("failure", FAILURE_HEAD, "failures"), "batch_id", "left"
    )
    kinds = messages.groupBy("batch_id").agg(
        F.count_if(F.col("kind") == "warning").alias("n_warnings"), F.count_if(F.col("kind") == "failure").alias("n_failures")
    )
    joined = joined.join(kinds, "batch_id", "left")
    figures = [F.col(c) for c in totals.columns if c != "batch_id"]
    figures += [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_warnings", "n_failures")]
    params = F.to_json(
        F.struct(
            *figures, F.coalesce("warnings", empty).alias("warnings"), F.coalesce("failures", empty).alias("failures")
        )
    )
    return joined.select("batch_id", params.alias("params"))


def pipeline_kind(dataset: str = "dataset") -> Column:
    out = F.lit(seeds.OTHER_KIND)
    for name, kind in seeds.PIPELINE_KINDS.items():
        out = F.when(F.col(dataset) == name, kind).otherwise(out)
    return out


def register_pipelines(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Upsert by (source, dataset) with the kind derived from the dataset."""
    return upsert(existing, new, ["source_id", "dataset"]).withColumn("kind", pipeline_kind())


def upsert_features(existing: DataFrame, new: DataFrame) -> DataFrame:
    return upsert(existing, new, ["name", "version"])


def upsert_checks(existing: DataFrame, new: DataFrame) -> DataFrame:
    return upsert(existing, new, ["name"])


def run_batch(spark: SparkSession, registry: str, run: str, epoch: int) -> int:
    """Batch id of an epoch of a run: the one registered, or the next after all registered ones, which is stored.

    The registry has one row per micro-batch; a run is one writer, so ids are given one at a time.
    """
    schema = "run string, epoch bigint, batch_id bigint"
    known = spark.read.schema(schema).parquet(registry) if exists(spark, registry) else spark.createDataFrame([], schema)
    own = F.max(F.when((F.col("run") == run) & (F.col("epoch") == epoch), F.col("batch_id")))
    found = known.agg(own.alias("own"), F.coalesce(F.max("batch_id"), F.lit(0)).alias("last")).first()
    if found.own is not None:
        return found.own
    spark.createDataFrame([(run, epoch, found.last + 1)], schema).coalesce(1).write.mode("append").parquet(registry)
    return found.last + 1
