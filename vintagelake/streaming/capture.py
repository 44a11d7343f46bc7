"""Capture as a stream of vendor documents.

Each file, or each line of a file, is one JSON document {"symbol": ..., "rows": [...]}. A micro-batch is
parsed once, resolved and merged into the month partitions. Its batch id comes from a
registry keyed by run and epoch: a micro-batch that is replayed keeps its id and changes
nothing, and a run with a new checkpoint gets later ids than all before it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vintagelake import session
from vintagelake.operators import identity, lineage
from vintagelake.plans.capture import batch_quality, graded, parsed_rows, stored_rows, usable
from vintagelake.sources import lake


def documents(spark: SparkSession, path: str, per_line: bool = False) -> DataFrame:
    """Stream of whole documents in arrival order."""
    raw = spark.readStream.format("text").option("wholetext", str(not per_line).lower()).load(path)
    parts = F.struct(
        F.get_json_object("value", "$.symbol").alias("symbol"), F.get_json_object("value", "$.rows").alias("text")
    )
    # From a generator, since a column would be computed again by each filter and key made of it.
    return raw.select(F.inline(F.array(parts)))


def merge_documents(
    docs: DataFrame, identifiers: DataFrame, sessions: DataFrame, checks: DataFrame, lake_path: str,
    dq_path: str, batch_id: int, today: dt.date, source: str,
) -> None:
    """One micro-batch: parse, resolve as of today, merge bars, store the quality rows under the batch."""
    named, _ = identity.resolve_batch(docs, identifiers, today)
    rows = graded(parsed_rows(named), sessions).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    parsed, path = stored_rows(rows)
    lake.merge_batches(usable(parsed), sessions, lake_path, source)
    quality = batch_quality(parsed, checks, [batch_id])
    (
        quality.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id").parquet(dq_path)
    )
    session.discard(docs.sparkSession, path)


def start(
    spark: SparkSession, bronze_path: str, identifiers: DataFrame, sessions: DataFrame, checks: DataFrame,
    lake_path: str, dq_path: str, checkpoint: str, today: dt.date, source: str = "TIINGO", per_line: bool = False,
) -> StreamingQuery:
    """Process everything that has arrived, then stop; the checkpoint remembers what was done.

    Batch ids are kept beside the quality rows, in <dq_path>_registry.
    """
    registry = f"{dq_path.rstrip('/')}_registry"

    def step(docs: DataFrame, epoch: int) -> None:
        batch = lineage.run_batch(docs.sparkSession, registry, checkpoint, epoch)
        merge_documents(docs, identifiers, sessions, checks, lake_path, dq_path, batch, today, source)

    return (
        documents(spark, bronze_path, per_line)
        .writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
