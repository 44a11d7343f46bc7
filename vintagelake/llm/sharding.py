"""Shards of near equal bytes, words and rows, by vector bin packing.

Copies of a text form a group and stay together. Groups are hashed into parcels, many times as
many as shards; a group that is large for a shard is a parcel of its own, and one above half a shard
is split into several. Parcels, largest first, go to the shard whose residual capacity has the highest dot
product with the parcel's vector. So the packing itself sees a bounded number of vectors,
however many texts there are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintagelake.llm.common import cut, mapped, prepare, texts_of, words_of

SHARDS = 40
ROW_BYTES = 16
PARCELS = 128  # hashed parcels for each shard
# Shares of a shard: above OWN a group is a parcel of its own, above WHOLE it is split into pieces of up to PIECE.
OWN, WHOLE, PIECE = 1 / 32, 1 / 2, 1 / 16
SLOT_ROWS = 50_000  # rows that are numbered in one task, on average


def placed(vectors: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each vector: greedy by the dot product with the residual capacities.

    Both are measured in shares of a shard's even load, so no dimension outweighs another; a dimension
    that is full counts nothing. Bytes, the first one, are the law: a shard that a vector would fill
    beyond its bytes is taken only if none has room, and then the one with the most room.
    """
    total = vectors.sum(axis=0)
    share = np.divide(vectors * shards, total, out=np.zeros(vectors.shape), where=total > 0)
    left = np.ones((shards, vectors.shape[1]))
    where = np.zeros(len(vectors), np.int64)
    for i in np.lexsort((np.arange(len(vectors)), -share.max(axis=1))).tolist():
        v = share[i]
        fit = np.maximum(left, 0) @ v
        over = np.maximum(v[0] - left[:, 0], 0)
        best = int(np.argmax(np.where(over <= 1e-12, fit, -1e6 * (1 + over))))
        where[i] = best
        left[best] -= v
    return where


def facts(docs: DataFrame) -> DataFrame:
    """row, doc_id, size (bytes and row overhead), words, text_crc32, text_group of each row; null text: no bytes.

    docs has row, a number of its own for each row, beside doc_id and text.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = [len(words_of(t)) for t in texts_of(batch.column("text"))]
        names = ["row", "doc_id", "size", "text_crc32", "text_group"]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(n, pa.int64())], [*names, "words"])

    text = F.col("text").cast("string")
    rows = docs.select(
        "row", F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        # Texts whose hashes collide are packed as one group, which harms nothing.
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_group"), text.alias("text"),
    )
    return mapped(rows, run, "row bigint, doc_id bigint, size bigint, text_crc32 bigint, text_group bigint, words bigint")


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc, doc_id, size, text_crc32, shard, slot, words, text_group for each row of docs (doc_id, text, any others).

    doc is the row itself, a struct of all columns of docs as they are, so their names can't meet the others:
    select("shard", "slot", "doc.*") is what a shard's file holds. The rows are stored once and dealt by a number of
    their own, and only sizes and digests take part in the packing, so null and repeated ids keep their row.
    shard is 0 to shards - 1, slot numbers a shard's rows from 0 without gaps. Rows with equal texts
    share a shard, unless together they exceed half of one; then they fill several pieces. Null and
    empty texts are equal and have no bytes; repeated rows and null ids are rows like others. An
    empty table gives an empty result.
    """
    spark = prepare(docs.sparkSession)
    held = cut(docs.select(F.struct("*").alias("doc")).withColumn("row", F.monotonically_increasing_id()))
    rows = cut(facts(held.select("row", "doc.doc_id", "doc.text")))
    sums = [F.sum("size").alias("size"), F.sum("words").alias("words"), F.count("*").alias("rows")]
    total = rows.agg(*sums).first()
    if not total.rows:
        return held.join(rows, "row").select(
            "doc", "doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot"), "words", "text_group"
        )
    groups = rows.groupBy("text_group").agg(*sums)
    share = F.greatest(*[F.col(c) * shards / max(1, total[c] or 0) for c in ("size", "words", "rows")])
    pieces = F.when((share > WHOLE) & (F.col("rows") > 1), F.ceil(share / PIECE)).otherwise(1)
    # At most 3 / OWN groups for each shard can be above the bound.
    large = cut(groups.where(share > OWN).select("text_group", pieces.cast("int").alias("pieces")))
    # Parcels: hashed ones count up from 0, pieces of large groups have the group's hash and their number.
    known = (
        rows.join(F.broadcast(large), "text_group", "left")  # bounded as above
        .withColumn(
            "piece",
            F.when(F.col("pieces").isNotNull(), F.pmod(F.xxhash64("row"), F.col("pieces"))).otherwise(-1),
        )
        .withColumn(
            "parcel", F.when(F.col("piece") < 0, F.pmod(F.xxhash64("text_group", F.lit(1)), F.lit(shards * PARCELS))).otherwise(F.col("text_group"))
        )
    )
    known = cut(known.select("row", "doc_id", "size", "text_crc32", "text_group", "words", "parcel", "piece"))
    units = known.groupBy("parcel", "piece").agg(*sums).orderBy("parcel", "piece").collect()  # bounded: parcels and pieces
    where = placed(np.array([[u["size"], u["words"], u["rows"]] for u in units], float), shards)
    homes = spark.createDataFrame(
        [(u.parcel, u.piece, int(s)) for u, s in zip(units, where, strict=True)], "parcel bigint, piece bigint, shard int"
    )
    dealt = known.join(F.broadcast(homes), ["parcel", "piece"])
    slotted = _slotted(spark, dealt, total.rows).select("row", "doc_id", "size", "text_crc32", "shard", "slot", "words", "text_group")
    return held.join(slotted, "row").select("doc", "doc_id", "size", "text_crc32", "shard", "slot", "words", "text_group")


def _slotted(spark, rows: DataFrame, n: int) -> DataFrame:
    """Number the rows of each shard: by hashed stretches of bounded size, each after those before it."""
    stretches = max(1, -(-n // SLOT_ROWS))
    rows = rows.withColumn("stretch", F.pmod(F.xxhash64("doc_id", "text_crc32", "size", "piece"), F.lit(stretches)))
    counts = rows.groupBy("shard", "stretch").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    at = F.row_number().over(Window.partitionBy("shard", "stretch").orderBy("doc_id", "text_crc32", "size", "row"))
    return (
        rows.withColumn("at", at - 1)
        .join(starts, ["shard", "stretch"])
        .withColumn("slot", (F.col("start") + F.col("at")).cast("bigint"))
    )
