"""Registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagelake.llm import (
    centroids, language, licences, manifest, mixing, near_dups, neighbours, packing, passages, personal, quality, secrets, sharding,
)
from vintagelake.llm.common import table
from vintagelake.llm.vocabularies import pattern, vocabulary

Query = Callable[[SparkSession, str], DataFrame]


def op1_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identified(docs, docs.where(~language.held_out())).select(
        "doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "rejected"
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "size", "source_size", "target", "copies", "taken"
    )


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scanned(table(spark, sf_dir, "documents")).select("doc_id", "digest", "licence", "n_notices", "notices")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "words",
    )


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scanned(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), pattern())
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_random"
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op10_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal.found(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(personal.BASE))
    counts = [personal.counted(F.col("spans"), k).alias(f"n_{k}") for k in personal.BASE]
    return found.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), *counts, F.sha2(personal.rendered(base), 256).alias("base_sha256"),
        personal.rendered(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda s: F.format_number(s["score"], 2)), ",").alias("scores"),
    )


def op11_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Half of the rows are met again without their line ends.
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = manifest.proven(table(spark, sf_dir, "documents"), tampered).withColumn("folded_root", manifest.folded("found_leaf", "path"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", manifest.proof("path").alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


_ALL = (
    op1_near_dups, op2_quality, op3_language, op4_mixing, op5_licences, op6_sharding, op7_neighbours, op8_secrets,
    op9_packing, op10_personal, op11_passages, op12_centroids, op13_manifest,
)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in _ALL}


def oracle_sql() -> dict[str, str]:
    return {"op5_licences": licences.sql(), "op12_centroids": centroids.sql(), "op13_manifest": manifest.sql()}
