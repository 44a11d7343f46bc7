"""A training corpus from raw documents: five stages, each on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vintagelake.llm import mixing, near_dups, packing, personal, quality
from vintagelake.llm.common import cut, table
from vintagelake.llm.vocabularies import vocabulary


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.filtered(docs, table(spark, sf_dir, "labels"))


def single(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dups.deduplicated(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their personal data masked."""
    return personal.masked(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.remixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in their sequences."""
    return packing.packed(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("quality", good), ("near_dups", single), ("personal", private), ("mixing", mixed), ("packing", packed)]

# Neither the forest's verdicts nor the drawn mix can be said in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir. Between stages the rows are stored in the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
