"""Approximate nearest neighbours by collision counting over single projections.

Each block of vectors keeps one sorted array per random projection. A query opens a window around
its own value in every array; virtual rehashing widens all windows step by step. Vectors that lie in
enough windows are verified on the original vectors. A step's radius ends the search once the k-th
verified neighbour lies within it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintagelake.llm.common import cut, prepare, seeds

PROJECTIONS = 128
# A vector at the search radius falls into a window with probability 0.52; it must fall into so many
# of the 128: nearly two standard deviations less than the mean of 66. Nearer ones fall into more.
HALF_WIDTH = 0.7
LEAST_COLLISIONS = 56
GROWTH = 1.25
FIRST_RADIUS = 0.25
BLOCK = 32_768  # vectors in a block, on average
CHUNK = 512  # queries that meet a block in one task, on average

_FOUND = "query_id bigint, vec_id bigint, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (doubles) of the rows that can take part."""
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    return rows.where(
        "vec_id IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0"
        " AND NOT exists(embedding, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))"
        " AND exists(embedding, x -> x <> 0)"
    )


class Block:
    """Sorted projections of some vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        random = np.random.default_rng(int(seeds(1, 7)[0]))
        self.axes = random.normal(size=(vectors.shape[1], PROJECTIONS))
        shadow = ((vectors / self.norms[:, None]) @ self.axes).T
        order = np.argsort(shadow, axis=1, kind="stable")
        # All arrays in one: each is lifted above the one before it, so one search serves them all.
        self.lift = np.arange(PROJECTIONS) * 4 * (np.abs(shadow).max() + np.sqrt(vectors.shape[1]) * 8)
        self.sorted = (np.take_along_axis(shadow, order, axis=1) + self.lift[:, None]).reshape(-1)
        self.order = order.astype(np.int32).reshape(-1)
        self.first = np.arange(PROJECTIONS) * len(ids)
        self.distinct = len(np.unique(ids))

    def nearest(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and cosines of the k nearest ids found, each with its best row; ties to the smaller id."""
        norm = float(np.sqrt((query * query).sum()))
        centre = (query / norm) @ self.axes + self.lift
        low = np.searchsorted(self.sorted, centre)
        high = low.copy()
        counts = np.zeros(len(self.ids), np.int64)
        open_ = self.ids != query_id
        wanted = min(k, self.distinct - (not open_.all()))
        place, score = np.empty(0, np.int64), np.empty(0)
        radius = FIRST_RADIUS
        while wanted:
            half = HALF_WIDTH * radius
            # Only what a wider window adds is counted. A window never leaves its own array.
            lo = np.maximum(np.searchsorted(self.sorted, centre - half, "left"), self.first)
            hi = np.minimum(np.searchsorted(self.sorted, centre + half, "right"), self.first + len(self.ids))
            left, right = zip(lo.tolist(), low.tolist(), strict=True), zip(high.tolist(), hi.tolist(), strict=True)
            new = [self.order[i:j] for i, j in (*left, *right)]
            low, high = lo, hi
            counts += np.bincount(np.concatenate(new), minlength=len(counts))
            fresh = np.flatnonzero(open_ & (counts >= LEAST_COLLISIONS))
            if len(fresh):
                open_[fresh] = False
                v = self.vectors[fresh]
                cosine = (v * query).sum(axis=1) / (self.norms[fresh] * norm)
                place, score = np.concatenate((place, fresh)), np.concatenate((score, cosine))
                best = np.lexsort((self.ids[place], -score))
                # An id's first row is its best one.
                best = best[np.sort(np.unique(self.ids[place[best]], return_index=True)[1])[:wanted]]
                place, score = place[best], score[best]
                if len(place) == wanted and 2 - 2 * score[-1] <= radius * radius:
                    break
            if len(place) == wanted and radius > 2:  # no two directions are farther apart
                break
            if radius > 100:  # all windows cover all vectors
                break
            radius *= GROWTH
        return place, score


def _search(k: int):
    def run(block: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(block) and len(queries):
            index = Block(block["vec_id"].to_numpy(np.int64), np.stack(block["embedding"].to_numpy()))
            for query_id, vector in zip(queries["vec_id"].tolist(), queries["embedding"], strict=True):
                place, score = index.nearest(query_id, np.asarray(vector), k)
                out.append(pd.DataFrame({"query_id": query_id, "vec_id": index.ids[place], "score": score}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query by cosine, nearest first.

    vectors and queries have vec_id and embedding. Every vector is indexed; a query's own vec_id is no
    candidate. Null, zero and non-finite vectors take no part; vectors of another length than the query's
    aren't compared with it. Equal scores go to the smaller vec_id; a vec_id that repeats counts once, with its
    best score. Fewer candidates than k are all returned. Empty tables give an empty result.
    """
    prepare(vectors.sparkSession)
    rows = cut(usable(vectors).dropDuplicates(["vec_id", "embedding"]))
    asked = cut(usable(queries).dropDuplicates(["vec_id", "embedding"]))
    blocks, chunks = max(1, -(-rows.count() // BLOCK)), max(1, -(-asked.count() // CHUNK))
    # Dealt by position, so that equal ids or vectors don't meet in one block.
    at = F.monotonically_increasing_id()
    left = rows.select(
        "vec_id", "embedding", F.size("embedding").alias("length"), F.pmod(F.xxhash64(at), F.lit(blocks)).alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"),
    )
    right = asked.select(
        "vec_id", "embedding", F.size("embedding").alias("length"), F.pmod(F.xxhash64(at), F.lit(chunks)).cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block"),
    )
    keys = ["length", "block", "chunk"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_search(k), _FOUND)
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
