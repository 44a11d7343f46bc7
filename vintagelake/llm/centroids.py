"""Centroid clustering on integers, with a Walsh-Hadamard progressive search for the nearest centroid.

The transform of 64 integers is exact, and its coefficients keep squared distances, times 64. Their
differences are added up coarse to fine (few sign changes first). A sum over some coefficients never exceeds
the whole, so a centroid whose sum is above another's finished distance is strictly worse and is dropped;
those that stay are finished over all 64 coefficients, and the smallest number wins a tie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagelake.llm.common import cut, prepare

WIDTH = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
# Coefficients added at a time.
STEPS = ((0, 4), (4, 16), (16, 64))
# Integers up to here keep all sums of the search inside 64 bits; larger ones are searched with Python's integers.
NARROW = 1 << 21
# With integers up to here every squared distance fits a long. Vectors beyond take no part.
WIDEST = 1 << 26
LONG = (1 << 63) - 1


def transformed(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of each row, ordered by their number of sign changes."""
    x = rows.copy()
    half = 1
    while half < WIDTH:
        pairs = x.reshape(len(x), -1, 2, half)
        x = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(len(x), WIDTH)
        half *= 2
    return x[:, _coarse_first()]


def _coarse_first() -> np.ndarray:
    """Places of the coefficients by sign changes of their basis row."""
    at = np.arange(WIDTH)
    ones = np.bitwise_count(at[:, None] & at[None, :]) % 2
    return np.argsort(np.abs(np.diff(ones.astype(int), axis=1)).sum(axis=1), kind="stable")


def nearest(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each row's nearest centroid; both inputs hold integers."""
    if max(np.abs(rows).max(initial=0), np.abs(centroids).max(initial=0)) > NARROW:
        rows, centroids = rows.astype(object), centroids.astype(object)
    w, u = transformed(rows), transformed(centroids)
    at = np.arange(len(rows))
    lo, hi = STEPS[0]
    partial = ((w[:, None, lo:hi] - u[None, :, lo:hi]) ** 2).sum(axis=2)
    alive = np.ones(partial.shape, bool)
    for lo, hi in STEPS[1:]:
        leader = np.where(alive, partial, partial.max(initial=0) + 1).argmin(axis=1)
        bound = ((w - u[leader]) ** 2).sum(axis=1)
        alive &= partial <= bound[:, None]
        r, c = np.nonzero(alive)
        partial[r, c] += ((w[r, lo:hi] - u[c, lo:hi]) ** 2).sum(axis=1)
    final = np.where(alive, partial, partial.max(initial=0) + 1)
    best = final.argmin(axis=1)
    return best.astype(np.int32), (final[at, best] // WIDTH).astype(np.int64)


def integers(batch: pa.RecordBatch) -> np.ndarray:
    """floor(64 * x) of each component, one row for each vector."""
    values = batch.column(batch.schema.get_field_index("embedding")).flatten().to_numpy(zero_copy_only=False)
    return np.floor(values.astype(np.float64) * SCALE).astype(np.int64).reshape(-1, WIDTH)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the vectors with exactly 64 components, none null, non-finite or too large."""
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) * SCALE >= WIDEST))
    return vectors.where((F.size("embedding") == WIDTH) & ~odd).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), "embedding"
    )


def first_centroids(kept: DataFrame, n: int) -> np.ndarray:
    """The n vectors with the smallest hashes of their id; null ids come last, equal ids by components."""
    mark = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    rows = kept.withColumn("mark", mark).orderBy(F.col("mark").asc_nulls_last(), "embedding").limit(n).collect()
    return np.array([[int(np.floor(float(x) * SCALE)) for x in r.embedding] for r in rows], np.int64).reshape(-1, WIDTH)


def moved(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid replaced by the floor of its vectors' mean; empty ones stay.

    Every task adds up its own rows; one row for each centroid leaves it, and the driver sees one sum for each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
        for batch in batches:
            if batch.num_rows:
                rows = integers(batch)
                best, _ = nearest(rows, centroids)
                np.add.at(total, best, rows)
                count += np.bincount(best, minlength=len(count))
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(count[some]), pa.array(list(total[some]), pa.list_(pa.int64()))],
            ["cluster", "n", "total"],
        )

    sums = kept.mapInArrow(run, "cluster int, n bigint, total array<bigint>")
    added = sums.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[k]) for k in range(WIDTH)]).alias("total")
    )
    out = centroids.copy()
    for r in added.collect():  # one row for each centroid
        out[r.cluster] = [x // r.n for x in r.total]
    return out


def assigned(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                best, distance = nearest(integers(batch), centroids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(best), pa.array(distance)], ["vec_id", "cluster", "distance"]
                )

    return kept.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def clustered(vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid, cluster_size for each kept row.

    vectors has vec_id and embedding, and is read once for the start, once a round and once at the end. Rows whose
    embedding is null, has not exactly 64 components, or holds a null, a non-finite number or one of 2**20 and more
    take no part. Repeated rows are vectors of their own and get the same cluster; rows with a null id take part, and
    start a centroid only after all others. With fewer vectors than centroids every vector starts one. Ties go to the
    smaller number. An inertia that does not fit a long is null. An empty table gives an empty result.
    """
    spark = prepare(vectors.sparkSession)
    kept = usable(vectors)
    places = first_centroids(kept, centroids)
    if not len(places):
        none = "cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string, "
        return spark.createDataFrame([], f"vec_id bigint, {none}centroid array<bigint>, cluster_size bigint")
    for _ in range(rounds):
        places = moved(kept, places)
    found = cut(assigned(kept, places))
    sums = found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(20,0)")).alias("inertia"), F.count(F.lit(1)).alias("n")
    )
    by = {r.cluster: (int(r.inertia), r.n) for r in sums.collect()}  # one row for each centroid
    total = sum(x for x, _ in by.values())
    rows = [
        (k, x if x <= LONG else None, total if total <= LONG else None,
         hashlib.sha256(",".join(map(str, places[k])).encode()).hexdigest(), places[k].tolist(), n)
        for k, (x, n) in sorted(by.items())
    ]
    known = spark.createDataFrame(
        rows,
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string, centroid array<bigint>, cluster_size bigint",
    )
    return found.join(F.broadcast(known), "cluster").select(  # one row for each centroid
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid", "cluster_size"
    )


def sql(n: int = CENTROIDS, rounds: int = ROUNDS) -> str:
    """The registered query in SQL, over embeddings, by comparing every vector with every centroid."""
    steps = [
        f"""kept AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings
      WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x) OR abs(CAST(x AS DOUBLE)) * {SCALE} >= {WIDEST})) = 0)""",
        f"""c0 AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY h) - 1 AS k, v
      FROM (SELECT sha256('1:' || CAST(vec_id AS VARCHAR)) AS h, v FROM kept ORDER BY h LIMIT {n}))""",
    ]
    places = ", ".join(str(i) for i in range(1, WIDTH + 1))
    for t in range(rounds + 1):
        squares = f"list_sum(list_transform([{places}], lambda i: (a.v[i] - c.v[i]) * (a.v[i] - c.v[i])))"
        steps.append(f"d{t} AS (SELECT a.r, c.k, CAST({squares} AS BIGINT) AS d FROM kept a CROSS JOIN c{t} c)")
        steps.append(
            f"""a{t} AS MATERIALIZED (
      SELECT r, k, d FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY d, k) AS p FROM d{t}) WHERE p = 1)"""
        )
        if t < rounds:
            steps.append(
                f"""m{t} AS (
      SELECT k, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS v
      FROM (SELECT k, i, CAST(sum(x) AS DOUBLE) AS s, count(*) AS n
            FROM (SELECT a.k, unnest([{places}]) AS i, unnest(b.v) AS x FROM a{t} a JOIN kept b USING (r)) GROUP BY k, i)
      GROUP BY k)"""
            )
            steps.append(
                f"c{t + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.v, c.v) AS v FROM c{t} c LEFT JOIN m{t} m USING (k))"
            )
    last = rounds
    return f"""WITH {', '.join(steps)}
    SELECT b.vec_id, CAST(a.k AS INTEGER) AS cluster, a.d AS distance,
      CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
      sha256(array_to_string(c.v, ',')) AS centroid_sha256
    FROM a{last} a JOIN kept b USING (r) JOIN c{last} c USING (k)"""
