"""Centroid clustering against plain loops, and its odd rows."""

import hashlib
import math
import sys

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from vintagelake.llm import centroids, registry
from vintagelake.llm.common import prepare, table

sys.path.insert(0, "tests")
import compare  # noqa: E402

SF = "/root/testdata/sf0.01"
ROWS = "vec_id bigint, embedding array<double>, cluster string, distance string, centroid string"


def frame(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(i, v, "a", "b", "c") for i, v in rows], ROWS)


def plain(rows, n=16, rounds=3):
    """Every vector against every centroid, with Python's integers."""
    kept = [
        (i, [math.floor(64 * x) for x in v]) for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    places = [v for _, v in order[:n]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(places))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for k, found in groups.items():
            places[k] = [sum(x) // len(found) for x in zip(*found, strict=True)]
    last = [(i, *nearest(v)) for i, v in kept]
    inertia = {}
    for _, d, k in last:
        inertia[k] = inertia.get(k, 0) + d
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in places]
    return sorted((i, k, d, inertia[k], sum(inertia.values()), digests[k]) for i, d, k in last)


def result(df):
    rows = df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()
    return sorted(tuple(r) for r in rows)


@pytest.mark.parametrize("spread", [0.05, 1.0, 3000.0])
def test_clusters_match_plain_loops(spark, spread):
    rng = np.random.default_rng(4)
    middles = rng.normal(0, spread, (20, 64))
    rows = [(i, (middles[i % 20] + rng.normal(0, spread / 3, 64)).tolist()) for i in range(400)]
    rows += [(i, rows[i - 400][1]) for i in range(400, 460)]
    got = centroids.clustered(frame(spark, rows))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid", "cluster_size"]
    assert result(got) == plain(rows)


def test_wide_integers_stay_exact(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.uniform(-1_000_000, 1_000_000, 64).tolist()) for i in range(60)]
    assert result(centroids.clustered(frame(spark, rows))) == plain(rows)


def test_search_equals_all_distances_with_ties():
    rng = np.random.default_rng(8)
    places = rng.integers(-3, 4, (16, 64))
    places[9] = places[2]
    rows = np.vstack((rng.integers(-3, 4, (500, 64)), places, (places[3] + places[5]) // 2 * np.ones((1, 64), np.int64)))
    every = ((rows[:, None].astype(np.int64) - places[None]) ** 2).sum(axis=2)
    best, distance = centroids.nearest(rows.astype(np.int64), places.astype(np.int64))
    assert best.tolist() == every.argmin(axis=1).tolist() and distance.tolist() == every.min(axis=1).tolist()


def test_odd_rows(spark):
    good = [0.5] * 64
    rows = [
        (1, None), (2, []), (3, [0.1] * 63), (4, [0.1] * 65), (5, [None, *[0.1] * 63]), (6, [float("nan"), *[0.1] * 63]),
        (7, [float("inf"), *[0.1] * 63]), (8, [-float("inf"), *[0.1] * 63]), (9, [1e300, *[0.1] * 63]), (10, good), (10, good),
        (11, [-0.01] * 64),
    ]
    assert result(centroids.clustered(frame(spark, rows))) == plain([r for r in rows if r[0] != 9])
    null_id = centroids.clustered(frame(spark, [*rows, (None, [0.7] * 64)])).collect()
    assert sorted(r.vec_id for r in null_id if r.vec_id is not None) == [10, 10, 11] and len(null_id) == 4
    for few in ([], rows[:8]):
        assert result(centroids.clustered(frame(spark, few))) == []


def test_registered_query_matches_its_sql(spark):
    con = compare.connect(SF)
    df = registry.op12_centroids(spark, SF)
    cur = con.execute(centroids.sql())
    names, want = compare.rows_of([c[0] for c in cur.description], cur.fetchall())
    got_names, got = compare.rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert names == got_names and got == want
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    assert result(df) == plain(rows)
