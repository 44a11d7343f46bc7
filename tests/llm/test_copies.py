"""Near-duplicates and their components, against brute force."""

import random
import time

import pytest
from pyspark.sql import functions as F

from vintagelake.llm import near_dups
from vintagelake.llm.common import cut, prepare
from vintagelake.llm.components import connected

DOCS = "doc_id bigint, text string, key string, rep int, n string, component_id string"


def frame(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(i, t, "k", 1, "n", "c") for i, t in rows], DOCS)


def brute(rows):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = {}
    for i, t in rows:
        w = (t or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted((i, len(sets[i]), find(i)) for i in ids)


def result(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def test_families_of_edits_match_brute_force(spark):
    rng = random.Random(5)
    rows, n = [], 0
    for family in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([6, 40, 150, 400]))]
        for _ in range(14):
            rows.append((n, edited(rng, base, rng.randrange(0, max(1, len(base) // 20) + 1))))
            n += 1
    rows += [(n + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(60))) for i in range(40)]
    rng.shuffle(rows)
    assert result(near_dups.near_duplicates(frame(spark, rows))) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "One TWO"), (6, "a b c d e f"), (6, "a b c d e f"),
        (7, "A b c\nd  e f"), (8, "x " * 30000), (9, "Été a b c d"), (None, "a b c d e f"), (None, None),
    ]
    got = near_dups.near_duplicates(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert [by[i].n_shingles for i in (1, 2, 3, 4, 6, 8)] == [0, 0, 0, 1, 2, 1]
    assert [by[i].component_id for i in (1, 2, 3, 4, 5, 6, 7, 8, 9)] == [1, 2, 3, 4, 4, 6, 6, 8, 9]
    assert [by[i].kept for i in (1, 2, 4, 5, 7)] == [True, True, True, False, False]
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    left = near_dups.deduplicated(frame(spark, rows))
    assert left.columns == ["doc_id", "text", "key", "rep", "n", "component_id"]
    ids = [r.doc_id for r in left.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 6, 8, 9] and ids.count(None) == 2
    assert near_dups.near_duplicates(frame(spark, [])).count() == 0


def test_apart_in_one_large_family(spark):
    """Many texts too far from each other to link, and one chain that only pairs away from the smallest id make."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, edited(rng, base, 5)) for i in range(150)]
    assert result(near_dups.near_duplicates(frame(spark, rows))) == brute(rows)


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(200)], [(0, i) for i in range(1, 300)]])
def test_components(spark, edges):
    prepare(spark)
    df = spark.createDataFrame(edges, "u bigint, v bigint")
    got = {r.node: r.component for r in connected(df).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: min(nodes) for x in nodes}


def test_lineage_is_stored(spark):
    df = cut(spark.range(5).withColumn("x", F.col("id") * 2))
    assert "ExistingRDD" in df._jdf.queryExecution().toString() or "Scan" in df._jdf.queryExecution().toString()


def test_unique_texts_of_a_repeated_id_stay(spark):
    t, other = "one two three four five six", "quite another text about something else"
    rows = [(1, t), (5, t), (5, other), (7, other), (7, other), (8, None), (8, None), (None, t), (None, t), (9, "last words here"), (9, "last words here")]
    left = near_dups.deduplicated(frame(spark, rows))
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(
        [(1, t), (5, other), (8, None), (None, t), (None, t), (9, "last words here")], key=str)
    # Columns named like those inside stay what they are.
    named = frame(spark, rows[:3]).selectExpr("doc_id", "text", "'a' AS id", "'b' AS text_mark", "'c' AS stays", "'d' AS place", "'e' AS doc", "'f' AS __place")
    got = near_dups.deduplicated(named)
    assert got.columns == named.columns and {r[2:] for r in got.collect()} == {("a", "b", "c", "d", "e", "f")}


def test_similarities_below_the_tables_are_refused(spark):
    with pytest.raises(ValueError, match="75"):
        near_dups.near_duplicates(frame(spark, [(1, "a")]), percent=50)


@pytest.mark.parametrize("split", [0, 4])
def test_small_blocks_change_nothing(spark, monkeypatch, split):
    """Families cut into many blocks, with size classes, large components of their own and large buckets split."""
    monkeypatch.setattr(near_dups, "BLOCK_ITEMS", 300)
    monkeypatch.setattr(near_dups, "SPLIT_BLOCKS", split)
    rng = random.Random(21)
    rows = []
    for length in (60, 75, 90):
        base = [f"w{i}" for i in range(length)]
        rows += [(len(rows) + i, edited(rng, base, rng.randrange(1, 4))) for i in range(60)]
    rng.shuffle(rows)
    assert result(near_dups.near_duplicates(frame(spark, rows))) == brute(rows)


def meeting_rows(spark, members):
    df = spark.createDataFrame([(7, 3, *m) for m in members], "key bigint, place int, rep bigint, n bigint, comp bigint")
    return near_dups._meetings(df, 75).collect()


def test_a_family_does_not_meet_itself(spark, monkeypatch):
    """Strays in a bucket meet the family once; the family's own pairs cost nothing."""
    prepare(spark)
    monkeypatch.setattr(near_dups, "BLOCK_ITEMS", 1000)
    for family in (400, 800, 1600):
        members = [(i, 100, 0) for i in range(family)] + [(5000 + i, 100, 5000 + i) for i in range(3)]
        met = meeting_rows(spark, members)
        blocks = -(-family * 100 // 1000)
        assert sum(r.rep < 5000 for r in met) == family
        assert len(met) <= family + 3 * blocks + 3
    assert meeting_rows(spark, [(i, 100, 0) for i in range(50)]) == []


def test_every_pair_of_components_meets_once(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(near_dups, "BLOCK_ITEMS", 500)
    rng = random.Random(4)
    members = [(i, rng.choice([60, 70, 80, 100, 130]), rng.choice([0, 1, i])) for i in range(120)]
    found = {}
    for r in meeting_rows(spark, members):
        found.setdefault(r.meet, []).append(r)
    seen = []
    for rows in found.values():
        left = [r for r in rows if r.side != near_dups.RIGHT]
        right = [r for r in rows if r.side != near_dups.LEFT]
        for x in left:
            for y in right:
                if x.comp != y.comp and (x.side != near_dups.BOTH or x.rep < y.rep):
                    seen.append((min(x.rep, y.rep), max(x.rep, y.rep)))
    assert len(seen) == len(set(seen))
    wanted = {
        (a, b) for k, (a, n, c) in enumerate(members) for b, m, d in members[k + 1 :]
        if c != d and 100 * min(n, m) >= 75 * max(n, m)
    }
    assert wanted <= set(seen)


def test_shuffles_of_what_was_cut_are_deleted(spark):
    def files():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(blocks.apply(i).getName().startswith("shuffle_") for i in range(blocks.size()))

    cut(spark.range(1))  # what earlier tests left goes now, or later, but never comes
    time.sleep(2)
    before = files()
    rows = [cut(spark.range(5000).groupBy((F.col("id") % 700).alias("k")).count()) for _ in range(4)]
    for _ in range(2):
        cut(spark.range(1))
        time.sleep(1)
    until = time.time() + 10
    while files() > before and time.time() < until:
        time.sleep(0.2)
    assert files() <= before
    assert all(r.count() == 700 for r in rows)
