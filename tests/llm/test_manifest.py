"""The Merkle manifest against plain recursion, its proofs, and odd rows."""

import hashlib
import random
import sys
import zlib

from pyspark.sql import functions as F

from vintagelake.llm import manifest, registry
from vintagelake.llm.common import prepare, table

sys.path.insert(0, "tests")
import compare  # noqa: E402

SF = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string, path string, lo int, grove string, hash string"


def frame(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(*r, "p", 1, "g", "h") for r in rows], DOCS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(hashes):
    """The top, and for each leaf its siblings level by level."""
    groups = [[i] for i in range(len(hashes))]
    proofs = [[] for _ in hashes]
    while len(hashes) > 1:
        up, held = [], []
        for at in range(0, len(hashes), 3):
            run = hashes[at : at + 3]
            for k in range(len(run)):
                for i in groups[at + k]:
                    proofs[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(sha("".join(run)))
            held.append([i for g in groups[at : at + 3] for i in g])
        hashes, groups = up, held
    return hashes[0], proofs


def plain(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = tree([leaf(r) for r in by[s]])
    root, above = tree([trees[s][0] for s in names]) if names else (None, [])
    out = []
    for s, up in zip(names, above, strict=True):
        for r, own in zip(by[s], trees[s][1], strict=True):
            steps = own + up
            odd = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            h = leaf((*r[:4], r[4].replace("\n", ""))) if odd else leaf(r)
            for a, b in steps:
                h = sha(a + h + b)
            out.append((r[0], leaf(r), trees[s][0], root, sha("".join(a + b for a, b in steps)), h, h == root))
    return sorted(out, key=str)


def result(df):
    cols = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def answers(docs):
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = manifest.proven(docs, tampered).withColumn("folded_root", manifest.folded("found_leaf", "path"))
    return found.withColumn("proof_sha256", manifest.proof("path")).withColumn("verified", F.expr("folded_root = root"))


def test_trees_of_many_sizes(spark):
    rng = random.Random(3)
    rows = []
    for s, n in [("a", 1), ("b", 2), ("c", 3), ("é", 4), ("z", 9), ("B", 10), ("", 27), (None, 28), ("hot", 700), ("zz", 82)]:
        for i in range(n):
            rows.append((rng.randrange(10**6), s, rng.choice(["en", None]), i, f"line {i}\nnext" if i % 3 else f"line {i}"))
    rng.shuffle(rows)
    got = answers(frame(spark, rows))
    assert result(got) == plain(rows)


def test_odd_rows(spark):
    rows = [
        (None, None, None, None, None), (None, None, None, None, None), (1, "s", "en", 0, ""), (1, "s", "en", 0, None), (1, "s", "en", 0, ""),
        (2, "s", None, 5, "\n\n\n"), (3, "", "en", 1, "x" * 3_000_000), (4, "s", "en", 2, "é\n日本"), (-7, "s", "en", None, "a:b-"),
        (0, "s", "en", 3, " \n "),
    ]
    docs = frame(spark, rows)
    assert result(answers(docs)) == plain(rows)
    whole = manifest.proven(docs).withColumn("again", manifest.folded("found_leaf", "path"))
    assert whole.where("again = root").count() == len(rows)
    assert answers(frame(spark, [])).count() == 0
    assert result(answers(frame(spark, rows[2:3]))) == plain(rows[2:3])


def test_ranks_have_no_gaps(spark):
    rows = [(i // 2, "s" if i % 3 else None, "en", i, "t") for i in range(500)]
    got = manifest.proven(frame(spark, rows)).select("source", "rank", "doc_id", "leaf").collect()
    for source in ("s", None):
        mine = sorted((r for r in got if r.source == source), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(len(mine)))
        assert [(r.doc_id, r.leaf) for r in mine] == sorted((r.doc_id, r.leaf) for r in mine)


def test_registered_query_matches_its_sql(spark):
    con = compare.connect(SF)
    df = registry.op13_manifest(spark, SF)
    cur = con.execute(manifest.sql())
    names, want = compare.rows_of([c[0] for c in cur.description], cur.fetchall())
    got_names, got = compare.rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert names == got_names and got == want
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in table(spark, SF, "documents").collect()]
    assert result(df) == plain(rows)
    assert 0 < sum(r[6] for r in result(df)) < len(rows)
