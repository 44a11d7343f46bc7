"""Quality rules and language identification: exact counts, held-out accuracy, odd rows."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vintagelake.llm import language, quality
from vintagelake.llm.common import prepare, table

SF = "/root/testdata/sf0.01"


def plain_counts(text):
    """The base counts, one rule at a time."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {i + k for i, t in enumerate(triples) if triples.count(t) > 1 for k in range(3)}
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated)]


def frame(spark, texts):
    prepare(spark)
    rows = [(i, t, "x", "y", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, kept string, lang string, quality int")


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id bigint, quality int, toxic int")


def test_base_counts(spark):
    rng = random.Random(2)
    parts = ["ab", "cd", "é", "日本", "x#", "|", "\n", "\n\n", " ", "\t", "\x1f", "\x85", "b c d ", "b c d\n"]
    texts = [None, "", " \n ", "a", "w " * 20_000, *("".join(rng.choice(parts) for _ in range(rng.randrange(1, 80))) for _ in range(200))]
    for r in quality.judged(frame(spark, texts), labels(spark)).collect():
        if r.doc_id == 4:
            assert (r.n_words, r.n_repeat_words) == (20_000, 20_000)
            continue
        want = plain_counts(texts[r.doc_id])
        assert [r[c] for c in quality.BASE] == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r.kept == (not r.base_failed) and r.score is None


@pytest.fixture(scope="module")
def judged(spark):
    docs, known = table(spark, SF, "documents"), table(spark, SF, "labels")
    learnt = known.where("doc_id % 2 = 0")
    return quality.judged(docs, learnt).join(known, "doc_id").where("doc_id % 2 = 1").collect()


def test_forest_on_unseen_labels(judged):
    good = [r for r in judged if r.quality == 1 and not r.base_failed]
    poor = [r for r in judged if r.quality == 0]
    assert np.mean([r.kept for r in good]) >= 0.99
    assert np.mean([not r.kept for r in poor]) >= 0.95


def test_filter_keeps_columns_and_agrees(spark):
    docs, known = table(spark, SF, "documents"), table(spark, SF, "labels")
    kept = quality.filtered(docs, known)
    assert kept.schema == docs.schema
    want = quality.judged(docs, known).where("kept").select("doc_id")
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(r.doc_id for r in want.collect())


def test_forest_odd_input(spark):
    docs = frame(spark, [])
    assert quality.judged(docs, labels(spark)).count() == 0 and quality.filtered(docs, labels(spark)).count() == 0
    docs = frame(spark, ["a b c " + " ".join(f"w{i}" for i in range(60))] * 3)
    odd = labels(spark, [(0, 1, 0), (0, 0, 0), (1, 1, None), (None, 1, 1), (2, None, 0)])
    assert [r.kept for r in quality.judged(docs, odd).collect()] == [True] * 3


def test_paths_shorten_for_odd_rows():
    rng = np.random.default_rng(1)
    good = rng.normal(0, 1, (500, 4))
    bad = np.full((5, 4), 9.0)
    forest = quality.grown(np.vstack((good, bad)), np.array([True] * 500 + [False] * 5))
    assert forest.score(bad).min() > forest.score(good).max()


def test_fit_takes_every_labelled_row(spark):
    """More labelled rows than the 20,000 that once counted: ranges, weights, node counts and threshold are those of all rows."""
    n = 24_000
    counted = spark.range(n).selectExpr(
        "id AS doc_id", "100L AS n_words", "500L AS word_chars", "0L AS n_symbols", "0L AS n_dup_lines", "0L AS n_repeat_words",
        f"transform(sequence(0, {len(quality.RULES) - 1}), k -> IF(id % 40 = 7, 2, 0) * (k % 3) + pmod(xxhash64(id, k), 1000) / 1000D) AS rules",
    )
    known = counted.selectExpr("doc_id", "IF(doc_id % 40 = 7, 0, 1) AS quality")
    forest, at = quality.fit(counted, known)
    rows = np.array([r.rules for r in counted.orderBy("doc_id").collect()])
    good = np.arange(n) % 40 != 7
    want = quality.grown(rows, good)
    assert np.allclose(forest.weights, want.weights) and np.array_equal(forest.path, want.path)
    assert forest.path.shape == (quality.TREES, 2**quality.TREE_DEPTH)
    score = want.score(rows)
    balance = {
        s: np.mean(score[~good] > s) - np.mean(score[good] > s) for s in np.unique(score) if np.mean(score[good] > s) <= quality.GOOD_LOST
    }
    best = max(balance.values())
    chosen = min(s for s, b in balance.items() if b == best)
    above = score[score > chosen]
    assert at == pytest.approx((chosen + above.min()) / 2 if len(above) else chosen, abs=1e-12)


def test_language_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    seen = docs.where(~language.held_out())
    rows = language.identified(docs, seen).join(docs.select("doc_id", "lang"), "doc_id").collect()
    unseen = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(rows) == docs.count() and len(unseen) > 100
    assert np.mean([r.lang == r.lang_pred for r in unseen]) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_odd_rows(spark):
    texts = [None, "", "123 ...", "the and of with " * 5000, "日本語", "😀".encode("utf-16", "surrogatepass").decode("utf-16"), "the"]
    prepare(spark)
    training = spark.createDataFrame(
        [(i, t, lang) for i, (t, lang) in enumerate([("the and of with", "en"), ("le la et avec", "fr")] * 40)] + [(None, None, "en"), (99, "x", None)],
        "doc_id bigint, text string, lang string",
    )
    rows = {r.doc_id: r for r in language.identified(frame(spark, texts), training).collect()}
    assert [rows[i].lang_pred for i in (0, 1, 2, 5)] == ["und"] * 4 and [rows[i].score for i in (0, 1, 2, 5)] == [0.0] * 4
    assert rows[3].lang_pred == rows[6].lang_pred == "en" and rows[4].lang_pred in ("en", "fr")
    assert rows[0].rejected and not rows[3].rejected
    nothing = language.identified(frame(spark, ["abc"]), training.where(F.lit(False))).collect()
    assert [(r.lang_pred, r.score) for r in nothing] == [("und", 0.0)]
    assert language.identified(frame(spark, []), training).count() == 0


def test_letters_are_of_category_l(spark):
    prepare(spark)
    training = spark.createDataFrame(
        [(i, t, lang) for i, (t, lang) in enumerate([("the and of with", "en"), ("le la et avec", "fr")] * 40)], "doc_id bigint, text string, lang string"
    )
    texts = ["²", "½ ③", "— … ×÷ €", "Ⅷ", "４２", "ªx", "the—and—of—with", "the and of with"]
    rows = [r for r in language.identified(frame(spark, texts), training).orderBy("doc_id").collect()]
    assert [(r.lang_pred, r.score) for r in rows[:5]] == [("und", 0.0)] * 5 and rows[5].lang_pred != "und"
    # Dashes part words as spaces do.
    assert rows[6].score == rows[7].score and rows[6].lang_pred == "en"


def test_language_ignores_other_columns(spark):
    docs = table(spark, SF, "documents").limit(200)
    seen = docs.where(~language.held_out())
    a = language.identified(docs, seen).orderBy("doc_id").collect()
    b = language.identified(docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("q")), seen).orderBy("doc_id").collect()
    assert a == b
