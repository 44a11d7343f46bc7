"""Quality from attended passages: statistics and pooling by plain loops, gradients by differences, held-out labels."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vintagelake.llm import passages, registry
from vintagelake.llm.common import ByteHash, prepare, table

SF = "/root/testdata/sf0.1"


def frame(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(*r, "a", 1, 0.5) for r in rows], "doc_id bigint, text string, lang string, quality int, score double")


def labels(spark, rows):
    return spark.createDataFrame(list(rows), "doc_id bigint, quality int, text string")


def plain_passages(piece):
    """Statistics of a piece's passages, one byte and one word at a time."""
    raw = piece + b" "
    words, at = [], 0
    for w in raw.split():
        at = raw.index(w, at)
        words.append((at, w))
        at += len(w)
    starts = [words[i][0] for i in range(0, len(words), passages.PASSAGE_WORDS)] or [0]
    starts[0] = 0
    out = []
    for k, lo in enumerate(starts):
        hi = starts[k + 1] if k + 1 < len(starts) else len(raw)
        mine = [w for _, w in words[k * passages.PASSAGE_WORDS : (k + 1) * passages.PASSAGE_WORDS]]
        x = np.zeros(passages.FEATURES)
        for i in range(lo, hi):
            x[passages.KIND[raw[i]]] += 1
            if i + 1 < len(raw):
                x[passages.KINDS + passages._PAIR[raw[i] * 256 + raw[i + 1]]] += 1
        x = np.sqrt(x / (hi - lo))
        n = max(1, len(mine))
        x[-4] = sum(a == b for a, b in zip(mine, mine[1:])) / n
        x[-3] = (len(mine) - len(set(mine))) / n
        x[-2] = np.log1p(sum(map(len, mine)) / n) / 5
        x[-1] = len(mine) / passages.PASSAGE_WORDS
        out.append(x)
    return np.array(out)


def test_statistics_match_plain_loops():
    rng = random.Random(4)
    pieces = [b"", b" \n", b"a", b"a a a", b"\n" * 300 + b"x"]
    pieces += [" ".join(rng.choice(["ab", "Été", "##", "7", "\n", "b"]) for _ in range(rng.randrange(200))).encode() for _ in range(40)]
    got, of = passages.encoded(pieces, ByteHash())
    for i, piece in enumerate(pieces):
        want = plain_passages(piece)
        assert np.allclose(got[of == i], want, atol=1e-5), (i, piece)


def small_model(seed=0):
    rng = np.random.default_rng(seed)
    bags = [rng.normal(0, 1, (n, passages.FEATURES)).astype(np.float32) for n in (1, 3, 2, 5, 4, 1, 2, 3)]
    return passages.Model(bags, np.array([0, 1, 1, 0, 1, 0, 1, 1], np.float32), [], np.array([])), bags


def test_gradients_match_differences(monkeypatch):
    monkeypatch.setattr(passages, "EPOCHS", 1)
    model, bags = small_model()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    y = np.array([0, 1, 1, 0], np.float64)
    bags = [b.astype(np.float64) for b in bags[:4]]

    def loss():
        total = 0
        for b, t in zip(bags, y, strict=True):
            h, _, _, e = model._forward(b)
            q = passages._sigmoid((e @ h) / e.sum() @ model.p["c"] + model.p["d"][0])
            total -= t * np.log(q) + (1 - t) * np.log(1 - q)
        return total / len(y)

    gradient = model._gradient(bags, y)
    for name, value in model.p.items():
        for at in [0, value.size // 2, value.size - 1]:
            flat = value.reshape(-1)
            kept, step = flat[at], 1e-5
            flat[at] = kept + step
            up = loss()
            flat[at] = kept - step
            down = loss()
            flat[at] = kept
            assert gradient[name].reshape(-1)[at] == pytest.approx((up - down) / 2 / step, abs=1e-6), (name, at)


def test_long_texts_are_pooled_piece_by_piece(monkeypatch):
    model, _ = small_model()
    monkeypatch.setattr(passages, "PIECE_BYTES", 700)
    text = b"some words of a long text, again and again " * 200
    score, _ = model.scores([b"x", text, None], ByteHash())
    x = np.concatenate([passages.encoded([text[i : i + 700]], ByteHash())[0] for i in range(0, len(text), 700)])
    h, _, _, e = model._forward(((x - model.mean) / model.spread).astype(np.float32))
    want = passages._sigmoid(model.scale * ((e @ h) / e.sum() @ model.p["c"] + model.p["d"][0]) + model.shift)
    assert score[1] == pytest.approx(want, abs=1e-4)
    assert model.scores([text], ByteHash())[0][0] == pytest.approx(score[1], abs=1e-5)


def test_held_out_labels(spark):
    docs, known = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = registry.op11_passages(spark, SF).join(known, "doc_id").collect()
    unseen = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows) and len(unseen) > 500
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert np.mean([r.predicted for r in unseen if r.quality == 1]) >= 0.995
    assert np.mean([not r.predicted for r in unseen if r.quality == 0]) >= 0.97
    # Held-out labels and other columns change nothing.
    turned = known.withColumn("quality", F.when(passages.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    some = docs.where("doc_id < 200")
    a = passages.judged(some, known).orderBy("doc_id").collect()
    b = passages.judged(some.withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None)), turned).orderBy("doc_id").collect()
    assert a == b


def test_odd_rows(spark):
    good, bad = "the quick brown fox and a lazy dog " * 4, "## %% ## && " * 12
    rows = [(i, good if i % 2 else bad) for i in range(60)] + [(100, None), (101, ""), (102, " \n"), (103, "x " * 700_000), (None, good), (7, good)]
    known = [(i, i % 2, "t") for i in range(60)] + [(None, 1, "t"), (5, None, "t"), (7, 1, "t"), (8, 1, "t"), (100, 1, "t")]
    got = passages.judged(frame(spark, rows), labels(spark, known)).collect()
    assert len(got) == len(rows) and got[0].__fields__ == ["doc_id", "held_out", "score", "predicted", "attention"]
    assert all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert by[1].score > 0.5 > by[2].score and by[None].score == by[1].score and not by[None].held_out
    assert len({r.score for r in got if r.doc_id in (101, 100)}) == 1
    for few in ([], [(1, 1, "t")], [(1, 1, "t"), (1, 0, "t")]):
        assert {(r.score, r.predicted) for r in passages.judged(frame(spark, rows), labels(spark, few)).collect()} == {(0.5, 1)}
    assert passages.judged(frame(spark, []), labels(spark, known)).count() == 0
