"""Mixing, sharding, packing, neighbours and the pipeline: laws, exact round trips, brute force."""

import json
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from vintagelake.llm import mixing, neighbours, packing, registry, sharding
from vintagelake.llm.common import prepare, table

SF = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id bigint, text string, source string, size string, place string, shard string"


def frame(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(i, t, s, "a", "b", "c") for i, t, s in rows], DOCS)


def test_targets():
    got = mixing.targets({"b": 100, "a": 100, "c": 1000, None: 10})
    # a, b, c, null weigh 1, 2, 3, 1; null stops at 30, b's share of the rest at 300.
    assert got[None] == 30 and got["b"] == 300
    assert got["a"] == pytest.approx(220) and got["c"] == pytest.approx(660)
    assert sum(got.values()) == pytest.approx(1210)
    assert mixing.targets({}) == {} and mixing.targets({"a": 0}) == {"a": 0.0}


@pytest.mark.parametrize("land", [False, True])
def test_flight_keeps_both_totals(land):
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 4000, 700).astype(float).tolist()
    x = mixing.flight(sizes, [0.37] * 700, rng, land)
    assert abs(np.dot(sizes, x) - 0.37 * sum(sizes)) < (1e-3 if not land else 10)
    assert sum(0 < p < 1 for p in x) <= (0 if land else 2 + mixing.LANDING)
    assert abs(sum(x) - 0.37 * 700) < (1e-6 if not land else 14)


def test_mixing_meets_targets(spark):
    rng = random.Random(1)
    rows = [(i, " ".join("w" * (1 + i % 3) for _ in range(rng.randrange(1, 300))), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(3000)]
    got = mixing.mixed(frame(spark, rows)).collect()
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3 and r.size == len(rows[r.doc_id][1].split())
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    want = mixing.targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) < 5
    again = mixing.mixed(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)


def test_mixing_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", None), (3, "x y", "a"), (3, "x y", "a"), (3, "z", "b"), (None, "q r s", None), (None, "q r s", None), (5, "w " * 20_000, "b")]
    got = mixing.mixed(frame(spark, rows)).collect()
    assert len(got) == len(rows) and sum(r.size for r in got) == 2 + 2 + 1 + 3 + 3 + 20_000
    out = mixing.remixed(frame(spark, rows))
    assert out.columns == DOCS.replace(" bigint", "").replace(" string", "").split(", ")
    words = Counter()
    for r in out.collect():
        words[r.source] += len((r.text or "").split())
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
    assert +words == +taken
    assert mixing.mixed(frame(spark, [])).count() == 0 and mixing.remixed(frame(spark, [])).count() == 0


def test_shards(spark):
    rng = random.Random(2)
    common = "c " * 40
    rows = [(i, common if i % 3 == 0 else "x" * rng.randrange(1, 900) + str(i % 700), "s") for i in range(6000)]
    rows += [(None, None, "s"), (7, "", "s"), (8, "long " * 3000, "s")]
    got = sharding.sharded(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    loads, slots, homes = Counter(), defaultdict(list), defaultdict(set)
    text = Counter((t or "") for _, t, _ in rows)
    for r in got:
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
    for t in set(t for _, t, _ in rows if t):
        homes[zlib.crc32(t.encode())] = set()
    for r in got:
        homes[r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(40))
    assert max(loads.values()) < 1.1 * min(loads.values())
    assert all(len(homes[zlib.crc32(t.encode())]) == 1 for t, n in text.items() if n < 9)
    assert sum(r.size for r in got) == sum(16 + len((t or "").encode()) for _, t, _ in rows)
    few = sharding.sharded(frame(spark, rows[:3])).collect()
    assert all(r.slot >= 0 for r in few) and sharding.sharded(frame(spark, [])).count() == 0


def test_shards_hold_whole_rows(spark):
    rows = [(None if i % 50 == 0 else i % 30, None if i % 70 == 0 else f"text {i % 200} " * (i % 9), f"source {i}") for i in range(2000)]
    docs = frame(spark, rows).withColumn("tags", F.array("source"))
    got = sharding.sharded(docs, 8)
    assert got.select("doc.*").schema == docs.schema
    out = got.select("doc.*", F.col("shard").alias("to"), "slot").collect()
    assert len({(r.to, r.slot) for r in out}) == len(rows)
    assert Counter((r.doc_id, r.text, r.source, r.size, r.place, r.shard, r.tags[0]) for r in out) == Counter((*r, "a", "b", "c", r[2]) for r in rows)
    assert all(zlib.crc32((r.doc.text or "").encode()) == r.text_crc32 and r.doc.doc_id == r.doc_id for r in got.collect())
    assert sharding.sharded(docs.where(F.lit(False))).select("doc.*").schema == docs.schema


def test_first_fit_is_first_fit():
    rng = random.Random(6)
    sizes = sorted((rng.randrange(1, 101) for _ in range(400)), reverse=True)
    room, want = [], []
    for s in sizes:
        at = next((i for i, r in enumerate(room) if r >= s), len(room))
        room += [100] if at == len(room) else []
        room[at] -= s
        want.append(at)
    assert packing.first_fit(sizes, 100) == want and packing.first_fit([], 9) == []


def test_word_ids_equal_the_tokenizer():
    rng = random.Random(8)
    tokens = packing.WordTokens(WORDS, kept=300)
    alphabet = "aAbéÉßΣσıİ'sS.,!?-12 \n\t\x1ć  ﬁ日|$\""
    texts = ["", "<|endoftext|> a", "it's DON'T 'll", "ΑΣ ΣΑΣ.", *("".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(1500))]
    plain = Tokenizer.from_file(WORDS)
    plain.encode_special_tokens = True
    for lo in range(0, len(texts), 100):
        some = texts[lo : lo + 100]
        for t, raw in zip(some, tokens.ids(some), strict=True):
            assert np.frombuffer(raw, "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids, repr(t)


def check_packed(rows, texts):
    plain = Tokenizer.from_file(WORDS)
    plain.encode_special_tokens = True
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= packing.LENGTH
    for doc_id, text in texts.items():
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    return len(sequences)


def test_packing_round_trip(spark):
    docs = table(spark, SF, "documents")
    rows = packing.packed(docs, WORDS).collect()
    check_packed(rows, {r.doc_id: r.text for r in docs.collect()})
    odd = [(1, None, "s"), (2, "", "s"), (3, "a", "s"), (3, "a", "s"), (None, "b", "s"), (4, "word " * 10_000, "s"), (5, "w " * 4095, "s")]
    rows = packing.packed(frame(spark, odd), WORDS).collect()
    assert sum(r.length for r in rows) == 1 + 1 + 2 + 2 + 2 + 10_001 + 4096
    assert sum(r.doc_id == 3 for r in rows) == 2
    assert packing.packed(frame(spark, []), WORDS).count() == 0


def test_packing_fills_sequences(spark):
    rows = packing.packed(table(spark, "/root/testdata/sf0.01", "documents"), WORDS).collect()
    n = len({r.sequence_id for r in rows})
    assert sum(r.length for r in rows) / n / packing.LENGTH > 0.99


def test_packed_sequences_hold_their_ids(spark):
    plain = Tokenizer.from_file(WORDS)
    plain.encode_special_tokens = True
    rng = random.Random(11)
    odd = [(i % 40, " ".join(rng.choice(["word", "Other", "x1", "é"]) for _ in range(rng.randrange(0, 9000, 7))), "s") for i in range(60)]
    odd += [(3, None, "s"), (None, "b", "s"), (5, "w " * 4095, "s")]
    sequences, docs = defaultdict(dict), Counter()
    for r in packing.packed(frame(spark, odd), WORDS).collect():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length and r.offset not in sequences[r.sequence_id]
        sequences[r.sequence_id][r.offset] = ids
    stream = Counter()
    for s in sequences.values():
        whole = sum((s[at] for at in sorted(s)), [])
        assert all(whole[at : at + len(ids)] == ids for at, ids in s.items()) and len(whole) <= packing.LENGTH
        stream.update(whole)
    for _, t, _ in odd:
        docs.update([*plain.encode(t or "", add_special_tokens=False).ids, 2])
    assert stream == docs
    got = registry.op9_packing(spark, SF)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert got.count() >= table(spark, SF, "documents").count()


def vectors(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(i, v, 0, 0.0) for i, v in rows], "vec_id bigint, embedding array<float>, rank int, score double")


def brute_nearest(rows, queries, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(float)
    norms = np.sqrt((x * x).sum(axis=1))
    out = {}
    for i, v in queries:
        q = np.array(v, np.float32).astype(float)
        score = (x * q).sum(axis=1) / (norms * np.sqrt((q * q).sum()))
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
        out[i] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def test_neighbours_recall(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 32))
    x = np.vstack([rng.normal(size=(1500, 32)), centres[rng.integers(0, 40, 1500)] + 0.3 * rng.normal(size=(1500, 32))])
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    queries = [r for r in rows if r[0] % 50 == 0]
    want = brute_nearest(rows, queries, 5)
    got = defaultdict(list)
    for r in neighbours.nearest(vectors(spark, rows), vectors(spark, queries)).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    hits = sum(len({v for _, v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits / (5 * len(want)) >= 0.95
    assert all([k for k, _, _ in g] == [1, 2, 3, 4, 5] and [-s for *_, s in g] == sorted(-s for *_, s in g) for g in got.values())


def test_neighbours_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [3.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, None]),
        (8, [1.0, 0.0, 0.0]), (9, []), (2, [3.0, 0.0]), (50, [0.0, 1.0]), (None, [1.0, 1.0]),
    ]
    df = vectors(spark, rows)
    got = neighbours.nearest(df, df.where("vec_id % 50 = 0")).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == [(0, 1, 1), (0, 2, 2), (0, 3, 50), (50, 1, 0), (50, 2, 1), (50, 3, 2)]
    assert neighbours.nearest(vectors(spark, []), df).count() == 0 == neighbours.nearest(df, vectors(spark, [])).count()


def test_neighbours_repeated_ids(spark):
    rng = np.random.default_rng(12)
    base = [(i, [float(c) for c in rng.normal(size=8)]) for i in range(1, 40)]
    query = (0, [1.0] * 8)
    near = [(100, [1.0 + 0.001 * (j + 1) * (c % 2) for c in range(8)]) for j in range(10)]
    for copies in (near, near[:1] * 10):
        rows = [query, *base, *copies]
        got = neighbours.nearest(vectors(spark, rows), vectors(spark, [query])).orderBy("rank").collect()
        best = {}
        for i, s in brute_nearest(rows, [query], 99)[0]:
            best[i] = max(s, best.get(i, -2.0))
        want = sorted(best.items(), key=lambda x: (-x[1], x[0]))
        assert [r.rank for r in got] == [1, 2, 3, 4, 5] and len({r.vec_id for r in got}) == 5
        assert (got[0].vec_id, got[0].score) == (100, pytest.approx(want[0][1]))
        assert len({r.vec_id for r in got} & {i for i, _ in want[:5]}) >= 4


def test_pipeline(spark):
    """Each stage on what the stage before it kept; columns hold until the last one."""
    docs = table(spark, SF, "documents")
    before, names = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF)
        if name != "packing":
            assert after.columns == names
            left, there = Counter(r.doc_id for r in after.collect()), {r.doc_id for r in before.collect()}
            assert set(left) <= there and (name == "mixing" or max(left.values()) == 1)
            if name == "personal":
                assert set(left) == there and after.where(F.col("text").contains("@mail")).count() == 0
        before = after
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_dups", "personal", "mixing", "packing"]
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, whole.drop("sequence_id", "offset").collect())) == sorted(map(tuple, before.drop("sequence_id", "offset").collect()))


def test_pipeline_odd_rows(spark):
    prepare(spark)
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, "x y", None, None, 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for frame_ in (docs, docs.where(F.lit(False))):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame_, SF)
            assert out.count() == 0 if name == "quality" else out.count() <= 3


def test_another_vocabulary_is_encoded_whole(tmp_path):
    """A file that keeps case, parts numbers or closes words differently must not be taken for the usual one."""
    state = json.loads(Tokenizer.from_file(WORDS).to_str())
    texts = ["Hello WORLD, it's 2024!", "Été  naïve", "a\nb", ""]
    for change in (
        {"normalizer": None}, {"normalizer": {"type": "NFKC"}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}},
        {"model": state["model"] | {"end_of_word_suffix": None}}, {},
    ):
        path = str(tmp_path / "t.json")
        with open(path, "w") as f:
            json.dump(state | change, f)
        words = packing.WordTokens(path)
        assert words.by_word == (not change)
        plain = Tokenizer.from_file(path)
        want = [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert words.ids(texts) == want
