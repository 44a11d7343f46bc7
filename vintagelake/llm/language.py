"""Language identification: averaged embeddings of hashed subwords under a linear softmax.

Subwords are letter n-grams inside words, boundaries included. Since the average and the
softmax's weights are linear, their product is one small table: bucket to logits.
"""

from __future__ import annotations

import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintagelake.llm.common import mapped, mix, prepare, texts_of, worker_state

BUCKETS = 1 << 15
GRAMS = (2, 3, 4)
WIDTH = 16
# Training documents per language, at most: the lowest hashes of doc_id. How many times as many ids are ranked for it.
DOCS_PER_LANGUAGE = 512
SPARE = 4
# Languages that a model can tell apart, at most; more is an error.
MAX_LANGUAGES = 1_000
EPOCHS = 6
RATE = 0.5
# Predictions below the score that keeps this share of right validation predictions are rejected.
RIGHT_KEPT = 0.995
HELD_OUT = (4, 2)
NO_LANGUAGE = "und"


def _word_table() -> np.ndarray:
    """For each code point whether it stands inside words: letters (category L) and the marks on them (M)."""
    return np.array([unicodedata.category(chr(i))[0] in "LM" for i in range(sys.maxunicode + 1)])


def buckets(text: bytes | None) -> np.ndarray | None:
    """Bucket of each subword of the whole text; None if it has no letter."""
    if not text:
        return None
    s = text.decode("utf-8", "replace").lower()
    if not any(map(str.isalpha, s)):  # a letter is of category L, whatever the script
        return None
    cp = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32)
    cp = np.where(worker_state(("word table",), _word_table)[cp], cp, np.uint32(0))
    first = np.empty(len(cp), bool)
    first[0] = True
    first[1:] = (cp[1:] != 0) | (cp[:-1] != 0)
    cp = np.concatenate(([0], cp[first], [0])).astype(np.uint64)
    out = []
    with np.errstate(over="ignore"):
        for n in GRAMS:
            if len(cp) < n:
                continue
            h = np.full(len(cp) - n + 1, n, np.uint64)
            for k in range(n):
                h = h * np.uint64(0x9E3779B97F4A7C15) + cp[k : len(cp) - n + 1 + k]
            whole = np.ones(len(h), bool)
            for k in range(1, n - 1):
                whole &= cp[k : len(cp) - n + 1 + k] != 0
            out.append((mix(h[whole]) & np.uint64(BUCKETS - 1)).astype(np.int64))
    return np.concatenate(out)


def _counted(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Training rows: distinct buckets and their counts, as bytes."""
    at, weight = [], []
    for text in texts_of(batch.column("text")):
        b = buckets(text)
        b, n = np.unique(b if b is not None else np.empty(0, np.int64), return_counts=True)
        at.append(b.astype(np.uint16).tobytes())
        weight.append(n.astype(np.float32).tobytes())
    return pa.RecordBatch.from_arrays(
        [batch.column("lang"), batch.column("place"), pa.array(at, pa.binary()), pa.array(weight, pa.binary())],
        ["lang", "place", "at", "weight"],
    )


class Model:
    """Bucket table of logits, with the temperature and the rejection score fitted on a validation part."""

    def __init__(self, rows: list[tuple[str, np.ndarray, np.ndarray]], validation: list[tuple[str, np.ndarray, np.ndarray]]):
        self.names = sorted({lang for lang, _, _ in rows})
        number = {lang: i for i, lang in enumerate(self.names)}
        rng = np.random.default_rng(23)
        embed = rng.normal(0, 0.1, (BUCKETS, WIDTH))
        out = np.zeros((WIDTH, len(self.names)))
        steps, total = 0, EPOCHS * len(rows)
        for _ in range(EPOCHS):
            for i in rng.permutation(len(rows)).tolist():
                lang, at, share = rows[i]
                mean = share @ embed[at]
                z = mean @ out
                p = np.exp(z - z.max())
                p /= p.sum()
                p[number[lang]] -= 1.0
                rate = RATE * (1 - steps / total)
                back = out @ p
                out -= rate * np.outer(mean, p)
                # Shares are small; the square root keeps rare subwords learning.
                embed[at] -= (rate * 10) * np.sqrt(share)[:, None] * back
                steps += 1
        self.logits = (embed @ out).astype(np.float32)
        self.temperature, self.least = self._calibrated(validation or rows, number)

    def _calibrated(self, rows: list, number: dict[str, int]) -> tuple[float, float]:
        rows = [r for r in rows if r[0] in number]
        if not rows:
            return 1.0, 0.0
        z = np.array([share @ self.logits[at] for _, at, share in rows], float)
        y = np.array([number[lang] for lang, _, _ in rows])

        def loss(t: float) -> float:
            s = z / t
            s = s - s.max(axis=1, keepdims=True)
            return float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]))

        t = min((float(x) for x in np.geomspace(0.05, 5, 41)), key=loss)
        s = np.exp((z - z.max(axis=1, keepdims=True)) / t)
        p = (s / s.sum(axis=1, keepdims=True)).max(axis=1)
        right = np.sort(p[z.argmax(axis=1) == y])
        return t, float(right[int((1 - RIGHT_KEPT) * len(right))]) if len(right) else 0.0

    def predict(self, text: bytes | None) -> tuple[str, float]:
        b = buckets(text)
        if b is None:
            return NO_LANGUAGE, 0.0
        z = np.bincount(b, minlength=BUCKETS).astype(np.float32) @ self.logits if len(b) > BUCKETS else self.logits[b].sum(axis=0)
        z = z.astype(float) / max(1, len(b)) / self.temperature
        p = np.exp(z - z.max())
        best = int(z.argmax())
        return self.names[best], float(p[best] / p.sum())


def train(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE) -> Model | None:
    """Model learnt from text and lang of docs; at most per_language documents of each language
    come to the driver, as bucket counts. One in five of them calibrates. None without labelled text."""
    order = ["__mark", "doc_id"]
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"), F.xxhash64("doc_id").alias("__mark"),
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    sizes = known.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    # Hashes are even, so the lowest of a language lie in the share of all hashes that holds SPARE times as many. Only
    # those are ranked, however many documents the language has.
    shares = [(r.lang, min(1.0, SPARE * per_language / max(1, r.n))) for r in sizes]
    shares = F.broadcast(docs.sparkSession.createDataFrame(shares, "of string, share double"))  # at most MAX_LANGUAGES rows
    low = (F.col("__mark").cast("double") / 2.0**64 + 0.5) <= F.col("share")
    ids = known.select("doc_id", "lang", "__mark").join(shares, F.col("lang") == F.col("of")).where(low)
    ids = ids.select("doc_id", "lang", "__mark").distinct().withColumn("place", rank).where(F.col("place") <= per_language)
    ids = ids.select("doc_id").distinct()
    chosen = (
        known.join(F.broadcast(ids), "doc_id", "left_semi")  # bounded by per_language for each language
        .withColumn("place", rank)
        .where(F.col("place") <= per_language)
        .select("lang", "place", "text")
    )
    rows, validation = [], []
    for r in sorted(mapped(chosen, _counted, "lang string, place int, at binary, weight binary").collect(), key=lambda r: (r.lang, r.place)):
        weight = np.frombuffer(r.weight, np.float32)
        if len(weight):
            row = (r.lang, np.frombuffer(r.at, np.uint16).astype(np.int64), weight / weight.sum())
            (validation if r.place % 5 == 0 else rows).append(row)
    if not rows:
        rows, validation = validation, []
    return Model(rows, validation) if rows else None


def identified(docs: DataFrame, training: DataFrame) -> DataFrame:
    """doc_id, lang_pred, score, rejected for each row of docs (doc_id, text).

    score is the calibrated probability of lang_pred over the whole text; rejected marks `und` and
    scores under the calibrated bound. Null, empty and letterless texts are `und` with score 0, as is
    everything if training holds no labelled text. Ties go to the language that sorts first. Repeated
    rows are predicted alike; an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    model = train(training)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [model.predict(t) if model else (NO_LANGUAGE, 0.0) for t in texts_of(batch.column(1))]
        least = model.least if model else 0.0
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                pa.array([f[0] == NO_LANGUAGE or f[1] < least for f in found], pa.bool_()),
            ],
            ["doc_id", "lang_pred", "score", "rejected"],
        )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return mapped(rows, run, "doc_id bigint, lang_pred string, score double, rejected boolean")


def held_out():
    """Rows that training never sees."""
    divisor, rest = HELD_OUT
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % divisor == rest, F.lit(False))
