"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages, and only the bag has a label. Every passage is encoded by one dense layer over its byte,
byte-pair and repetition statistics. A gate, tanh(V h) * sigmoid(U h), gives each passage its attention weight, and the
weighted mean of the encodings is scored. Attention logits are bounded (both factors are below 1), so numerator
and denominator of the mean are plain sums over passages: a text of any length is read piece by piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintagelake.llm.common import ByteHash, mapped, mix, prepare, texts_of

PASSAGE_WORDS = 48
# Texts are read in pieces of this many bytes; passages do not run across them.
PIECE_BYTES = 1 << 20
# Labelled documents that the model is fitted on, at most: the lowest hashes of doc_id. One in five of them calibrates it.
LABELLED_DOCS = 4_000
# Passages of a document that fitting looks at, at most: the lowest hashes of their place. Scoring reads all.
FITTED_PASSAGES = 32
PAIRS = 128
WIDTH = 24
GATE = 12
EPOCHS = 30
BAGS_A_STEP = 32
RATE = 3e-3
DECAY = 1e-4
THRESHOLD = 0.3
HELD_OUT = (5, 0)

# Bytes below 128 stand for themselves, other bytes begin or go on with a character.
KIND = np.concatenate((np.arange(128), np.full(64, 128), np.full(64, 129))).astype(np.int64)
KINDS = 130
FEATURES = KINDS + PAIRS + 4
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PAIR = (mix(np.arange(1 << 16, dtype=np.uint64) + np.uint64(1)) % np.uint64(PAIRS)).astype(np.int64)


def encoded(pieces: list[bytes], hasher: ByteHash) -> tuple[np.ndarray, np.ndarray]:
    """Statistics of every passage of the pieces, and the number of the piece each one belongs to.

    A passage is up to PASSAGE_WORDS words and the white space after them; what a piece has before its first
    word belongs to its first passage, and a piece without a word is one passage.
    """
    raw = b" ".join([*pieces, b""])
    buf = np.frombuffer(raw, np.uint8)
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1
    ends = np.cumsum(lengths)
    space = _SPACE[buf]
    first = ~space
    first[1:] &= space[:-1]
    starts = np.flatnonzero(first)
    last = ~space[:-1] & space[1:]
    stops = np.flatnonzero(last) + 1
    piece_of_word = np.searchsorted(ends, starts, side="right")
    words = np.bincount(piece_of_word, minlength=len(pieces))
    before = np.concatenate(([0], np.cumsum(words)[:-1]))
    passages = np.maximum(1, -(-words // PASSAGE_WORDS))
    base = np.concatenate(([0], np.cumsum(passages)[:-1]))
    n = int(passages.sum())
    of_word = base[piece_of_word] + (np.arange(len(starts)) - before[piece_of_word]) // PASSAGE_WORDS

    # Each byte belongs to the passage of the last word begun in its piece, or to the piece's first one.
    step = np.zeros(len(buf), np.int64)
    begin = np.concatenate(([0], ends[:-1]))
    step[begin[1:]] = np.diff(base)
    new = np.flatnonzero(np.diff(of_word, prepend=-1)) if len(of_word) else np.empty(0, np.int64)
    new = new[of_word[new] > base[piece_of_word[new]]]
    late = np.bincount(piece_of_word[new], minlength=len(pieces))
    step[starts[new]] += 1
    step[begin[1:]] -= late[:-1]
    at = np.cumsum(step)

    out = np.zeros((n, FEATURES), np.float32)
    total = np.maximum(1, np.bincount(at, minlength=n)).astype(np.float32)[:, None]
    out[:, :KINDS] = np.bincount(at * KINDS + KIND[buf], minlength=n * KINDS).reshape(n, KINDS)
    inside = np.ones(len(buf) - 1, bool)
    inside[ends[:-1] - 1] = False  # no pair runs from one piece into the next
    pair = _PAIR[buf[:-1][inside].astype(np.int64) * 256 + buf[1:][inside]]
    out[:, KINDS : KINDS + PAIRS] = np.bincount(at[:-1][inside] * PAIRS + pair, minlength=n * PAIRS).reshape(n, PAIRS)
    out[:, : KINDS + PAIRS] = np.sqrt(out[:, : KINDS + PAIRS] / total)

    if len(starts):
        words = np.bincount(of_word, minlength=n)
        count = np.maximum(1, words)
        ids = hasher(raw, starts, stops)
        same = (ids[1:] == ids[:-1]) & (of_word[1:] == of_word[:-1])
        with np.errstate(over="ignore"):
            in_passage = mix(ids + mix(of_word.astype(np.uint64)))
        _, one = np.unique(in_passage, return_index=True)
        out[:, -4] = np.bincount(of_word[1:][same], minlength=n) / count
        out[:, -3] = (words - np.bincount(of_word[one], minlength=n)) / count
        out[:, -2] = np.log1p(np.bincount(of_word, weights=stops - starts, minlength=n) / count) / 5
        out[:, -1] = words / PASSAGE_WORDS
    return out, np.repeat(np.arange(len(pieces)), passages)


def pieces_of(texts: list[bytes | None]) -> Iterator[tuple[list[bytes], list[int]]]:
    """Pieces of texts with the numbers of their texts, about PIECE_BYTES at a time."""
    held, owner, size = [], [], 0
    for i, text in enumerate(texts):
        text = text or b""
        for at in range(0, max(1, len(text)), PIECE_BYTES):
            held.append(text[at : at + PIECE_BYTES])
            owner.append(i)
            size += len(held[-1])
            if size >= PIECE_BYTES:
                yield held, owner
                held, owner, size = [], [], 0
    if held:
        yield held, owner


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    """Encoder, gated attention and score, fitted by Adam on the documents' labels, then calibrated."""

    def __init__(self, bags: list[np.ndarray], labels: np.ndarray, validation: list[np.ndarray], known: np.ndarray, seed: int = 31):
        rng = np.random.default_rng(seed)
        n = sum(map(len, bags))
        self.mean = np.sum([b.sum(axis=0, dtype=float) for b in bags], axis=0) / n
        self.spread = np.sqrt(np.sum([((b - self.mean) ** 2).sum(axis=0) for b in bags], axis=0) / n) + 0.02
        shapes = {"W": (FEATURES, WIDTH), "b": (WIDTH,), "V": (WIDTH, GATE), "U": (WIDTH, GATE), "w": (GATE,), "c": (WIDTH,), "d": (1,)}
        self.p = {
            k: (rng.normal(0, 1 / np.sqrt(s[0]), s) if len(s) > 1 or k in "wc" else np.zeros(s)).astype(np.float32)
            for k, s in shapes.items()
        }
        self.scale, self.shift = 1.0, 0.0
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        bags = [((b - self.mean) / self.spread).astype(np.float32) for b in bags]
        t, steps = 0, EPOCHS * -(-len(bags) // BAGS_A_STEP)
        for _ in range(EPOCHS):
            order = rng.permutation(len(bags))
            for lo in range(0, len(order), BAGS_A_STEP):
                chosen = order[lo : lo + BAGS_A_STEP]
                t += 1
                rate = RATE * (1 - (t - 1) / steps)
                for k, g in self._gradient([bags[i] for i in chosen], labels[chosen]).items():
                    m, v = moments[k]
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    self.p[k] -= rate * (m / (1 - 0.9**t) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8) + DECAY * self.p[k])
        if len(known) and 0 < known.sum() < len(known):
            self._calibrate(np.array([self.logit(b) for b in validation]), known)

    def _forward(self, x: np.ndarray):
        h = np.tanh(x @ self.p["W"] + self.p["b"])
        tanh, gate = np.tanh(h @ self.p["V"]), _sigmoid(h @ self.p["U"])
        return h, tanh, gate, np.exp((tanh * gate) @ self.p["w"])

    def _gradient(self, bags: list[np.ndarray], y: np.ndarray) -> dict[str, np.ndarray]:
        """Mean gradient of the log loss over some bags."""
        p, x = self.p, np.concatenate(bags)
        sizes = np.array([len(b) for b in bags])
        heads = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        of = np.repeat(np.arange(len(bags)), sizes)
        h, tanh, gate, e = self._forward(x)
        a = e / np.add.reduceat(e, heads)[of]
        z = np.add.reduceat(a[:, None] * h, heads, axis=0)
        wrong = (_sigmoid(z @ p["c"] + p["d"]) - y) / len(bags)
        dz = wrong[:, None] * p["c"]
        da = (h * dz[of]).sum(axis=1)
        ds = a * (da - np.add.reduceat(a * da, heads)[of])
        dtanh = ds[:, None] * p["w"] * gate * (1 - tanh**2)
        dgate = ds[:, None] * p["w"] * tanh * gate * (1 - gate)
        dh = (a[:, None] * dz[of] + dtanh @ p["V"].T + dgate @ p["U"].T) * (1 - h**2)
        return {
            "W": x.T @ dh, "b": dh.sum(axis=0), "V": h.T @ dtanh, "U": h.T @ dgate, "w": (tanh * gate).T @ ds,
            "c": z.T @ wrong, "d": np.array([wrong.sum()]),
        }

    def _calibrate(self, logits: np.ndarray, y: np.ndarray) -> None:
        """Slope and shift that fit the validation labels best, by Newton steps; a little weight keeps them finite."""
        x, theta = np.stack((logits, np.ones_like(logits)), axis=1), np.array([1.0, 0.0])
        prior = np.diag([1.0, 0.1])
        for _ in range(30):
            q = _sigmoid(x @ theta)
            g = x.T @ (q - y) + prior @ (theta - [1.0, 0.0])
            theta = theta - np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + prior, g)
        if np.isfinite(theta).all() and theta[0] > 0:
            self.scale, self.shift = float(theta[0]), float(theta[1])

    def logit(self, bag: np.ndarray) -> float:
        h, _, _, e = self._forward(((bag - self.mean) / self.spread).astype(np.float32))
        return float((e @ h) / e.sum() @ self.p["c"] + self.p["d"][0])

    def scores(self, texts: list[bytes | None], hasher: ByteHash) -> tuple[np.ndarray, np.ndarray]:
        """Score of each whole text and the largest share of attention that one of its passages holds."""
        top, whole, most = np.zeros((len(texts), WIDTH)), np.zeros(len(texts)), np.zeros(len(texts))
        for held, owner in pieces_of(texts):
            x, of = encoded(held, hasher)
            h, _, _, e = self._forward(((x - self.mean) / self.spread).astype(np.float32))
            at = np.asarray(owner)[of]
            np.add.at(top, at, e[:, None] * h)
            np.add.at(whole, at, e)
            np.maximum.at(most, at, e)
        logits = top / whole[:, None] @ self.p["c"] + self.p["d"][0]
        # Products of different shapes may differ in the last bits.
        return np.round(_sigmoid(self.scale * logits + self.shift), 6), np.round(most / whole, 6)


def _bags(batch: pa.RecordBatch, hasher: ByteHash) -> pa.RecordBatch:
    """At most FITTED_PASSAGES passages of each document, as bytes."""
    out = []
    for text in texts_of(batch.column("text")):
        kept, n = [], 0
        for held, _ in pieces_of([text]):
            x, _ = encoded(held, hasher)
            mark = mix(np.arange(n, n + len(x), dtype=np.uint64) + np.uint64(1))
            n += len(x)
            kept.append((mark, x))
            if len(kept) > 1 or len(x) > FITTED_PASSAGES:
                mark, x = np.concatenate([m for m, _ in kept]), np.concatenate([v for _, v in kept])
                best = np.sort(np.argsort(mark)[:FITTED_PASSAGES])
                kept = [(mark[best], x[best])]
        out.append(kept[0][1].astype(np.float16).tobytes())
    return pa.RecordBatch.from_arrays(
        [batch.column("place"), batch.column("quality"), pa.array(out, pa.binary())], ["place", "quality", "bag"]
    )


def held_out(divisor: int = HELD_OUT[0], rest: int = HELD_OUT[1]) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % divisor == rest, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, most: int = LABELLED_DOCS) -> Model | None:
    """Model from the labelled documents that are not held out; None if they don't hold both labels.

    At most `most` labelled documents count, and of each at most FITTED_PASSAGES passages come to the driver.
    Documents labelled both ways count for nothing; of an id with several texts the first in order counts.
    """
    sample = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .where((F.col("quality") == F.col("other")) & ~held_out())
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        .select("doc_id", (F.col("quality") > 0).cast("int").alias("quality"))
    )
    known = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hasher = ByteHash()
    chosen = (
        known.join(F.broadcast(sample), "doc_id")  # bounded by `most`
        .groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
        .select(F.xxhash64("doc_id").alias("place"), "quality", "text")
    )
    rows = mapped(chosen, lambda b: _bags(b, hasher), "place bigint, quality int, bag binary").collect()
    rows.sort(key=lambda r: (r.place, r.bag))
    bags = [np.frombuffer(r.bag, np.float16).reshape(-1, FEATURES).astype(np.float32) for r in rows]
    y = np.array([r.quality for r in rows], np.float32)
    if not len(y) or y.min() == y.max():
        return None
    part = np.arange(len(y)) % 5 == 4
    if y[~part].min() == y[~part].max():
        part[:] = False
    return Model(
        [b for b, v in zip(bags, part, strict=True) if not v], y[~part], [b for b, v in zip(bags, part, strict=True) if v], y[part]
    )


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, attention for each row of docs (doc_id, text).

    score (0 to 1) is the calibrated chance of label 1 over the whole text, predicted is 1 from THRESHOLD up, attention is the
    largest share of the weight that one passage holds. Null, empty and blank texts are one passage without words and are
    scored like any other. Without labels of both kinds nothing can be learnt: every score is 0.5. Repeated rows
    are scored alike; rows with a null id are not held out. An empty table gives an empty result. labels may
    hold nulls, repeated and contradicting rows: these count for nothing or once.
    """
    prepare(docs.sparkSession)
    model = fit(docs, labels)
    hasher = ByteHash()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = texts_of(batch.column(2))
        score, most = model.scores(texts, hasher) if model else (np.full(len(texts), 0.5), np.zeros(len(texts)))
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1), pa.array(score, pa.float64()), pa.array((score >= THRESHOLD).astype(np.int32)),
                pa.array(most, pa.float64()),
            ],
            ["doc_id", "held_out", "score", "predicted", "attention"],
        )

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text")
    )
    return mapped(rows, run, "doc_id bigint, held_out boolean, score double, predicted int, attention double")
