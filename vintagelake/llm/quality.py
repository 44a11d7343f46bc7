"""Quality rules judged by an isolation forest.

Every text gets a few rule statistics. A forest of random splits, filled with all good
labelled rows, measures how soon a document stands alone: short paths mean odd statistics.
Ranges, rule weights, the rows in each node and the score above which a document is
rejected come from every labelled row, by grouped sums; none of these rows is gathered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintagelake.llm.common import ByteHash, cut, mapped, mix, prepare, texts_of

MIN_WORDS = 50
REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"

TREES = 128
TREE_DEPTH = 10
# Share of good labelled rows that the threshold may reject.
GOOD_LOST = 0.002

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RULES = [
    "symbol_rate", "upper_rate", "mark_rate", "digit_rate", "dup_line_rate", "repeat_rate", "same_next_rate",
    "word_length",
]


def base_counts(text: bytes | None, hasher: ByteHash) -> tuple[list[int], list[float]]:
    """The five base counts and the rule statistics of one text."""
    words = text.split() if text else []
    n = len(words)
    if not n:
        return [0, 0, sum(text.count(c) for c in SYMBOLS) if text else 0, 0, 0], [0.0] * len(RULES)
    joined = b" ".join(words)
    raw = np.frombuffer(joined, np.uint8)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    chars = int(np.count_nonzero((raw & 0xC0) != 0x80)) - (n - 1)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split(b"\n") if x.strip()]
    dup_lines = len(lines) - len(set(lines))
    ids = hasher(joined, starts, ends)
    covered = 0
    if n > 2:
        with np.errstate(over="ignore"):
            triples = mix(mix(ids[:-2] * np.uint64(3) + ids[1:-1]) * np.uint64(5) + ids[2:])
        _, place, count = np.unique(triples, return_inverse=True, return_counts=True)
        again = count[place] > 1
        mask = np.zeros(n, bool)
        for k in range(3):
            mask[k : n - 2 + k] |= again
        covered = int(mask.sum())
    counts = np.bincount(raw, minlength=256)
    upper, digits = int(counts[65:91].sum()), int(counts[48:58].sum())
    marks = int(counts[[33, 63]].sum())
    lead = raw[np.minimum(starts, len(raw) - 1)]
    shouted = int(np.count_nonzero((lead >= 65) & (lead <= 90)))
    return [n, chars, symbols, dup_lines, covered], [
        symbols / chars, max(0, upper - shouted) / chars, marks / n, digits / chars, dup_lines / max(1, len(lines)),
        covered / n, float(np.mean(ids[1:] == ids[:-1])) if n > 1 else 0.0, min(chars / n, 50.0),
    ]


COUNTED = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in BASE)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts and `rules` (array in the order of RULES) of each whole text; null counts as empty."""
    hasher = ByteHash()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [base_counts(t, hasher) for t in texts_of(batch.column(1))]
        columns = [pa.array([f[0][k] for f in found], pa.int64()) for k in range(len(BASE))]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *columns, pa.array([f[1] for f in found], pa.list_(pa.float64()))],
            ["doc_id", *BASE, "rules"],
        )

    return mapped(_texts(docs), run, f"{COUNTED}, rules array<double>")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _mean_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth at which a row of n stands alone in a random tree."""
    n = np.maximum(np.asarray(n, float), 1.0)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / n, n - 1)


def rule_weights(rows: np.ndarray, good: np.ndarray) -> np.ndarray:
    """How often each rule is drawn for a split: by how well it alone orders good and bad labelled rows."""
    weights = np.zeros(rows.shape[1])
    for k in range(rows.shape[1]):
        fine, poor = np.sort(rows[good, k]), rows[~good, k]
        if len(poor):
            under = (np.searchsorted(fine, poor, "left") + np.searchsorted(fine, poor, "right")) / 2 / len(fine)
            weights[k] = (2 * under.mean() - 1) ** 2
    return weights / weights.sum() if weights.sum() > 0 else np.full(rows.shape[1], 1 / rows.shape[1])


class Forest:
    """Isolation trees of random splits, complete to `depth`; `filled` gives each leaf its path length.

    Splits are drawn over a node's part of the range that all labelled rows span, so a rule that
    never varies among good rows can still set others apart; what falls beside all good rows has a short path.
    They don't depend on the rows in a node, so rows are counted in the leaves of the drawn trees afterwards.
    """

    def __init__(
        self, low: np.ndarray, high: np.ndarray, weights: np.ndarray, trees: int = TREES, depth: int = TREE_DEPTH,
        seed: int = 17,
    ):
        rng = np.random.default_rng(seed)
        self.depth, self.weights = depth, weights
        self.rule: list[np.ndarray] = []  # of each level: trees x nodes
        self.split: list[np.ndarray] = []
        self.closed: list[np.ndarray] = []  # nothing left to split
        low, high = (np.broadcast_to(np.asarray(x, float), (trees, 1, len(weights))) for x in (low, high))
        for _ in range(depth):
            chance = np.cumsum(np.where(high > low, weights, 0.0), axis=2)
            drawn = rng.uniform(size=chance.shape[:2]) * chance[:, :, -1]
            rule = np.minimum((chance <= drawn[:, :, None]).sum(axis=2), len(weights) - 1)
            at = rule[:, :, None]
            split = rng.uniform(np.take_along_axis(low, at, 2), np.take_along_axis(high, at, 2))
            under, over = high.copy(), low.copy()
            np.put_along_axis(under, at, split, 2)
            np.put_along_axis(over, at, split, 2)
            self.rule.append(rule)
            self.split.append(split[:, :, 0])
            self.closed.append(chance[:, :, -1] == 0)
            low, high = (
                np.stack(pair, axis=2).reshape(trees, -1, len(weights)) for pair in ((low, over), (under, high))
            )
        self.path = np.zeros((trees, 2**depth))
        self.usual = 0.0

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree, numbered through all trees."""
        tree = np.arange(len(self.path))
        at = np.zeros((len(rows), len(tree)), np.int64)
        for rule, split in zip(self.rule, self.split, strict=True):
            value = np.take_along_axis(rows, rule[tree, at], axis=1)
            at = 2 * at + (value >= split[tree, at])
        return at + tree * 2**self.depth

    def filled(self, counts: np.ndarray) -> Forest:
        """Path lengths from the number of good rows in each leaf: a path ends where fewer than two rows are left."""
        inside = counts.reshape(self.path.shape)
        self.usual = float(_mean_path(inside[0].sum()))
        self.path = self.depth + _mean_path(inside)
        for level in range(self.depth - 1, -1, -1):
            inside = inside[:, 0::2] + inside[:, 1::2]
            ends = np.repeat((inside < 2) | self.closed[level], 2 ** (self.depth - level), axis=1)
            here = np.repeat(level + _mean_path(inside), 2 ** (self.depth - level), axis=1)
            self.path = np.where(ends, here, self.path)
        return self

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1: 2 ** -(mean path / usual path)."""
        return 2.0 ** (-self.path.ravel()[self.leaves(rows)].mean(axis=1) / max(self.usual, 1e-9))


def grown(rows: np.ndarray, good: np.ndarray) -> Forest:
    """The forest of rows at hand."""
    forest = Forest(rows.min(axis=0), rows.max(axis=0), rule_weights(rows, good))
    return forest.filled(np.bincount(forest.leaves(rows[good]).ravel(), minlength=forest.path.size))


def _ranked(values: DataFrame) -> DataFrame:
    """rule, value, fine, poor (rows of a value, good and not), fine_under, poor_under: those of smaller values of the rule.

    Values are dealt by ranges over tasks; only the totals of a range go through one window.
    """
    counts = values.groupBy("rule", "value").agg(F.count_if("good").alias("fine"), F.count_if(~F.col("good")).alias("poor"))
    dealt = cut(counts.repartitionByRange("rule", "value").withColumn("part", F.spark_partition_id()))
    kinds = ("fine", "poor")
    parts = Window.partitionBy("rule").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        dealt.groupBy("rule", "part").agg(*[F.sum(k).alias(k) for k in kinds])
        .select("rule", "part", *[F.coalesce(F.sum(k).over(parts), F.lit(0)).alias(f"{k}_before") for k in kinds])
    )
    rows = Window.partitionBy("rule", "part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    return dealt.join(before, ["rule", "part"]).select(
        "rule", "value", *kinds,
        *[(F.col(f"{k}_before") + F.coalesce(F.sum(k).over(rows), F.lit(0))).alias(f"{k}_under") for k in kinds],
    )


def _weights(known: DataFrame, fine: int, poor: int) -> np.ndarray:
    """rule_weights of all rows of known, from the ranks of its values."""
    weights = np.zeros(len(RULES))
    if poor:
        ranks = _ranked(known.select("good", F.posexplode("rules").alias("rule", "value")))
        under = ranks.groupBy("rule").agg(F.sum(F.col("poor") * (2 * F.col("fine_under") + F.col("fine"))).alias("twice"))
        for r in under.collect():  # one row for each rule
            weights[r.rule] = (r.twice / fine / poor - 1) ** 2
    return weights / weights.sum() if weights.sum() > 0 else np.full(len(RULES), 1 / len(RULES))


def _counted(known: DataFrame, forest: Forest) -> np.ndarray:
    """Number of good rows in each leaf; a task sends each leaf once."""
    width, size = len(RULES), forest.path.size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            counts += np.bincount(forest.leaves(_rules_of(batch.column(0), width)).ravel(), minlength=size)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["leaf", "n"])

    found = known.where("good").select("rules").mapInArrow(run, "leaf bigint, n bigint")
    table = found.groupBy("leaf").agg(F.sum("n").alias("n")).toArrow()  # at most trees x leaves
    counts = np.zeros(size, np.int64)
    counts[table["leaf"].to_numpy()] = table["n"].to_numpy()
    return counts


def _rules_of(column: pa.Array, width: int = len(RULES)) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def threshold(scores: DataFrame, lost: float = GOOD_LOST) -> float | None:
    """The score above which rows (score, good) are rejected: of those that lose at most `lost` of the good rows,
    the one with the best balance of bad rows caught against good rows lost. None without both kinds."""
    totals = scores.agg(F.count_if("good").alias("fine"), F.count_if(~F.col("good")).alias("poor")).first()
    if not totals.fine or not totals.poor:
        return None
    ranks = _ranked(scores.select("good", F.lit(0).alias("rule"), F.col("score").alias("value")))
    over = {k: 1 - (F.col(f"{k}_under") + F.col(k)) / F.lit(totals[k]) for k in ("fine", "poor")}
    best = (
        ranks.where(over["fine"] <= lost).select("value", (over["poor"] - over["fine"]).alias("gain"))
        .orderBy(F.col("gain").desc(), "value").first()
    )
    # Halfway to the next rejected row, so that rows just like the kept ones stay.
    above = scores.where(F.col("score") > best.value).agg(F.min("score").alias("s")).first().s
    return best.value if above is None else (best.value + above) / 2


def fit(counted: DataFrame, labels: DataFrame) -> tuple[Forest, float] | None:
    """Forest and threshold from all labelled documents that pass the base rules; None if labels can't calibrate it.

    counted: `statistics` of the documents. Documents labelled both good and bad are left out. The driver
    sees ranges, weights and the number of rows in each leaf.
    """
    marks = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .where("quality = other")
        .select("doc_id", (F.col("quality") > 0).alias("good"))
    )
    known = cut(
        counted.where(f"n_words >= {MIN_WORDS} AND 100 * n_repeat_words <= {REPEAT_PERCENT} * n_words")
        .join(marks, "doc_id")
        .groupBy("doc_id", "good")
        .agg(F.min("rules").alias("rules"))
    )
    ends = [f(F.col("rules")[k]).alias(f"{n}{k}") for n, f in (("low", F.min), ("high", F.max)) for k in range(len(RULES))]
    span = known.agg(F.count_if("good").alias("fine"), F.count_if(~F.col("good")).alias("poor"), *ends).first()
    if not span.fine:
        return None
    low, high = (np.array([span[f"{n}{k}"] for k in range(len(RULES))]) for n in ("low", "high"))
    forest = Forest(low, high, _weights(known, span.fine, span.poor))
    forest.filled(_counted(known, forest))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(forest.score(_rules_of(batch.column(0)))), batch.column(1)], ["score", "good"]
        )

    at = threshold(cut(mapped(known.select("rules", "good"), run, "score double, good boolean")))
    return None if at is None else (forest, at)


def _verdicts(counts: np.ndarray, rules: np.ndarray, model: tuple[Forest, float] | None):
    """Base failures, verdicts and scores of a batch."""
    failed = (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > REPEAT_PERCENT * counts[:, 0])
    score = model[0].score(rules) if model else None
    return failed, ~failed & (score <= model[1] if model else True), score


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, score.

    kept is false where a base rule fails or the forest's score is above the threshold. Null, empty
    and blank texts have no words and fail. Without labels of both kinds the forest rejects
    nothing (score null). Rows that repeat are judged alike; an empty table gives an empty result.
    Texts are read once: their statistics are stored in the checkpoint folder.
    """
    prepare(docs.sparkSession)
    counted = cut(statistics(docs))
    model = fit(counted, labels)
    place = [counted.columns.index(c) for c in BASE]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in place], axis=1)
        failed, kept, score = _verdicts(counts, _rules_of(batch.column(batch.num_columns - 1)), model)
        return pa.RecordBatch.from_arrays(
            [
                *batch.columns[:-1], pa.array(failed), pa.array(kept),
                pa.array(score if model else [None] * batch.num_rows, pa.float64()),
            ],
            ["doc_id", *BASE, "base_failed", "kept", "score"],
        )

    return mapped(counted, run, f"{COUNTED}, base_failed boolean, kept boolean, score double")


def filtered(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of docs that are kept, with all their columns unchanged."""
    prepare(docs.sparkSession)
    model = fit(cut(statistics(docs)), labels)
    hasher = ByteHash()
    place = docs.columns.index("text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [base_counts(t, hasher) for t in texts_of(batch.column(place))]
        counts, rules = (np.array([f[k] for f in found]) for k in range(2))
        return batch.filter(pa.array(_verdicts(counts, rules, model)[1]))

    return mapped(docs, run, docs.schema)
