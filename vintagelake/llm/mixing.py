"""Mixing sources to target weights by balanced sampling with the cube method.

A source whose target is r times its size takes every document floor(r) times, and one more time
with probability pi = r - floor(r). The cube method draws these so that words and documents
keep their totals: three undecided documents at a time move along the null space of the two
constraints until one of them is decided. Randomised groups of a source do this side by
side; what they leave undecided (a few documents each) meets in fewer groups, until a
source has one group, where a few documents land on the choice nearest to the totals.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintagelake.llm.common import cut, mapped, prepare, texts_of, words_of

WEIGHTS = (1, 2, 3)
MOST = 3  # times a source, and so a document, may be taken
GROUP = 1024  # documents that one flight decides, on average
LANDING = 12  # documents, over all sizes, that a flight leaves for the landing
# Sources are a dimension: their totals come to the driver. More than these are refused.
MAX_SOURCES = 100_000
SEED = 29
_EPS = 1e-9


def targets(sizes: dict[str | None, int], weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> dict[str | None, float]:
    """Words to take of each source. Sources by code point, null last, get the weights in turn; what a
    source can't hold (more than `most` times its size) is shared by weight among the others."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, found = float(sum(sizes.values())), list(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total > most * sizes[s]]
        if not full:
            return found | {s: left * weight[s] / total for s in open_}
        for s in full:
            found[s] = float(most * sizes[s])
        left -= sum(found[s] for s in full)
        open_ = [s for s in open_ if s not in found]
    return found


def flight(sizes: list[float], x: list[float], rng: np.random.Generator, land: bool) -> list[float]:
    """Move the inclusion probabilities to 0 or 1 while the sums of x and of size * x hold.

    A few documents are held back, and two at most of the others stay undecided. With `land` all of
    these are decided as landed() says.
    """
    x = [0.0 if p < _EPS else 1.0 if p > 1 - _EPS else p for p in x]
    waiting = [i for i, p in enumerate(x) if 0 < p < 1]
    held = {waiting[int(q)] for q in np.linspace(0, len(waiting) - 1, LANDING)} if waiting else set()
    flown = [i for i in waiting if i not in held]
    draws = iter(rng.random(len(flown) + 3).tolist())
    active = flown[:3]
    k = len(active)
    while len(active) == 3:
        a, b, c = (sizes[i] for i in active)
        u = [b - c, c - a, a - b]
        scale = max(map(abs, u))
        u = [d / scale for d in u] if scale else [1.0, -1.0, 0.0]
        up = down = math.inf
        for i, d in zip(active, u, strict=True):
            if d > 0:
                up, down = min(up, (1 - x[i]) / d), min(down, x[i] / d)
            elif d < 0:
                up, down = min(up, -x[i] / d), min(down, (x[i] - 1) / d)
        step = up if next(draws) * (up + down) < down else -down
        for i, d in zip(active, u, strict=True):
            p = x[i] + step * d
            x[i] = 0.0 if p < _EPS else 1.0 if p > 1 - _EPS else p
        active = [i for i in active if 0 < x[i] < 1]
        while len(active) < 3 and k < len(flown):
            active.append(flown[k])
            k += 1
    if land:
        left = [i for i in waiting if 0 < x[i] < 1]
        for i, p in zip(left, landed([sizes[i] for i in left], [x[i] for i in left]), strict=True):
            x[i] = p
    return x


def landed(sizes: list[float], x: list[float]) -> list[float]:
    """0 or 1 for each of a few documents: the choice whose words, then whose number, come nearest to x's."""
    n = len(x)
    choice = (np.arange(1 << n)[:, None] >> np.arange(n)) & 1
    words = np.abs(choice @ np.array(sizes, float) - np.dot(sizes, x)) if n else np.zeros(1)
    number = np.abs(choice.sum(axis=1) - sum(x))
    return choice[np.lexsort((number, np.round(words, 6)))[0]].astype(float).tolist()


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words), mark (hash of text) of each row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes = [len(words_of(t)) for t in texts_of(batch.column("text"))]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("source"), batch.column("mark"), pa.array(sizes, pa.int64())],
            ["doc_id", "source", "mark", "size"],
        )

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.xxhash64(F.col("text").cast("string")).alias("mark"), F.col("text").cast("string").alias("text"),
    )
    return mapped(rows, run, "doc_id bigint, source string, mark bigint, size bigint")


def _placed(rows: DataFrame) -> DataFrame:
    """Number rows that share a doc_id. Rows that tie are alike in text and source, so any order serves."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("doc_id").orderBy("mark", "source")))


def _flights(rows: DataFrame, groups: dict[str | None, int], level: int) -> DataFrame:
    """One flight in each randomised group of each source; a source in a single group lands."""

    def fly(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        number, group = int(key[0]), int(key[1])
        # Large documents first, so that what stays undecided tends to be small.
        pdf = pdf.sort_values(
            ["size", "turn", "doc_id", "place"], ascending=[False, True, True, True], kind="stable", na_position="first", ignore_index=True
        )
        rng = np.random.default_rng([SEED, level, number, group])
        pdf["x"] = flight(pdf["size"].astype(float).tolist(), pdf["x"].tolist(), rng, bool(pdf["lands"].iloc[0]))
        return pdf[["doc_id", "place", "number", "size", "x"]]

    many = F.create_map(*[F.lit(v) for pair in groups.items() for v in pair]) if groups else None
    dealt = (
        rows.withColumn("turn", F.xxhash64(F.lit(level), "doc_id", "place"))
        .withColumn("groups", F.element_at(many, F.col("number")) if many is not None else F.lit(1))
        .withColumn("group", F.pmod(F.col("turn"), F.col("groups")))
        .withColumn("lands", F.col("groups") == 1)
    )
    return dealt.groupBy("number", "group").applyInPandas(fly, "doc_id bigint, place int, number int, size bigint, x double")


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, place, source, size, source_size, target, copies, taken for each row of docs (doc_id, text, source).

    copies is how often the mix takes the row, 0 to `most`; taken = copies * size. The sum over
    a source is within one document of its target. Reruns agree. A null source is a source; null, empty
    and blank texts have size 0 and are drawn like others; rows that repeat a doc_id are drawn one by one, told
    apart by place. An empty table gives an empty result.
    """
    spark = prepare(docs.sparkSession)
    rows = cut(_placed(sized(docs)))
    totals = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("rows")).limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    size = {r.source: r["size"] for r in totals}
    target = targets(size, weights, most)
    table = []
    for i, r in enumerate(sorted(totals, key=lambda r: (r.source is None, r.source or ""))):
        ratio = min(float(most), target[r.source] / r["size"]) if r["size"] else 0.0
        whole = int(ratio + _EPS)
        table.append((i, r.source, r["size"], target[r.source], whole, max(0.0, ratio - whole), r["rows"]))
    sources = spark.createDataFrame(
        table, "number int, source string, source_size bigint, target double, whole int, pi double, rows bigint"
    )
    known = F.broadcast(sources.drop("rows"))  # at most MAX_SOURCES rows
    base = rows.join(known, rows.source.eqNullSafe(sources.source)).drop(sources.source)
    undecided = base.where(f"pi >= {_EPS}").select("doc_id", "place", "number", "size", F.col("pi").alias("x"))
    counts = {r[0]: r[6] for r in table if r[5] >= _EPS}
    chosen, level = None, 0
    while counts:
        groups = {n: max(1, -(-c // GROUP)) for n, c in counts.items()}
        flown = cut(_flights(undecided, groups, level))
        taken = flown.where("x = 1").select("doc_id", "place")
        chosen = taken if chosen is None else chosen.union(taken)
        undecided = flown.where("x > 0 AND x < 1")
        counts = {r[0]: r[1] for r in undecided.groupBy("number").count().collect()}
        level += 1
    if chosen is None:
        chosen = rows.select("doc_id", "place").limit(0)
    extra = chosen.withColumn("extra", F.lit(1))
    same = base.doc_id.eqNullSafe(extra.doc_id) & (base.place == extra.place)
    copies = F.col("whole") + F.coalesce("extra", F.lit(0))
    return (
        base.join(extra, same, "left").drop(extra.doc_id).drop(extra.place)
        .select(
            "doc_id", "place", "mark", "source", "size", "source_size", "target", copies.alias("copies"),
            (copies * F.col("size")).cast("bigint").alias("taken"),
        )
    )


def remixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Rows of docs as the mix takes them: each row as many times as its copies, all columns unchanged.

    Null, empty and blank texts, repeated rows and null ids are drawn as `mixed` says. An empty table gives an empty result.
    """
    taken = mixed(docs, weights, most).where("copies > 0").select(F.col("doc_id").alias("id"), F.col("place").alias("at"), "copies")
    held = docs.select(F.struct("*").alias("doc"))  # no column of docs can meet those used here
    number = F.col("doc.doc_id").cast("bigint")
    order = Window.partitionBy(number).orderBy(F.xxhash64(F.col("doc.text").cast("string")), F.col("doc.source").cast("string"))
    here = held.withColumn("place", F.row_number().over(order))
    same = number.eqNullSafe(F.col("id")) & (F.col("place") == F.col("at"))
    copy = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return here.join(taken, same).select("doc", copy).select("doc.*")
