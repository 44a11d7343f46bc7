"""Near-duplicate documents by MinHash with tensored banding.

A table key of plain banding costs its own minhashes. Here two small collections of
keys, A and B, are hashed, and every pair (a, b) is a table: 12 x 12 tables come from
48 minhashes instead of 576. A pair of texts with Jaccard similarity s misses all tables
only if it misses all of A or all of B: 2 * (1 - s**2)**12, 1 in 10,000 at s = 0.75.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintagelake.llm.common import ByteHash, cut, mapped, mix, prepare, runs, seeds, texts_of
from vintagelake.llm.components import connected

SHINGLE = 5
COLLECTION = 12  # keys in each of the two collections
PER_KEY = 2  # minhashes in each key
PERCENT = 75
# Shingles in a block of documents that are compared with another block at once, on average.
BLOCK_ITEMS = 1 << 16
# A bucket of a key of A whose small components fill more blocks than this is split by the keys of B.
SPLIT_BLOCKS = 4
# Equal minhashes below which a pair counts as unlike: 4.7 standard deviations under the mean at 75 %.
LEAST_EQUAL = 22

_HASHES = 2 * COLLECTION * PER_KEY


def shingles(text: bytes | None, width: int, hasher: ByteHash) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of one text."""
    words = text.lower().split() if text else []  # bytes.lower touches A-Z only
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = min(width, len(words)) - 1
    return np.unique(hasher(joined, starts[: len(words) - last], ends[last:]))


def minhashes(items: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """One 32-bit minhash per factor, from 64-bit items."""
    low = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(items), 2048):
            np.minimum(low, (factors[:, None] * items[None, i : i + 2048]).min(axis=1), out=low)
    return (mix(low) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _sketch(width: int):
    hasher = ByteHash()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        factors = seeds(_HASHES, 11) | np.uint64(1)
        sizes, ids, signs = [], [], []
        for text in texts_of(batch.column(1)):
            items = shingles(text, width, hasher)
            sizes.append(len(items))
            ids.append(hashlib.blake2b(items.tobytes(), digest_size=16).digest() if len(items) else None)
            signs.append(minhashes(items, factors).tobytes() if len(items) else None)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(signs, pa.binary())],
            ["doc_id", "mark", "n_shingles", "set_id", "sign"],
        )

    return run


def _collection(sign: np.ndarray) -> np.ndarray:
    """Keys of both collections, each mixed from its minhashes (uint64)."""
    part = np.zeros((len(sign), 2 * COLLECTION), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(PER_KEY):
            part = mix(part + sign[:, j::PER_KEY] + seeds(2 * COLLECTION, 100 + j))
    return part


def _table_keys(batch: pa.RecordBatch) -> pa.RecordBatch:
    """A row per document and table: all pairs of an A key and a B key."""
    n = batch.num_rows
    sign = np.frombuffer(b"".join(batch.column("sign").to_pylist()), np.uint32).reshape(n, -1).astype(np.uint64)
    part = _collection(sign)
    a, b = part[:, :COLLECTION], part[:, COLLECTION:]
    with np.errstate(over="ignore"):
        keys = mix(a[:, :, None] * np.uint64(3) + b[:, None, :]).reshape(-1).view(np.int64)
    each = COLLECTION * COLLECTION
    return pa.RecordBatch.from_arrays(
        [
            pa.array(keys),
            pa.array(np.repeat(batch.column("rep").to_numpy(zero_copy_only=False), each)),
            pa.array(np.repeat(batch.column("n").to_numpy(zero_copy_only=False), each)),
        ],
        ["key", "rep", "n"],
    )


def _confirm(width: int, percent: int):
    """Exact test of pairs; rows arrive sorted by a, whose set is kept while it repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ByteHash()
        last, mine = None, None
        for batch in batches:
            good = []
            for a, text_a, text_b in zip(
                batch.column("a").to_pylist(),
                texts_of(batch.column("text_a")),
                texts_of(batch.column("text_b")),
                strict=True,
            ):
                if (a, text_a) != last:
                    last, mine = (a, text_a), shingles(text_a, width, hasher)
                other = shingles(text_b, width, hasher)
                both = len(mine) + len(other)
                common = both - len(np.union1d(mine, other)) if both else 0
                good.append(bool(common) and 100 * common >= percent * (both - common))
            kept = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["u", "v"])
            yield kept.filter(pa.array(good, pa.bool_()))

    return run


def _alike(size_a: str, size_b: str, percent: int):
    """Sets of such sizes can reach the similarity at all."""
    return F.expr(f"100 * least({size_a}, {size_b}) >= {percent} * greatest({size_a}, {size_b})")


def verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(u, v) of the pairs (a, b) whose full shingle sets reach the similarity."""
    texts = docs.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    side_a = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    side_b = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.select("a", "b").join(side_b, "b").join(side_a, "a").select("a", "b", "text_a", "text_b")
    return rows.sortWithinPartitions("a").mapInArrow(_confirm(width, percent), "u bigint, v bigint").distinct()


def _keys_of(sign: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    part = _collection(sign.astype(np.uint64))
    return part[:, :COLLECTION], part[:, COLLECTION:]


def _half_keys(batch: pa.RecordBatch) -> pa.RecordBatch:
    """A row per document and key of the collection A."""
    keys, _ = _keys_of(_signs(batch))
    rest = {c: pa.array(np.repeat(batch.column(c).to_numpy(zero_copy_only=False), COLLECTION)) for c in ("rep", "n", "comp")}
    place = pa.array(np.tile(np.arange(COLLECTION, dtype=np.int32) * COLLECTION, batch.num_rows))
    return pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), place, *rest.values()], ["key", "place", *rest])


def _tables_of(batch: pa.RecordBatch) -> pa.RecordBatch:
    """A row per table of one A key: the key with each key of the collection B."""
    _, second = _keys_of(_signs(batch))
    first = batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64)
    with np.errstate(over="ignore"):
        keys = mix(first[:, None] * np.uint64(3) + second)
    place = batch.column("place").to_numpy(zero_copy_only=False)[:, None] + np.arange(COLLECTION)
    rest = {c: pa.array(np.repeat(batch.column(c).to_numpy(zero_copy_only=False), COLLECTION)) for c in ("rep", "n", "comp")}
    return pa.RecordBatch.from_arrays(
        [pa.array(keys.reshape(-1).view(np.int64)), pa.array(place.reshape(-1).astype(np.int32)), *rest.values()],
        ["key", "place", *rest],
    )


def _candidates(t: pa.Table, sign: np.ndarray, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """A row of one side and its likely partners of the other side, in another component.

    Each pair comes up once: in the first table that the two share.
    """
    comp, n, side = (t[c].to_numpy() for c in ("comp", "n", "side"))
    a, b = divmod(t["place"][0].as_py(), COLLECTION)
    first, second = _keys_of(sign)
    right = np.flatnonzero(side != LEFT)
    for i in np.flatnonzero(side != RIGHT).tolist():
        js = right[comp[right] != comp[i]]
        if side[i] == BOTH:
            js = js[js > i]
        js = js[100 * np.minimum(n[js], n[i]) >= percent * np.maximum(n[js], n[i])]
        js = js[(sign[js] == sign[i]).sum(axis=1) >= LEAST_EQUAL]
        if len(js):
            met = (first[js, :a] == first[i, :a]).any(axis=1) | (second[js, :b] == second[i, :b]).any(axis=1)
            js = js[~met]
        if len(js):
            yield i, js


def _signs(t: pa.Table | pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(t["sign"].to_pylist()), np.uint32).reshape(t.num_rows, -1)


LEFT, RIGHT, BOTH = 0, 1, 2  # sides of a meeting: one block with another, or a block with itself
_MEETING = ["key", "meet"]


def _likely(percent: int):
    """Rows of a block pair that have a likely partner in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, _MEETING):
            used = np.zeros(t.num_rows, bool)
            for i, js in _candidates(t, _signs(t), percent):
                used[i] = True
                used[js] = True
            if used.any():
                yield from t.filter(pa.array(used)).combine_chunks().to_batches()

    return run


def _exact(percent: int):
    """Links inside a block pair, by the full sets of all likely pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, _MEETING):
            rep, size = t["rep"].to_numpy(), t["n"].to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in t["items"].to_pylist()]
            found_a, found_b = [], []
            for i, js in _candidates(t, _signs(t), percent):
                mine = sets[i]
                every = np.concatenate([sets[j] for j in js])
                at = np.minimum(np.searchsorted(mine, every), len(mine) - 1)
                ends = np.cumsum(size[js])
                common = np.diff(np.concatenate(([0], np.cumsum(mine[at] == every)))[np.concatenate(([0], ends))])
                js = js[100 * common >= percent * (size[js] + size[i] - common)]
                found_a += [rep[i]] * len(js)
                found_b += rep[js].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], ["u", "v"])

    return run


def _sets(width: int):
    hasher = ByteHash()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        items = [shingles(t, width, hasher).tobytes() for t in texts_of(batch.column("text"))]
        return pa.RecordBatch.from_arrays(
            [batch.column("rep"), pa.array([len(x) // 8 for x in items], pa.int64()), pa.array(items, pa.binary())],
            ["rep", "n", "items"],
        )

    return run


def _several(members: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component."""
    keys = members.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
    return members.join(keys.select("key"), "key", "left_semi")


def _meetings(members: DataFrame, percent: int) -> DataFrame:
    """key, place, meet, side, rep, n, comp: the members of each bucket in pairs of blocks.

    members: key, place, rep, n, comp. A bucket falls into size classes, of which only equal and adjacent
    ones can be alike; in a class, a component of a block's weight or more is a group of its own and the
    others share one. Groups are dealt into blocks by a hash, so no bucket is gathered, and two groups
    meet only if they hold more than one component between them: a family never meets itself.
    """
    step = max(math.log(100 / percent), 0.01) * 1.000001  # a hair wider, so that rounding can't part two classes
    rows = members.withColumn("size", F.floor(F.log("n") / step).cast("int"))
    owners = (
        rows.groupBy("key", "size", "comp").agg(F.sum("n").alias("weight"))
        .withColumn("own", F.when(F.col("weight") >= BLOCK_ITEMS, F.col("comp")))
    )
    groups = owners.groupBy("key", "size", "own").agg(
        F.ceil(F.sum("weight") / BLOCK_ITEMS).alias("parts"), F.min("comp").alias("lo"), F.max("comp").alias("hi")
    ).withColumn("group", F.xxhash64("key", "size", F.coalesce(F.col("own").cast("string"), F.lit("rest"))))
    groups = cut(groups.drop("own").withColumn("alone", F.col("lo") == F.col("hi")))
    near = groups.withColumn("at", F.explode(F.array("size", F.col("size") + 1)))
    other = groups.select("key", *[F.col(c).alias(f"other_{c}") for c in ("size", "group", "parts", "lo", "alone")])
    pairs = near.join(other, (near.key == other.key) & (F.col("at") == F.col("other_size"))).drop(other.key).where(
        "(size < other_size OR group <= other_group)"
        " AND NOT (alone AND other_alone AND lo = other_lo)"
    )
    same = F.col("group") == F.col("other_group")
    left = pairs.select(
        "key", "group", F.when(same, BOTH).otherwise(LEFT).alias("side"), "parts", F.col("other_group").alias("other"),
        F.col("other_parts").alias("other_parts"),
    )
    right = pairs.where(~same).select(
        "key", F.col("other_group").alias("group"), F.lit(RIGHT).alias("side"), F.col("other_parts").alias("parts"),
        F.col("group").alias("other"), F.col("parts").alias("other_parts"),
    )
    own = owners.where("own IS NOT NULL").select("key", "size", "comp", "own")
    dealt = rows.join(own, ["key", "size", "comp"], "left").select(
        "key", "place", "rep", "n", "comp",
        F.xxhash64("key", "size", F.coalesce(F.col("own").cast("string"), F.lit("rest"))).alias("group"),
    )
    met = (
        dealt.join(left.union(right), ["key", "group"])
        .withColumn("part", F.pmod(F.xxhash64("rep", "n"), F.col("parts")))
        .withColumn("other_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("other_parts") - 1)))
        # Inside one group a block meets itself once, and another block from one side each.
        .withColumn(
            "side",
            F.when((F.col("side") != BOTH) | (F.col("part") == F.col("other_part")), F.col("side"))
            .otherwise(F.when(F.col("part") < F.col("other_part"), LEFT).otherwise(RIGHT)),
        )
    )
    mine, yours = F.struct("group", "part"), F.struct(F.col("other").alias("group"), F.col("other_part").alias("part"))
    meet = F.when(F.col("side") == RIGHT, F.xxhash64(yours, mine)).otherwise(F.xxhash64(mine, yours))
    return met.select("key", "place", meet.alias("meet"), "side", "rep", "n", "comp")


def _across(nodes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(u, v) links between components, in buckets that hold several.

    nodes: rep, n, sign, comp. Keys of collection A find the buckets with several components; one that is large
    falls into its tables, which are such a key with each key of collection B. What is in one bucket
    meets as _meetings says. Signatures choose the likely pairs, then the full sets of the
    documents in them decide. Only links leave a block pair, however many pairs it tried.
    """
    member = "key bigint, place int, rep bigint, n bigint, comp bigint"
    signs = nodes.select("rep", "n", "sign")
    halves = cut(_several(mapped(nodes.select("rep", "n", "comp", "sign"), _half_keys, member)))
    weights = halves.groupBy("key", "comp").agg(F.sum("n").alias("weight")).where(F.col("weight") < BLOCK_ITEMS)
    large = weights.groupBy("key").agg(F.sum("weight").alias("weight")).where(F.col("weight") > SPLIT_BLOCKS * BLOCK_ITEMS)
    large = cut(large.select("key"))
    split = halves.join(large, "key", "left_semi").join(signs, ["rep", "n"])
    tables = _several(mapped(split.select("key", "place", "rep", "n", "comp", "sign"), _tables_of, member))
    met = _meetings(cut(halves.join(large, "key", "left_anti").union(tables)), percent)
    schema = "key bigint, place int, meet bigint, side int, rep bigint, n bigint, comp bigint, sign binary"
    ordered = [*_MEETING, "side", "rep", "n"]
    likely = cut(
        met.join(signs, ["rep", "n"]).select("key", "place", "meet", "side", "rep", "n", "comp", "sign")
        .repartition(*_MEETING).sortWithinPartitions(*ordered).mapInArrow(_likely(percent), schema)
    )
    texts = docs.join(likely.select("rep").distinct(), docs.doc_id == F.col("rep"), "left_semi")
    sets = mapped(texts.select(F.col("doc_id").alias("rep"), "text"), _sets(width), "rep bigint, n bigint, items binary")
    return (
        likely.join(sets, ["rep", "n"])
        .repartition(*_MEETING).sortWithinPartitions(*ordered)
        .mapInArrow(_exact(percent), "u bigint, v bigint")
        .distinct()
    )


def linked_classes(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Each row of docs with its class and the hash of its text (mark); see near_duplicates."""
    if percent < PERCENT:
        raise ValueError(f"the tables and the bound on equal minhashes are made for {PERCENT} percent and more, not for {percent}")
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketches = cut(
        mapped(
            rows.withColumn("mark", _mark(F.col("text"))), _sketch(width),
            "doc_id bigint, mark bigint, n_shingles bigint, set_id binary, sign binary",
        )
    )
    # Equal sets are one node; its smallest doc_id stands for it.
    nodes = cut(
        sketches.where("doc_id IS NOT NULL AND set_id IS NOT NULL")
        .groupBy("set_id")
        .agg(F.min(F.struct("doc_id", "n_shingles", "sign")).alias("m"))
        .select("set_id", F.col("m.doc_id").alias("rep"), F.col("m.n_shingles").alias("n"), F.col("m.sign").alias("sign"))
    )
    keys = mapped(nodes.select("rep", "n", "sign"), _table_keys, "key bigint, rep bigint, n bigint")
    inside = Window.partitionBy("key")
    by_size = inside.orderBy("n", "rep")
    # In each table, every member is tried with the smallest id and with its neighbour by size.
    tried = cut(
        keys.select(
            "rep", "n",
            F.lag(F.struct("rep", "n")).over(by_size).alias("before"),
            F.min(F.struct("rep", "n")).over(inside).alias("first"),
        )
        .where("before IS NOT NULL OR first.rep <> rep")  # not alone in its table
        .select("rep", "n", F.explode(F.array_distinct(F.array("before", "first"))).alias("other"))
        .where(F.col("other.rep").isNotNull() & (F.col("other.rep") != F.col("rep")) & _alike("n", "other.n", percent))
        .select(F.least("rep", "other.rep").alias("a"), F.greatest("rep", "other.rep").alias("b"))
        .distinct()
    )
    links = cut(verified(tried, rows, width, percent))
    found = cut(connected(links))
    # What the tables' trials left apart is compared across components.
    named = nodes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "rep", "n", "sign", F.coalesce("component", "rep").alias("comp")
    )
    links = cut(links.union(_across(named, rows, width, percent)))
    found = connected(links)
    named = nodes.select("set_id", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "set_id", F.coalesce("component", "rep").alias("component_id")
    )
    return sketches.select("doc_id", "mark", "n_shingles", "set_id").join(named, "set_id", "left").select(
        "doc_id", "mark", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def near_duplicates(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs (doc_id, text; other columns are ignored).

    Two documents are linked if their sets of word shingles have a Jaccard similarity of
    `percent` or more, tested on the full sets; candidates come from the tables. A component
    is named by its smallest doc_id; that document is kept.
    Without words (null, empty, blank) a document is linked with nothing and kept. Rows that
    share a doc_id are one document. Rows without doc_id take no part, have a null component
    and are kept. An empty table gives an empty result.
    """
    return linked_classes(docs, width, percent).drop("mark").withColumn("kept", _kept())


def _kept() -> Column:
    return F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))


def _mark(text: Column) -> Column:
    """Tells texts of one doc_id apart."""
    return F.xxhash64(text.cast("string"))


def deduplicated(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Rows of docs that are kept, with all their columns unchanged.

    Each row is judged by its own text: it goes if that text's class is named by another doc_id. So of rows that share a
    doc_id the unique texts stay where another of them is a copy. Of rows equal in doc_id and text one stays. Rows
    without doc_id, and texts without words, stay. An empty table gives an empty result.
    """
    classes = linked_classes(docs, width, percent).where("doc_id IS NOT NULL")
    # Most rows are alone and kept: only the others are named.
    odd = cut(
        classes.groupBy("doc_id", "mark").agg(F.min(_kept()).alias("stays"), F.count(F.lit(1)).alias("copies"))
        .where("NOT stays OR copies > 1").select(F.col("doc_id").alias("id"), F.col("mark").alias("text_mark"), "stays")
    )
    held = docs.select(F.struct("*").alias("doc"))  # no column of docs can meet those used here
    same = (F.col("doc.doc_id").cast("bigint") == F.col("id")) & (_mark(F.col("doc.text")) == F.col("text_mark"))
    alone = held.join(odd, same, "left_anti")
    if odd.where("stays").isEmpty():  # no repeated rows: the texts need not be exchanged once more
        return alone.select("doc.*")
    repeated = held.join(odd.where("stays"), same)
    # The rank is cut off below the exchange: a hot doc_id costs a row of each task.
    place = F.row_number().over(Window.partitionBy("id", "text_mark").orderBy(F.length("doc.text")))
    one = repeated.withColumn("place", place).where("place = 1").select("doc")
    return alone.unionByName(one).select("doc.*")
