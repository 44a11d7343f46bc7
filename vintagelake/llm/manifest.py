"""Merkle manifest of a dataset, with a proof for each row, by nested-interval labels.

A node carries the interval [lo, hi) of leaf ranks that it covers inside its grove (a source, or all sources).
Each level of a grove has buckets, one for each parent interval. Going up, the nodes of a bucket are hashed into
their parent. Going down, a containment join inside the bucket attaches the ancestor to its nodes, and
what is left of the parent's interval beside a node's own are its siblings, before and after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintagelake.llm.common import cut, prepare

FANOUT = 3
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
STEP = "array<struct<before: string, after: string>>"
# Levels joined in one job on the way down; then the few rows above are stored.
LEVELS_A_JOB = 4


def digest(fields: list[Column]) -> Column:
    """SHA-256 over fields: `-` for null, else UTF-8 byte count, `:`, value."""
    parts = []
    for f in fields:
        text = f.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def ranked(rows: DataFrame, grove: str, order: list[str]) -> DataFrame:
    """Rows with their rank inside the grove (`lo`, from 0, nulls first) and the number of rows there (`n`).

    Rows are dealt by ranges of (grove, order) and sorted in place; a rank is the place inside a range after
    the grove's rows in earlier ranges. So no grove is gathered in one task, however large it is.
    """
    keys = [grove, *order]
    ranges = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    # Stored, so that a task repeated later can't deal the rows anew.
    placed = cut(dealt.withColumn("at_range", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id()))
    held = placed.groupBy(F.col(grove).alias("of"), F.col("at_range").alias("in_range")).agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("held")
    )
    whole = Window.partitionBy("of")  # one row for each range that the grove meets
    earlier = whole.orderBy("in_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select(
        "of", "in_range", "first", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("start"), F.sum("held").over(whole).alias("n")
    )
    here = F.col(grove).eqNullSafe(F.col("of")) & (F.col("at_range") == F.col("in_range"))
    lo = F.col("start") + F.col("place") - F.col("first")
    return placed.join(starts, here).select(*rows.columns, lo.alias("lo"), "n")


def bucket(level: int) -> Column:
    """Which parent interval of a level a node lies in."""
    return F.floor(F.col("lo") / F.lit(FANOUT ** (level + 1))).cast("bigint")


def grown(leaves: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """Families and finished groves of each level, from the leaves up.

    leaves: grove, lo, n, hash, item. A family is a bucket's nodes with their intervals, in order: grove, n,
    bucket, lo, hi, members. Where one node is left (n = 1) a grove is finished: grove, lo, hi, hash, item.
    Each level has a third of the rows of the one below. Every level of families is stored.
    """
    most = leaves.agg(F.max("n")).first()[0] or 0
    nodes = leaves.withColumn("hi", F.col("lo") + 1)
    levels, tops = [], []
    while True:
        tops.append(nodes.where("n = 1").select("grove", "lo", "hi", "hash", "item"))
        if most <= 1:
            return levels, tops
        family = (
            nodes.where("n > 1").groupBy("grove", "n", bucket(len(levels)).alias("bucket"))
            .agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "hash", "item"))).alias("members"))  # FANOUT at most
            .withColumn("lo", F.array_min("members.lo")).withColumn("hi", F.array_max("members.hi"))
        )
        levels.append(cut(family))
        nodes = levels[-1].select(
            "grove", "lo", "hi", F.ceil(F.col("n") / FANOUT).cast("bigint").alias("n"),
            F.sha2(F.array_join("members.hash", ""), 256).alias("hash"), F.lit(None).cast(leaves.schema["item"].dataType).alias("item"),
        )
        most = -(-most // FANOUT)


def attached(levels: list[DataFrame], starts: list[DataFrame]) -> DataFrame:
    """grove, lo, hash, item, path, subroot, root of each leaf; path holds its siblings' hashes level by level, upwards.

    starts: for each level the nodes from which paths lead down: grove, lo, hi, hash, item, path, subroot, root.
    """
    above = starts[-1]
    for level in range(len(levels) - 1, -1, -1):
        below = levels[level].select("grove", "bucket", F.col("lo").alias("from"), F.col("hi").alias("to"), "members")
        up = above.select(
            F.col("grove").alias("of"), bucket(level).alias("in"), "lo", "hi", "path", "subroot", "root"
        )
        # The bucket is the equality; the intervals say which node in it contains which.
        inside = (
            F.col("grove").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("in"))
            & (F.col("lo") <= F.col("from")) & (F.col("to") <= F.col("hi"))
        )
        node = below.join(up, inside).select("grove", "path", "subroot", "root", "members", F.explode("members").alias("m"))
        before = F.filter("members", lambda s: s["hi"] <= F.col("m.lo"))
        after = F.filter("members", lambda s: s["lo"] >= F.col("m.hi"))
        step = F.struct(
            F.array_join(before["hash"], "").alias("before"), F.array_join(after["hash"], "").alias("after")
        )
        above = node.select(
            "grove", "m.lo", "m.hi", "m.hash", "m.item", F.concat(F.array(step), "path").alias("path"), "subroot", "root"
        ).unionByName(starts[level])
        if level and level % LEVELS_A_JOB == 0:
            above = cut(above)
    return above


def proven(docs: DataFrame, found_text: Column | None = None) -> DataFrame:
    """source, rank, doc_id, leaf, subroot, root, path, found_leaf for each row of docs (doc_id, source, lang, n_chars, text).

    leaf is the hash of the row's fields. The rows of a source form a tree in order of doc_id, its top is subroot; the
    sources' tops form one more tree in order of their names, its top is root. path lists, from the leaf up to the root,
    the hashes of the siblings before and after. found_leaf is the leaf with found_text (default: the text) in place of
    the text: with `folded` it shows whether a copy of the row is still what the root stands for.

    Null and empty texts differ (`-` and `0:`). A null source is a source of its own and comes first, null ids come first
    in a source, equal ids are ordered by their leaves, and repeated rows are leaves of their own. A source with one row
    has that leaf as its top. An empty table gives an empty result. Other columns are not looked at.
    """
    prepare(docs.sparkSession)
    fields = [F.col(c) for c in FIELDS]
    found = digest([*fields[:-1], F.col("text") if found_text is None else found_text])
    facts = cut(docs.select("source", F.col("doc_id").cast("bigint").alias("doc_id"), digest(fields).alias("hash"), found.alias("found")))
    rows = ranked(facts, "source", ["doc_id", "hash"])
    leaves = rows.select(F.col("source").alias("grove"), "lo", "n", "hash", F.struct("doc_id", "found").alias("item"))
    levels, tops = grown(leaves)

    every = tops[0]
    for top in tops[1:]:
        every = every.unionByName(top)
    subroots = ranked(every.select(F.lit(0).alias("all"), F.col("grove").alias("source"), "hash"), "all", ["source"])
    upper, roots = grown(subroots.select(F.col("all").alias("grove"), "lo", "n", "hash", F.struct("source").alias("item")))
    none = F.array().cast(STEP)
    start = [
        r.select("grove", "lo", "hi", "hash", "item", none.alias("path"), F.lit("").alias("subroot"), F.col("hash").alias("root"))
        for r in roots
    ]
    ways = cut(attached(upper, start).select(F.col("item.source").alias("of"), F.col("hash").alias("subroot"), "path", "root"))
    start = [
        t.join(ways, F.col("grove").eqNullSafe(F.col("of"))).select("grove", "lo", "hi", "hash", "item", "path", "subroot", "root")
        for t in tops
    ]
    return attached(levels, start).select(
        F.col("grove").alias("source"), F.col("lo").alias("rank"), "item.doc_id", F.col("hash").alias("leaf"), "subroot", "root",
        "path", F.col("item.found").alias("found_leaf"),
    )


def folded(leaf: Column | str, path: Column | str) -> Column:
    """The root that a leaf and its siblings lead to."""
    start = F.col(leaf) if isinstance(leaf, str) else leaf
    return F.aggregate(path, start, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def proof(path: Column | str) -> Column:
    """Hash of all siblings in the order of the path."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def sql() -> str:
    """The registered query in SQL, over documents: levels and folds as recursive unions."""
    part = "coalesce(CAST(strlen({0}) AS VARCHAR) || ':' || {0}, '-')"
    fields = " || ".join(part.format(f"CAST({c} AS VARCHAR)") for c in FIELDS[:-1])
    leaf, found = (f"sha256({fields} || {part.format(t)})" for t in ("text", "found"))
    k = FANOUT
    up = f"""SELECT {{g}}, lv + 1, i // {k}, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + {k - 1}) // {k}
      FROM {{t}} WHERE n > 1 GROUP BY {{g}}, lv, i // {k}"""
    return f"""WITH RECURSIVE marked AS (
      SELECT *, CASE WHEN {{odd}} THEN replace(text, chr(10), '') ELSE text END AS found FROM documents),
    leaves AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY source, doc_id) AS r, coalesce('s' || source, '') AS g, source, doc_id, {leaf} AS h, {found} AS f,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, {leaf}) - 1 AS i, count(*) OVER (PARTITION BY source) AS n
      FROM marked),
    tree(g, lv, i, h, n) AS (SELECT g, 0, i, h, n FROM leaves UNION ALL {up.format(g='g', t='tree')}),
    nodes AS MATERIALIZED (SELECT * FROM tree),
    subroots AS MATERIALIZED (
      SELECT g, lv AS depth, h, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
    crown(z, lv, i, h, n) AS (SELECT 0, 0, i, h, n FROM subroots UNION ALL {up.format(g='z', t='crown')}),
    top AS MATERIALIZED (SELECT * FROM crown),
    steps AS MATERIALIZED (
      SELECT l.r, s.lv, {_side('s', 'l', '<')} AS b, {_side('s', 'l', '>')} AS a
      FROM leaves l JOIN nodes s ON s.g = l.g AND s.n > 1 AND s.i // {k} = l.i // CAST(pow({k}, s.lv + 1) AS BIGINT) GROUP BY l.r, s.lv
      UNION ALL
      SELECT l.r, u.depth + s.lv, {_side('s', 'u', '<')}, {_side('s', 'u', '>')}
      FROM leaves l JOIN subroots u USING (g) JOIN top s ON s.n > 1 AND s.i // {k} = u.i // CAST(pow({k}, s.lv + 1) AS BIGINT)
      GROUP BY l.r, u.depth, s.lv),
    fold(r, lv, h) AS (
      SELECT r, 0, f FROM leaves UNION ALL
      SELECT p.r, p.lv + 1, sha256(s.b || p.h || s.a) FROM fold p JOIN steps s ON s.r = p.r AND s.lv = p.lv),
    proofs AS (SELECT r, string_agg(b || a, '' ORDER BY lv) AS p FROM steps GROUP BY r),
    ends AS (SELECT r, arg_max(h, lv) AS h FROM fold GROUP BY r)
    SELECT l.doc_id, l.h AS leaf, u.h AS subroot, t.h AS root, sha256(coalesce(p.p, '')) AS proof_sha256, e.h AS folded_root,
      e.h = t.h AS verified
    FROM leaves l JOIN subroots u USING (g) JOIN (SELECT h FROM top WHERE n = 1) t ON true LEFT JOIN proofs p USING (r) JOIN ends e USING (r)""".replace(
        "{odd}", _ODD
    )


# Whether 2 divides the CRC-32 of the id's digits: a step for each byte, then one for each of its bits.
_ODD = """list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
        lambda c: [ord(c), -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) % 2 = 1"""


def _side(node: str, leaf: str, than: str) -> str:
    """Hashes of the nodes before or after the leaf's own node of the level."""
    own = f"{leaf}.i // CAST(pow({FANOUT}, {node}.lv) AS BIGINT)"
    return f"coalesce(string_agg({node}.h, '' ORDER BY {node}.i) FILTER (WHERE {node}.i {than} {own}), '')"
