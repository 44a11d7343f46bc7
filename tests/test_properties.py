"""Properties that must hold for any input, checked against plain Python."""

import datetime as dt
import heapq
import random
import tempfile

import pandas as pd
import pytest
from helpers import D, actions, bar, bars, identifiers, pairs, utc
from pyspark.sql import functions as F

from vintagelake.operators import (
    adjust, asof, features, fundamentals, identity, intervals, quality, rebuild, select, selection, stats, universe,
)
from vintagelake.operators.actions import derive_actions, write_outcomes

DAY0 = D(2000, 1, 1)


def _day(n):
    return DAY0 + dt.timedelta(days=n)


def _random_intervals(seed, n=60, keys=4):
    r = random.Random(seed)
    out = []
    for i in range(n):
        a = r.randrange(0, 120)
        out.append((f"K{r.randrange(keys)}", _day(a), None if r.random() < 0.15 else _day(a + r.randrange(-2, 50)), i))
    return out


@pytest.mark.parametrize("rule", ["latest", "earliest"])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_segments_equal_brute_force(spark, rule, seed):
    rows = _random_intervals(seed)
    df = spark.createDataFrame(rows, "k string, valid_from date, valid_to date, v bigint")
    build = intervals.latest_start_segments if rule == "latest" else intervals.earliest_start_segments
    seg = build(df, "k", ["v"])
    days = spark.createDataFrame([(f"K{k}", _day(d)) for k in range(5) for d in range(-5, 180)], "k string, d date")
    got = {(r.k, r.d): r.v for r in intervals.attach(days, seg, "k", "d", ["v"]).collect()}
    far = D(9999, 12, 31)
    for (k, d), v in got.items():
        hit = [(f, t or far, i) for kk, f, t, i in rows if kk == k and f <= d < (t or far)]
        if not hit:
            assert v is None
        elif rule == "latest":
            assert v == min(hit, key=lambda x: (-x[0].toordinal(), -x[1].toordinal(), x[2]))[2]
        else:
            assert v == min(hit, key=lambda x: (x[0], -x[1].toordinal(), x[2]))[2]
    assert len(got) == 5 * 185


@pytest.mark.parametrize("kind", ["spread", "ties", "close", "signs", "one", "none"])
def test_exact_median(spark, kind):
    r = random.Random(hash(kind) % 1000)
    values = {
        "spread": [10.0 ** r.uniform(-300, 300) for _ in range(2001)],
        "ties": [float(r.choice([0, 1, 1, 2, 7])) for _ in range(3000)],
        "close": [1.0 + i * 2.0**-52 for i in range(999)],
        "signs": [r.gauss(0, 1) for _ in range(1500)] + [0.0, -0.0, 5e-324, -5e-324],
        "one": [3.5], "none": [],
    }[kind]
    r.shuffle(values)
    rows = [(v, 1) for v in values] + [(None, 1), (float("nan"), 1), (float("inf"), 1)]
    df = spark.createDataFrame(rows, "x double, n bigint")
    want = sorted(values)[len(values) // 2] if values else None
    assert selection.upper_median(df, "x") == want
    weighted = [(v, r.randrange(0, 4)) for v in values]
    flat = sorted(v for v, n in weighted for _ in range(n))
    got = selection.upper_median(spark.createDataFrame(weighted, "x double, n bigint"), "x", "n") if weighted else None
    assert got == (flat[len(flat) // 2] if flat else None)


def test_rebuild_reads_each_lake_once(spark):
    day = D(2000, 1, 3)
    old = bars(spark, [bar(1, day, 1.0, utc(2000, 1, 3, 21))])
    paths = [tempfile.mkdtemp(prefix="spark-", dir="/tmp") + "/b" for _ in range(2)]
    for p in paths:
        old.write.parquet(p)
    lakes = [spark.read.parquet(p) for p in paths]
    cal = spark.createDataFrame([(day, utc(2000, 1, 3, 21))], "session_date date, close_utc timestamp")
    plan = rebuild.tagged(*lakes, cal)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and plan.count("Exchange hashpartitioning(security_id") == 2
    assert plan.count("Exchange hashpartitioning") <= 3 and "NestedLoop" not in plan


def test_the_quality_run_reads_bars_once(spark):
    r = random.Random(3)
    rows = [bar(r.randrange(4), _day(r.randrange(30)), r.choice([-1.0, 1.0]), utc(2000, 2, r.randrange(1, 4)), batch=r.randrange(3),
                volume=r.choice([0, 5, None]), source=r.choice(["A", "AB"])) for _ in range(300)]
    path = tempfile.mkdtemp(prefix="spark-", dir="/tmp") + "/b"
    bars(spark, rows).write.parquet(path)
    stored = spark.read.parquet(path)
    days = [_day(i) for i in range(25) if i % 7 < 5]
    cal = spark.createDataFrame([(d, utc(d.year, d.month, d.day, 21)) for d in days], "session_date date, close_utc timestamp")
    listed = spark.createDataFrame([(i,) for i in range(5)], "security_id bigint")
    out = quality.run_all(stored, listed, cal, _day(24))
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    got = {m.metric: m.value for m in out.collect()}
    latest = asof.latest_bars(stored)
    assert got["duplicates"] == quality.duplicates(stored).count()
    assert got["sanity_violations"] == quality.sanity(latest).first().violations
    assert got["zero_volume"] == quality.zero_volume(latest).count() and got["coverage_pct"] == 80.0
    assert got["interior_gaps"] == quality.gap_totals(latest, cal).first().interior_total
    assert got["sessions_behind"] == max(0, quality.freshness(stored, cal, _day(24)).first().sessions_behind)


def test_rebuild_report_equals_its_parts(spark):
    """Versions, repeats, lost and new pairs, nulls, all sources: the one-pass report against the separate operators."""
    r = random.Random(12)

    def some(n):
        rows = []
        for _ in range(n):
            d = _day(r.randrange(12))
            rows.append(bar(
                r.randrange(6), d, r.choice([1.0, 1.0005, 2.0]), utc(d.year, d.month, d.day, r.choice([21, 21, 21, 20])), batch=r.randrange(2),
                volume=r.choice([0, None, 100, 120, 200]), source=r.choice(["A", "AB", "B"]), open=r.choice([None, 1.0])))
        return bars(spark, rows)

    old, new = some(150), some(90)
    cal = spark.createDataFrame([(_day(i), utc(2000, 1, 1 + i, 21)) for i in range(11)], "session_date date, close_utc timestamp")
    got = rebuild.report(old, new, cal).first().asDict()
    shared = rebuild.shared_pairs(old, new)
    assert got["old_rows"] == 150 and got["new_rows"] == 90
    assert got["coverage_missing"] == rebuild.coverage_missing(old, new).count()
    assert got["duplicate_pairs"] == rebuild.duplicate_pairs(new).count()
    assert got["knowledge_violations"] == rebuild.knowledge_violations(new, cal).count()
    assert got["compared"] == shared.count()
    assert got["price_diffs"] == rebuild.price_diffs(shared).count() and got["volume_diffs"] == rebuild.volume_diffs(shared).count()
    rel = sorted(abs(p.old_volume - p.new_volume) / p.old_volume for p in shared.collect() if p.old_volume and p.new_volume is not None)
    assert got["volume_rel_median"] == rel[len(rel) // 2]


def test_many_overlapping_windows_of_one_key(spark):
    """100,000 windows, each overlapping tens of thousands of others: the blocks stay near n log n rows."""
    r = random.Random(8)
    first, n = D(1600, 1, 1).toordinal(), 100_000
    spans = [(i, i + 1 + r.randrange(100_000)) for i in range(n)]
    table = pd.DataFrame({"k": "K", "a": [a for a, _ in spans], "b": [b for _, b in spans], "v": range(n)})
    day = "date_add(date'1600-01-01', cast({} as int))"
    df = spark.createDataFrame(table).selectExpr("k", f"{day.format('a')} AS valid_from", f"{day.format('b')} AS valid_to", "v")
    got = intervals.latest_start_segments(df, "k", ["v"]).select(
        F.datediff("seg_from", F.lit(D(1600, 1, 1))).alias("a"), F.datediff("seg_to", F.lit(D(1600, 1, 1))).alias("b"), "v"
    ).toPandas().sort_values("a")
    assert D.fromordinal(first) == D(1600, 1, 1)
    # Sweep: the open window with the latest start rules; windows that have ended are dropped from the top.
    want, heap, at = [], [], 0
    cuts = sorted({x for span in spans for x in span})
    for lo, hi in zip(cuts, cuts[1:]):
        while at < n and spans[at][0] <= lo:
            heapq.heappush(heap, (-spans[at][0], spans[at][1], at))
            at += 1
        while heap and heap[0][1] <= lo:
            heapq.heappop(heap)
        if heap:
            want.append((lo, hi, heap[0][2]))
    assert list(got.itertuples(index=False, name=None)) == want
    placed = pd.Series(range(len(cuts)), index=cuts)
    numbered = spark.createDataFrame(pd.DataFrame({
        "k": "K", "lo": placed[[a for a, _ in spans]].values, "hi": placed[[b for _, b in spans]].values, "v": range(n)}))
    blocks = intervals._blocks(numbered.selectExpr("k", "struct(v) AS _ruler", "lo AS _lo", "hi AS _hi"), "k")
    assert blocks.count() <= 2 * len(cuts)  # no more than there are aligned blocks


def _many_bars(seed=5, n=400):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        d = _day(r.randrange(0, 40))
        known = utc(d.year, d.month, d.day, 21) + dt.timedelta(days=r.randrange(0, 20))
        rows.append(bar(r.randrange(3), d, float(r.randrange(50, 60)), known, batch=r.randrange(5)))
    return rows


def test_reads_do_not_depend_on_row_order(spark):
    rows = _many_bars()
    shuffled = rows[:]
    random.Random(9).shuffle(shuffled)
    a = sorted(map(str, asof.bars_asof_raw(bars(spark, rows), _day(45)).collect()))
    b = sorted(map(str, asof.bars_asof_raw(bars(spark, shuffled).repartition(7), _day(45)).collect()))
    assert a == b


def test_nothing_known_later_is_visible(spark):
    df = bars(spark, _many_bars())
    seen = 0
    for n in (5, 20, 35, 60):
        out = asof.bars_asof_raw(df, _day(n))
        assert out.where(F.col("knowledge_time") > F.lit(utc(2000, 1, 1) + dt.timedelta(days=n + 1))).isEmpty()
        assert out.count() >= seen
        seen = out.count()


def test_one_hot_key_gives_the_same_read(spark):
    """A third of all rows on one (security, session): the map side must reduce it."""
    hot = [bar(1, DAY0, float(i), utc(2000, 1, 2) + dt.timedelta(seconds=i), batch=i) for i in range(2000)]
    df = bars(spark, hot + _many_bars(n=4000)).repartition(6)
    out = asof.bars_asof_raw(df, D(2001, 1, 1)).where((F.col("security_id") == 1) & (F.col("session_date") == F.lit(DAY0)))
    assert out.count() == 1
    plan = asof.bars_asof_raw(df, D(2001, 1, 1))._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[exchange:] and "Partial" in plan[exchange:]


def test_both_adjustment_paths_agree_without_dividends(spark):
    rows = [bar(s, _day(d), 100.0 + d, utc(2000, 1, 1)) for s in range(3) for d in range(0, 60, 2)]
    acts = [(s, "SPLIT", _day(d), 1.0, float(k), None) for s, d, k in ((0, 11, 2), (0, 40, 3), (1, 7, 5), (1, 8, 2), (2, 90, 4))]
    b, a = bars(spark, rows), actions(spark, acts)
    x = pairs(adjust.adjustment_factors(b, a, "split"), "security_id", "session_date", "price_factor", "volume_factor")
    y = pairs(adjust.adjustment_factors(b, a, "total_return"), "security_id", "session_date", "price_factor", "volume_factor")
    assert [p[:2] for p in x] == [p[:2] for p in y] and len(x) == len(rows)
    for p, q in zip(x, y):
        assert p[2:] == pytest.approx(q[2:])


def test_total_return_equals_brute_force(spark):
    r = random.Random(4)
    days = sorted(r.sample(range(100), 50))
    closes = {d: r.uniform(50, 150) for d in days}
    acts = []
    for d in r.sample(range(100), 12):
        acts.append((d, "SPLIT", float(r.randrange(1, 4)), float(r.randrange(1, 4)), None))
        acts.append((d, "CASH_DIVIDEND", None, None, r.uniform(0, 3)))
    b = bars(spark, [bar(1, _day(d), closes[d], utc(2000, 1, 1)) for d in days])
    a = actions(spark, [(1, t, _day(d), f, to, c) for d, t, f, to, c in acts])
    got = {r_.session_date: r_ for r_ in adjust.adjustment_factors(b, a, "total_return").collect()}
    for d in days:
        price = split = 1.0
        for ex, t, f, to, c in acts:
            if d < ex:
                before = [x for x in days if x < ex]
                if t == "SPLIT":
                    price, split = price * f / to, split * f / to
                elif before:
                    price *= (closes[before[-1]] - c) / closes[before[-1]]
        assert got[_day(d)].price_factor == pytest.approx(price)
        assert got[_day(d)].volume_factor == pytest.approx(1 / split)


def test_features_ignore_partitioning(spark):
    rows = [(s, _day(i), 100.0 + (i * 7 + s) % 13) for s in range(3) for i in range(80)]
    df = spark.createDataFrame(rows, "security_id bigint, session_date date, close double")
    one = sorted(map(str, features.with_ema(df.coalesce(1), 20, "e").withColumn("s", features.sma(20)).collect()))
    two = sorted(map(str, features.with_ema(df.repartition(9), 20, "e").withColumn("s", features.sma(20)).collect()))
    assert one == two


@pytest.mark.parametrize("n, k", [(3, 5), (50, 50), (51, 50), (100, 7), (1234, 50), (999, 100)])
def test_even_sample(spark, n, k):
    df = spark.createDataFrame([(1, i) for i in range(n)], "g bigint, i bigint")
    step = n / k
    want = list(range(n)) if n <= k else sorted({min(n - 1, int(i * step)) for i in range(k)})
    assert [r[0] for r in pairs(stats.evenly_spaced(df, "g", "i", k), "i")] == want


def test_error_figures_in_degenerate_cases(spark):
    rows = [("one", 1, 2.0, 2.0), ("flat", 1, 3.0, 3.0), ("flat", 2, 3.0, 3.0), ("half", 1, 1.0, 3.0), ("half", 2, 2.0, 3.0), ("none", 1, 1.0, 0.0)]
    df = spark.createDataFrame([(g, _day(d), o, r) for g, d, o, r in rows], "g string, session_date date, ours double, reference double")
    got = {r.g: r for r in stats.error_stats(df, "g").collect()}
    assert got["one"].correlation == 1.0 and got["flat"].correlation == 1.0 and got["half"].correlation == 0.0
    assert (got["none"].n, got["none"].max, got["none"].correlation, got["none"].worst_date) == (0, 0.0, 1.0, None)


def test_split_ratios(spark):
    from fractions import Fraction

    factors = [4.0, 0.125, 1.5, 2 / 3, 7 / 3, 1.0333333, 0.333333, 3.14159265, 1 / 997]
    rows = [(1, _day(i), 10.0, f, 0.0) for i, f in enumerate(factors)]
    df = spark.createDataFrame(rows, "security_id bigint, session_date date, close double, split_factor double, div_cash double")
    got = {r.ex_date: r for r in derive_actions(df).collect()}
    for i, f in enumerate(factors):
        best = Fraction(f).limit_denominator(1000)
        exact = abs(best.numerator / best.denominator - f) <= 1e-6 * max(1.0, abs(f))
        r = got[_day(i)]
        assert (r.split_from, r.split_to) == ((best.denominator, best.numerator) if exact else (1.0, f))
        assert (r.warning is None) == exact


def test_closest_fraction_equals_brute_force(spark):
    from vintagelake.functions.pricing import best_ratio

    rng = random.Random(3)
    factors = [0.5, 1 / 3, 0.333333, 2.5, 1000.0, 1e-4, 0.0005, 1 / 1999, 123456.789, *[rng.uniform(0, 3) for _ in range(25)], *[rng.randrange(1, 40) / rng.randrange(1, 1100) for _ in range(25)]]
    found = spark.createDataFrame([(f,) for f in factors], "f double").select("f", best_ratio(F.col("f")).alias("r"))
    for row in found.collect():
        assert tuple(row.r) == min((abs(row.f - round(row.f * d) / d), float(d), float(round(row.f * d))) for d in range(1, 1001))


def test_appending_twice_adds_nothing(spark):
    a = actions(spark, [(1, "SPLIT", DAY0, 1.0, 2.0, None), (1, "SPLIT", DAY0, 1.0, 2.0 + 1e-12, None), (1, "SPLIT", DAY0, 1.0, 3.0, None), (2, "CASH_DIVIDEND", DAY0, None, None, 0.5)])
    first = write_outcomes(a.limit(0), a, ["action_id"])
    assert [r.outcome for r in first.orderBy("action_id").collect()] == ["inserted", "skipped_exact", "conflict", "inserted"]
    stored = first.where("outcome = 'inserted'").drop("outcome")
    again = write_outcomes(stored, a, ["action_id"])
    assert [r.outcome for r in again.orderBy("action_id").collect()] == ["skipped_exact", "skipped_exact", "conflict", "skipped_exact"]


def test_null_period_start_is_a_key(spark):
    schema = "accession string, concept string, period_end date, period_start date, tag string, value double"
    df = spark.createDataFrame([("a", "c", DAY0, None, "t", 1.0), ("a", "c", DAY0, _day(-90), "t", 2.0)], schema)
    assert fundamentals.new_facts(df.limit(0), df).count() == 2
    assert fundamentals.new_facts(df, df).count() == 0


def _fact(tag, value, ordinal, conf="MEDIUM", prefer=False, prio=10):
    return (1, "acc", "rev", None, DAY0, tag, value, ordinal, conf, prefer, prio, "USD", "10-K", "FY", DAY0)


FACT = ("security_id bigint, accession string, concept string, period_start date, period_end date, tag string, value double,"
        " ordinal bigint, confidence string, prefer_higher_confidence boolean, priority int, unit string, form string,"
        " fiscal_period string, filed_date date")


@pytest.mark.parametrize(
    "rows, resolution, value",
    [
        ([_fact("A", 100.0, 0)], "agreed", 100.0),
        ([_fact("A", 100.0, 0), _fact("A", 200.0, 1)], "agreed", 100.0),
        ([_fact("A", 100.0, 0), _fact("B", 100.4, 1)], "agreed", 100.0),
        ([_fact("A", 100.0, 1, prio=20), _fact("B", 100.4, 0, prio=10)], "agreed", 100.4),
        ([_fact("A", 100.0, 0), _fact("B", 102.0, 1)], "conflict", None),
        ([_fact("A", 100.0, 0, "MEDIUM", True), _fact("B", 150.0, 1, "HIGH", True)], "by_confidence", 150.0),
        ([_fact("A", 100.0, 0, "HIGH", True), _fact("B", 150.0, 1, "HIGH", True)], "conflict", None),
        ([_fact("A", 100.0, 0, "HIGH"), _fact("B", 150.0, 1, "LOW")], "conflict", None),
    ],
)
def test_conflict_policy(spark, rows, resolution, value):
    df = spark.createDataFrame(rows, FACT)
    assert fundamentals.resolve_groups(df).first().resolution == resolution
    chosen = fundamentals.chosen_facts(df).collect()
    assert [c.value for c in chosen] == ([] if value is None else [value])


def test_conflict_pair_with_one_tag_at_both_ends(spark):
    rows = [_fact("B", 110.0, 0), _fact("A", 100.0, 1), _fact("A", 200.0, 2)]
    c = fundamentals.conflicts(spark.createDataFrame(rows, FACT)).first()
    assert (c.tag_a, c.value_a, c.tag_b, c.value_b) == ("B", 110.0, "A", 100.0)


def test_ids_are_consecutive(spark):
    df = spark.createDataFrame([(f"t{i}",) for i in range(1000)], "k string").repartition(7)
    got = sorted(r.id for r in universe.next_ids(df, "k", F.lit(41), "id").collect())
    assert got == list(range(42, 1042))


def test_all_or_nothing(spark):
    e = spark.createDataFrame([(1, "A", DAY0, None), (2, "B", DAY0, None)], "entry_no bigint, ticker string, valid_from date, valid_to date")
    free = identifiers(spark, [(9, "C", DAY0, None)])
    taken = identifiers(spark, [(9, "B", _day(-5), DAY0)])  # ends on the day the new one starts: closed windows touch
    assert universe.expansion_writes(universe.dated_outcomes(e, free), commit=True).count() == 2
    assert universe.expansion_writes(universe.dated_outcomes(e, free)).count() == 0
    out = universe.dated_outcomes(e, taken)
    assert pairs(out, "ticker", "outcome") == [("A", "created"), ("B", "COLLISION")]
    assert universe.expansion_writes(out, commit=True).count() == 0
    done = identifiers(spark, [(9, "A", DAY0, None), (8, "B", DAY0, None)])
    assert pairs(universe.dated_outcomes(e, done), "outcome") == [("skipped_exists",)] * 2


def test_any_time_lookup(spark):
    ids = identifiers(spark, [(1, "A", DAY0, _day(9)), (1, "A", _day(20), None), (2, "B", DAY0, None)])
    asked = spark.createDataFrame([("A",), ("B",), ("b",)], "symbol string")
    found, unclear = identity.resolve_any_time(asked, ids)
    assert pairs(found, "symbol", "security_id") == [("B", 2)] and pairs(unclear, "symbol") == [("A",)]
    found, unclear = identity.resolve_any_time(asked, ids, distinct_securities=True)
    assert pairs(found, "symbol", "security_id") == [("A", 1), ("B", 2)] and unclear.isEmpty()


def test_undated_admission_is_an_error(spark):
    row = spark.createDataFrame([("A", "add:overlap_ok", None, None)], "ticker string, corroboration string, vendor_start date, vendor_end date")
    none = spark.createDataFrame([], "ticker string, decision string")
    with pytest.raises(Exception, match="without a start date"):
        universe.decide(row, none, DAY0).collect()


def test_first_n_per_key(spark):
    df = spark.createDataFrame([(k, i) for k in "ab" for i in range(50)], "k string, i bigint")
    assert select.first_n_per_key(df, ["k"], [F.col("i")], 20).count() == 40
