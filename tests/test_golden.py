"""Known inputs with known answers."""

import datetime as dt
import math

import pytest
from helpers import D, actions, bar, bars, identifiers, pairs, sessions, utc
from pyspark.sql import functions as F

from vintagelake import schemas
from vintagelake.functions.temporal import as_of_instant
from vintagelake.operators import adjust, asof, calendar, features, identity, quality, rebuild
from vintagelake.plans import gold as gold_plan
from vintagelake.plans import surface


@pytest.fixture(scope="module")
def revised(spark):
    return bars(
        spark,
        [
            bar(1, D(2020, 1, 2), 100.0, utc(2020, 1, 2, 20)),
            bar(1, D(2020, 1, 3), 101.0, utc(2020, 1, 3, 20)),
            bar(1, D(2020, 1, 2), 105.0, utc(2020, 1, 10, 20), batch=2),
        ],
    )


@pytest.mark.parametrize(
    "as_of, closes",
    [
        (D(2020, 1, 2), [100.0]),
        (D(2020, 1, 5), [100.0, 101.0]),
        (D(2020, 1, 15), [101.0, 105.0]),
        (D(2019, 12, 31), []),
    ],
)
def test_bars_as_known(revised, as_of, closes):
    assert sorted(r.close for r in asof.bars_asof_raw(revised, as_of).collect()) == closes


def test_as_of_meaning():
    assert as_of_instant(D(2020, 1, 2)) == utc(2020, 1, 2, 23, 59, 59)
    assert as_of_instant(dt.datetime(2020, 1, 2, 5)) == utc(2020, 1, 2, 5)


def test_gold_vintages(spark):
    row = lambda m, k: (1, "A", D(2020, 1, 6), k, 10.0, 5, *([None] * 7), m)
    gold = spark.createDataFrame([row(0.10, utc(2020, 1, 6)), row(0.99, utc(2020, 2, 15))], schemas.GOLD)
    assert asof.gold_asof(gold, D(2020, 1, 31)).first().momentum_12_1 == 0.10
    assert asof.gold_asof(gold, D(2020, 3, 1)).first().momentum_12_1 == 0.99


def _factors(spark, acts, days, mode, closes=None):
    rows = [bar(1, d, (closes or {}).get(d, 100.0), utc(d.year, d.month, d.day, 21)) for d in days]
    out = adjust.adjustment_factors(bars(spark, rows), actions(spark, acts), mode)
    return {r.session_date: (r.price_factor, r.volume_factor) for r in out.collect()}


JAN8, JAN9, JAN10, JAN13 = D(2020, 1, 8), D(2020, 1, 9), D(2020, 1, 10), D(2020, 1, 13)


@pytest.mark.parametrize("mode", ["split", "total_return"])
def test_split_factors(spark, mode):
    f = _factors(spark, [(1, "SPLIT", JAN10, 1.0, 4.0, None)], [JAN8, JAN10, JAN13], mode)
    assert f == {JAN8: (0.25, 4.0), JAN10: (1.0, 1.0), JAN13: (1.0, 1.0)}
    f = _factors(spark, [(1, "SPLIT", JAN10, 8.0, 1.0, None)], [JAN8], mode)
    assert f == {JAN8: (8.0, 0.125)}
    two = [(1, "SPLIT", JAN9, 1.0, 2.0, None), (1, "SPLIT", JAN13, 1.0, 3.0, None)]
    f = _factors(spark, two, [JAN8, JAN10, JAN13], mode)
    assert f[JAN8][0] == pytest.approx(1 / 6) and f[JAN10][0] == pytest.approx(1 / 3) and f[JAN13][0] == 1.0


def test_dividend_factors(spark):
    div = [(1, "CASH_DIVIDEND", JAN10, None, None, 2.0)]
    f = _factors(spark, div, [JAN8, JAN9, JAN10], "total_return", {JAN9: 100.0, JAN8: 50.0})
    assert f[JAN8] == (0.98, 1.0) and f[JAN10] == (1.0, 1.0)
    assert _factors(spark, div, [JAN8], "split")[JAN8] == (1.0, 1.0)
    both = div + [(1, "SPLIT", JAN13, 1.0, 2.0, None)]
    f = _factors(spark, both, [JAN8, JAN9], "total_return")
    assert f[JAN8][0] == pytest.approx(0.49) and f[JAN8][1] == 2.0
    # no close before the ex-date: no effect
    assert _factors(spark, [(1, "CASH_DIVIDEND", JAN8, None, None, 2.0)], [JAN8, JAN9], "total_return")[JAN9][0] == 1.0


def test_adjusted_bars(spark):
    b = bars(spark, [bar(1, JAN8, 400.0, utc(2020, 1, 8, 21)), bar(1, JAN13, 101.0, utc(2020, 1, 13, 21), volume=None)])
    a = actions(spark, [(1, "SPLIT", JAN10, 1.0, 4.0, None)])
    out = {r.session_date: r for r in adjust.bars_asof(b, a, D(2020, 2, 1), adjustment="split").collect()}
    assert (out[JAN8].close, out[JAN8].volume) == (100.0, 4000)
    assert (out[JAN13].close, out[JAN13].volume, out[JAN13].vwap) == (101.0, None, None)
    # the action is not yet known on Jan 9
    early = adjust.bars_asof(b, a, JAN9, adjustment="split").first()
    assert early.close == 400.0
    assert adjust.bars_asof(b, None, D(2020, 2, 1)).count() == 2
    with pytest.raises(ValueError):
        adjust.bars_asof(b, a, JAN9, adjustment="typo")


def test_split_without_ratio_is_an_error(spark):
    b = bars(spark, [bar(1, JAN8, 1.0, utc(2020, 1, 8))])
    bad = actions(spark, [(1, "SPLIT", JAN10, None, 4.0, None)])
    with pytest.raises(Exception, match="SPLIT without a ratio"):
        adjust.adjustment_factors(b, bad, "split").collect()


def test_source_precedence(spark):
    from vintagelake.operators.actions import by_precedence, known_actions

    k = utc(2020, 1, 10)
    rows = [(1, "SPLIT", JAN10, 1.0, 2.0, None, k, s) for s in ("BOOTSTRAP", "OTHER", "SEC", "TIINGO", None)]
    a = actions(spark, rows)
    assert by_precedence(known_actions(a, JAN13)).first().source == "SEC"
    assert known_actions(a, JAN13).count() == 4


def _series(spark, closes, sec=1):
    start = D(2000, 1, 1)
    rows = [(sec, start + dt.timedelta(days=i), float(c)) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "security_id bigint, session_date date, close double")


def _column(df, col):
    return [r.x for r in df.withColumn("x", col).orderBy("session_date").collect()]


def test_returns_and_averages(spark):
    assert _column(_series(spark, [100, 110, 99]), features.simple_return(1)) == [None, pytest.approx(0.1), pytest.approx(99 / 110 - 1)]
    s = _column(_series(spark, range(1, 22)), features.sma(20))
    assert s[:19] == [None] * 19 and s[19:] == [10.5, 11.5]
    r = _column(_series(spark, range(1, 25)), features.roc(20))
    assert r[19] is None and r[20] == 20.0
    m = _column(_series(spark, range(1, 261)), features.momentum_12_1())
    assert m[251] is None and m[252] == pytest.approx(232 / 1 - 1) and m[259] == pytest.approx(239 / 8 - 1)


def test_flat_series_has_no_volatility(spark):
    df = _series(spark, [100] * 25).withColumn("r", features.log_return(1))
    v = _column(df, features.realized_vol("r"))
    assert v[:20] == [None] * 20 and v[20:] == [0.0] * 5


def _recursion(closes, span):
    a, out = 2 / (span + 1), []
    for c in closes:
        out.append(c if not out else a * c + (1 - a) * out[-1])
    return out


@pytest.mark.parametrize("n", [1, 5, 5994, 5995, 13000])
def test_ema_equals_its_recursion(spark, n):
    closes = [100 + 20 * math.sin(i / 9) + i % 7 for i in range(n)]
    got = [r.e for r in features.with_ema(_series(spark, closes), 20, "e").orderBy("session_date").collect()]
    assert got == pytest.approx(_recursion(closes, 20), rel=1e-11)


def test_gold_columns_and_knowledge(spark):
    rows = [(1, "A", D(2020, 1, 1) + dt.timedelta(days=i), utc(2020, 1, 1 + i), 10.0 + i, 5) for i in range(3)]
    df = spark.createDataFrame(rows, "security_id bigint, symbol string, session_date date, knowledge_time timestamp, close double, volume bigint")
    out = features.gold(df)
    assert out.columns == features.GOLD_COLUMNS == schemas.GOLD.names
    days = {r.session_date: r.d for r in out.withColumn("d", F.to_date("knowledge_time")).collect()}
    assert all(k == v for k, v in days.items())
    assert features.gold(df.limit(0)).count() == 0
    late = df.withColumn("knowledge_time", F.when(F.dayofmonth("session_date") == 1, F.lit(utc(2021, 1, 1))).otherwise(F.col("knowledge_time")))
    assert {r.y for r in features.gold(late, "max_inputs").select(F.year("knowledge_time").alias("y")).collect()} == {2021}


def test_nightly_months():
    assert gold_plan.months_to_emit(D(2020, 1, 3)) == [(2019, 12), (2020, 1)]
    assert gold_plan.months_to_emit(D(2020, 3, 6)) == [(2020, 3)]


def test_lookback_of_the_nightly_run_is_enough(spark):
    """Emitting one month from a bounded look-back equals the full history."""
    days = [D(2018, 1, 1) + dt.timedelta(days=i) for i in range(900)]
    days = [d for d in days if d.weekday() < 5]
    rows = [bar(1, d, 100 + 10 * math.sin(i / 5), utc(d.year, d.month, d.day, 21)) for i, d in enumerate(days)]
    b, a = bars(spark, rows), actions(spark, [(1, "SPLIT", D(2020, 3, 2), 1.0, 2.0, None)])
    ids = identifiers(spark, [(1, "AAA", D(1900, 1, 1), None)])
    start = gold_plan.nightly_plan(sessions(spark, days), D(2020, 5, 20), gold_plan.EMA_LOOKBACK).first().lookback_start
    full = gold_plan.refresh(b, a, ids, D(2020, 12, 31), months=[(2020, 5)]).orderBy("session_date").collect()
    part = gold_plan.refresh(b, a, ids, D(2020, 12, 31), start=start, months=[(2020, 5)]).orderBy("session_date").collect()
    assert len(full) == len(part) > 15
    for x, y in zip(full, part):
        assert x.momentum_12_1 is not None and x.momentum_12_1 == y.momentum_12_1
        assert x.ema20 == pytest.approx(y.ema20, rel=1e-14)


def _rebuild_rows(changes=None, drop=None, extra=None):
    days = [D(2020, 1, 2), D(2020, 1, 3), D(2020, 1, 6)]
    rows = []
    for d in days:
        if d == drop:
            continue
        kw = {"close": 1.5, "volume": 1000} | ((changes or {}).get(d) or {})
        rows.append(bar(1, d, kw["close"], utc(d.year, d.month, d.day, 21), volume=kw["volume"]))
    return rows + (extra or [])


@pytest.mark.parametrize(
    "rows, expected",
    [
        (_rebuild_rows(), dict(passed=True, coverage_missing=0, price_diffs=0, volume_diffs=0)),
        (_rebuild_rows(drop=D(2020, 1, 3)), dict(passed=False, coverage_missing=1)),
        (_rebuild_rows(extra=[bar(1, D(2020, 1, 6), 1.5, utc(2020, 1, 6, 21))]), dict(passed=False, duplicate_pairs=1)),
        (_rebuild_rows({D(2020, 1, 3): {"close": 9.9}}), dict(passed=True, price_diffs=4)),
        (_rebuild_rows({D(2020, 1, 3): {"volume": 900}}), dict(passed=True, volume_diffs=1, price_diffs=0)),
        (_rebuild_rows({D(2020, 1, 3): {"close": 1.5001}}), dict(passed=True, price_diffs=0)),
        (_rebuild_rows(extra=[bar(1, D(2020, 1, 4), 1.5, utc(2020, 1, 4, 21))]), dict(passed=False, knowledge_violations=1)),
        (_rebuild_rows(extra=[bar(2, D(2020, 1, 6), 1.5, utc(2020, 1, 6, 20))]), dict(passed=False, knowledge_violations=2)),
    ],
)
def test_rebuild(spark, rows, expected):
    cal = sessions(spark, [D(2020, 1, 2), D(2020, 1, 3), D(2020, 1, 6)])
    got = rebuild.report(bars(spark, _rebuild_rows()), bars(spark, rows), cal).first().asDict()
    assert {k: got[k] for k in expected} == expected


def test_upper_median(spark):
    old = [bar(i, D(2020, 1, 2), 1.0, utc(2020, 1, 2, 21), volume=100) for i in range(4)]
    new = [bar(i, D(2020, 1, 2), 1.0, utc(2020, 1, 2, 21), volume=100 + 10 * i) for i in range(4)]
    s = rebuild.pairs_summary(rebuild.shared_pairs(bars(spark, old), bars(spark, new))).first()
    assert s.volume_rel_median == pytest.approx(0.2) and s.volume_diffs == 3


@pytest.mark.parametrize(
    "count, size, severity, passed",
    [(0, 1000, "info", True), (7, 4_000_000, "warn", True), (10, 1000, "warn", True), (11, 1000, "error", False),
     (300, 1000, "error", False), (0, 0, "info", True), (5, 0, "warn", True)],
)
def test_anomaly_verdict(spark, count, size, severity, passed):
    df = spark.createDataFrame([(count, size, 0.01)], "anomalies bigint, batch_size bigint, fail_fraction double")
    r = quality.verdicts(df).first()
    assert (r.severity, r.passed) == (severity, passed)


def test_unknown_check_is_an_error(spark):
    counts = spark.createDataFrame([("nope", 1)], "check_name string, batch_id bigint")
    checks = spark.createDataFrame([("other", "warn", "{}", True)], "name string, severity string, spec string, enabled boolean")
    with pytest.raises(Exception, match="no enabled check"):
        quality.with_policy(counts, checks).collect()


def test_freshness_and_empty_lake(spark):
    cal = sessions(spark, [D(2020, 1, 2), D(2020, 1, 3), D(2020, 1, 6)])
    b = bars(spark, [bar(1, D(2020, 1, 3), 1.0, utc(2020, 1, 3, 21))])
    r = quality.freshness(b, cal, D(2020, 1, 31)).first()
    assert (r.sessions_behind, r.status) == (1, "current")
    r = quality.freshness(bars(spark, []), cal, D(2020, 1, 31)).first()
    assert (r.sessions_behind, r.status) == (0, "empty")


def test_gaps_stay_inside_each_window(spark):
    cal = sessions(spark, [D(2020, 1, d) for d in (2, 3, 6, 7, 8)])
    k = utc(2020, 1, 9)
    b = bars(spark, [bar(1, D(2020, 1, 3), 1.0, k), bar(1, D(2020, 1, 8), 1.0, k), bar(2, D(2020, 1, 6), 1.0, k),
                     bar(2, D(2020, 1, 4), 1.0, k), bar(3, D(2019, 12, 1), 1.0, k), bar(3, D(2020, 2, 1), 1.0, k)])
    assert pairs(quality.gaps(b, cal), "security_id", "missing") == [(1, 2), (3, 5)]
    assert quality.gap_totals(b, cal).first().interior_total == 7


def test_sessions(spark):
    cal = sessions(spark, [D(2020, 1, 2), D(2020, 1, 3), D(2020, 1, 6)])
    last = lambda now: calendar.latest_completed_session(cal, now).first().session_date
    assert last(utc(2020, 1, 3, 21)) == D(2020, 1, 3)
    assert last(utc(2020, 1, 3, 20, 59)) == D(2020, 1, 2)
    with pytest.raises(Exception, match="no completed session"):
        last(utc(2020, 3, 1))
    assert calendar.sessions_between(cal, D(2020, 1, 5), D(2020, 1, 1)).count() == 0


def test_ticker_reuse(spark):
    ids = identifiers(spark, [(1, "ZZZX", D(1990, 1, 1), D(2000, 12, 31)), (2, "ZZZX", D(2015, 1, 1), None)])
    asked = spark.createDataFrame([("zzzx", D(1995, 6, 1)), ("ZZZX", D(2005, 6, 1)), ("ZZZX", D(2020, 6, 1)), ("ZZZX", D(2000, 12, 31))], "t string, d date")
    got = {r.d.year: r.security_id for r in identity.resolve(asked, ids, "t", "d").collect()}
    assert got == {1995: 1, 2005: None, 2020: 2, 2000: None}  # the end day itself is outside
    assert surface.security_of(ids, "zzzx", D(2020, 6, 1)) == 2
    with pytest.raises(surface.NotFound):
        surface.security_of(ids, "ZZZX", D(2005, 6, 1))


def test_membership_history(spark):
    rows = [("X", 1, D(2000, 1, 1), D(2010, 1, 1), utc(2020, 1, 1)), ("X", 2, D(2005, 1, 1), None, utc(2020, 1, 1)),
            ("X", 1, D(2015, 1, 1), None, utc(2022, 1, 1))]
    m = spark.createDataFrame(rows, schemas.MEMBERSHIP)
    ids = lambda df: sorted(r.security_id for r in df.collect())
    assert ids(asof.members_asof(m, D(2008, 1, 1), "X")) == [1, 2]
    assert ids(asof.members_asof(m, D(2012, 1, 1), "X")) == [2]
    assert ids(asof.members_asof(m, D(2020, 1, 1), "X")) == [1, 2]
    assert ids(asof.members_asof_bitemporal(m, D(2020, 1, 1), D(2021, 1, 1), "X")) == [2]
    assert ids(asof.members_asof(m, D(2020, 1, 1), "NONE")) == []


def test_reads_reject_bad_ranges(spark):
    with pytest.raises(ValueError):
        surface.check_range(D(2020, 1, 2), D(2020, 1, 1))


def test_two_dividends_on_one_day(spark):
    """Each dividend has its own factor."""
    rows = bars(spark, [bar(1, D(2020, 1, 2), 100.0, utc(2020, 1, 2)), bar(1, D(2020, 1, 3), 90.0, utc(2020, 1, 3))])
    acts = actions(spark, [(1, "CASH_DIVIDEND", D(2020, 1, 3), None, None, c) for c in (10.0, 5.0)])
    got = adjust.with_factors(rows, acts, "total_return").orderBy("session_date").collect()
    assert [r.price_factor for r in got] == [pytest.approx(0.855), 1.0]
