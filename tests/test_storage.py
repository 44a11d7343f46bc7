"""Sinks, publication, plans and the stream."""

import datetime as dt
import json
import os
import random
import re
import tempfile

import pytest
from helpers import D, actions, bar, bars, identifiers, pairs, sessions, utc
from pyspark.sql import functions as F

from vintagelake import schemas, seeds, session
from vintagelake.operators import adjust, asof, calendar, identity, quality
from vintagelake.plans import capture, gold as gold_plan, health, validators
from vintagelake.sources import bronze, lake, registry_files
from vintagelake.streaming import capture as stream


def _tmp():
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


JUL30, JUL31, SUN = D(2026, 7, 30), D(2026, 7, 31), D(2026, 8, 2)


def test_month_update(spark):
    cal = sessions(spark, [JUL30, JUL31, D(2026, 8, 3)])
    path = _tmp() + "/silver"
    k = utc(2026, 7, 31)
    lake.update_month(bars(spark, [bar(1, JUL30, 100.0, k)]), cal, path, "TIINGO", 10)
    lake.update_month(bars(spark, [bar(1, JUL30, 200.0, k), bar(1, JUL31, 50.0, k)]), cal, path, "TIINGO", 11)
    assert pairs(lake.scan_bars(spark, path), "session_date", "close", "batch_id") == [(JUL30, 200.0, 11), (JUL31, 50.0, 11)]
    skipped = lake.update_month(bars(spark, [bar(1, SUN, 1.0, k)]), cal, path, "TIINGO", 12)
    assert pairs(skipped, "session_date", "reason") == [(SUN, "non_session_date")]
    assert lake.scan_bars(spark, path).count() == 2
    with pytest.raises(ValueError, match="one month"):
        lake.update_month(bars(spark, [bar(1, JUL30, 1.0, k), bar(1, D(2026, 8, 3), 1.0, k)]), cal, path, "TIINGO", 13)


def test_empty_lake_and_empty_batch(spark):
    root = _tmp()
    assert lake.scan_bars(spark, root + "/none").count() == 0
    cal = sessions(spark, [JUL30])
    skipped = lake.write_bars(bars(spark, [bar(1, SUN, 1.0, utc(2026, 8, 2))]), cal, root + "/b", "TIINGO", 1)
    assert skipped.count() == 1 and not os.path.exists(root + "/b")


def test_range_scan_reads_only_its_months(spark):
    days = [D(2020, m, 3) for m in range(1, 13)]
    path = _tmp() + "/silver"
    lake.merge_bars(bars(spark, [bar(1, d, 1.0, utc(2020, 1, 1)) for d in days]), sessions(spark, days), path, "TIINGO", 1)
    df = lake.scan_months(spark, path, schemas.BARS, D(2020, 3, 1), D(2020, 4, 30))
    assert df.count() == 2
    assert re.search(r"PartitionFilters: \[[^\]]*year", _plan(df))


def test_publication(spark):
    root = _tmp() + "/p"
    rows = bars(spark, [bar(1, JUL30, 1.0, utc(2026, 7, 30))])
    assert lake.live(spark, root, schemas.BARS).count() == 0
    lake.stage(rows, root, 1)
    assert lake.live(spark, root, schemas.BARS).count() == 0
    assert not lake.publish(spark, root, 1, False, utc(2026, 8, 1))
    assert lake.publish(spark, root, 1, True, utc(2026, 8, 1))
    lake.stage(rows.union(rows), root, 2)
    assert lake.publish(spark, root, 2, False, utc(2026, 8, 2), force_reason="known vendor gap")
    assert lake.live(spark, root, schemas.BARS).count() == 2
    assert pairs(lake.pointers(spark, root).where("reason IS NOT NULL"), "version", "reason") == [(2, "known vendor gap")]
    assert spark.read.parquet(lake.version_path(root, 1)).count() == 1  # the old version stays


def test_readers_see_a_merge_whole_or_not_at_all(spark):
    """A reader that started before a merge keeps its version, a later one has all of the new one, months of both never mix."""
    days = [D(2020, m, 3) for m in range(1, 5)]
    cal, path = sessions(spark, days), _tmp() + "/silver"
    lake.merge_bars(bars(spark, [bar(1, d, 1.0, utc(2020, 1, 1)) for d in days]), cal, path, "TIINGO", 1)
    before = lake.scan_bars(spark, path)
    written, seen = lake.snapshots.commit, []

    def watched(*args):
        # All new months are stored, but not committed: the dataset is still the old one.
        seen.append(pairs(lake.scan_bars(spark, path), "session_date", "close"))
        return written(*args)

    lake.snapshots.commit = watched
    try:
        lake.merge_bars(bars(spark, [bar(1, d, 2.0, utc(2020, 1, 1)) for d in days[1:]]), cal, path, "TIINGO", 2)
    finally:
        lake.snapshots.commit = written
    assert seen == [[(d, 1.0) for d in days]] and pairs(before, "session_date", "close") == seen[0]
    assert pairs(lake.scan_bars(spark, path), "session_date", "close") == [(days[0], 1.0), *((d, 2.0) for d in days[1:])]
    version, months = lake.snapshot(spark, path)
    assert version == 2 and sorted(months) == ["2020-01", "2020-02", "2020-03", "2020-04"]
    assert lake.snapshot(spark, path, 1)[1]["2020-01"] == months["2020-01"] != months["2020-02"]
    assert lake.vacuum_months(spark, path, keep=1) == 3
    assert pairs(lake.scan_bars(spark, path), "session_date", "close") == [(days[0], 1.0), *((d, 2.0) for d in days[1:])]


def test_a_lost_race_is_an_error_and_changes_nothing(spark):
    cal, path = sessions(spark, [JUL30, JUL31]), _tmp() + "/silver"
    k = utc(2026, 7, 31)
    lake.merge_bars(bars(spark, [bar(1, JUL30, 1.0, k)]), cal, path, "TIINGO", 1)
    written = lake.snapshots.commit

    def overtaken(*args):
        lake.snapshots.commit = written
        lake.merge_bars(bars(spark, [bar(1, JUL31, 5.0, k)]), cal, path, "TIINGO", 2)
        return written(*args)

    lake.snapshots.commit = overtaken
    try:
        with pytest.raises(lake.snapshots.LostRace):
            lake.merge_bars(bars(spark, [bar(1, JUL30, 9.0, k)]), cal, path, "TIINGO", 3)
    finally:
        lake.snapshots.commit = written
    assert pairs(lake.scan_bars(spark, path), "session_date", "close") == [(JUL30, 1.0), (JUL31, 5.0)]
    assert len([n for n in os.listdir(path) if n.startswith("part=")]) == 2 and lake.snapshot(spark, path)[0] == 2
    root = _tmp() + "/p"
    lake.stage(bars(spark, [bar(1, JUL30, 1.0, k)]), root, 1)
    lake.publish(spark, root, 1, True, utc(2026, 8, 1))
    with pytest.raises(lake.snapshots.LostRace):
        lake.snapshots.commit(spark, root + "/_published", 0, {"version": 7})
    assert pairs(lake.pointers(spark, root), "version", "published_at") == [(1, dt.datetime(2026, 8, 1))]


def test_a_batch_is_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    rows = bars(spark, [bar(1, d, 1.0, utc(2026, 7, 31)) for d in (JUL30, JUL31, SUN)]).mapInPandas(counted, schemas.BARS)
    path = _tmp() + "/b"
    skipped = lake.write_bars(rows, sessions(spark, [JUL30, JUL31]), path, "TIINGO", 1)
    assert pairs(skipped, "session_date") == [(SUN,)] and lake.scan_bars(spark, path).count() == 2 and seen.value == 3


def test_gold_of_one_security_leaves_the_others(spark):
    path = _tmp() + "/gold"
    row = lambda s, d, c: (s, "A", d, utc(2020, 1, 1), c, 1, *([None] * 8))
    lake.write_months(spark.createDataFrame([row(s, D(2020, m, 2), 1.0) for s in (1, 2) for m in (1, 2)], schemas.GOLD), path)
    lake.merge_gold(spark.createDataFrame([row(1, D(2020, 1, 2), 9.0)], schemas.GOLD), path, [(2020, 1)], [1])
    got = pairs(lake.scan_gold(spark, path), "security_id", "session_date", "adj_close")
    assert got == [(1, D(2020, 1, 2), 9.0), (1, D(2020, 2, 2), 1.0), (2, D(2020, 1, 2), 1.0), (2, D(2020, 2, 2), 1.0)]


def test_bucketed_bars_need_no_exchange(spark):
    rows = [bar(s, JUL30 - dt.timedelta(days=i), 10.0 + i, utc(2026, 7, 30)) for s in range(20) for i in range(30)]
    lake.save_bucketed(bars(spark, rows), "latest_bars_t", _tmp() + "/t", 4)
    stored = spark.table("latest_bars_t")
    ids = identifiers(spark, [(s, f"T{s}", D(2000, 1, 1), None) for s in range(20)])
    acts = actions(spark, [(1, "SPLIT", JUL30, 1.0, 2.0, None)])
    df = gold_plan.refresh(stored, acts, ids, D(2027, 1, 1))
    assert df.count() == 600
    plan = _plan(df)
    chain = plan[plan.rindex("FileScan"):]
    # between the scan and the features no row of the large table is exchanged
    above = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert "Bucketed: true" in chain
    assert not any("close" in line or "session_date" in line for line in above)
    spark.sql("DROP TABLE latest_bars_t")


def test_filters_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    path = _tmp() + "/b"
    bars(spark, [bar(1, JUL30, 1.0, utc(2026, 7, 30))]).write.parquet(path)
    plan = _plan(asof.bars_asof_raw(lake.scan_bars(spark, path), JUL31, [1, 2], start=JUL30))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)
    assert "LessThan(knowledge_time" in pushed and "In(security_id" in pushed and "GreaterThanOrEqual(session_date" in pushed
    narrow = asof.bars_asof_raw(lake.scan_bars(spark, path), JUL31).select("security_id", "session_date")
    assert "low" in _plan(narrow)  # the tie-break columns are read, and nothing else
    assert "symbol" not in re.search(r"ReadSchema: (.*)", _plan(narrow)).group(1)


def test_total_return_range_reads_only_its_months(spark):
    r = random.Random(4)
    days = [D(2018, 1, 1) + dt.timedelta(days=i) for i in range(0, 900, 3)]
    rows = [bar(s, d, r.uniform(5, 9), utc(d.year, d.month, d.day, 21) + dt.timedelta(days=r.randrange(4))) for s in (1, 2) for d in days]
    acts = actions(spark, [
        (r.choice([1, 2]), "SPLIT", d, 1.0, 2.0, None) if r.random() < 0.5 else (r.choice([1, 2]), "CASH_DIVIDEND", d, None, None, 0.25)
        for d in r.sample([D(2018, 1, 1) + dt.timedelta(days=i) for i in range(900)], 30)])
    path, as_of = _tmp() + "/months", D(2020, 5, 1)
    lake.write_months(bars(spark, rows), path)
    whole = adjust.bars_asof(bars(spark, rows), acts, as_of, start=D(2019, 3, 5), end=D(2019, 6, 9), adjustment="total_return")
    segments = session.stored(adjust.total_return_segments(bars(spark, rows), acts, as_of))
    some = lake.scan_months(spark, path, schemas.BARS, D(2019, 3, 5), D(2019, 6, 9))
    got = adjust.bars_asof(some, None, as_of, start=D(2019, 3, 5), end=D(2019, 6, 9), adjustment="total_return", segments=segments)
    assert re.search(r"PartitionFilters: \[[^\]]*year", _plan(got))
    key = ("security_id", "session_date", "close", "volume")
    want, have = pairs(whole, *key), pairs(got, *key)
    assert len(have) == len(want) > 50 and all(
        a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-12) and a[3] == pytest.approx(b[3], abs=1) for a, b in zip(have, want, strict=True))
    with pytest.raises(Exception, match="factors are stored as of"):
        adjust.bars_asof(some, None, D(2020, 5, 2), adjustment="total_return", segments=segments).collect()


def test_pages_together_are_the_whole_table(spark):
    r = random.Random(6)
    stamps = [None, *(dt.datetime(2020, 1, 1, h) for h in range(5))]
    rows = [(i, r.choice(stamps), r.choice(["failed", "succeeded"])) for i in range(230)]
    r.shuffle(rows)
    path = _tmp() + "/batches"
    spark.createDataFrame(rows, "batch_id bigint, started_at timestamp, status string").write.parquet(path)
    table = spark.read.parquet(path)
    for failed in (False, True):
        seen, before = [], None
        while True:
            page = health.recent_jobs(table, 40, failed, before).collect()
            if not page:
                break
            seen += [p.batch_id for p in page]
            before = (page[-1].started_at, page[-1].batch_id)
        want = [x for x in rows if not failed or x[2] == "failed"]
        assert seen == [x[0] for x in sorted(want, key=lambda x: (x[1] or dt.datetime.min, x[0]), reverse=True)]
    assert "LessThan(started_at" in _plan(health.recent_jobs(table, 40, False, (dt.datetime(2020, 1, 1, 2), 9)))
    results = table.selectExpr("batch_id AS result_id", "batch_id", "started_at AS run_at", "status = 'failed' AS passed", "'c' AS check_name", "'{}' AS observed", "'d' AS details")
    checks = spark.createDataFrame([("c",)], "name string")
    first = health.recent_dq(results, checks, 150).collect()
    rest = health.recent_dq(results, checks, 150, before=(first[-1].run_at, first[-1].result_id)).collect()
    assert len({x.result_id for x in first + rest}) == 230


def test_nightly_reads_only_the_look_back(spark):
    days = [D(2018, 1, 1) + dt.timedelta(days=i) for i in range(0, 900, 3)]
    path = _tmp() + "/months"
    lake.write_months(bars(spark, [bar(1, d, 1.0, utc(d.year, d.month, d.day)) for d in days]), path)
    cal = sessions(spark, days)
    ids, acts = identifiers(spark, [(1, "A", D(2000, 1, 1), None)]), actions(spark, [(1, "SPLIT", days[-1], 1.0, 2.0, None)])
    start = gold_plan.nightly_plan(cal, D(2020, 6, 15), 20).first().lookback_start
    rows = gold_plan.nightly(lake.scan_months(spark, path, schemas.BARS, start), acts, ids, cal, D(2020, 6, 15), lookback=20)
    assert {(r.session_date.year, r.session_date.month) for r in rows.collect()} == {(2020, 6)}
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", _plan(rows)).group(1)
    assert "year" in filters and "month" in filters


def test_registry_files(spark):
    root = _tmp()
    with open(root + "/m.csv", "w") as f:
        f.write("ticker,security_type\n aapl ,\nspy,etf\n,\n")
    rows = registry_files.read_csv(spark, root + "/m.csv", registry_files.MANIFEST_COLUMNS)
    got = pairs(registry_files.manifest(rows), "ticker", "security_type", "valid_from")
    assert got == [("AAPL", "EQUITY", None), ("SPY", "ETF", None)]
    assert registry_files.read_csv(spark, root + "/none.csv", ["ticker"]).count() == 0


def _vendor_json(day, close=10.0):
    return {"date": f"{day}T00:00:00.000Z", "open": close, "high": close, "low": close, "close": close, "volume": 7}


def test_vendor_documents(spark):
    rows = [_vendor_json("2020-08-28", 500.0), {"open": 1}, {**_vendor_json("2020-08-31"), "open": None},
            {**_vendor_json("2020-08-31"), "volume": None}, {**_vendor_json("2020-08-31"), "high": "x"},
            {k: v for k, v in _vendor_json("2020-08-31").items() if k != "low"}, {**_vendor_json("2020-08-31"), "volume": "n"}]
    df = spark.createDataFrame([(1, "A", json.dumps(rows))], "security_id bigint, symbol string, text string")
    good, bad = bronze.vendor_bars(df)
    assert pairs(good, "close", "volume") == [(10.0, 0), (500.0, 7)]
    assert sorted(r.reason for r in bad.collect()) == [
        "malformed_row:KeyError", "malformed_row:TypeError", "malformed_row:ValueError", "malformed_row:ValueError", "missing_date"]


def test_replay_takes_the_later_fetch(spark):
    def doc(name, at, close, symbol="AAA"):
        page = {"bars": {symbol: [{"t": "2020-01-02T05:00:00Z", "o": 1, "h": 1, "l": 1, "c": close, "v": 10, "n": 1, "vw": 1}]}}
        return (name, json.dumps({"fetched_at": at, "pages": [page]}))

    docs = spark.createDataFrame([doc("b", "2020-01-03", 9.99), doc("a", "2020-01-02", 1.5), doc("c", "2020-01-09", 3.0, "ZZZ")], "doc string, text string")
    ids = spark.createDataFrame([("AAA", 1)], "symbol string, security_id bigint")
    assert pairs(capture.replay(docs, ids), "security_id", "close") == [(1, 9.99)]


def test_silver_ahead_of_the_calendar_aborts(spark):
    cal = sessions(spark, [JUL30, JUL31])
    ids = identifiers(spark, [(1, "A", D(2000, 1, 1), None)])
    late = bars(spark, [bar(1, D(2026, 8, 3), 1.0, utc(2026, 8, 3))])
    with pytest.raises(Exception, match="lie after"):
        capture.capture_plan(late, cal, ids, utc(2026, 8, 1)).collect()
    ok = capture.capture_plan(bars(spark, [bar(1, JUL30, 1.0, utc(2026, 7, 30))]), cal, ids, utc(2026, 8, 1)).first()
    assert (ok.last_stored, ok.latest, ok.sessions_due, ok.active, ok.expected_bars) == (JUL30, JUL31, 1, 1, 1)


def test_stream_capture(spark):
    root = _tmp()
    inbox, silver, dq, cp = (f"{root}/{n}" for n in ("inbox", "silver", "dq", "cp"))
    os.makedirs(inbox)
    cal = sessions(spark, [JUL30, JUL31])
    ids = identifiers(spark, [(1, "AAA", D(2000, 1, 1), None), (2, "BBB", D(2000, 1, 1), None)])
    checks = seeds.dq_checks(spark)

    def put(name, symbol, rows):
        with open(f"{inbox}/{name}.json", "w") as f:
            json.dump({"symbol": symbol, "rows": rows}, f)

    def run(checkpoint=cp):
        q = stream.start(spark, inbox, ids, cal, checks, silver, dq, checkpoint, JUL31)
        q.awaitTermination(120)
        assert q.exception() is None

    put("1", "AAA", [_vendor_json("2026-07-30", 10.0), _vendor_json("2026-08-01", 1.0), {"open": 1}])
    put("2", "NOPE", [_vendor_json("2026-07-30", 10.0)])
    run()
    put("3", "BBB", [_vendor_json("2026-07-31", 20.0)])
    put("4", "AAA", [_vendor_json("2026-07-30", 11.0)])
    run()
    assert pairs(lake.scan_bars(spark, silver), "security_id", "session_date", "close") == [(1, JUL30, 11.0), (2, JUL31, 20.0)]
    first = spark.read.parquet(dq).where("batch_id = 1")
    assert pairs(first, "check_name", "passed") == [("bars_malformed_row", False), ("bars_non_session_date", False)]
    run()  # nothing new
    assert lake.scan_bars(spark, silver).count() == 2
    # A run with a new checkpoint takes later ids: its bars win, and earlier quality rows stay.
    for name in ("1", "2", "3", "4"):
        os.remove(f"{inbox}/{name}.json")
    put("5", "AAA", [_vendor_json("2026-07-30", 12.0)])
    run(f"{root}/cp2")
    assert pairs(lake.scan_bars(spark, silver), "security_id", "close", "batch_id") == [(1, 12.0, 3), (2, 20.0, 2)]
    assert spark.read.parquet(dq).select("batch_id").distinct().count() == 3


def _counts(results):
    return sorted(
        (r.check_name, r.batch_id, json.loads(r.observed)["count"], json.loads(r.observed)["batch_size"], json.loads(r.observed)["sample"])
        for r in results.collect()
    )


def test_capture_counts_rows_without_a_date(spark):
    cal = sessions(spark, [D(2026, 7, 29), JUL30, JUL31])
    ids = identifiers(spark, [(1, "AAA", D(2000, 1, 1), None)])
    rows = [_vendor_json("2026-07-30", 10.0), _vendor_json("2026-07-31", 11.0), {"open": 1}, {**_vendor_json("2026-07-31"), "open": None},
            _vendor_json("2026-07-29", 9.0)]
    docs = spark.createDataFrame([("AAA", json.dumps(rows))], "symbol string, text string")
    path = _tmp() + "/silver"
    before = set(os.listdir(session.shared_root(spark)))
    got, counted = capture.capture_sessions(docs, ids, cal, seeds.dq_checks(spark), path, [JUL30, JUL31], 7)
    assert [c[:4] for c in _counts(got)] == [
        ("bars_malformed_row", 7, 1, 1), ("bars_malformed_row", 8, 1, 1), ("bars_non_session_date", 7, 0, 1), ("bars_non_session_date", 8, 0, 1)]
    assert pairs(counted, "batch_id", "parsed", "kept", "refused", "already_stored") == [(7, 3, 1, 1, 1), (8, 2, 1, 1, 0)]
    assert pairs(lake.scan_bars(spark, path), "session_date", "close", "batch_id") == [(JUL30, 10.0, 7), (JUL31, 11.0, 8)]
    left = {n for n in set(os.listdir(session.shared_root(spark))) - before if n.split("-")[0] in ("parsed", "stamped", "months")}
    assert not left  # scratch folders are deleted
    wide = capture.backfill(docs, ids, cal, seeds.dq_checks(spark), _tmp() + "/v", 1, 5)
    assert wide[0].count() == 3 and [c[2] for c in _counts(wide[1])] == [2, 0]


def test_capture_counts_weekend_bars(spark):
    """Friday to Monday, sessions on Friday and Monday: the weekend's bars are counted with Monday."""
    friday, monday = D(2024, 1, 5), D(2024, 1, 8)
    cal = sessions(spark, [D(2024, 1, 4), friday, monday])
    ids = identifiers(spark, [(1, "AAA", D(2000, 1, 1), None)])
    days = ["2024-01-05", "2024-01-06", "2024-01-07", "2024-01-08"]
    docs = spark.createDataFrame([("AAA", json.dumps([_vendor_json(d) for d in days]))], "symbol string, text string")
    path = _tmp() + "/silver"
    got, counted = capture.capture_sessions(docs, ids, cal, seeds.dq_checks(spark), path, [friday, monday], 1)
    off = [c for c in _counts(got) if c[0] == "bars_non_session_date"]
    assert [c[1:4] for c in off] == [(1, 0, 1), (2, 2, 3)]
    assert off[1][4] == ["AAA 2024-01-06 non_session_date", "AAA 2024-01-07 non_session_date"]
    assert pairs(lake.scan_bars(spark, path), "session_date", "batch_id") == [(friday, 1), (monday, 2)]
    assert pairs(counted, "batch_id", "parsed", "kept", "non_session") == [(1, 1, 1, 0), (2, 3, 1, 2)]


def test_every_parsed_row_has_one_batch_and_one_state(spark):
    """All days around a due range with a gap, readable and broken, outside the calendar too."""
    cal = [d for d in (D(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)) if d.weekday() < 5]
    due = [D(2024, 1, 10), D(2024, 1, 11), D(2024, 1, 16), D(2024, 1, 17)]
    days = [D(2023, 12, 20) + dt.timedelta(days=i) for i in range(80)] + [D(1950, 1, 1), D(2040, 1, 1)]
    rows = [(d, None) for d in days] + [(d, "malformed_row:ValueError") for d in days] + [(None, "missing_date")] * 3
    frame = spark.createDataFrame(rows, "session_date date, reason string")
    got = capture.assigned(frame, sessions(spark, cal), due, 50).collect()
    assert len(got) == len(rows)

    def plain(day, reason):
        batch = 50 + next((i for i, d in enumerate(due) if day is None or d >= day), len(due) - 1)
        after = None if day is None else next((d for d in cal if d >= day), None)
        if day is not None and day.year >= 1962 and day < due[0] and after is not None and after < due[0]:
            return batch, "already_stored"
        if reason:
            return batch, "refused"
        if day not in cal:
            return batch, "non_session"
        return batch, "kept" if day in due else "not_due"

    key = lambda x: (str(x[0]), str(x[1]), x[2], x[3])
    assert sorted(((r.session_date, r.reason, r.batch_id, r.state) for r in got), key=key) == sorted(
        ((d, s, *plain(d, s)) for d, s in rows), key=key)
    counted = capture.accounts(capture.assigned(frame, sessions(spark, cal), due, 50), [50, 51, 52, 53, 54]).collect()
    assert all(r.parsed == sum(r[s] for s in capture.STATES) for r in counted) and sum(r.parsed for r in counted) == len(rows)
    assert {r.batch_id: r.parsed for r in counted}[54] == 0


def test_sessions_outside_the_calendar_are_an_error(spark):
    cal = sessions(spark, [JUL30, D(2031, 1, 2)])
    with pytest.raises(Exception, match="outside the calendar"):
        calendar.bounded(cal).collect()


def test_each_exchange_has_its_own_sessions(spark):
    """Closes, holidays and listings by exchange: two listings, a move, an overlap, no listing, no session."""
    day, next_day = D(2024, 5, 24), D(2024, 5, 27)  # 27 May 2024: both exchanges rest; XPAR does not
    cal = spark.createDataFrame(
        [("XNYS", day, utc(2024, 5, 24, 20)), ("XLON", day, utc(2024, 5, 24, 15)), ("XPAR", next_day, utc(2024, 5, 27, 15))],
        "exchange string, session_date date, close_utc timestamp")
    listed = spark.createDataFrame(
        [(1, "XNYS", D(2000, 1, 1), None), (2, "XLON", D(2000, 1, 1), None), (3, "XNYS", D(2000, 1, 1), None),
         (3, "XLON", D(2024, 1, 1), None), (4, "XLON", D(2000, 1, 1), D(2024, 5, 24)), (5, "XPAR", D(2000, 1, 1), None)],
        "security_id bigint, exchange string, valid_from date, valid_to date")
    rows = bars(spark, [bar(s, d, 1.0, utc(2024, 6, 1)) for s in range(1, 7) for d in (day, next_day)]).drop("knowledge_time")

    def hours(home):
        kept, skipped = calendar.stamp_knowledge(rows, cal, listed, home)
        assert "exchange" not in kept.columns
        got = {(r.security_id, r.session_date): r.h for r in kept.withColumn("h", F.hour("knowledge_time")).collect()}
        assert len(got) + skipped.count() == 12
        return got

    own = {(1, day): 20, (2, day): 15, (3, day): 15, (5, next_day): 15}
    assert hours(None) == own
    assert hours("XNYS") == own | {(4, day): 20, (6, day): 20}  # 4 was delisted that day, 6 never listed
    with pytest.raises(Exception, match="several exchanges"):
        calendar.bounded(cal).collect()
    assert calendar.bounded(calendar.of_exchange(cal, "XLON")).count() == 1


def test_vendor_check_sends_each_row_once(spark):
    """Bars, actions and vendor rows meet in one partitioning; an action at the first bar or after the last is a boundary."""
    days = [D(2024, 1, 1) + dt.timedelta(days=i) for i in range(30)]
    root = _tmp()
    bars(spark, [bar(1, d, 100.0 if d < days[10] else 50.0, utc(2024, 1, d.day, 21)) for d in days[2:20]]).write.parquet(root + "/b")
    acts = [(1, "SPLIT", days[10], 1.0, 2.0, None), (1, "CASH_DIVIDEND", days[2], None, None, 1.0)]
    actions(spark, acts).write.parquet(root + "/a")
    rows = [(1, d, 100.0 if d < days[10] else 50.0, 50.0, 2.0 if d in (days[10], days[25]) else 1.0, 1.0 if d == days[2] else 0.0) for d in days]
    kind = "security_id bigint, session_date date, close double, adj_close double, split_factor double, div_cash double"
    spark.createDataFrame(rows, kind).write.parquet(root + "/v")
    out = validators.against_vendor(*(spark.read.parquet(f"{root}/{x}") for x in "bav"), D(2024, 12, 31))
    r = out.first()
    assert (r.raw_n, r.adj_n, r.expected, r.applicable, r.boundary, r.retrieved) == (18, 18, 3, 1, 2, 2)
    assert r.raw_max == 0.0
    assert r.adj_max == pytest.approx(0.0, abs=1e-12) and r.passed
    assert _plan(out).split("Initial Plan")[0].count("Exchange hashpartitioning") <= 4


def test_shared_folder_follows_the_setting(spark):
    assert session.scratch(spark, "x").startswith(session.shared_root(spark))


def test_vendor_rows_compile(spark):
    """Methods of more than 8,000 bytes are never compiled by the JVM; such a plan took three times as long."""
    docs = spark.range(10).selectExpr("id AS security_id", "concat('S', id) AS symbol", "concat('[{\"date\": \"', id, '\"}]') AS text")
    for rows in (bronze.vendor_rows(docs), *bronze.vendor_bars(docs)):
        text = spark._jvm.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
        assert sizes and max(sizes) < 8000


def test_vendor_causes_come_in_order(spark):
    fields = {"date": "2020-01-02", "open": "1", "high": "2", "low": "0.5", "close": "1.5", "volume": "7.9"}
    cases = [
        ({}, None), ({"date": None}, "missing_date"), ({"date": ""}, "missing_date"), ({"date": "2020-13-01"}, "ValueError"),
        ({"high": None, "low": "x"}, "TypeError"), ({"open": "x", "high": None}, "ValueError"), ({"close": "NaN"}, "ValueError"),
        ({"volume": None}, None), ({"volume": ""}, None), ({"volume": "x"}, "ValueError"), ({"volume": "x", "close": None}, "TypeError"),
    ]
    rows = [(n, "S", json.dumps([fields | change])) for n, (change, _) in enumerate(cases)]
    without = {k: v for k, v in fields.items() if k != "low"}
    rows.append((len(rows), "S", json.dumps([without | {"close": None}])))
    docs = spark.createDataFrame(rows, "security_id long, symbol string, text string")
    want = [c if c in (None, "missing_date") else f"malformed_row:{c}" for c in (*(c for _, c in cases), "KeyError")]
    assert [r.reason for r in bronze.vendor_rows(docs).orderBy("security_id").collect()] == want
    good, bad = bronze.vendor_bars(docs)
    assert sorted(r.security_id for r in good.collect()) == [n for n, c in enumerate(want) if c is None]
    assert sorted(r.reason for r in bad.collect()) == sorted(c for c in want if c)


def test_documents_are_read_once_to_resolve_them(spark):
    """Symbols resolve with the documents themselves: no pass for their distinct symbols and no exchange of texts."""
    root = _tmp()
    spark.range(50).selectExpr("concat('A', id % 5) AS symbol", "'[]' AS text").write.parquet(root + "/docs")
    identifiers(spark, [(n, f"A{n}", D(2000, 1, 1), None) for n in range(3)]).write.parquet(root + "/ids")
    docs, ids = (spark.read.parquet(f"{root}/{n}") for n in ("docs", "ids"))
    for found in (identity.resolve_batch(docs, ids, D(2020, 1, 1))[0], identity.resolve_any_time(docs, ids)[0]):
        assert found.columns == ["symbol", "text", "security_id"] and found.count() == 30
        assert _plan(found).count("docs") == 1


def test_other_taxonomies_are_not_converted(spark):
    entry = {"end": "2020-03-31", "val": 7, "accn": "A", "fy": 2020, "fp": "Q1", "form": "10-Q", "filed": "2020-05-01"}
    facts = {"dei": {"X": 5, "Y": {"units": "none"}}, "us-gaap": {"Assets": {"units": {"USD": [entry]}}}}
    docs = spark.createDataFrame([(1, json.dumps({"cik": 12, "facts": facts}))], "security_id long, text string")
    assert pairs(bronze.company_facts(docs), "tag", "unit", "value") == [("Assets", "USD", 7.0)]
    assert "dei" not in schemas.COMPANY_FACTS_JSON and "`us-gaap`" in schemas.COMPANY_FACTS_JSON


def test_paged_documents_are_parsed_once(spark):
    """No filter made for an explode parses a document again; rows, order and columns stay."""
    root = _tmp() + "/docs"
    bar_of = lambda t, c: {"t": t, "o": c, "h": c, "l": c, "c": c, "v": 5.0, "n": 1, "vw": c}
    pages = [{"bars": {"A": [bar_of(None, 1.0), bar_of("2020-01-02T05:00:00Z", 2.0)]}}, {"bars": {}}, {"bars": None}]
    texts = [json.dumps({"fetched_at": "2020-01-03", "pages": pages}), json.dumps({"fetched_at": "x", "pages": None}), "{", None]
    spark.createDataFrame([(f"d{n}", t) for n, t in enumerate(texts)], "doc string, text string").write.parquet(root)
    rows = bronze.paged_bars(spark.read.parquet(root))
    assert pairs(rows, "doc", "fetched_at", "page", "entry", "symbol", "close") == [("d0", "2020-01-03", 0, 1, "A", 2.0)]
    for some in (rows, rows.select("symbol", "close", "page"), rows.select("symbol")):
        assert _plan(some).count("from_json") == 1


def test_results_of_few_checks_are_not_gathered_by_name(spark, monkeypatch):
    path = _tmp() + "/results"
    spark.range(400).selectExpr(
        "id AS result_id", "concat('c', id % 4) AS check_name", "id AS batch_id", "timestamp_seconds(id) AS run_at",
        "false AS passed", "'{}' AS observed", "'d' AS details",
    ).write.parquet(path)
    checks = spark.createDataFrame([("c1",), ("c3",), ("c3",)], "name string")
    want = [n for n in reversed(range(400)) if n % 2][:50]
    few = health.recent_dq(spark.read.parquet(path), checks)
    assert [r.result_id for r in few.collect()] == want
    assert "SortMergeJoin" not in _plan(few)
    monkeypatch.setattr(health, "MAX_SENT", 1)  # more names than may be sent
    assert [r.result_id for r in health.recent_dq(spark.read.parquet(path), checks).collect()] == want


def test_stored_rows_hold_what_is_read_of_their_state(spark):
    """Bars of kept rows, causes of refused ones; the others keep whose day they are."""
    texts = [[_vendor_json("2026-07-30")], [{**_vendor_json("2026-07-30"), "open": None}], [_vendor_json("2026-08-01")]]
    docs = spark.createDataFrame([(n, "A", json.dumps(t)) for n, t in enumerate(texts)], "security_id long, symbol string, text string")
    rows = capture.graded(capture.parsed_rows(docs), sessions(spark, [JUL30, JUL31]))
    held, path = capture.stored_rows(rows)
    assert held.columns == rows.columns and held.count() == 3
    got = {r.state: r for r in held.collect()}
    assert {s: (r.close, r.volume is None, r.raw_date, r.reason) for s, r in got.items()} == {
        "kept": (10.0, False, None, None), "refused": (None, True, "2026-07-30", "malformed_row:TypeError"), "non_session": (None, True, None, None),
    }
    assert {r.session_date for r in got.values()} == {JUL30, D(2026, 8, 1)}
    session.discard(spark, path)


def test_heads_of_anomalies_are_compiled(spark):
    """No function is interpreted for each row; a row with several flags counts for each."""
    root = _tmp() + "/rows"
    spark.range(90).selectExpr(
        "id % 2 AS batch_id", "concat('l', lpad(id, 2, '0')) AS label", "id % 3 = 0 AS a", "CASE WHEN id % 5 > 0 THEN id % 5 = 1 END AS b"
    ).write.parquet(root)
    counts = quality.anomaly_counts(spark.read.parquet(root), ["a", "b"], sample=3)
    assert "lambda" not in _plan(counts)
    want = []
    for name, hit in (("a", lambda n: n % 3 == 0), ("b", lambda n: n % 5 == 1)):
        for batch in (0, 1):
            found = [n for n in range(90) if hit(n) and n % 2 == batch]
            want.append((name, batch, 45, len(found), [f"l{n:02d}" for n in found[:3]]))
    assert pairs(counts, "check_name", "batch_id", "batch_size", "anomalies", "sample") == want


def test_next_session_is_found_in_one_pass(spark):
    """A frame up to the end of the calendar is read again for each of its days."""
    days = calendar.next_sessions(sessions(spark, [D(2024, 1, 5), D(2024, 1, 8)]))
    assert "unboundedfollowing" not in _plan(days).lower()
    got = {r.day: r.next_session for r in days.where("day >= DATE'2024-01-04'").collect()}
    assert got == {D(2024, 1, 4): D(2024, 1, 5), D(2024, 1, 5): D(2024, 1, 5), **{D(2024, 1, n): D(2024, 1, 8) for n in (6, 7, 8)}}


def test_odd_numbers_and_days(spark):
    texts = ["1", "+1.5", " -.5 ", "1.", "1e3", "\t2\n", "1E-2", "", " ", "NaN", "inf", "1d", "1f", "0x1p3", "1 2", "--1", "1e", ".", "1,5", "\u00011"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(bronze.number(F.col("t")).alias("n")).collect()
    assert [r.n for r in rows] == [1.0, 1.5, -0.5, 1.0, 1000.0, 2.0, 0.01, *[None] * 13]
    days = ["2024-02-29", "2023-02-29", "2024-13-01", "2024-00-10", "2024-01-32", "2024-1-1", "20240101", " 2024-01-01", "2024-01-01T"]
    rows = spark.createDataFrame([(t,) for t in days], "t string").select(bronze.iso_day(F.col("t")).alias("d")).collect()
    assert [r.d for r in rows] == [D(2024, 2, 29), *[None] * 8]


def test_self_contained_reads_the_vendor_once(spark):
    """Splits and dividends are counted where prices are adjusted; both ranks of the errors come from one table."""
    days = [D(2024, 1, 1) + dt.timedelta(days=i) for i in range(12)]
    kind = "security_id bigint, session_date date, close double, adj_close double, split_factor double, div_cash double"
    rows = [(s, d, 10.0, 10.0 if d >= days[6] else 5.0, 2.0 if d == days[6] else 1.0, 0.5 if s == 2 and d == days[9] else 0.0) for s in (1, 2) for d in days]
    root = _tmp()
    spark.createDataFrame(rows, kind).write.parquet(root + "/v")
    out = validators.self_contained(spark.read.parquet(root + "/v"))
    plan = _plan(out).split("Initial Plan")[0]
    assert plan.count("FileScan parquet") == 1 and "Join" not in plan
    assert len(re.findall(r"sequence\(1, 1000|\[1\.0,2\.0,3\.0", plan)) <= 1  # one search for each row
    assert pairs(out, "security_id", "splits", "dividends", "split_n", "total_n") == [(1, 1, 0, 12, 12), (2, 1, 1, 12, 12)]
    assert out.where("security_id = 1").first().passed
