"""Calendar, ingest, sinks and adjustment oracles."""

import datetime as dt

from pyspark.sql import functions as F

from vintagelake import schemas, seeds, session
from vintagelake.checks.families.asof import BAR_SQL
from vintagelake.checks.families.features import GOLD_SQL, refreshed, rounded_gold
from vintagelake.checks.registry import check
from vintagelake.checks.views import AS_OF, SQL_VIEWS, Views, settle, settle_sql
from vintagelake.operators import asof, calendar, stats
from vintagelake.operators.select import first_per_key
from vintagelake.plans import capture, validators
from vintagelake.sources import bronze, lake
from vintagelake.streaming import capture as stream

NOW = dt.datetime(2000, 6, 30, 20, tzinfo=dt.timezone.utc)
_DAY = "CAST(session_date AS VARCHAR) AS session_date"


@check(
    "cal_sessions",
    f"SELECT {_DAY}, strftime(close_utc, '%Y-%m-%d %H:%M:%S') AS close_utc, is_half_day FROM sessions",
)
def _(v: Views):
    path = session.scratch(v.spark, "sessions")
    v.sessions.write.parquet(path)
    return lake.scan_sessions(v.spark, path).select("session_date", "close_utc", "is_half_day")


@check(
    "cal_knowledge_time",
    f"""SELECT b.security_id, CAST(b.session_date AS VARCHAR) AS session_date, b.batch_id, b.close,
          strftime(s.close_utc, '%Y-%m-%d %H:%M:%S') AS knowledge_time FROM bars b JOIN sessions s USING (session_date)""",
)
def _(v: Views):
    kept, _ = calendar.stamp_knowledge(v.bars, v.sessions)
    return kept.select("security_id", "session_date", "batch_id", "close", "knowledge_time")


# A second exchange that closes earlier, trades on New Year and rests on Boxing Day; a third of the securities moved there,
# a third is listed there from the start, the rest has no listing and trades at the home exchange.
SQL_VIEWS["exchange_sessions"] = """
    SELECT 'XNYS' AS exchange, session_date, close_utc FROM sessions UNION ALL
    SELECT 'XLON', d, d + INTERVAL 990 MINUTE FROM (SELECT CAST(unnest(generate_series(
        CAST(min(l_shipdate) AS DATE), CAST(max(l_shipdate) AS DATE), INTERVAL 1 DAY)) AS DATE) AS d FROM lineitem)
    WHERE isodow(d) < 6 AND NOT (month(d) = 12 AND day(d) IN (25, 26))"""
SQL_VIEWS["listings"] = """
    SELECT s_suppkey AS security_id, DATE '1998-07-01' AS moved, s_suppkey % 3 AS kind FROM supplier"""
SQL_VIEWS["listed_bars"] = """
    SELECT b.*, CASE WHEN l.kind = 0 OR (l.kind = 1 AND b.session_date >= l.moved) THEN 'XLON' ELSE 'XNYS' END AS exchange
    FROM bars b LEFT JOIN listings l USING (security_id)"""


def _exchanges(v: Views):
    span = v.table("lineitem").selectExpr("CAST(min(l_shipdate) AS DATE) AS lo", "CAST(max(l_shipdate) AS DATE) AS hi")
    london = span.selectExpr("explode(sequence(lo, hi)) AS session_date").where(
        "weekday(session_date) < 5 AND NOT (month(session_date) = 12 AND day(session_date) IN (25, 26))"
    )
    closes = london.selectExpr("'XLON' AS exchange", "session_date", "CAST(session_date AS TIMESTAMP) + INTERVAL 990 MINUTE AS close_utc")
    return v.sessions.selectExpr("'XNYS' AS exchange", "session_date", "close_utc").unionByName(closes)


def _listings(v: Views):
    # The old listing of a security that moved stays open; the later one counts.
    return v.table("supplier").where("s_suppkey % 3 < 2").selectExpr(
        "s_suppkey AS security_id",
        """explode(CASE WHEN s_suppkey % 3 = 0 THEN array(struct('XLON' AS exchange, DATE'1980-01-01' AS valid_from))
           ELSE array(struct('XNYS' AS exchange, DATE'1980-01-01' AS valid_from),
                      struct('XLON' AS exchange, DATE'1998-07-01' AS valid_from)) END) AS l""",
    ).select("security_id", "l.*", F.lit(None).cast("date").alias("valid_to"))


@check(
    "cal_knowledge_time_listed",
    f"""SELECT b.security_id, b.exchange, {_DAY.replace('session_date', 'b.session_date', 1)}, b.batch_id, b.close,
          strftime(s.close_utc, '%Y-%m-%d %H:%M:%S') AS knowledge_time
        FROM listed_bars b JOIN exchange_sessions s ON s.exchange = b.exchange AND s.session_date = b.session_date""",
)
def _(v: Views):
    bars = v.bars.withColumn("exchange", F.lit(None).cast("string"))
    kept, _ = calendar.stamp_knowledge(bars, _exchanges(v), _listings(v), home="XNYS")
    return kept.select("security_id", "exchange", "session_date", "batch_id", "close", "knowledge_time")


@check(
    "cal_non_session_listed",
    f"""SELECT b.security_id, b.symbol, {_DAY.replace('session_date', 'b.session_date', 1)}, 'non_session_date' AS reason FROM listed_bars b
        ANTI JOIN exchange_sessions s ON s.exchange = b.exchange AND s.session_date = b.session_date""",
)
def _(v: Views):
    return calendar.stamp_knowledge(v.bars, _exchanges(v), _listings(v), home="XNYS")[1]


@check(
    "cal_non_session_bars",
    f"SELECT security_id, symbol, {_DAY}, 'non_session_date' AS reason FROM bars ANTI JOIN sessions USING (session_date)",
)
def _(v: Views):
    return calendar.stamp_knowledge(v.bars, v.sessions)[1]


@check(
    "cal_latest_completed",
    "SELECT CAST(max(session_date) AS VARCHAR) AS session_date FROM sessions WHERE close_utc <= TIMESTAMP '2000-06-30 20:00:00'",
)
def _(v: Views):
    return calendar.latest_completed_session(v.sessions, NOW)


@check(
    "cal_between",
    f"SELECT {_DAY} FROM sessions WHERE session_date BETWEEN DATE '1999-12-20' AND DATE '2000-01-10'",
)
def _(v: Views):
    return calendar.sessions_between(v.sessions, dt.date(1999, 12, 20), dt.date(2000, 1, 10)).select("session_date")


@check(
    "cal_upsert",
    f"""SELECT 'XNYS' AS exchange, {_DAY}, CASE WHEN year(session_date) >= 2000 THEN true ELSE is_half_day END AS is_half_day
        FROM sessions""",
)
def _(v: Views):
    old = v.sessions.select(F.lit("XNYS").alias("exchange"), "session_date", "is_half_day")
    new = old.where("year(session_date) >= 2000").withColumn("is_half_day", F.lit(True))
    return calendar.upsert_sessions(calendar.upsert_sessions(old, new), new)


@check(
    "cal_exchange_upsert",
    """SELECT 'X' || n_nationkey AS mic, CASE WHEN n_regionkey > 2 THEN 'new ' ELSE '' END || n_name AS name FROM nation""",
)
def _(v: Views):
    old = v.table("nation").selectExpr("concat('X', n_nationkey) AS mic", "n_name AS name")
    new = v.table("nation").where("n_regionkey > 2").selectExpr(
        "concat('X', n_nationkey) AS mic", "concat('new ', n_name) AS name"
    )
    return calendar.upsert_exchanges(old, new)


# Paged documents: two fetches per order line; the second, later one carries a changed close.
SQL_VIEWS["pages_src"] = """
    SELECT 'S' || l_suppkey AS symbol, l_suppkey AS security_id, CAST(l_shipdate AS DATE) AS session_date, l_orderkey AS doc,
      l_linenumber AS line, l_extendedprice AS close, l_quantity AS qty FROM lineitem"""


def _paged(v: Views):
    bar = lambda t, c: (
        f"named_struct('t', {t}, 'o', {c}, 'h', {c}, 'l', {c}, 'c', {c}, 'v', l_quantity, 'n', 1L, 'vw', {c})"
    )
    day = "concat(CAST(CAST(l_shipdate AS DATE) AS STRING), 'T05:00:00Z')"
    first = f"named_struct('bars', map(concat('S', l_suppkey), array({bar(day, 'l_extendedprice')}, {bar('CAST(NULL AS STRING)', '1D')})))"
    second = f"named_struct('bars', map('UNKNOWN', array({bar(day, '2D')}), concat('S', l_suppkey), array({bar(day, 'l_extendedprice + 1')})))"
    return v.table("lineitem").selectExpr(
        "concat('d', lpad(CAST(l_orderkey AS STRING), 9, '0'), '-', l_linenumber, '-', lpad(CAST(l_partkey AS STRING), 9, '0'),"
        " '-', lpad(CAST(CAST(l_extendedprice * 100 AS BIGINT) AS STRING), 12, '0')) AS doc",
        f"to_json(named_struct('fetched_at', concat('2001-01-', lpad(CAST(l_linenumber AS STRING), 2, '0')),"
        f" 'pages', array({first}, {second}))) AS text",
    )


@check(
    "source_paged_bars",
    """SELECT symbol, CAST(session_date AS VARCHAR) AS session_date, close + k AS close, CAST(qty AS BIGINT) AS volume, k AS page
       FROM pages_src, (SELECT unnest([0, 1]) AS k)
       UNION ALL SELECT 'UNKNOWN', CAST(session_date AS VARCHAR), 2.0, CAST(qty AS BIGINT), 1 FROM pages_src""",
)
def _(v: Views):
    return bronze.paged_bars(_paged(v)).select("symbol", "session_date", "close", "volume", "page")


@check(
    "ingest_replay",
    """SELECT l_suppkey AS security_id, 'S' || l_suppkey AS symbol, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS session_date,
         l_extendedprice + 1 AS close, CAST(l_quantity AS BIGINT) AS volume FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_suppkey, CAST(l_shipdate AS DATE)
         ORDER BY l_linenumber DESC, l_orderkey DESC, l_partkey DESC, l_extendedprice DESC) = 1""",
)
def _(v: Views):
    symbols = v.table("supplier").selectExpr("concat('S', s_suppkey) AS symbol", "s_suppkey AS security_id")
    out = capture.replay(_paged(v), symbols)
    return out.select("security_id", "symbol", "session_date", "close", "volume")


# Vendor daily documents: one per order line, good and broken rows by line number.
_ROW = """CASE l_linenumber
    WHEN 1 THEN concat('{"date": "', d, 'T00:00:00.000Z", "open": ', p, ', "high": ', p, ', "low": ', p, ', "close": ', p, ', "volume": 5}')
    WHEN 2 THEN concat('{"open": ', p, ', "high": 1, "low": 1, "close": 1}')
    WHEN 3 THEN concat('{"date": "', d, '", "open": ', p, ', "high": 1, "close": 1, "volume": null}')
    WHEN 4 THEN concat('{"date": "', d, '", "open": null, "high": 1, "low": 1, "close": 1}')
    WHEN 5 THEN concat('{"date": "', d, '", "open": ', p, ', "high": "x", "low": 1, "close": 1}')
    WHEN 6 THEN concat('{"date": "1999-99-99", "open": ', p, ', "high": 1, "low": 1, "close": 1}')
    ELSE concat('{"date": "', d, '", "open": ', p, ', "high": ', p, ', "low": ', p, ', "close": ', p, ', "volume": null}') END"""
_REASON = """CASE l_linenumber WHEN 2 THEN 'missing_date' WHEN 3 THEN 'malformed_row:KeyError' WHEN 4 THEN 'malformed_row:TypeError'
    WHEN 5 THEN 'malformed_row:ValueError' WHEN 6 THEN 'malformed_row:ValueError' END"""


def _vendor_docs(v: Views):
    rows = v.table("lineitem").selectExpr(
        "l_suppkey AS security_id", "concat('S', l_suppkey) AS symbol", "l_orderkey", "l_linenumber",
        "CAST(CAST(l_shipdate AS DATE) AS STRING) AS d", "CAST(l_quantity AS STRING) AS p",
    )
    return rows.selectExpr("security_id", "symbol", f"concat('[', {_ROW}, ']') AS text")


@check(
    "source_vendor_bars",
    """SELECT l_suppkey AS security_id, 'S' || l_suppkey AS symbol, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS session_date,
         l_quantity AS close, CASE WHEN l_linenumber = 1 THEN 5 ELSE 0 END AS volume FROM lineitem WHERE l_linenumber IN (1, 7)""",
)
def _(v: Views):
    return bronze.vendor_bars(_vendor_docs(v))[0].select("security_id", "symbol", "session_date", "close", "volume")


@check(
    "source_vendor_anomalies",
    f"""SELECT l_suppkey AS security_id, 'S' || l_suppkey AS symbol, CASE l_linenumber WHEN 2 THEN NULL WHEN 6 THEN '1999-99-99'
          ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS raw_date, {_REASON} AS reason
        FROM lineitem WHERE l_linenumber BETWEEN 2 AND 6""",
)
def _(v: Views):
    return bronze.vendor_bars(_vendor_docs(v))[1]


@check(
    "ingest_capture_plan",
    f"""WITH s AS (SELECT max(session_date) AS last FROM bars WHERE session_date <= DATE '2000-06-01'),
          l AS (SELECT max(session_date) AS d FROM sessions WHERE close_utc <= TIMESTAMP '2000-06-30 20:00:00'),
          a AS (SELECT count(DISTINCT id_value) AS n FROM identifiers WHERE valid_from <= DATE '2000-06-30'
                AND (valid_to IS NULL OR valid_to >= DATE '2000-06-30')),
          t AS (SELECT count(*) AS n FROM sessions, s WHERE session_date > s.last AND close_utc <= TIMESTAMP '2000-06-30 20:00:00')
        SELECT CAST(s.last AS VARCHAR) AS last_stored, CAST(l.d AS VARCHAR) AS latest, a.n AS active, t.n AS sessions_due,
          a.n * t.n AS expected_bars FROM s, l, a, t""",
)
def _(v: Views):
    stored = v.bars.where(F.col("session_date") <= F.lit(dt.date(2000, 6, 1)))
    return capture.capture_plan(stored, v.sessions, v.identifiers, NOW)


def _symbol_ids(v: Views):
    return v.table("supplier").selectExpr(
        "s_suppkey AS security_id", "'TICKER' AS id_type", "concat('S', s_suppkey) AS id_value",
        "DATE'1990-01-01' AS valid_from", "CAST(NULL AS DATE) AS valid_to",
    )


def _backfill(v: Views):
    docs = _vendor_docs(v).drop("security_id")
    root = session.scratch(v.spark, "silver")
    return capture.backfill(docs, _symbol_ids(v), v.sessions, seeds.dq_checks(v.spark), root, 1, 77)


@check(
    "ingest_backfill",
    """SELECT l_suppkey AS security_id, 'S' || l_suppkey AS symbol, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS session_date,
         l_quantity AS close, CASE WHEN l_linenumber = 1 THEN 5 ELSE 0 END AS volume,
         strftime(s.close_utc, '%Y-%m-%d %H:%M:%S') AS knowledge_time, 77 AS batch_id, 'TIINGO' AS source
       FROM lineitem JOIN sessions s ON s.session_date = CAST(l_shipdate AS DATE) WHERE l_linenumber IN (1, 7)""",
)
def _(v: Views):
    staged, _, _ = _backfill(v)
    return staged.select(
        "security_id", "symbol", "session_date", "close", "volume", "knowledge_time", "batch_id", "source"
    )


SQL_VIEWS["backfill_counts"] = """
    SELECT (SELECT count(*) FROM lineitem WHERE l_linenumber IN (1, 7)) AS size,
      (SELECT count(*) FROM lineitem WHERE l_linenumber IN (1, 7) AND CAST(l_shipdate AS DATE) NOT IN
        (SELECT session_date FROM sessions)) AS off,
      (SELECT count(*) FROM lineitem WHERE l_linenumber BETWEEN 2 AND 6) AS bad"""


@check(
    "ingest_backfill_quality",
    """SELECT 'bars_non_session_date' AS check_name, 77 AS batch_id, off = 0 OR off / size <= 0.01 AS passed, off AS anomalies
       FROM backfill_counts
       UNION ALL SELECT 'bars_malformed_row', 77, bad = 0 OR bad / size <= 0.01, bad FROM backfill_counts""",
)
def _(v: Views):
    _, quality, _ = _backfill(v)
    return quality.select(
        "check_name", "batch_id", "passed", F.get_json_object("observed", "$.count").cast("bigint").alias("anomalies")
    )


@check(
    "ingest_stream",
    """SELECT l_suppkey AS security_id, CAST(d AS VARCHAR) AS session_date, max(l_quantity) AS close,
         strftime(s.close_utc, '%Y-%m-%d %H:%M:%S') AS knowledge_time, 1 AS batch_id
       FROM (SELECT *, CAST(l_shipdate AS DATE) AS d FROM lineitem) JOIN sessions s ON s.session_date = d
       WHERE l_linenumber IN (1, 7) GROUP BY l_suppkey, d, s.close_utc""",
)
def _(v: Views):
    # All documents have arrived, one on each line; the stream takes them as one micro-batch and ends.
    root = session.scratch(v.spark, "stream")
    line = F.concat(F.lit('{"symbol": "'), "symbol", F.lit('", "rows": '), "text", F.lit("}"))
    _vendor_docs(v).select(line.alias("value")).write.text(f"{root}/inbox")
    query = stream.start(
        v.spark, f"{root}/inbox", _symbol_ids(v), v.sessions, seeds.dq_checks(v.spark), f"{root}/lake", f"{root}/dq",
        f"{root}/checkpoint", dt.date(2002, 1, 1), per_line=True,
    )
    query.awaitTermination()
    return lake.scan_bars(v.spark, f"{root}/lake").select("security_id", "session_date", "close", "knowledge_time", "batch_id")


@check(
    "ingest_capture_sessions",
    """SELECT l_suppkey AS security_id, 'S' || l_suppkey AS symbol, CAST(d AS VARCHAR) AS session_date, max(l_quantity) AS close,
         batch_id
       FROM lineitem JOIN (SELECT session_date AS d, 99 + row_number() OVER (ORDER BY session_date) AS batch_id FROM sessions
           WHERE session_date > DATE '1999-12-31') ON CAST(l_shipdate AS DATE) = d
       WHERE l_linenumber IN (1, 7) GROUP BY l_suppkey, d, batch_id""",
)
def _(v: Views):
    return _captured(v)[0].select("security_id", "symbol", "session_date", "close", "batch_id")


def _captured(v: Views):
    """Stored through 1999: every later session is captured."""
    stored = v.bars.where(F.col("session_date") <= F.lit(dt.date(1999, 12, 31)))
    now = dt.datetime(2001, 12, 1, tzinfo=dt.timezone.utc)
    targets = [r.session_date for r in capture.due_sessions(stored, v.sessions, now).collect()]
    path = session.scratch(v.spark, "silver")
    docs = _vendor_docs(v).drop("security_id")
    checks = seeds.dq_checks(v.spark)
    results, accounts = capture.capture_sessions(docs, _symbol_ids(v), v.sessions, checks, path, targets, 100)
    return lake.scan_bars(v.spark, path), results, accounts


# Each vendor row with the due session it is counted with, and what becomes of it.
SQL_VIEWS["captured"] = """
    SELECT due.batch_id, CASE WHEN o.d < o.lo AND s.session_date < o.lo THEN 'already_stored' WHEN NOT o.good THEN 'refused'
        WHEN s.session_date IS NULL OR s.session_date <> o.d THEN 'non_session' WHEN due.d <> o.d THEN 'not_due' ELSE 'kept' END AS state
    FROM (SELECT *, CASE WHEN d IS NULL THEN lo ELSE greatest(least(d, hi), lo) END AS held FROM (
        SELECT CASE WHEN l_linenumber NOT IN (2, 6) THEN CAST(l_shipdate AS DATE) END AS d, l_linenumber IN (1, 7) AS good, lo, hi
        FROM lineitem, (SELECT min(session_date) AS lo, max(session_date) AS hi FROM sessions WHERE session_date > DATE '1999-12-31'))) o
    ASOF JOIN (SELECT session_date AS d, 99 + row_number() OVER (ORDER BY session_date) AS batch_id FROM sessions
        WHERE session_date > DATE '1999-12-31') due ON o.held <= due.d
    ASOF LEFT JOIN sessions s ON o.d <= s.session_date"""
SQL_VIEWS["capture_accounts"] = """
    SELECT 99 + p AS batch_id, coalesce(parsed, 0) AS parsed, coalesce(kept, 0) AS kept, coalesce(refused, 0) AS refused,
      coalesce(non_session, 0) AS non_session, coalesce(already_stored, 0) AS already_stored, coalesce(not_due, 0) AS not_due
    FROM (SELECT row_number() OVER (ORDER BY session_date) AS p FROM sessions WHERE session_date > DATE '1999-12-31')
    LEFT JOIN (SELECT batch_id - 99 AS p, count(*) AS parsed, count(*) FILTER (WHERE state = 'kept') AS kept,
        count(*) FILTER (WHERE state = 'refused') AS refused, count(*) FILTER (WHERE state = 'non_session') AS non_session,
        count(*) FILTER (WHERE state = 'already_stored') AS already_stored, count(*) FILTER (WHERE state = 'not_due') AS not_due
      FROM captured GROUP BY 1) USING (p)"""


@check(
    "ingest_capture_sessions_quality",
    """WITH n AS (SELECT batch_id, kept + non_session AS size, refused, non_session FROM capture_accounts),
         c AS (SELECT 'bars_malformed_row' AS check_name, batch_id, refused AS anomalies, size AS batch_size FROM n
           UNION ALL SELECT 'bars_non_session_date', batch_id, non_session, size FROM n)
       SELECT *, anomalies = 0 OR batch_size = 0 OR anomalies / batch_size <= 0.01 AS passed FROM c""",
)
def _(v: Views):
    value = lambda f: F.get_json_object("observed", f"$.{f}").cast("bigint")
    return _captured(v)[1].select(
        "check_name", "batch_id", value("count").alias("anomalies"), value("batch_size").alias("batch_size"), "passed"
    )


@check("ingest_capture_accounts", "SELECT * FROM capture_accounts")
def _(v: Views):
    return _captured(v)[2]


# Sinks: write, read back, compare with the view.
@check(
    "sink_macro_export",
    "SELECT series_id, CAST(obs_date AS VARCHAR) AS obs_date, CAST(vintage_date AS VARCHAR) AS vintage_date, value FROM macro",
)
def _(v: Views):
    path = session.scratch(v.spark, "macro")
    lake.export_observations(v.macro, path)
    lake.export_observations(v.macro, path)  # a second snapshot replaces the first
    return lake.scan(v.spark, path, schemas.MACRO).select("series_id", "obs_date", "vintage_date", "value")


@check(
    "sink_bars",
    f"""SELECT b.security_id, b.symbol, CAST(b.session_date AS VARCHAR) AS session_date, b.close, b.volume,
          strftime(s.close_utc, '%Y-%m-%d %H:%M:%S') AS knowledge_time, 5 AS batch_id, 'TIINGO' AS source
        FROM bars b JOIN sessions s USING (session_date)""",
)
def _(v: Views):
    path = session.scratch(v.spark, "bars")
    for _ in range(2):  # storing the batch again leaves one copy
        lake.write_bars(v.bars, v.sessions, path, "TIINGO", 5)
    return lake.scan_bars(v.spark, path).select(
        "security_id", "symbol", "session_date", "close", "volume", "knowledge_time", "batch_id", "source"
    )


SQL_VIEWS["merged"] = """
    SELECT * FROM (
      SELECT b.* REPLACE (1 AS batch_id, 'TIINGO' AS source), s.close_utc FROM bars b JOIN sessions s USING (session_date)
        WHERE b.volume > 2000
      UNION ALL
      SELECT b.* REPLACE (2 AS batch_id, 'TIINGO' AS source), s.close_utc FROM bars b JOIN sessions s USING (session_date)
        WHERE b.volume <= 2500)
    QUALIFY row_number() OVER (PARTITION BY security_id, session_date ORDER BY close_utc DESC, batch_id DESC, source,
      close DESC, volume DESC, open DESC, high DESC, low DESC, trade_count DESC, vwap DESC) = 1"""


@check(
    "sink_month_merge",
    f"SELECT security_id, {_DAY}, close, volume, batch_id FROM merged",
)
def _(v: Views):
    path = session.scratch(v.spark, "silver")
    lake.merge_bars(v.bars.where("volume > 2000"), v.sessions, path, "TIINGO", 1)
    lake.merge_bars(v.bars.where("volume <= 2500"), v.sessions, path, "TIINGO", 2)
    return lake.scan_bars(v.spark, path).select("security_id", "session_date", "close", "volume", "batch_id")


@check("sink_gold", f"SELECT {GOLD_SQL} FROM wide")
def _(v: Views):
    path = session.scratch(v.spark, "gold")
    rows = refreshed(v)
    lake.write_months(rows, path)
    # One security recomputed: its rows in two months are replaced, all others stay.
    again = lake.scan_gold(v.spark, path).where("security_id = 1")
    lake.merge_gold(again, path, [(1999, 3), (1999, 4)], [1])
    return rounded_gold(lake.scan_gold(v.spark, path))


@check(
    "sink_publish",
    f"SELECT {BAR_SQL}, 2 AS live_version FROM bars_asof",
)
def _(v: Views):
    root = session.scratch(v.spark, "published")
    at = dt.datetime(2000, 1, 1, tzinfo=dt.timezone.utc)
    first = v.bars.where("volume > 4000")
    lake.stage(first, root, 1)
    lake.publish(v.spark, root, 1, True, at)
    lake.stage(asof.bars_asof_raw(v.bars, AS_OF), root, 2)
    lake.publish(v.spark, root, 2, False, at + dt.timedelta(days=1), force_reason="approved")
    lake.stage(first, root, 3)
    lake.publish(v.spark, root, 3, False, at + dt.timedelta(days=2))  # failed validation stays unpublished
    last = lake.pointers(v.spark, root).agg(F.max_by("version", "published_at").alias("n")).scalar()
    return lake.live(v.spark, root, schemas.BARS).withColumn("live_version", last)


@check(
    "sink_month_range",
    f"""SELECT security_id, {_DAY}, close, volume FROM merged
        WHERE session_date BETWEEN DATE '1997-02-10' AND DATE '1997-11-20' AND batch_id = 2""",
)
def _(v: Views):
    path = session.scratch(v.spark, "silver")
    lake.merge_bars(v.bars.where("volume > 2000"), v.sessions, path, "TIINGO", 1)
    lake.merge_bars(v.bars.where("volume <= 2500"), v.sessions, path, "TIINGO", 2)
    rows = lake.scan_months(v.spark, path, schemas.BARS, dt.date(1997, 2, 10), dt.date(1997, 11, 20))
    return rows.where("batch_id = 2").select("security_id", "session_date", "close", "volume")


# Adjustment oracles over vendor daily rows.
SQL_VIEWS["daily"] = """
    SELECT * FROM vendor QUALIFY row_number() OVER (PARTITION BY security_id, session_date ORDER BY batch_id DESC, line DESC,
      close DESC, volume DESC, split_factor DESC NULLS LAST, div_cash DESC, adj_close DESC) = 1"""


def _daily(v: Views):
    order = [F.col(c).desc() for c in ("batch_id", "line", "close", "volume", "split_factor", "div_cash", "adj_close")]
    return first_per_key(v.vendor, ["security_id", "session_date"], order)


SQL_VIEWS["spread"] = """
    SELECT * EXCLUDE (pos, n) FROM (SELECT *, row_number() OVER (PARTITION BY security_id ORDER BY session_date) - 1 AS pos,
        count(*) OVER (PARTITION BY security_id) AS n FROM daily)
    WHERE n <= 50 OR pos IN (SELECT CAST(floor(i * (n / 50.0::DOUBLE)) AS BIGINT) FROM (SELECT unnest(range(50)) AS i))"""


@check("stat_sample_dates", f"SELECT security_id, {_DAY}, close, adj_close FROM spread")
def _(v: Views):
    out = stats.evenly_spaced(_daily(v), "security_id", "session_date", 50)
    return out.select("security_id", "session_date", "close", "adj_close")


def _stats_sql(ours: str, ref: str, source: str, where: str = "") -> str:
    return f"""SELECT security_id, count(rel) AS n, coalesce(avg(rel), 0) AS mean, coalesce(quantile_cont(rel, 0.5), 0) AS median,
          coalesce(quantile_cont(rel, 0.95), 0) AS p95, coalesce(max(rel), 0) AS max,
          arg_max(session_date, (rel, DATE '9999-12-31' - session_date)) FILTER (WHERE rel IS NOT NULL) AS worst_date,
          CASE WHEN count(o) < 2 THEN 1.0 WHEN var_pop(o) = 0 OR var_pop(r) = 0 THEN
            CASE WHEN var_pop(o) = var_pop(r) THEN 1.0 ELSE 0.0 END
            ELSE covar_pop(o, r) / sqrt(var_pop(o) * var_pop(r)) END AS correlation
        FROM (SELECT security_id, session_date, CASE WHEN {ref} <> 0 THEN abs({ours} - {ref}) / abs({ref}) END AS rel,
            CASE WHEN {ref} <> 0 THEN {ours} END AS o, CASE WHEN {ref} <> 0 THEN {ref} END AS r FROM {source} {where})
        GROUP BY security_id"""


SQL_VIEWS["pair_stats"] = _stats_sql("close * 1.01", "(close * (volume % 700))", "daily")


@check(
    "stat_errors",
    f"""SELECT security_id, n, {settle_sql('mean', 7)} AS mean, {settle_sql('median', 7)} AS median, {settle_sql('p95', 7)} AS p95,
          {settle_sql('max', 7)} AS max, CAST(worst_date AS VARCHAR) AS worst_date, {settle_sql('correlation', 7)} AS correlation
        FROM pair_stats""",
)
def _(v: Views):
    pairs = _daily(v).selectExpr(
        "security_id", "session_date", "close * 1.01D AS ours", "close * (volume % 700) AS reference"
    )
    out = stats.error_stats(pairs, "security_id")
    nums = [settle(F.col(c), 7).alias(c) for c in ("mean", "median", "p95", "max", "correlation")]
    return out.select("security_id", "n", *nums, "worst_date")


SQL_VIEWS["daily_acts"] = """
    SELECT d.security_id, d.session_date AS ex_date, CASE WHEN abs(d.split_factor - 1) > 1e-9 AND d.split_factor <> 0
        THEN CASE WHEN abs(r.n / r.d - r.f) <= 1e-6 * greatest(1.0, abs(r.f)) THEN r.d / r.n ELSE 1.0 / r.f END END AS sf,
      CASE WHEN d.div_cash > 0 THEN d.div_cash END AS cash, d.prev
    FROM (SELECT *, lag(close) OVER (PARTITION BY security_id ORDER BY session_date) AS prev FROM daily) d
    LEFT JOIN ratios r ON r.f = d.split_factor
    WHERE (abs(d.split_factor - 1) > 1e-9 AND d.split_factor <> 0) OR d.div_cash > 0"""
SQL_VIEWS["daily_adj"] = """
    SELECT d.security_id, d.session_date, any_value(d.close) AS close, any_value(d.adj_close) AS adj_close,
      any_value(d.close) * coalesce(product(coalesce(a.sf, 1.0) * CASE WHEN a.cash IS NOT NULL AND a.prev > 0
        THEN (a.prev - a.cash) / a.prev ELSE 1.0 END), 1.0) AS total_return,
      any_value(d.close) * coalesce(product(coalesce(a.sf, 1.0)), 1.0) AS split_only
    FROM daily d LEFT JOIN daily_acts a ON a.security_id = d.security_id AND d.session_date < a.ex_date GROUP BY 1, 2"""
SQL_VIEWS["stats_total"] = _stats_sql("total_return", "adj_close", "daily_adj")
SQL_VIEWS["stats_split"] = _stats_sql("split_only", "adj_close", "daily_adj")


@check(
    "validate_self_contained",
    f"""SELECT t.security_id, s.n AS split_n, {settle_sql('s.max', 6)} AS split_max, t.n AS total_n, {settle_sql('t.max', 6)} AS total_max,
          {settle_sql('t.correlation', 6)} AS total_correlation, coalesce(c.splits, 0) AS splits, coalesce(c.dividends, 0) AS dividends,
          t.n > 0 AND t.max < 1e-3 AND t.correlation > 0.9999 AS total_ok,
          coalesce(c.dividends, 0) > 0 OR (s.n > 0 AND s.max < 1e-9) AS split_ok
        FROM stats_total t JOIN stats_split s USING (security_id) LEFT JOIN (
          SELECT security_id, count(sf) AS splits, count(cash) AS dividends FROM daily_acts GROUP BY 1) c USING (security_id)""",
)
def _(v: Views):
    out = validators.self_contained(_daily(v))
    return out.select(
        "security_id", "split_n", settle(F.col("split_max"), 6).alias("split_max"), "total_n",
        settle(F.col("total_max"), 6).alias("total_max"),
        settle(F.col("total_correlation"), 6).alias("total_correlation"), "splits", "dividends", "total_ok", "split_ok",
    )


SQL_VIEWS["lake_adj"] = """
    SELECT b.security_id, b.session_date, b.close AS lake_raw, b.close * f.price_factor AS lake_adj
    FROM bars_asof b JOIN factors_total f USING (security_id, session_date)"""
SQL_VIEWS["common_days"] = """
    SELECT l.*, d.close AS vendor_raw, d.adj_close AS vendor_adj
    FROM lake_adj l JOIN daily d USING (security_id, session_date)"""
SQL_VIEWS["vendor_raw_stats"] = _stats_sql("lake_raw", "vendor_raw", "common_days")
SQL_VIEWS["vendor_adj_stats"] = _stats_sql("lake_adj", "vendor_adj", "common_days")


@check(
    "validate_against_vendor",
    f"""SELECT r.security_id, r.n AS raw_n, {settle_sql('r.max', 6)} AS raw_max, {settle_sql('a.max', 6)} AS adj_max,
          {settle_sql('a.max - r.max', 6)} AS delta_max, coalesce(e.expected, 0) AS expected, coalesce(e.applicable, 0) AS applicable,
          coalesce(k.n, 0) AS retrieved, a.n > 0 AND a.correlation > 0.9999 AND a.correlation * a.correlation > 0.9999 AND a.max < 1e-3 AS passed
        FROM vendor_raw_stats r JOIN vendor_adj_stats a USING (security_id)
        LEFT JOIN (SELECT x.security_id, count(x.sf) + count(x.cash) AS expected,
            count(x.sf) FILTER (WHERE b.lo < x.ex_date AND x.ex_date <= b.hi)
            + count(x.cash) FILTER (WHERE b.lo < x.ex_date AND x.ex_date <= b.hi) AS applicable
          FROM daily_acts x JOIN (SELECT security_id, min(session_date) AS lo, max(session_date) AS hi FROM bars_asof GROUP BY 1) b
            USING (security_id) GROUP BY 1) e USING (security_id)
        LEFT JOIN (SELECT security_id, count(*) AS n FROM acts GROUP BY 1) k USING (security_id)""",
)
def _(v: Views):
    out = validators.against_vendor(v.bars, v.actions, _daily(v), AS_OF)
    return out.select(
        "security_id", "raw_n", settle(F.col("raw_max"), 6).alias("raw_max"), settle(F.col("adj_max"), 6).alias("adj_max"),
        settle(F.col("delta_max"), 6).alias("delta_max"), "expected", "applicable", "retrieved", "passed",
    )
