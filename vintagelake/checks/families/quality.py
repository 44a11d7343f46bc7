"""Bar and action quality, rebuild validation."""

import datetime as dt

from pyspark.sql import functions as F

from vintagelake import seeds
from vintagelake.checks.registry import check
from vintagelake.checks.views import SQL_VIEWS, TODAY, Views
from vintagelake.operators import asof, quality, rebuild

NOW = dt.date(2001, 12, 31)
_LISTED = f"i.valid_from <= DATE '{TODAY}' AND (i.valid_to IS NULL OR i.valid_to >= DATE '{TODAY}')"


@check(
    "dq_coverage",
    """SELECT s.seeded, b.n AS with_bars, s.seeded - b.n AS missing,
         round(100.0::DOUBLE * b.n / s.seeded, 2) AS coverage_pct, o.n AS orphan_ids
       FROM (SELECT count(*) AS seeded FROM securities) s, (SELECT count(DISTINCT security_id) AS n FROM bars) b,
         (SELECT count(DISTINCT security_id + 3) AS n FROM bars WHERE security_id + 3 NOT IN (SELECT security_id FROM securities)) o""",
)
def _(v: Views):
    # Ids are moved by three: the first securities have no bars, the last bars no security.
    return quality.coverage(v.bars.withColumn("security_id", F.col("security_id") + 3), v.securities)


@check(
    "dq_coverage_missing",
    f"""SELECT i.security_id, i.id_value AS ticker FROM identifiers i
        WHERE {_LISTED} AND i.security_id NOT IN (SELECT security_id - security_id % 3 FROM bars)""",
)
def _(v: Views):
    # All bars count for every third security, so the others have none.
    moved = v.bars.withColumn("security_id", F.expr("security_id - security_id % 3"))
    return quality.coverage_missing(moved, v.securities, v.identifiers, TODAY)


SQL_VIEWS["dq_sanity_view"] = """
    SELECT count(*) FILTER (WHERE high < low) AS high_lt_low,
      count(*) FILTER (WHERE close < low OR close > high OR open < low OR open > high) AS ohlc_outside,
      count(*) FILTER (WHERE open <= 0 OR high <= 0 OR low <= 0 OR close <= 0) AS nonpositive, count(*) AS total
    FROM bars_latest"""


@check(
    "dq_sanity",
    "SELECT *, high_lt_low + ohlc_outside + nonpositive AS violations FROM dq_sanity_view",
)
def _(v: Views):
    return quality.sanity(asof.latest_bars(v.bars))


_DUP = "SELECT security_id, session_date, known, count(*) AS copies FROM bars GROUP BY 1, 2, 3 HAVING count(*) > 1"


@check(
    "dq_duplicates",
    f"""SELECT security_id, CAST(session_date AS VARCHAR) AS session_date,
          CAST(known AS VARCHAR) || ' 21:00:00' AS knowledge_time, copies FROM ({_DUP})""",
)
def _(v: Views):
    return quality.duplicates(v.bars)


@check(
    "dq_duplicate_examples",
    f"""SELECT security_id, CAST(session_date AS VARCHAR) AS session_date,
          CAST(known AS VARCHAR) || ' 21:00:00' AS knowledge_time, copies FROM ({_DUP})
        ORDER BY copies DESC, security_id, session_date, known LIMIT 10""",
)
def _(v: Views):
    return quality.duplicate_examples(v.bars)


@check("dq_zero_volume", "SELECT count(*) AS n FROM bars_latest WHERE volume IS NULL OR volume <= 0")
def _(v: Views):
    return quality.zero_volume(asof.latest_bars(v.bars)).agg(F.count(F.lit(1)).alias("n"))


@check(
    "dq_zero_volume_examples",
    """SELECT symbol, CAST(session_date AS VARCHAR) AS session_date, security_id FROM bars_latest
       WHERE volume IS NULL OR volume <= 0 ORDER BY bars_latest.session_date, symbol, security_id LIMIT 50""",
)
def _(v: Views):
    return quality.zero_volume_examples(asof.latest_bars(v.bars))


SQL_VIEWS["gap_dates_view"] = """
    SELECT o.security_id, s.session_date, o.first_bar, o.last_bar, o.symbol
    FROM (SELECT security_id, min(symbol) AS symbol, min(session_date) AS first_bar, max(session_date) AS last_bar
          FROM bars_latest GROUP BY 1) o
    JOIN sessions s ON s.session_date BETWEEN o.first_bar AND o.last_bar
    ANTI JOIN bars_latest b ON b.security_id = o.security_id AND b.session_date = s.session_date"""


@check(
    "dq_gaps",
    "SELECT security_id, symbol, count(*) AS missing FROM gap_dates_view GROUP BY 1, 2",
)
def _(v: Views):
    return quality.gaps(asof.latest_bars(v.bars), v.sessions)


@check(
    "dq_gap_totals",
    """SELECT count(*) AS interior_total, count(*) FILTER (WHERE session_date < first_bar) AS listing_era_leak
       FROM gap_dates_view""",
)
def _(v: Views):
    return quality.gap_totals(asof.latest_bars(v.bars), v.sessions)


@check(
    "dq_gap_dates",
    """SELECT security_id, CAST(session_date AS VARCHAR) AS session_date, CAST(first_bar AS VARCHAR) AS first_bar,
         CAST(last_bar AS VARCHAR) AS last_bar FROM gap_dates_view""",
)
def _(v: Views):
    return quality.gap_dates(asof.latest_bars(v.bars), v.sessions)


SQL_VIEWS["fresh"] = f"""
    SELECT l.d AS lake_max, (SELECT max(session_date) FROM sessions WHERE session_date <= DATE '{NOW}') AS calendar_max,
      (SELECT count(*) FROM sessions, (SELECT max(session_date) AS m FROM bars_asof) x
        WHERE session_date > x.m AND session_date <= DATE '{NOW}') AS sessions_behind
    FROM (SELECT max(session_date) AS d FROM bars_asof) l"""


@check(
    "dq_freshness",
    """SELECT CAST(lake_max AS VARCHAR) AS lake_max, CAST(calendar_max AS VARCHAR) AS calendar_max, sessions_behind,
         CASE WHEN sessions_behind <= 1 THEN 'current' ELSE 'stale' END AS status FROM fresh""",
)
def _(v: Views):
    from vintagelake.checks.views import AS_OF

    return quality.freshness(asof.bars_asof_raw(v.bars, AS_OF), v.sessions, NOW)


@check(
    "dq_run_all",
    f"""SELECT metric, CAST(value AS DOUBLE) AS value, passed FROM (
          SELECT 'coverage_pct' AS metric, round(100.0::DOUBLE * (SELECT count(DISTINCT security_id) FROM bars)
              / (SELECT count(*) FROM securities), 2) AS value,
            100.0 * (SELECT count(DISTINCT security_id) FROM bars) / (SELECT count(*) FROM securities) >= 99 AS passed
          UNION ALL SELECT 'sanity_violations', high_lt_low + ohlc_outside + nonpositive,
            high_lt_low + ohlc_outside + nonpositive = 0 FROM dq_sanity_view
          UNION ALL SELECT 'duplicates', count(*), count(*) = 0 FROM ({_DUP})
          UNION ALL SELECT 'listing_era_leak', count(*) FILTER (WHERE session_date < first_bar), true FROM gap_dates_view
          UNION ALL SELECT 'interior_gaps', count(*), true FROM gap_dates_view
          UNION ALL SELECT 'zero_volume', count(*), true FROM bars_latest WHERE volume IS NULL OR volume <= 0
          UNION ALL SELECT 'sessions_behind', (SELECT count(*) FROM sessions
              WHERE session_date > (SELECT max(session_date) FROM bars) AND session_date <= DATE '{NOW}'), true)""",
)
def _(v: Views):
    return quality.run_all(v.bars, v.securities, v.sessions, NOW)


# Per-batch anomalies: bars on days without a session, and bars with broken prices.
SQL_VIEWS["anomaly"] = """
    SELECT 'bars_non_session_date' AS check_name, b.batch_id, b.symbol || ' ' || CAST(b.session_date AS VARCHAR) AS label
    FROM bars b ANTI JOIN sessions s USING (session_date)
    UNION ALL
    SELECT 'bars_malformed_row', batch_id, symbol || ' ' || CAST(session_date AS VARCHAR) FROM bars
    WHERE high < low OR open < low"""
SQL_VIEWS["batch_size"] = """
    SELECT check_name, batch_id, n AS batch_size FROM (SELECT batch_id, count(*) AS n FROM bars GROUP BY 1),
      (SELECT unnest(['bars_non_session_date', 'bars_malformed_row']) AS check_name)"""
SQL_VIEWS["verdict"] = """
    SELECT z.check_name, z.batch_id, z.batch_size, coalesce(a.n, 0) AS anomalies, coalesce(a.n, 0) / z.batch_size AS fraction,
      coalesce(a.n, 0) = 0 OR a.n / z.batch_size <= 0.01 AS passed,
      CASE WHEN coalesce(a.n, 0) = 0 THEN 'info' WHEN a.n / z.batch_size <= 0.01 THEN 'warn' ELSE 'error' END AS severity,
      coalesce(a.sample, '') AS sample
    FROM batch_size z LEFT JOIN (SELECT check_name, batch_id, count(*) AS n,
        array_to_string(list_sort(list(label))[1:20], ',') AS sample FROM anomaly GROUP BY 1, 2) a
      ON a.check_name = z.check_name AND a.batch_id = z.batch_id"""


def _anomalies(v: Views):
    """Bars marked with both anomalies."""
    from vintagelake.operators.calendar import with_close

    marked = with_close(v.bars, v.sessions).select(
        "batch_id", F.concat_ws(" ", "symbol", "session_date").alias("label"),
        F.col("close_utc").isNull().alias("bars_non_session_date"), F.expr("high < low OR open < low").alias("bars_malformed_row"),
    )
    return marked, ["bars_non_session_date", "bars_malformed_row"]


@check(
    "dq_batch_verdict",
    "SELECT check_name, batch_id, batch_size, anomalies, round(fraction, 6) AS fraction, passed, severity, sample FROM verdict",
)
def _(v: Views):
    counts = quality.anomaly_counts(*_anomalies(v))
    judged = quality.verdicts(quality.with_policy(counts, seeds.dq_checks(v.spark)))
    return judged.select(
        "check_name", "batch_id", "batch_size", "anomalies", F.round("fraction", 6).alias("fraction"), "passed",
        "severity", F.array_join("sample", ",").alias("sample"),
    )


@check(
    "dq_batch_results",
    """SELECT check_name, batch_id, passed, anomalies AS observed_count, severity,
         check_name || ': ' || anomalies || ' anomalies in ' || batch_size || ' bars; ' ||
         CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END || ' (' || severity || ')' AS details FROM verdict""",
)
def _(v: Views):
    out = quality.dq_results(quality.anomaly_counts(*_anomalies(v)), seeds.dq_checks(v.spark))
    return out.select(
        "check_name", "batch_id", "passed",
        F.get_json_object("observed", "$.count").cast("bigint").alias("observed_count"),
        F.get_json_object("observed", "$.severity").alias("severity"), "details",
    )


def _checks_from_parts(v: Views):
    """One check definition per part; some leave the fraction out, some are disabled."""
    return v.table("part").selectExpr(
        "concat('check_', p_partkey) AS name", "CASE WHEN p_size > 25 THEN 'warn' ELSE 'error' END AS severity",
        "CASE WHEN p_size % 3 = 0 THEN '{}' ELSE concat('{\"fail_fraction\": ', CAST(p_size AS STRING), '}') END AS spec",
        "p_size % 5 > 0 AS enabled",
    )


@check(
    "dq_check_policy",
    """SELECT 'check_' || p_partkey AS check_name, CASE WHEN p_size > 25 THEN 'warn' ELSE 'error' END AS severity,
         CASE WHEN p_size % 3 = 0 THEN 1.0::DOUBLE ELSE CAST(p_size AS DOUBLE) END AS fail_fraction
       FROM part WHERE p_size % 5 > 0""",
)
def _(v: Views):
    return quality.check_policy(_checks_from_parts(v))


@check("dq_action_counts", "SELECT source, action_type, count(*) AS n FROM actions GROUP BY ALL")
def _(v: Views):
    return quality.action_counts(v.actions)


@check(
    "dq_action_totals",
    "SELECT count(*) AS total_actions, count(DISTINCT security_id) AS securities_with_actions FROM actions",
)
def _(v: Views):
    return quality.action_totals(v.actions)


@check(
    "dq_without_actions",
    f"""SELECT i.id_value AS ticker FROM identifiers i WHERE {_LISTED} AND i.security_id NOT IN (
          SELECT security_id - security_id % 3 FROM actions WHERE security_id IS NOT NULL)""",
)
def _(v: Views):
    moved = v.actions.withColumn("security_id", F.expr("security_id - security_id % 3"))
    return quality.without_actions(v.securities, v.identifiers, moved, TODAY)


@check(
    "dq_action_conflicts",
    """SELECT security_id, action_type, CAST(ex_date AS VARCHAR) AS ex_date,
         count(DISTINCT coalesce(CAST(split_from AS VARCHAR), '') || '|' || coalesce(CAST(split_to AS VARCHAR), '') || '|' ||
           coalesce(CAST(cash_amount AS VARCHAR), '')) AS payloads, count(DISTINCT source) AS sources
       FROM actions GROUP BY ALL HAVING payloads > 1 AND sources > 1""",
)
def _(v: Views):
    return quality.action_conflicts(v.actions)


# Rebuild: the lake as known on two days; the newer one is the rebuild.
OLD, NEW = dt.date(1999, 6, 30), dt.date(2000, 6, 30)
SQL_VIEWS["old_lake"] = f"SELECT * FROM bars WHERE known <= DATE '{OLD}'"
SQL_VIEWS["new_lake"] = f"""
    SELECT b.* REPLACE (CASE WHEN batch_id % 3 = 0 THEN close * 1.01 ELSE close END AS close,
      CASE WHEN batch_id % 5 = 0 THEN volume + 100 ELSE volume END AS volume)
    FROM bars b WHERE known <= DATE '{NEW}' AND volume > 0"""


def _lakes(v: Views):
    old = v.bars.where(F.col("knowledge_time") < F.lit(OLD + dt.timedelta(days=1)))
    new = (
        v.bars.where(F.col("knowledge_time") < F.lit(NEW + dt.timedelta(days=1)))
        .where("volume > 0")  # the rebuild lost the bars without volume
        .withColumn("close", F.expr("CASE WHEN batch_id % 3 = 0 THEN close * 1.01D ELSE close END"))
        .withColumn("volume", F.expr("CASE WHEN batch_id % 5 = 0 THEN volume + 100 ELSE volume END"))
    )
    return old, new


SQL_VIEWS["lost_pairs"] = """
    SELECT DISTINCT security_id, session_date FROM old_lake
    EXCEPT SELECT DISTINCT security_id, session_date FROM new_lake"""
SQL_VIEWS["bad_dates"] = """
    SELECT DISTINCT n.session_date FROM new_lake n LEFT JOIN sessions s USING (session_date)
    WHERE s.close_utc IS NULL OR s.close_utc <> n.known + INTERVAL 21 HOUR"""
SQL_VIEWS["shared"] = """
    SELECT o.security_id, o.session_date, o.open AS old_open, o.high AS old_high, o.low AS old_low, o.close AS old_close,
      o.volume AS old_volume, n.open AS new_open, n.high AS new_high, n.low AS new_low, n.close AS new_close,
      n.volume AS new_volume
    FROM (SELECT * FROM old_lake QUALIFY row_number() OVER (PARTITION BY security_id, session_date ORDER BY known DESC,
            batch_id DESC, source, close DESC, volume DESC, open DESC, high DESC, low DESC, trade_count DESC, vwap DESC) = 1) o
    JOIN new_lake n USING (security_id, session_date)"""
SQL_VIEWS["shared_prices"] = """
    SELECT security_id, session_date, f.field, f.o AS old_value, f.n AS new_value FROM (
      SELECT security_id, session_date, unnest([{'field': 'open', 'o': old_open, 'n': new_open},
        {'field': 'high', 'o': old_high, 'n': new_high}, {'field': 'low', 'o': old_low, 'n': new_low},
        {'field': 'close', 'o': old_close, 'n': new_close}]) AS f FROM shared)
    WHERE abs(f.o - f.n) > 0.001 * greatest(abs(f.o), abs(f.n), 1e-9)"""
SQL_VIEWS["shared_median"] = """
    SELECT max(rel) AS volume_rel_median FROM (
      SELECT abs(old_volume - new_volume) / old_volume AS rel, row_number() OVER (ORDER BY abs(old_volume - new_volume) / old_volume) AS i,
        count(*) OVER () AS n FROM shared WHERE old_volume <> 0) WHERE i = n // 2 + 1"""


@check(
    "rebuild_row_counts",
    "SELECT (SELECT count(*) FROM old_lake) AS old_rows, (SELECT count(*) FROM new_lake) AS new_rows",
)
def _(v: Views):
    return rebuild.row_counts(*_lakes(v))


@check(
    "rebuild_coverage",
    "SELECT security_id, CAST(session_date AS VARCHAR) AS session_date FROM lost_pairs",
)
def _(v: Views):
    return rebuild.coverage_missing(*_lakes(v))


@check(
    "rebuild_knowledge",
    """SELECT security_id, CAST(session_date AS VARCHAR) AS session_date, batch_id, close FROM new_lake
       WHERE session_date IN (SELECT session_date FROM bad_dates)""",
)
def _(v: Views):
    bad = rebuild.knowledge_violations(_lakes(v)[1], v.sessions)
    return bad.select("security_id", "session_date", "batch_id", "close")


@check(
    "rebuild_duplicates",
    """SELECT security_id, CAST(session_date AS VARCHAR) AS session_date, count(*) AS copies FROM new_lake
       GROUP BY ALL HAVING count(*) > 1""",
)
def _(v: Views):
    return rebuild.duplicate_pairs(_lakes(v)[1])


@check(
    "rebuild_sample",
    """SELECT security_id, CAST(session_date AS VARCHAR) AS session_date, old_close, new_close, old_volume, new_volume
       FROM shared ORDER BY md5('420|' || security_id || '|' || CAST(session_date AS VARCHAR)), security_id, session_date,
         new_open, new_high, new_low, new_close, new_volume LIMIT 5000""",
)
def _(v: Views):
    out = rebuild.sampled(rebuild.shared_pairs(*_lakes(v)))
    return out.select("security_id", "session_date", "old_close", "new_close", "old_volume", "new_volume")


@check(
    "rebuild_price_diffs",
    "SELECT security_id, CAST(session_date AS VARCHAR) AS session_date, field, old_value, new_value FROM shared_prices",
)
def _(v: Views):
    return rebuild.price_diffs(rebuild.shared_pairs(*_lakes(v)))


@check(
    "rebuild_volume_diffs",
    """SELECT security_id, CAST(session_date AS VARCHAR) AS session_date, old_volume, new_volume FROM shared
       WHERE old_volume IS DISTINCT FROM new_volume""",
)
def _(v: Views):
    return rebuild.volume_diffs(rebuild.shared_pairs(*_lakes(v)))


@check(
    "rebuild_report",
    """WITH r AS (SELECT (SELECT count(*) FROM shared) AS compared, (SELECT count(*) FROM shared_prices) AS price_diffs,
           (SELECT count(*) FROM shared WHERE old_volume IS DISTINCT FROM new_volume) AS volume_diffs,
           (SELECT volume_rel_median FROM shared_median) AS volume_rel_median,
           (SELECT count(*) FROM old_lake) AS old_rows, (SELECT count(*) FROM new_lake) AS new_rows,
           (SELECT count(*) FROM lost_pairs) AS coverage_missing,
           (SELECT count(*) FROM new_lake WHERE session_date IN (SELECT session_date FROM bad_dates)) AS knowledge_violations,
           (SELECT count(*) FROM (SELECT 1 FROM new_lake GROUP BY security_id, session_date HAVING count(*) > 1)) AS duplicate_pairs)
       SELECT *, coverage_missing = 0 AND duplicate_pairs = 0 AND knowledge_violations = 0 AS passed FROM r""",
)
def _(v: Views):
    return rebuild.report(*_lakes(v), v.sessions)
