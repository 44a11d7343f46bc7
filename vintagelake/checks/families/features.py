"""Price features and the feature refresh."""

import datetime as dt
import re

from pyspark.sql import functions as F

from vintagelake import schemas, session
from vintagelake.checks.registry import check
from vintagelake.checks.views import AS_OF, SQL_VIEWS, Views, settle, settle_sql
from vintagelake.operators import asof, features
from vintagelake.plans import gold as gold_plan, gold_state
from vintagelake.sources import lake

SQL_VIEWS["feat"] = """
    SELECT *, close / lag(close, 1) OVER w - 1 AS return_1d, ln(close / lag(close, 1) OVER w) AS log_return_1d,
      CASE WHEN count(*) OVER w20 = 20 THEN avg(close) OVER w20 END AS sma20,
      CASE WHEN count(*) OVER w50 = 50 THEN avg(close) OVER w50 END AS sma50,
      close / lag(close, 20) OVER w - 1 AS roc20,
      lag(close, 21) OVER w / lag(close, 252) OVER w - 1 AS momentum_12_1,
      row_number() OVER w - 1 AS i, list(close) OVER w AS closes
    FROM bars_latest
    WINDOW w AS (PARTITION BY security_id ORDER BY session_date),
      w20 AS (PARTITION BY security_id ORDER BY session_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
      w50 AS (PARTITION BY security_id ORDER BY session_date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)"""
SQL_VIEWS["vol"] = """
    SELECT security_id, session_date, CASE WHEN count(log_return_1d) OVER w = 20
        THEN stddev_samp(log_return_1d) OVER w * sqrt(252) END AS realized_vol20
    FROM feat WINDOW w AS (PARTITION BY security_id ORDER BY session_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"""
# The recursion itself, restarted 400 closes back (weight left out about 4e-18).
_EMA = """list_reduce(list_transform(range(greatest(i - 400, 0), i + 1), lambda j: CAST(closes[j + 1] AS DOUBLE)),
    lambda a, b: a * (19.0::DOUBLE / 21) + b * (2.0::DOUBLE / 21))"""


def _digits(name: str) -> int:
    """Fewer digits for price levels than for ratios."""
    return 4 if name in ("adj_close", "sma20", "sma50", "ema20") else 8


def _feature(v: Views, column, name: str):
    bars = asof.latest_bars(v.bars).select("security_id", "session_date", "close")
    out = bars.withColumn(name, column)
    return out.select("security_id", "session_date", settle(F.col(name), _digits(name)).alias(name))


def _sql(name: str) -> str:
    value = settle_sql(name, _digits(name))
    return f"SELECT security_id, CAST(session_date AS VARCHAR) AS session_date, {value} AS {name} FROM feat"


@check("feat_return_1d", _sql("return_1d"))
def _(v: Views):
    return _feature(v, features.simple_return(1), "return_1d")


@check("feat_log_return_1d", _sql("log_return_1d"))
def _(v: Views):
    return _feature(v, features.log_return(1), "log_return_1d")


@check("feat_sma20", _sql("sma20"))
def _(v: Views):
    return _feature(v, features.sma(20), "sma20")


@check("feat_sma50", _sql("sma50"))
def _(v: Views):
    return _feature(v, features.sma(50), "sma50")


@check("feat_roc20", _sql("roc20"))
def _(v: Views):
    return _feature(v, features.roc(20), "roc20")


@check("feat_momentum_12_1", _sql("momentum_12_1"))
def _(v: Views):
    return _feature(v, features.momentum_12_1(), "momentum_12_1")


@check(
    "feat_realized_vol20",
    f"""SELECT security_id, CAST(session_date AS VARCHAR) AS session_date,
          {settle_sql('realized_vol20', 8)} AS realized_vol20 FROM vol""",
)
def _(v: Views):
    bars = asof.latest_bars(v.bars).select("security_id", "session_date", "close")
    out = bars.withColumn("r", features.log_return(1)).withColumn("x", features.realized_vol("r"))
    return out.select("security_id", "session_date", settle(F.col("x"), 8).alias("realized_vol20"))


@check(
    "feat_ema20",
    f"SELECT security_id, CAST(session_date AS VARCHAR) AS session_date, {settle_sql(_EMA, 4)} AS ema20 FROM feat",
)
def _(v: Views):
    bars = asof.latest_bars(v.bars).select("security_id", "session_date", "close")
    out = features.with_ema(bars, 20, "ema20")
    return out.select("security_id", "session_date", settle(F.col("ema20"), 4).alias("ema20"))


# Wide rows on split-adjusted bars, over everything known at AS_OF.
_END = "coalesce(s.valid_to, DATE '9999-12-31')"
SQL_VIEWS["adjusted"] = """
    SELECT b.security_id, b.session_date, b.known, b.close * f.price_factor AS close,
      CAST(round_even(b.volume * f.volume_factor, 0) AS BIGINT) AS volume
    FROM bars_asof b JOIN factors_split f USING (security_id, session_date)"""
SQL_VIEWS["wide0"] = """
    SELECT *, close / lag(close, 1) OVER w - 1 AS return_1d, ln(close / lag(close, 1) OVER w) AS log_return_1d,
      CASE WHEN count(*) OVER w20 = 20 THEN avg(close) OVER w20 END AS sma20,
      CASE WHEN count(*) OVER w50 = 50 THEN avg(close) OVER w50 END AS sma50,
      close / lag(close, 20) OVER w - 1 AS roc20,
      lag(close, 21) OVER w / lag(close, 252) OVER w - 1 AS momentum_12_1,
      row_number() OVER w - 1 AS i, list(close) OVER w AS closes
    FROM adjusted
    WINDOW w AS (PARTITION BY security_id ORDER BY session_date),
      w20 AS (PARTITION BY security_id ORDER BY session_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
      w50 AS (PARTITION BY security_id ORDER BY session_date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)"""
SQL_VIEWS["wide"] = f"""
    SELECT x.security_id, s.id_value AS symbol, x.session_date, x.known, x.close AS adj_close, x.volume AS adj_volume,
      x.return_1d, x.log_return_1d, x.sma20, x.sma50, {_EMA} AS ema20,
      CASE WHEN count(log_return_1d) OVER w = 20 THEN stddev_samp(log_return_1d) OVER w * sqrt(252) END AS realized_vol20,
      x.roc20, x.momentum_12_1
    FROM wide0 x LEFT JOIN (
      SELECT b.security_id, b.session_date, s.id_value FROM adjusted b JOIN identifiers s
        ON s.security_id = b.security_id AND s.valid_from <= b.session_date AND b.session_date < {_END}
      QUALIFY row_number() OVER (PARTITION BY b.security_id, b.session_date ORDER BY s.valid_from, {_END} DESC,
        s.id_value) = 1) s ON s.security_id = x.security_id AND s.session_date = x.session_date
    WINDOW w AS (PARTITION BY x.security_id ORDER BY x.session_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"""
_NUM = ("adj_close", "return_1d", "log_return_1d", "sma20", "sma50", "ema20", "realized_vol20", "roc20", "momentum_12_1")
GOLD_SQL = (
    "security_id, symbol, CAST(session_date AS VARCHAR) AS session_date, "
    "CAST(known AS VARCHAR) || ' 21:00:00' AS knowledge_time, adj_volume, "
    + ", ".join(f"{settle_sql(c, _digits(c))} AS {c}" for c in _NUM)
)


def rounded_gold(df):
    return df.select(
        "security_id", "symbol", "session_date", "knowledge_time", "adj_volume",
        *[settle(F.col(c), _digits(c)).alias(c) for c in _NUM],
    )


def refreshed(v: Views, **kw):
    return gold_plan.refresh(v.bars, v.actions, v.identifiers, AS_OF, **kw)


@check("gold_wide", f"SELECT {GOLD_SQL} FROM wide")
def _(v: Views):
    return rounded_gold(refreshed(v))


@check(
    "gold_refresh_months",
    f"""SELECT {GOLD_SQL} FROM wide WHERE session_date >= DATE '2000-03-01' AND session_date < DATE '2000-05-01'""",
)
def _(v: Views):
    return rounded_gold(refreshed(v, months=[(2000, 3), (2000, 4)]))


@check(
    "gold_nightly_plan",
    """WITH l AS (SELECT min(session_date) AS d FROM (SELECT session_date FROM sessions
           WHERE session_date < DATE '2000-03-01' ORDER BY session_date DESC LIMIT 252))
       SELECT CAST(d AS VARCHAR) AS lookback_start, 2000 AS year, unnest([3, 4]) AS month FROM l""",
)
def _(v: Views):
    return gold_plan.nightly_plan(v.sessions, dt.date(2000, 4, 4))


# The same features over bars that begin with the look-back.
SQL_VIEWS["night_bars"] = """
    SELECT * FROM adjusted WHERE session_date >= (SELECT min(session_date) FROM (SELECT session_date FROM sessions
      WHERE session_date < DATE '2000-03-01' ORDER BY session_date DESC LIMIT 400))"""
SQL_VIEWS["night0"] = re.sub(r"\badjusted\b", "night_bars", SQL_VIEWS["wide0"])
SQL_VIEWS["night"] = re.sub(r"\bwide0\b", "night0", re.sub(r"\badjusted\b", "night_bars", SQL_VIEWS["wide"]))


@check(
    "gold_nightly",
    f"""SELECT {GOLD_SQL} FROM night WHERE session_date >= DATE '2000-03-01' AND session_date < DATE '2000-05-01'""",
)
def _(v: Views):
    # From the stored lake, so that the bound reaches its month partitions.
    path = session.scratch(v.spark, "bars")
    lake.write_months(v.bars, path)
    start = gold_plan.nightly_plan(v.sessions, dt.date(2000, 4, 4), gold_plan.EMA_LOOKBACK).first().lookback_start
    stored = lake.scan_months(v.spark, path, schemas.BARS, start)
    return rounded_gold(
        gold_plan.nightly(stored, v.actions, v.identifiers, v.sessions, dt.date(2000, 4, 4), as_of=AS_OF)
    )


@check(
    "gold_nightly_state",
    f"""SELECT {GOLD_SQL} FROM wide WHERE session_date >= DATE '2000-03-01' AND session_date < DATE '2000-05-01'""",
)
def _(v: Views):
    # A state built in January, when bars of November were still to come, taken on in March, and used in April.
    paths = [session.scratch(v.spark, name) for name in ("bars", "january", "march")]
    lake.write_months(v.bars, paths[0])
    bars = lake.scan_months(v.spark, paths[0], schemas.BARS)
    gold_state.advance(None, bars, v.actions, dt.date(2000, 1, 5), dt.date(1999, 12, 1)).write.parquet(paths[1])
    january = v.spark.read.parquet(paths[1])
    gold_state.advance(january, bars, v.actions, dt.date(2000, 3, 20), dt.date(2000, 2, 1)).write.parquet(paths[2])
    march = v.spark.read.parquet(paths[2])
    return rounded_gold(gold_state.nightly(march, bars, v.actions, v.identifiers, dt.date(2000, 4, 4), as_of=AS_OF))


@check(
    "gold_asof",
    f"""SELECT {GOLD_SQL} FROM wide WHERE known <= DATE '2000-03-31'
        AND session_date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31'""",
)
def _(v: Views):
    rows = refreshed(v)
    return rounded_gold(
        asof.gold_asof(rows, dt.date(2000, 3, 31), start=dt.date(1999, 1, 1), end=dt.date(1999, 12, 31))
    )


_MEMBER = f"""security_id IN (SELECT security_id FROM membership WHERE valid_from <= DATE '{AS_OF}'
    AND (valid_to IS NULL OR DATE '{AS_OF}' < valid_to))"""


@check("flagship_member_features", f"SELECT {GOLD_SQL} FROM wide WHERE {_MEMBER}")
def _(v: Views):
    members = asof.members_asof(v.membership, AS_OF).select("security_id").distinct()
    bars, actions, ids = (df.join(members, "security_id", "left_semi") for df in (v.bars, v.actions, v.identifiers))
    return rounded_gold(gold_plan.refresh(bars, actions, ids, AS_OF))


@check(
    "gold_breadth",
    f"""SELECT CAST(session_date AS VARCHAR) AS session_date,
          round(avg(CASE WHEN adj_close > sma50 THEN 1.0 ELSE 0.0 END), 9) AS breadth, count(*) AS members
        FROM wide WHERE sma50 IS NOT NULL AND {_MEMBER} GROUP BY session_date""",
)
def _(v: Views):
    out = features.breadth(asof.members_asof(v.membership, AS_OF), refreshed(v))
    return out.withColumn("breadth", F.round("breadth", 9))
