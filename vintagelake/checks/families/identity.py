"""Ticker resolution, symbols and universe reads."""

import datetime as dt

from pyspark.sql import functions as F

from vintagelake.checks.registry import check
from vintagelake.checks.views import AS_OF, TODAY, Views
from vintagelake.operators import asof, identity

_END = "coalesce(i.valid_to, DATE '9999-12-31')"


def _requests(v: Views):
    """A (ticker, day) request per order; upper and lower case mixed."""
    return v.table("orders").selectExpr(
        "o_orderkey AS request_id",
        f"CASE WHEN o_orderkey % 2 = 0 THEN concat('t', (o_custkey % {v.n_securities}) div 8)"
        f" ELSE concat('U', (o_custkey % {v.n_securities}) div 2) END AS ticker",
        "CAST(o_orderdate AS DATE) AS day",
    )


_REQ = """SELECT o_orderkey AS request_id,
    CASE WHEN o_orderkey % 2 = 0 THEN 't' || ((o_custkey % (SELECT n FROM nsec)) // 8)
      ELSE 'U' || ((o_custkey % (SELECT n FROM nsec)) // 2) END AS ticker, CAST(o_orderdate AS DATE) AS day
  FROM orders"""


@check(
    "id_resolve_ticker",
    f"""WITH r AS ({_REQ})
        SELECT r.request_id, r.ticker, CAST(r.day AS VARCHAR) AS day, i.security_id
        FROM r LEFT JOIN identifiers i ON upper(i.id_value) = upper(r.ticker) AND i.valid_from <= r.day
          AND r.day < {_END}
        QUALIFY row_number() OVER (PARTITION BY r.request_id
          ORDER BY i.valid_from DESC, {_END} DESC, i.security_id) = 1""",
)
def _(v: Views):
    return identity.resolve(_requests(v), v.identifiers, "ticker", "day")


_NOW = f"""SELECT upper(i.id_value) AS ticker_key, i.security_id FROM identifiers i
    WHERE i.valid_from <= DATE '{TODAY}' AND DATE '{TODAY}' < {_END}
    QUALIFY row_number() OVER (PARTITION BY upper(i.id_value)
      ORDER BY i.valid_from DESC, {_END} DESC, i.security_id) = 1"""
_SYMBOLS = f"SELECT DISTINCT ticker AS symbol FROM ({_REQ}) UNION SELECT DISTINCT p_brand FROM part"


def _symbols(v: Views):
    asked = _requests(v).selectExpr("ticker AS symbol")
    return asked.union(v.table("part").selectExpr("p_brand AS symbol")).distinct()


@check(
    "id_resolve_batch",
    f"WITH n AS ({_NOW}), s AS ({_SYMBOLS}) SELECT s.symbol, n.security_id FROM s JOIN n ON n.ticker_key = upper(s.symbol)",
)
def _(v: Views):
    return identity.resolve_batch(_symbols(v), v.identifiers, TODAY)[0]


@check(
    "id_resolve_batch_skipped",
    f"WITH n AS ({_NOW}), s AS ({_SYMBOLS}) SELECT s.symbol FROM s WHERE upper(s.symbol) NOT IN (SELECT ticker_key FROM n)",
)
def _(v: Views):
    return identity.resolve_batch(_symbols(v), v.identifiers, TODAY)[1]


_USE = """SELECT id_value, count(*) AS n_rows, count(DISTINCT security_id) AS n_securities,
    min(security_id) AS security_id FROM identifiers GROUP BY id_value"""


@check(
    "id_any_time",
    f"WITH u AS ({_USE}) SELECT id_value AS symbol, security_id FROM u WHERE n_rows = 1",
)
def _(v: Views):
    asked = v.identifiers.selectExpr("id_value AS symbol").distinct()
    return identity.resolve_any_time(asked, v.identifiers)[0]


@check(
    "id_any_time_ambiguous",
    f"WITH u AS ({_USE}) SELECT id_value AS symbol, n_rows, n_securities FROM u WHERE n_rows > 1",
)
def _(v: Views):
    asked = v.identifiers.selectExpr("id_value AS symbol").distinct()
    return identity.resolve_any_time(asked, v.identifiers)[1]


@check(
    "id_symbol_of_bar",
    f"""SELECT b.security_id, CAST(b.session_date AS VARCHAR) AS session_date, i.id_value AS ticker
        FROM bars_latest b LEFT JOIN identifiers i ON i.security_id = b.security_id
          AND i.valid_from <= b.session_date AND b.session_date < {_END}
        QUALIFY row_number() OVER (PARTITION BY b.security_id, b.session_date
          ORDER BY i.valid_from, {_END} DESC, i.id_value) = 1""",
)
def _(v: Views):
    bars = asof.latest_bars(v.bars).select("security_id", "session_date")
    return identity.attach_symbol(bars, v.identifiers)


@check(
    "id_listed",
    f"""SELECT DISTINCT id_value AS ticker FROM identifiers
        WHERE valid_from <= DATE '{TODAY}' AND (valid_to IS NULL OR valid_to >= DATE '{TODAY}')""",
)
def _(v: Views):
    return identity.listed_tickers(v.identifiers, TODAY)


@check(
    "id_display_symbol",
    """SELECT security_id, id_value AS ticker FROM identifiers
       QUALIFY row_number() OVER (PARTITION BY security_id ORDER BY valid_from DESC, id_value DESC) = 1""",
)
def _(v: Views):
    return identity.display_symbol(v.identifiers)


_HISTORY = f"""SELECT m.universe, m.security_id, m.valid_from, m.valid_to, i.id_value AS ticker
    FROM (SELECT * FROM membership WHERE known <= DATE '2000-09-30') m
    LEFT JOIN identifiers i ON i.security_id = m.security_id AND i.valid_from <= m.valid_from
      AND m.valid_from < {_END}
    QUALIFY row_number() OVER (PARTITION BY m.universe, m.security_id, m.valid_from
      ORDER BY i.valid_from DESC, {_END} DESC, i.id_value) = 1"""


@check(
    "id_universe_history",
    f"""WITH h AS ({_HISTORY}) SELECT universe, security_id, CAST(valid_from AS VARCHAR) AS valid_from,
          CAST(valid_to AS VARCHAR) AS valid_to, ticker FROM h""",
)
def _(v: Views):
    return identity.universe_history(v.membership, v.identifiers, None, dt.date(2000, 9, 30))


@check(
    "id_universe_history_counts",
    f"""WITH h AS ({_HISTORY}) SELECT universe, count(*) AS interval_count,
          count(DISTINCT security_id) AS security_count FROM h GROUP BY universe""",
)
def _(v: Views):
    history = identity.universe_history(v.membership, v.identifiers, None, dt.date(2000, 9, 30))
    return identity.universe_history_counts(history)


@check(
    "id_universe_members",
    f"""SELECT m.universe, m.security_id, i.id_value AS ticker, CAST(m.valid_from AS VARCHAR) AS valid_from,
          CAST(m.valid_to AS VARCHAR) AS valid_to
        FROM (SELECT * FROM membership WHERE valid_from <= DATE '{AS_OF}'
               AND (valid_to IS NULL OR DATE '{AS_OF}' < valid_to)) m
        LEFT JOIN identifiers i ON i.security_id = m.security_id AND i.valid_from <= DATE '{AS_OF}'
          AND DATE '{AS_OF}' < {_END}
        QUALIFY row_number() OVER (PARTITION BY m.universe, m.security_id, m.valid_from
          ORDER BY i.valid_from DESC, {_END} DESC, i.id_value) = 1""",
)
def _(v: Views):
    return identity.universe_members(v.membership, v.identifiers, None, AS_OF)
