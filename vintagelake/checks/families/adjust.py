"""Corporate actions and price adjustment."""

import datetime as dt

from pyspark.sql import functions as F

from vintagelake import schemas, session
from vintagelake.checks.registry import check
from vintagelake.checks.views import AS_OF, SQL_VIEWS, Views, settle, settle_sql
from vintagelake.operators import actions, adjust, asof
from vintagelake.sources import lake

_RANK = "CASE source WHEN 'MANUAL' THEN 0 WHEN 'SEC' THEN 1 WHEN 'TIINGO' THEN 2 WHEN 'BOOTSTRAP' THEN 3 ELSE 99 END"
SQL_VIEWS["acts"] = f"""
    SELECT * FROM actions WHERE ex_date <= DATE '{AS_OF}' AND known <= DATE '{AS_OF}'
    QUALIFY row_number() OVER (PARTITION BY security_id, action_type, ex_date
      ORDER BY {_RANK}, known DESC, action_id DESC) = 1"""
SQL_VIEWS["refs"] = """
    SELECT a.security_id, a.ex_date, a.action_type, a.split_from, a.split_to, a.cash_amount, b.close AS ref_close
    FROM acts a ASOF LEFT JOIN bars_asof b ON a.security_id = b.security_id AND a.ex_date > b.session_date"""
SQL_VIEWS["factors_split"] = """
    SELECT b.security_id, b.session_date, coalesce(product(a.split_from / a.split_to), 1.0) AS price_factor,
      1.0 / coalesce(product(a.split_from / a.split_to), 1.0) AS volume_factor
    FROM bars_asof b LEFT JOIN acts a ON a.security_id = b.security_id AND a.action_type = 'SPLIT'
      AND b.session_date < a.ex_date GROUP BY 1, 2"""
SQL_VIEWS["factors_total"] = """
    SELECT b.security_id, b.session_date,
      coalesce(product(CASE WHEN a.action_type = 'SPLIT' THEN a.split_from / a.split_to
        WHEN a.ref_close > 0 THEN (a.ref_close - coalesce(a.cash_amount, 0)) / a.ref_close ELSE 1.0 END), 1.0) AS price_factor,
      1.0 / coalesce(product(CASE WHEN a.action_type = 'SPLIT' THEN a.split_from / a.split_to END), 1.0) AS volume_factor
    FROM bars_asof b LEFT JOIN refs a ON a.security_id = b.security_id AND b.session_date < a.ex_date GROUP BY 1, 2"""

_ACT = """action_id, security_id, action_type, CAST(ex_date AS VARCHAR) AS ex_date, split_from, split_to, cash_amount,
    CAST(known AS VARCHAR) || ' 21:00:00' AS knowledge_time, source"""
_PRICES = ("open", "high", "low", "close", "vwap")
_ADJ = (
    "b.security_id, CAST(b.session_date AS VARCHAR) AS session_date, "
    + ", ".join(f"{settle_sql(f'b.{c} * f.price_factor', 4)} AS {c}" for c in _PRICES)
    + ", CAST(round_even(b.volume * f.volume_factor, 0) AS BIGINT) AS volume, b.trade_count, b.source"
)


def _rounded(df):
    prices = [settle(F.col(c), 4).alias(c) for c in _PRICES]
    return df.select("security_id", "session_date", *prices, "volume", "trade_count", "source")


@check(
    "action_asof",
    f"SELECT {_ACT} FROM actions WHERE ex_date <= DATE '{AS_OF}' AND known <= DATE '{AS_OF}' AND source <> 'BOOTSTRAP'",
)
def _(v: Views):
    # One source is not registered: its actions are not known.
    sources = v.actions.selectExpr("source AS name").distinct().where("name <> 'BOOTSTRAP'")
    return actions.known_actions(v.actions, AS_OF, sources).select(*v.actions.columns)


@check("action_precedence", f"SELECT {_ACT} FROM acts")
def _(v: Views):
    return actions.effective_actions(v.actions, AS_OF)


@check(
    "action_split_factor",
    "SELECT action_id, split_from / split_to AS factor FROM actions WHERE action_type = 'SPLIT'",
)
def _(v: Views):
    from vintagelake.functions.pricing import split_price_factor

    splits = v.actions.where("action_type = 'SPLIT'")
    return splits.select("action_id", split_price_factor().alias("factor"))


@check(
    "action_reference_close",
    """SELECT DISTINCT security_id, CAST(ex_date AS VARCHAR) AS ex_date, ref_close FROM refs""",
)
def _(v: Views):
    return adjust.dividend_references(asof.bars_asof_raw(v.bars, AS_OF), actions.effective_actions(v.actions, AS_OF))


@check(
    "action_dividend_factor",
    """SELECT security_id, CAST(ex_date AS VARCHAR) AS ex_date,
         CASE WHEN ref_close > 0 THEN (ref_close - coalesce(cash_amount, 0)) / ref_close ELSE 1.0 END AS factor
       FROM refs WHERE action_type = 'CASH_DIVIDEND'""",
)
def _(v: Views):
    from vintagelake.functions.pricing import dividend_price_factor

    acts = actions.effective_actions(v.actions, AS_OF)
    refs = adjust.dividend_references(asof.bars_asof_raw(v.bars, AS_OF), acts)
    paid = acts.where("action_type = 'CASH_DIVIDEND'").join(refs, ["security_id", "ex_date"])
    return paid.select(
        "security_id", "ex_date", dividend_price_factor(F.col("ref_close"), F.col("cash_amount")).alias("factor")
    )


_FAC = (
    "security_id, CAST(session_date AS VARCHAR) AS session_date, "
    f"{settle_sql('price_factor', 9)} AS price_factor, {settle_sql('volume_factor', 9)} AS volume_factor"
)


def _factors(v: Views, mode):
    acts = actions.effective_actions(v.actions, AS_OF)
    out = adjust.adjustment_factors(asof.bars_asof_raw(v.bars, AS_OF), acts, mode)
    return out.select(
        "security_id", "session_date", settle(F.col("price_factor"), 9).alias("price_factor"),
        settle(F.col("volume_factor"), 9).alias("volume_factor"),
    )


@check("adj_factors_split", f"SELECT {_FAC} FROM factors_split")
def _(v: Views):
    return _factors(v, "split")


@check("adj_factors_total_return", f"SELECT {_FAC} FROM factors_total")
def _(v: Views):
    return _factors(v, "total_return")


@check("adj_bars_split", f"SELECT {_ADJ} FROM bars_asof b JOIN factors_split f USING (security_id, session_date)")
def _(v: Views):
    return _rounded(adjust.bars_asof(v.bars, v.actions, AS_OF, adjustment="split"))


@check(
    "adj_bars_total_return",
    f"SELECT {_ADJ} FROM bars_asof b JOIN factors_total f USING (security_id, session_date)",
)
def _(v: Views):
    return _rounded(adjust.bars_asof(v.bars, v.actions, AS_OF, adjustment="total_return"))


@check(
    "adj_bars_total_return_range",
    f"""SELECT {_ADJ} FROM bars_asof b JOIN factors_total f USING (security_id, session_date)
        WHERE b.session_date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'""",
)
def _(v: Views):
    # Months and factors are stored; the read takes the months of its range and one segment for each bar.
    path, start, end = session.scratch(v.spark, "silver"), dt.date(1998, 1, 1), dt.date(1998, 12, 31)
    lake.write_months(v.bars, path)
    segments = session.stored(adjust.total_return_segments(v.bars, v.actions, AS_OF))
    rows = lake.scan_months(v.spark, path, schemas.BARS, start, end)
    return _rounded(adjust.bars_asof(rows, None, AS_OF, start=start, end=end, adjustment="total_return", segments=segments))


@check(
    "adj_segments",
    f"SELECT {_FAC} FROM factors_total",
)
def _(v: Views):
    days = asof.bars_asof_raw(v.bars, AS_OF).select("security_id", "session_date")
    out = adjust.with_stored_factors(days, adjust.total_return_segments(v.bars, v.actions, AS_OF), AS_OF)
    return out.select("security_id", "session_date", *[settle(F.col(c), 9).alias(c) for c in ("price_factor", "volume_factor")])


# The ratio search in SQL: all denominators for every distinct factor.
SQL_VIEWS["ratios"] = """
    SELECT f, arg_min(d, (err, d)) AS d, arg_min(n, (err, d)) AS n FROM (
      SELECT f, CAST(d AS DOUBLE) AS d, round_even(f * d, 0) AS n, abs(f - round_even(f * d, 0) / d) AS err
      FROM (SELECT DISTINCT split_factor AS f FROM vendor WHERE split_factor IS NOT NULL AND split_factor <> 0)
        CROSS JOIN (SELECT unnest(range(1, 1001)) AS d)) GROUP BY f"""
SQL_VIEWS["derived"] = """
    SELECT v.security_id, 'SPLIT' AS action_type, v.session_date AS ex_date,
      CASE WHEN abs(r.n / r.d - f) <= 1e-6 * greatest(1.0, abs(f)) THEN r.d ELSE 1.0 END AS split_from,
      CASE WHEN abs(r.n / r.d - f) <= 1e-6 * greatest(1.0, abs(f)) THEN r.n ELSE f END AS split_to,
      CAST(NULL AS DOUBLE) AS cash_amount,
      CASE WHEN abs(r.n / r.d - f) <= 1e-6 * greatest(1.0, abs(f)) THEN NULL ELSE 'ratio not exact' END AS warning
    FROM vendor v JOIN ratios r ON r.f = v.split_factor WHERE abs(v.split_factor - 1.0) > 1e-9
    UNION ALL
    SELECT security_id, 'CASH_DIVIDEND', session_date, NULL, NULL, div_cash, NULL FROM vendor WHERE div_cash > 0"""


@check(
    "action_derive",
    """SELECT security_id, action_type, CAST(ex_date AS VARCHAR) AS ex_date, split_from, split_to, cash_amount, warning
       FROM derived""",
)
def _(v: Views):
    return actions.derive_actions(v.vendor)


@check(
    "action_rationalize",
    """SELECT v.batch_id, v.line, v.split_factor, r.d AS split_from, r.n AS split_to,
         abs(r.n / r.d - r.f) <= 1e-6 * greatest(1.0, abs(r.f)) AS exact
       FROM vendor v JOIN ratios r ON r.f = v.split_factor WHERE abs(v.split_factor - 1.0) > 1e-9""",
)
def _(v: Views):
    from vintagelake.functions.pricing import best_ratio, ratio_is_exact

    rows = v.vendor.where("split_factor <> 0 AND abs(split_factor - 1.0) > 1e-9")
    r = rows.withColumn("r", best_ratio(F.col("split_factor")))
    return r.select(
        "batch_id", "line", "split_factor", F.col("r.d").alias("split_from"), F.col("r.n").alias("split_to"),
        ratio_is_exact(F.col("r"), F.col("split_factor")).alias("exact"),
    )


# Actions known by the end of 1997 are stored; all later ones arrive as one batch.
_CUT = "DATE '1997-12-31'"
_KEYED = "action_id, security_id, action_type, ex_date, source, split_from, split_to, cash_amount"
SQL_VIEWS["append_outcomes"] = f"""
    SELECT i.*, CASE
        WHEN s.n IS NOT NULL THEN CASE WHEN s.eq THEN 'skipped_exact' ELSE 'conflict' END
        WHEN i.action_id = f.action_id THEN 'inserted'
        WHEN i.split_from IS NOT DISTINCT FROM f.split_from AND i.split_to IS NOT DISTINCT FROM f.split_to
          AND i.cash_amount IS NOT DISTINCT FROM f.cash_amount THEN 'skipped_exact'
        ELSE 'conflict' END AS outcome
    FROM (SELECT * FROM actions WHERE known > {_CUT}) i
    JOIN (SELECT * FROM actions WHERE known > {_CUT}
          QUALIFY row_number() OVER (PARTITION BY security_id, action_type, ex_date, source ORDER BY action_id) = 1) f
      USING (security_id, action_type, ex_date, source)
    LEFT JOIN (SELECT i.action_id, count(*) AS n, bool_or(i.split_from IS NOT DISTINCT FROM e.split_from
            AND i.split_to IS NOT DISTINCT FROM e.split_to AND i.cash_amount IS NOT DISTINCT FROM e.cash_amount) AS eq
          FROM actions i JOIN actions e USING (security_id, action_type, ex_date, source)
          WHERE i.known > {_CUT} AND e.known <= {_CUT} GROUP BY 1) s ON s.action_id = i.action_id"""


def _outcomes(v: Views):
    stored = v.actions.where(F.to_date("knowledge_time") <= F.lit(dt.date(1997, 12, 31)))
    batch = v.actions.where(F.to_date("knowledge_time") > F.lit(dt.date(1997, 12, 31)))
    return actions.write_outcomes(stored, batch, ["action_id"])


@check("action_append", f"SELECT {_ACT}, outcome FROM append_outcomes")
def _(v: Views):
    return _outcomes(v)


@check(
    "action_append_tallies",
    "SELECT source, outcome, count(*) AS n FROM append_outcomes GROUP BY ALL",
)
def _(v: Views):
    return actions.outcome_tallies(_outcomes(v))


@check(
    "action_append_conflicts",
    f"""WITH told AS (SELECT *, CASE WHEN action_type = 'SPLIT' THEN split_from || '->' || split_to ELSE '$' || cash_amount END AS t
           FROM (SELECT {_KEYED}, 'stored' AS outcome FROM actions WHERE known <= {_CUT}
             UNION ALL SELECT {_KEYED}, outcome FROM append_outcomes)),
         held AS (SELECT security_id, action_type, ex_date, source, string_agg(DISTINCT t, '; ' ORDER BY t) AS stored FROM told
           WHERE outcome IN ('stored', 'inserted') GROUP BY ALL)
       SELECT action_id, 'CONFLICT ' || action_type || ' ' || CAST(ex_date AS VARCHAR) || ': existing [' || stored
         || '] != incoming [' || t || ']' AS message
       FROM told JOIN held USING (security_id, action_type, ex_date, source) WHERE outcome = 'conflict'""",
)
def _(v: Views):
    stored = v.actions.where(F.to_date("knowledge_time") <= F.lit(dt.date(1997, 12, 31)))
    return actions.conflict_messages(_outcomes(v), stored)


@check(
    "action_load_bootstrap",
    """SELECT security_id, action_type, CAST(ex_date AS VARCHAR) AS ex_date, split_from, split_to, cash_amount,
         CAST(ex_date AS VARCHAR) || ' 00:00:00' AS knowledge_time, 'BOOTSTRAP' AS source
       FROM derived WHERE ex_date >= DATE '1995-01-01'""",
)
def _(v: Views):
    # The full window, from the first day of the given tables instead of the fixed one.
    start = actions.load_window(dt.date(2001, 8, 15), full=True, history_start=dt.date(1995, 1, 1))
    found = actions.derive_actions(v.vendor.where(F.col("session_date") >= F.lit(start))).drop("warning")
    return actions.stamp_bootstrap(found)


@check(
    "action_load_rolling",
    """SELECT security_id, action_type, CAST(ex_date AS VARCHAR) AS ex_date, split_from, split_to, cash_amount,
         '2001-08-15 22:00:00' AS knowledge_time, 'TIINGO' AS source
       FROM derived WHERE ex_date >= DATE '2001-08-05'""",
)
def _(v: Views):
    start = actions.load_window(dt.date(2001, 8, 15), full=False)
    found = actions.derive_actions(v.vendor.where(F.col("session_date") >= F.lit(start))).drop("warning")
    return actions.stamp_canonical(found, dt.datetime(2001, 8, 15, 22, tzinfo=dt.timezone.utc))


@check(
    "action_load_status",
    """SELECT source_id AS batch_id, count(*) AS symbols, count(*) FILTER (WHERE status = 'failed') AS symbols_failed,
         CASE WHEN bool_or(status = 'failed') THEN 'partial' ELSE 'succeeded' END AS status
       FROM batches GROUP BY source_id""",
)
def _(v: Views):
    return actions.load_status(v.batches.selectExpr("source_id AS batch_id", "status = 'failed' AS failed"))
