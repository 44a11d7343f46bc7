"""Point-in-time reads."""

import datetime as dt

from pyspark.sql import functions as F

from vintagelake.checks.registry import check
from vintagelake.checks.views import AS_OF, Views
from vintagelake.operators import asof

BAR_SQL = (
    "security_id, symbol, CAST(session_date AS VARCHAR) AS session_date, open, high, low, close, volume, "
    "trade_count, vwap, CAST(known AS VARCHAR) || ' 21:00:00' AS knowledge_time, batch_id, source"
)
MACRO_AS_OF = dt.date(2024, 1, 20)
CONTEXT_SERIES = "purchase"


@check("asof_bars", f"SELECT {BAR_SQL} FROM bars_asof")
def _(v: Views):
    return asof.bars_asof_raw(v.bars, AS_OF)


@check(
    "asof_bars_range",
    f"SELECT {BAR_SQL} FROM bars_asof WHERE session_date BETWEEN DATE '1997-03-01' AND DATE '1999-02-28'",
)
def _(v: Views):
    return asof.bars_asof_raw(v.bars, AS_OF, start=dt.date(1997, 3, 1), end=dt.date(1999, 2, 28))


@check("asof_bars_latest", f"SELECT {BAR_SQL} FROM bars_latest")
def _(v: Views):
    return asof.latest_bars(v.bars)


@check(
    "asof_fundamentals",
    f"""SELECT security_id, accession, concept, CAST(period_start AS VARCHAR) AS period_start,
          CAST(period_end AS VARCHAR) AS period_end, fiscal_period, CAST(value AS DOUBLE) AS value, unit,
          CAST(filed AS VARCHAR) || ' 00:00:00' AS filed_at
        FROM facts WHERE filed <= DATE '{AS_OF}'
        QUALIFY row_number() OVER (PARTITION BY security_id, concept, period_end, period_start
          ORDER BY filed DESC, accession DESC, value DESC, unit DESC) = 1""",
)
def _(v: Views):
    return asof.fundamentals_asof(v.facts, AS_OF)


@check(
    "asof_macro",
    f"""SELECT series_id, CAST(obs_date AS VARCHAR) AS obs_date, CAST(vintage_date AS VARCHAR) AS vintage_date, value
        FROM macro WHERE vintage_date <= DATE '{MACRO_AS_OF}'
        QUALIFY row_number() OVER (PARTITION BY series_id, obs_date ORDER BY vintage_date DESC, value DESC) = 1""",
)
def _(v: Views):
    return asof.observations_asof(v.macro, MACRO_AS_OF)


@check(
    "asof_macro_point",
    """SELECT series_id, CAST(obs_date AS VARCHAR) AS obs_date, arg_max(value, vintage_date) AS value,
         CAST(max(vintage_date) AS VARCHAR) AS vintage_date
       FROM macro WHERE series_id = 'view' AND obs_date = DATE '2024-01-10' AND vintage_date <= DATE '2024-01-13'
       GROUP BY series_id, obs_date""",
)
def _(v: Views):
    return asof.macro_value_asof(v.macro, "view", dt.date(2024, 1, 10), dt.date(2024, 1, 13))


@check(
    "asof_bars_instant",
    """SELECT security_id, CAST(session_date AS VARCHAR) AS session_date, close, batch_id FROM bars
       WHERE known < DATE '1999-03-15'
       QUALIFY row_number() OVER (PARTITION BY security_id, session_date ORDER BY known DESC, batch_id DESC, source,
         close DESC, volume DESC, open DESC, high DESC, low DESC, trade_count DESC, vwap DESC) = 1""",
)
def _(v: Views):
    # A naive datetime is read as UTC; 12:00 lies before the 21:00 knowledge time of that day.
    out = asof.bars_asof_raw(v.bars, dt.datetime(1999, 3, 15, 12, 0))
    return out.select("security_id", "session_date", "close", "batch_id")


_MEMBERS = "SELECT universe, security_id, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to FROM membership"
_ON_DAY = f"valid_from <= DATE '{AS_OF}' AND (valid_to IS NULL OR DATE '{AS_OF}' < valid_to)"


@check("asof_members", f"{_MEMBERS} WHERE {_ON_DAY}")
def _(v: Views):
    return asof.members_asof(v.membership, AS_OF)


@check("asof_members_bitemporal", f"{_MEMBERS} WHERE {_ON_DAY} AND known <= DATE '2000-03-31'")
def _(v: Views):
    return asof.members_asof_bitemporal(v.membership, AS_OF, dt.date(2000, 3, 31))


@check("asof_members_strict", f"{_MEMBERS} WHERE {_ON_DAY} AND known <= DATE '{AS_OF}'")
def _(v: Views):
    return asof.members_asof_strict(v.membership, AS_OF)


@check(
    "asof_world_state",
    f"""WITH m AS (SELECT value, obs_date FROM macro
            WHERE series_id = '{CONTEXT_SERIES}' AND vintage_date <= DATE '2024-06-30'
            QUALIFY row_number() OVER (PARTITION BY obs_date ORDER BY vintage_date DESC, value DESC) = 1),
          ctx AS (SELECT value FROM m ORDER BY obs_date DESC LIMIT 1),
          f AS (SELECT * FROM facts WHERE concept = 'total_assets' AND period_start IS NULL
              AND CAST(filed + INTERVAL 24 YEAR AS DATE) <= DATE '2024-06-30'
            QUALIFY row_number() OVER (PARTITION BY security_id
              ORDER BY period_end DESC, filed DESC, accession DESC, value DESC) = 1)
        SELECT f.security_id, s.figi, s.description, CAST(f.value AS DOUBLE) AS total_assets,
          CAST(f.period_end AS VARCHAR) AS period_end, ctx.value AS context_value
        FROM f JOIN securities s ON s.security_id = f.security_id CROSS JOIN ctx""",
)
def _(v: Views):
    # Observations are of 2024: facts are filed 24 years later, so that both are partly unknown on the day.
    facts = v.facts.withColumn("filed_at", F.expr("filed_at + INTERVAL '24' YEAR"))
    return asof.world_state(v.macro, facts, v.securities, CONTEXT_SERIES, dt.date(2024, 6, 30))


@check(
    "asof_member_bars",
    f"""SELECT {BAR_SQL} FROM bars_asof WHERE security_id IN (SELECT security_id FROM membership WHERE {_ON_DAY})""",
)
def _(v: Views):
    return asof.member_bars(v.membership, v.bars, None, AS_OF)
