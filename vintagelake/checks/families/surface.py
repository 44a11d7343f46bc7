"""Client-shaped reads."""

import datetime as dt

from pyspark.sql import functions as F

from vintagelake import seeds
from vintagelake.checks.families.features import GOLD_SQL, refreshed, rounded_gold
from vintagelake.checks.registry import check
from vintagelake.checks.views import AS_OF, SQL_VIEWS, Views, settle, settle_sql
from vintagelake.plans import surface

_FAR = "DATE '9999-12-31'"
_PRICES = ("open", "high", "low", "close", "vwap")


def _select(symbol: str) -> str:
    return (
        f"b.security_id, {symbol} AS symbol, CAST(b.session_date AS VARCHAR) AS session_date, "
        + ", ".join(f"{settle_sql(f'b.{c} * f.price_factor', 4)} AS {c}" for c in _PRICES)
        + ", CAST(round_even(b.volume * f.volume_factor, 0) AS BIGINT) AS volume"
    )


def _shown(df):
    return df.select(
        "security_id", "symbol", "session_date", *[settle(F.col(c), 4).alias(c) for c in _PRICES], "volume"
    )


def _resolved(symbol: str) -> str:
    return f"""(SELECT security_id FROM identifiers i WHERE upper(id_value) = '{symbol.upper()}' AND valid_from <= DATE '{AS_OF}'
        AND DATE '{AS_OF}' < coalesce(valid_to, {_FAR})
        ORDER BY valid_from DESC, coalesce(valid_to, {_FAR}) DESC, security_id LIMIT 1)"""


_IDENTITY = "(SELECT security_id, session_date, 1.0 AS price_factor, 1.0 AS volume_factor FROM bars_asof)"


@check(
    "read_bars_raw",
    f"""SELECT {_select("'U0'")} FROM bars_asof b JOIN {_IDENTITY} f USING (security_id, session_date)
        WHERE b.security_id = {_resolved('u0')} AND b.session_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""",
)
def _(v: Views):
    return _shown(
        surface.bars(v.bars, v.actions, v.identifiers, "u0", AS_OF, dt.date(1996, 1, 1), dt.date(1999, 12, 31))
    )


@check(
    "read_bars_split",
    f"""SELECT {_select("'U1'")} FROM bars_asof b JOIN factors_split f USING (security_id, session_date)
        WHERE b.security_id = {_resolved('U1')}""",
)
def _(v: Views):
    return _shown(surface.bars(v.bars, v.actions, v.identifiers, "U1", AS_OF, adjustment="split"))


@check(
    "read_bars_total_return",
    f"""SELECT {_select("'U1'")} FROM bars_asof b JOIN factors_total f USING (security_id, session_date)
        WHERE b.security_id = {_resolved('U1')} AND b.session_date >= DATE '1998-06-01'""",
)
def _(v: Views):
    return _shown(
        surface.bars(
            v.bars, v.actions, v.identifiers, "U1", AS_OF, start=dt.date(1998, 6, 1), adjustment="total_return"
        )
    )


@check(
    "read_bars_by_id",
    f"""SELECT {_select("(SELECT arg_max(id_value, (valid_from, id_value)) FROM identifiers WHERE security_id = 3)")}
        FROM bars_asof b JOIN factors_split f USING (security_id, session_date) WHERE b.security_id = 3""",
)
def _(v: Views):
    return _shown(
        surface.bars_by_id(v.bars, v.actions, v.identifiers, v.securities, 3, AS_OF, adjustment="split")
    )


SQL_VIEWS["asked"] = "SELECT DISTINCT CASE WHEN p_size % 2 = 0 THEN 't' || (p_size // 2) ELSE 'NONE' || p_size END AS symbol FROM part"
SQL_VIEWS["asked_ids"] = f"""
    SELECT a.symbol, n.security_id FROM asked a LEFT JOIN (SELECT upper(i.id_value) AS k, i.security_id FROM identifiers i
      WHERE i.valid_from <= DATE '{AS_OF}' AND DATE '{AS_OF}' < coalesce(i.valid_to, {_FAR})
      QUALIFY row_number() OVER (PARTITION BY upper(i.id_value) ORDER BY i.valid_from DESC, coalesce(i.valid_to, {_FAR}) DESC,
        i.security_id) = 1) n ON n.k = upper(a.symbol)"""


def _asked(v: Views):
    return v.table("part").selectExpr(
        "CASE WHEN p_size % 2 = 0 THEN concat('t', p_size div 2) ELSE concat('NONE', p_size) END AS symbol"
    ).distinct()


@check("read_features", f"SELECT {GOLD_SQL} FROM wide WHERE security_id IN (SELECT security_id FROM asked_ids)")
def _(v: Views):
    return rounded_gold(surface.features(refreshed(v), v.identifiers, AS_OF, _asked(v))[0])


@check("read_features_unresolved", "SELECT symbol FROM asked_ids WHERE security_id IS NULL")
def _(v: Views):
    return surface.features(refreshed(v), v.identifiers, AS_OF, _asked(v))[1]


@check(
    "read_features_by_id",
    f"SELECT {GOLD_SQL} FROM wide WHERE security_id = 5 AND session_date >= DATE '1997-01-01'",
)
def _(v: Views):
    return rounded_gold(surface.features_by_id(refreshed(v), 5, AS_OF, start=dt.date(1997, 1, 1)))


_FUND = f"""SELECT f.security_id, f.concept, c.statement, CAST(f.period_start AS VARCHAR) AS period_start,
      CAST(f.period_end AS VARCHAR) AS period_end, f.period_end - f.period_start AS duration_days, f.fiscal_period,
      CAST(f.value AS DOUBLE) AS value, f.unit, CAST(f.filed AS VARCHAR) || ' 00:00:00' AS knowledge_time
    FROM (SELECT * FROM facts WHERE filed <= DATE '{AS_OF}' QUALIFY row_number() OVER (PARTITION BY security_id, concept,
      period_end, period_start ORDER BY filed DESC, accession DESC, value DESC, unit DESC) = 1) f
    JOIN concept_rules c ON c.concept = f.concept"""


def _facts(v: Views, kind: str, **kw):
    return surface.fundamentals_rows(v.facts, seeds.concepts(v.spark), AS_OF, kind, **kw)


@check("read_fundamentals_annual", f"{_FUND} WHERE f.period_start IS NULL OR f.period_end - f.period_start BETWEEN 350 AND 380")
def _(v: Views):
    return _facts(v, "annual")


@check(
    "read_fundamentals_quarterly",
    f"{_FUND} WHERE c.statement = 'cashflow' AND (f.period_start IS NULL OR f.period_end - f.period_start BETWEEN 85 AND 95)",
)
def _(v: Views):
    return _facts(v, "quarterly", statement="cashflow")


@check("read_fundamentals_instant", f"{_FUND} WHERE f.period_start IS NULL AND f.concept = 'total_assets'")
def _(v: Views):
    return _facts(v, "instant", concept="total_assets")


@check(
    "read_fundamentals_symbol",
    f"""{_FUND} WHERE f.security_id = {_resolved('U2')} AND (f.period_start IS NULL
        OR f.period_end - f.period_start BETWEEN 350 AND 380)""",
)
def _(v: Views):
    return surface.fundamentals_of(v.facts, seeds.concepts(v.spark), v.identifiers, "u2", AS_OF)


@check(
    "read_macro",
    """SELECT series_id, CAST(obs_date AS VARCHAR) AS obs_date, CAST(vintage_date AS VARCHAR) AS vintage_date, value,
         'title ' || series_id AS title
       FROM macro WHERE series_id = 'click' AND vintage_date <= DATE '2024-01-25' AND obs_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-24'
       QUALIFY row_number() OVER (PARTITION BY obs_date ORDER BY vintage_date DESC, value DESC) = 1""",
)
def _(v: Views):
    series = v.macro.select("series_id").distinct().withColumn("title", F.concat(F.lit("title "), "series_id"))
    # Identifiers are matched without case: the stored ids are lower case here.
    return surface.macro(v.macro, series, "CLICK", dt.date(2024, 1, 25), dt.date(2024, 1, 5), dt.date(2024, 1, 24))
