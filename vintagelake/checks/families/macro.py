"""Macro series."""

import datetime as dt

from pyspark.sql import functions as F

from vintagelake import seeds
from vintagelake.checks.registry import check
from vintagelake.checks.views import SQL_VIEWS, Views
from vintagelake.operators import macro
from vintagelake.sources import bronze

CUT = dt.date(2024, 1, 15)
_M = "series_id, CAST(obs_date AS VARCHAR) AS obs_date, CAST(vintage_date AS VARCHAR) AS vintage_date"
_IDS = [s[0] for s in seeds.MACRO_SERIES]
_LIST = ", ".join(f"'{i}'" for i in _IDS)
SQL_VIEWS["series_config"] = seeds.values_sql(seeds.MACRO_SERIES, "series_id, label, dimension, revisable")
SQL_VIEWS["alfred"] = f"""
    SELECT e.event_id, s.series_id, s.revisable, d.obs_date, d.start, d.value FROM (
      SELECT event_id, [{_LIST}][event_id % 12 + 1] AS series_id, CAST(ts AS DATE) AS d, value FROM events) e
    JOIN series_config s ON s.series_id = e.series_id,
    LATERAL (SELECT e.d AS obs_date, e.d + CAST(e.event_id % 5 AS INTEGER) AS start,
        CASE WHEN e.event_id % 7 = 0 THEN NULL ELSE e.value END AS value
      UNION ALL SELECT e.d - 1, NULL, e.value + 1) d"""


def _documents(v: Views):
    """A document per event: one observation with a vintage ('.' for some values), one without a vintage."""
    ids = F.array(*[F.lit(i) for i in _IDS])
    day = F.to_date("ts")
    with_vintage = F.struct(
        day.cast("string").alias("date"),
        F.date_add(day, (F.col("event_id") % 5).cast("int")).cast("string").alias("realtime_start"),
        F.lit("9999-12-31").alias("realtime_end"),
        F.when(F.col("event_id") % 7 == 0, F.lit(".")).otherwise(F.col("value").cast("string")).alias("value"),
    )
    without = F.struct(
        F.date_sub(day, 1).cast("string").alias("date"), F.lit(None).cast("string").alias("realtime_start"),
        F.lit(None).cast("string").alias("realtime_end"), (F.col("value") + 1).cast("string").alias("value"),
    )
    series = F.element_at(ids, (F.col("event_id") % 12 + 1).cast("int"))
    text = F.to_json(F.struct(F.array(with_vintage, without).alias("observations")))
    return v.table("events").select(series.alias("series_id"), text.alias("text"))


@check(
    "source_vintages",
    f"""SELECT series_id, CAST(obs_date AS VARCHAR) AS obs_date,
          CAST(CASE WHEN revisable THEN start ELSE obs_date END AS VARCHAR) AS vintage_date,
          CASE WHEN revisable THEN '9999-12-31' END AS realtime_end, value
        FROM alfred WHERE NOT revisable OR start IS NOT NULL""",
)
def _(v: Views):
    docs = _documents(v).join(seeds.macro_series(v.spark).select("series_id", "revisable"), "series_id")
    return bronze.vintages(docs, ~F.col("revisable"))


@check(
    "macro_append",
    f"SELECT {_M}, value FROM macro WHERE vintage_date > DATE '{CUT}'",
)
def _(v: Views):
    stored = v.macro.where(F.col("vintage_date") <= F.lit(CUT))
    return macro.new_observations(stored, v.macro)


@check(
    "macro_append_count",
    f"SELECT series_id, count(*) AS inserted FROM macro WHERE vintage_date > DATE '{CUT}' GROUP BY series_id",
)
def _(v: Views):
    stored = v.macro.where(F.col("vintage_date") <= F.lit(CUT))
    return macro.new_observations(stored, v.macro).groupBy("series_id").agg(F.count(F.lit(1)).alias("inserted"))


@check("macro_revision_depth", "SELECT series_id, count(*) AS vintage_rows, count(DISTINCT obs_date) AS obs_dates FROM macro GROUP BY 1")
def _(v: Views):
    return macro.revision_depth(v.macro)


@check(
    "macro_revised",
    """SELECT series_id, CAST(obs_date AS VARCHAR) AS obs_date, count(DISTINCT value) AS "values",
         arg_min(value, vintage_date) AS first_value, arg_max(value, vintage_date) AS last_value
       FROM macro GROUP BY ALL HAVING count(DISTINCT value) > 1""",
)
def _(v: Views):
    return macro.revised_observations(v.macro)


@check(
    "macro_series_upsert",
    """WITH old AS (SELECT c_custkey AS k, 'M' || c_custkey AS series_id, 'FRED' AS source, c_name AS title,
           CAST(c_nationkey AS VARCHAR) AS units, c_mktsegment AS frequency FROM customer WHERE c_acctbal < 5000),
         new AS (SELECT 'M' || c_custkey AS series_id, 'FRED2' AS source,
           CASE WHEN c_custkey % 3 = 0 THEN 'M' || c_custkey ELSE 'title ' || c_custkey END AS title,
           'u' || c_nationkey AS units, CAST(NULL AS VARCHAR) AS frequency FROM customer WHERE c_acctbal > 2500)
       SELECT coalesce(old.series_id, new.series_id) AS series_id, coalesce(old.source, new.source) AS source,
         coalesce(new.title, old.title) AS title, coalesce(new.units, old.units) AS units,
         coalesce(new.frequency, old.frequency) AS frequency
       FROM old FULL JOIN new ON old.series_id = new.series_id""",
)
def _(v: Views):
    stored = v.table("customer").where("c_acctbal < 5000").selectExpr(
        "concat('M', c_custkey) AS series_id", "'FRED' AS source", "c_name AS title",
        "CAST(c_nationkey AS STRING) AS units", "c_mktsegment AS frequency",
    )
    docs = v.table("customer").where("c_acctbal > 2500").selectExpr(
        "concat('M', c_custkey) AS series_id",
        "to_json(named_struct('seriess', array(named_struct('id', concat('M', c_custkey), 'title',"
        " CASE WHEN c_custkey % 3 > 0 THEN concat('title ', c_custkey) END, 'units', concat('u', c_nationkey)))))"
        " AS text",
    )
    fresh = bronze.series_metadata(docs).withColumn("source", F.lit("FRED2"))
    return macro.upsert_series(stored, fresh)


@check(
    "macro_series_config",
    f"""SELECT s.series_id, s.label, s.dimension, s.revisable, count(e.event_id) AS documents
        FROM series_config s LEFT JOIN (SELECT event_id, [{_LIST}][event_id % 12 + 1] AS series_id FROM events) e
          ON e.series_id = s.series_id GROUP BY ALL""",
)
def _(v: Views):
    config = seeds.macro_series(v.spark)
    seen = _documents(v).groupBy("series_id").agg(F.count(F.lit(1)).alias("documents"))
    return config.join(seen, "series_id", "left").withColumn("documents", F.coalesce("documents", F.lit(0)))
