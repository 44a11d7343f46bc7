"""Lineage, pipeline health and catalogs."""

import datetime as dt

from pyspark.sql import functions as F

from vintagelake import seeds
from vintagelake.checks.registry import check
from vintagelake.checks.views import SQL_VIEWS, Views
from vintagelake.operators import lineage
from vintagelake.plans import health

NOW = dt.datetime(2001, 12, 31, 12, tzinfo=dt.timezone.utc)
SQL_VIEWS["source_names"] = seeds.values_sql(seeds.SOURCES, "source_id, name")
SQL_VIEWS["pipeline_seed"] = seeds.values_sql(
    seeds.PIPELINES, "source_id, dataset, cadence, enabled, retired, critical"
)
_KIND = "CASE dataset " + " ".join(f"WHEN '{d}' THEN '{k}'" for d, k in seeds.PIPELINE_KINDS.items()) + " ELSE 'reference' END"
_TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"
_JOB = f"""batch_id, source_id, dataset, status, {_TIME.format('started_at')}, {_TIME.format('finished_at')}, rows_in, rows_out,
    code_version, error"""


def _pipelines(v: Views):
    return lineage.register_pipelines(seeds.pipelines(v.spark).limit(0), seeds.pipelines(v.spark))


SQL_VIEWS["health"] = f"""
    SELECT s.name, p.dataset, {_KIND.replace('dataset', 'p.dataset', 1)} AS kind, p.cadence, p.retired, p.critical,
      b.last_success, b.last_status, CAST(epoch(TIMESTAMP '2001-12-31 12:00:00') - epoch(b.last_success) AS BIGINT) AS lag_seconds
    FROM pipeline_seed p JOIN source_names s USING (source_id) LEFT JOIN (
      SELECT source_id, dataset, max(CASE WHEN status = 'succeeded' THEN finished_at END) AS last_success,
        arg_max(status, (started_at, batch_id)) AS last_status FROM batches GROUP BY 1, 2) b
      ON b.source_id = p.source_id AND b.dataset = p.dataset"""


@check(
    "health_freshness",
    f"SELECT name, dataset, kind, cadence, retired, critical, {_TIME.format('last_success')}, last_status, lag_seconds FROM health",
)
def _(v: Views):
    return health.freshness(_pipelines(v), seeds.sources(v.spark), v.batches, NOW)


@check("health_jobs", f"SELECT {_JOB} FROM (SELECT * FROM batches ORDER BY started_at DESC, batch_id DESC LIMIT 50)")
def _(v: Views):
    return health.recent_jobs(v.batches)


@check(
    "health_failed_jobs",
    f"SELECT {_JOB} FROM (SELECT * FROM batches WHERE status = 'failed' ORDER BY started_at DESC, batch_id DESC LIMIT 500)",
)
def _(v: Views):
    return health.recent_jobs(v.batches, limit=500, only_failed=True)


_DQ = f"""result_id, check_name, batch_id, {_TIME.format('run_at')}, passed, severity, cnt AS "count", details"""


@check("health_dq", f"SELECT {_DQ} FROM (SELECT * FROM dq_results ORDER BY run_at DESC, result_id DESC LIMIT 50)")
def _(v: Views):
    return health.recent_dq(v.dq_results, seeds.dq_checks(v.spark))


@check(
    "health_summary",
    """SELECT 'sources' AS section, name || ' ' || dataset AS item FROM health
       UNION ALL SELECT 'recent_jobs', CAST(batch_id AS VARCHAR) FROM
         (SELECT * FROM batches ORDER BY started_at DESC, batch_id DESC LIMIT 20)
       UNION ALL SELECT 'recent_failures', CAST(batch_id AS VARCHAR) FROM
         (SELECT * FROM batches WHERE status = 'failed' ORDER BY started_at DESC, batch_id DESC LIMIT 20)
       UNION ALL SELECT 'recent_dq_failures', CAST(result_id AS VARCHAR) FROM
         (SELECT * FROM dq_results WHERE NOT passed ORDER BY run_at DESC, result_id DESC LIMIT 20)""",
)
def _(v: Views):
    parts = health.summary(
        _pipelines(v), seeds.sources(v.spark), v.batches, v.dq_results, seeds.dq_checks(v.spark), NOW
    )
    item = {
        "sources": F.concat_ws(" ", "name", "dataset"),
        "recent_jobs": F.col("batch_id").cast("string"),
        "recent_failures": F.col("batch_id").cast("string"),
        "recent_dq_failures": F.col("result_id").cast("string"),
    }
    out = None
    for name, df in parts.items():
        rows = df.select(F.lit(name).alias("section"), item[name].alias("item"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _definitions(v: Views, shift: int):
    """Feature definitions by part brand and size."""
    return v.table("part").groupBy(F.col("p_brand").alias("name"), (F.col("p_size") + shift).alias("version")).agg(
        F.max("p_name").alias("description"),
        F.max(F.expr("CASE WHEN p_size % 4 = 0 THEN DATE'2000-01-01' END")).alias("deprecated_at"),
    )


@check(
    "catalog_features",
    """SELECT p_brand AS name, p_size AS version, max(p_name) AS description FROM part WHERE p_size % 4 > 0 GROUP BY 1, 2""",
)
def _(v: Views):
    return health.feature_catalog(_definitions(v, 0))


@check(
    "catalog_feature_upsert",
    """WITH o AS (SELECT p_brand AS name, p_size AS version, max(p_name) AS d FROM part GROUP BY 1, 2),
         n AS (SELECT p_brand AS name, p_size + 1 AS version, 'new ' || max(p_name) AS d FROM part GROUP BY 1, 2)
       SELECT coalesce(n.name, o.name) AS name, coalesce(n.version, o.version) AS version, coalesce(n.d, o.d) AS description
       FROM o FULL JOIN n ON o.name = n.name AND o.version = n.version""",
)
def _(v: Views):
    old = _definitions(v, 0).drop("deprecated_at")
    new = _definitions(v, 1).drop("deprecated_at").withColumn("description", F.concat(F.lit("new "), "description"))
    return lineage.upsert_features(old, new)


@check(
    "catalog_feature_seed",
    """SELECT f.name, f.version, coalesce(g.n, 0) AS filled_rows FROM (
         SELECT unnest(['return_1d', 'log_return_1d', 'sma20', 'sma50', 'ema20', 'realized_vol20', 'roc20', 'momentum_12_1']) AS name,
           1 AS version) f
       JOIN (SELECT unnest(['return_1d', 'log_return_1d', 'sma20', 'sma50', 'ema20', 'realized_vol20', 'roc20', 'momentum_12_1']) AS name,
           unnest([count(return_1d), count(log_return_1d), count(sma20), count(sma50), count(ema20), count(realized_vol20),
             count(roc20), count(momentum_12_1)]) AS n FROM wide) g USING (name)""",
)
def _(v: Views):
    from vintagelake.checks.families.features import refreshed

    names = [f[0] for f in seeds.FEATURES]
    filled = refreshed(v).agg(*[F.count(n).alias(n) for n in names])
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("filled_rows")) for n in names])
    counts = filled.select(F.explode(pairs).alias("p")).select("p.*")
    catalog = seeds.features(v.spark).withColumn("deprecated_at", F.lit(None).cast("date"))
    return health.feature_catalog(catalog).join(counts, "name").select("name", "version", "filled_rows")


@check(
    "catalog_datasets",
    """SELECT d.name, d.storage, c.rows FROM (VALUES ('bars', 'parquet_lake'), ('gold', 'parquet_lake'), ('macro', 'postgres'),
         ('fundamentals', 'postgres'), ('universe', 'postgres')) d(name, storage) LEFT JOIN (
         SELECT 'bars' AS name, count(*) AS rows FROM bars UNION ALL SELECT 'macro', count(*) FROM macro
         UNION ALL SELECT 'fundamentals', count(*) FROM facts UNION ALL SELECT 'universe', count(*) FROM membership) c
       ON c.name = d.name""",
)
def _(v: Views):
    counted = {"bars": v.bars, "macro": v.macro, "fundamentals": v.facts, "universe": v.membership}
    sizes = None
    for name, df in counted.items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).withColumn("name", F.lit(name))
        sizes = one if sizes is None else sizes.unionByName(one)
    return health.dataset_catalog(seeds.datasets(v.spark), sizes)


@check(
    "lineage_sources",
    """WITH o AS (SELECT row_number() OVER (ORDER BY n_name) + 10 AS source_id, n_name AS name FROM nation),
         m AS (SELECT DISTINCT p_brand AS name FROM part)
       SELECT source_id, name FROM o UNION ALL
       SELECT (SELECT max(source_id) FROM o) + row_number() OVER (ORDER BY md5(name), name), name FROM m
       WHERE name NOT IN (SELECT name FROM o)""",
)
def _(v: Views):
    from pyspark.sql import Window

    # Nations are a fixed list of 25, so one window numbers them.
    old = v.table("nation").select(
        (F.row_number().over(Window.orderBy("n_name")) + 10).cast("bigint").alias("source_id"), F.col("n_name").alias("name")
    )
    wanted = v.table("part").selectExpr("p_brand AS name").union(v.table("nation").select("n_name"))
    return lineage.ensure_sources(old, wanted)


@check(
    "lineage_batch_state",
    f"""SELECT batch_id, CASE WHEN finished_at IS NULL THEN 'running' ELSE status END AS status,
          strftime(coalesce(finished_at, started_at), '%Y-%m-%d %H:%M:%S') AS event_time,
          CASE WHEN finished_at IS NOT NULL THEN rows_in END AS rows_in,
          CASE WHEN finished_at IS NOT NULL THEN rows_out END AS rows_out,
          CASE WHEN finished_at IS NOT NULL THEN error END AS error FROM batches""",
)
def _(v: Views):
    events = lineage.open_events(v.batches).unionByName(lineage.close_events(v.batches))
    return lineage.batch_state(events)


SQL_VIEWS["messages"] = """
    SELECT c_nationkey AS batch_id, CASE WHEN c_custkey % 3 = 0 THEN 'failure' ELSE 'warning' END AS kind,
      c_custkey AS ord, c_name AS text FROM customer"""


@check(
    "lineage_batch_stats",
    """SELECT t.batch_id, t.n AS symbols_processed, round(t.s, 2) AS elapsed_seconds, coalesce(w.n, 0) AS warnings,
         w.last AS last_warning, coalesce(f.n, 0) AS failures, f.last AS last_failure,
         (SELECT count(*) FROM messages m WHERE m.batch_id = t.batch_id AND m.kind = 'warning') AS n_warnings,
         (SELECT count(*) FROM messages m WHERE m.batch_id = t.batch_id AND m.kind = 'failure') AS n_failures
       FROM (SELECT c_nationkey AS batch_id, count(*) AS n, count(*) / 8 AS s FROM customer GROUP BY 1) t
       LEFT JOIN (SELECT batch_id, count(*) AS n, arg_max(text, ord) AS last FROM (SELECT * FROM messages WHERE kind = 'warning'
         QUALIFY row_number() OVER (PARTITION BY batch_id ORDER BY ord, text) <= 200) GROUP BY 1) w ON w.batch_id = t.batch_id
       LEFT JOIN (SELECT batch_id, count(*) AS n, arg_max(text, ord) AS last FROM (SELECT * FROM messages WHERE kind = 'failure'
         QUALIFY row_number() OVER (PARTITION BY batch_id ORDER BY ord, text) <= 50) GROUP BY 1) f ON f.batch_id = t.batch_id""",
)
def _(v: Views):
    customers = v.table("customer")
    messages = customers.selectExpr(
        "CAST(c_nationkey AS BIGINT) AS batch_id", "CASE WHEN c_custkey % 3 = 0 THEN 'failure' ELSE 'warning' END AS kind",
        "c_custkey AS ord", "c_name AS text",
    )
    totals = customers.groupBy(F.col("c_nationkey").cast("bigint").alias("batch_id")).agg(
        F.count(F.lit(1)).alias("symbols_processed"), F.round(F.count(F.lit(1)) / 8, 2).alias("elapsed_seconds")
    )
    schema = "symbols_processed bigint, elapsed_seconds double, n_warnings bigint, n_failures bigint, warnings array<string>, failures array<string>"
    out = lineage.batch_stats(messages, totals).withColumn("p", F.from_json("params", schema))
    last = lambda c: F.when(F.size(c) > 0, F.element_at(c, -1))
    return out.select(
        "batch_id", "p.symbols_processed", "p.elapsed_seconds",
        F.size("p.warnings").alias("warnings"), last(F.col("p.warnings")).alias("last_warning"),
        F.size("p.failures").alias("failures"), last(F.col("p.failures")).alias("last_failure"),
        "p.n_warnings", "p.n_failures",
    )


@check(
    "lineage_pipelines",
    f"""SELECT b.source_id, b.dataset, coalesce(p.cadence, 'daily') AS cadence, coalesce(p.enabled, true) AS enabled,
          coalesce(p.retired, false) AS retired, coalesce(p.critical, false) AS critical,
          {_KIND.replace('dataset', 'b.dataset', 1)} AS kind
        FROM (SELECT DISTINCT source_id, dataset FROM batches UNION SELECT source_id, dataset FROM pipeline_seed) b
        LEFT JOIN pipeline_seed p ON p.source_id = b.source_id AND p.dataset = b.dataset""",
)
def _(v: Views):
    # Every (source, dataset) that ever ran is declared with defaults; the seed replaces what it knows.
    seen = v.batches.select("source_id", "dataset").distinct().select(
        "source_id", "dataset", F.lit("daily").alias("cadence"), F.lit(True).alias("enabled"),
        F.lit(False).alias("retired"), F.lit(False).alias("critical"),
    )
    return lineage.register_pipelines(seen, seeds.pipelines(v.spark))


@check(
    "lineage_check_upsert",
    """WITH o AS (SELECT p_type || p_size AS name, max(p_brand) AS dataset FROM part GROUP BY 1),
         n AS (SELECT p_type || (p_size + 3) AS name, 'new' AS dataset FROM part GROUP BY 1)
       SELECT coalesce(n.name, o.name) AS name, coalesce(n.dataset, o.dataset) AS dataset FROM o FULL JOIN n ON o.name = n.name""",
)
def _(v: Views):
    part = v.table("part")
    old = part.groupBy(F.concat("p_type", "p_size").alias("name")).agg(F.max("p_brand").alias("dataset"))
    new = part.select(F.concat("p_type", F.col("p_size") + 3).alias("name")).distinct().withColumn("dataset", F.lit("new"))
    return lineage.upsert_checks(old, new)
