"""Security master and universe maintenance."""

from pyspark.sql import functions as F

from vintagelake import seeds, session
from vintagelake.checks.registry import check
from vintagelake.checks.views import SQL_VIEWS, TODAY, Views
from vintagelake.operators import universe
from vintagelake.sources import bronze, registry_files

_FAR = "DATE '9999-12-31'"
_NOW = f"""SELECT upper(i.id_value) AS ticker_key, i.security_id FROM identifiers i
    WHERE i.valid_from <= DATE '{TODAY}' AND DATE '{TODAY}' < coalesce(i.valid_to, {_FAR})
    QUALIFY row_number() OVER (PARTITION BY upper(i.id_value)
      ORDER BY i.valid_from DESC, coalesce(i.valid_to, {_FAR}) DESC, i.security_id) = 1"""
SQL_VIEWS["now_tickers"] = _NOW

# Manifests: one source per market segment, a line per customer.
_SEGMENTS = "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3 WHEN 'HOUSEHOLD' THEN 4 ELSE 5 END"
SQL_VIEWS["manifest"] = f"""
    SELECT {_SEGMENTS} AS registry_ord, c_custkey AS line_no, c_mktsegment AS source, 'C' || (c_custkey // 3) AS ticker,
      CASE WHEN c_custkey % 4 = 0 THEN 'ETF' WHEN c_custkey % 4 = 1 THEN 'FUND' ELSE 'EQUITY' END AS security_type,
      CASE WHEN c_custkey % 5 > 0 THEN c_name END AS name,
      CASE WHEN c_custkey % 2 = 0 THEN DATE '1990-01-01' + CAST(c_custkey % 3000 AS INTEGER) END AS valid_from
    FROM customer"""


def _manifest_text(v: Views):
    """Manifest lines as text, with blanks, padding and lower case as files have them."""
    return v.table("customer").selectExpr(
        f"{_SEGMENTS} AS registry_ord", "c_custkey AS line_no", "c_mktsegment AS source",
        "concat(' c', c_custkey div 3, ' ') AS ticker",
        "CASE WHEN c_custkey % 4 = 0 THEN 'etf' WHEN c_custkey % 4 = 1 THEN 'FUND' ELSE ' ' END AS security_type",
        "CASE WHEN c_custkey % 5 > 0 THEN c_name ELSE '' END AS name",
        "CASE WHEN c_custkey % 2 = 0 THEN CAST(date_add(DATE'1990-01-01', CAST(c_custkey % 3000 AS INT)) AS STRING)"
        " ELSE ' ' END AS valid_from",
        "'' AS valid_to",
    )


@check(
    "source_manifest",
    """SELECT registry_ord, line_no, source, ticker, security_type, name, CAST(valid_from AS VARCHAR) AS valid_from,
         CAST(NULL AS VARCHAR) AS valid_to FROM manifest""",
)
def _(v: Views):
    return registry_files.manifest(_manifest_text(v))


_FIRST = "SELECT * FROM manifest QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY registry_ord, line_no) = 1"


@check(
    "univ_load_coverage",
    f"SELECT ticker, source, line_no, security_type, name FROM ({_FIRST})",
)
def _(v: Views):
    out = universe.load_coverage(registry_files.manifest(_manifest_text(v)))
    return out.select("ticker", "source", "line_no", "security_type", "name")


@check(
    "univ_coverage_counts",
    f"""SELECT m.source, m.listed, coalesce(a.added, 0) AS added FROM (SELECT source, count(*) AS listed FROM manifest GROUP BY 1) m
        LEFT JOIN (SELECT source, count(*) AS added FROM ({_FIRST}) GROUP BY 1) a USING (source)""",
)
def _(v: Views):
    return universe.coverage_counts(registry_files.manifest(_manifest_text(v)))


# Vendor CIK map, one document per supplier; the same ticker comes back under a later index.
SQL_VIEWS["ciks"] = """
    SELECT ticker, cik FROM (
      SELECT CASE s % 4 WHEN 0 THEN 'K.' || s WHEN 1 THEN 'K-' || s ELSE 'K' || s END AS ticker,
        lpad(CAST(s + 1000 AS VARCHAR), 10, '0') AS cik FROM (SELECT s_suppkey AS s FROM supplier))"""


_TICKER = "CASE s_suppkey % 4 WHEN 0 THEN concat('K.', s_suppkey) WHEN 1 THEN concat('K-', s_suppkey) ELSE concat('K', s_suppkey) END"


def _cik_docs(v: Views):
    later = "concat('\"', s_suppkey + 100, '\": {\"cik_str\": 1, \"ticker\": \"', t, '\"}')"
    first = "concat('\"', s_suppkey, '\": {\"cik_str\": ', s_suppkey + 1000, ', \"ticker\": \" ', lower(t), '\"}')"
    named = v.table("supplier").selectExpr("s_suppkey", f"{_TICKER} AS t")
    return named.selectExpr(f"concat('{{', {later}, ', ', {first}, '}}') AS text")


@check("source_cik_map", "SELECT ticker, cik FROM ciks")
def _(v: Views):
    return bronze.cik_map(_cik_docs(v))


def _cik_requests(v: Views):
    n = v.n_securities
    return v.table("customer").selectExpr(
        "c_custkey AS request_id",
        f"CASE c_custkey % 3 WHEN 0 THEN concat('k.', c_custkey % {n}) WHEN 1 THEN concat('K-', c_custkey % {n})"
        f" ELSE concat('K', c_custkey % {n}) END AS ticker",
    )


@check(
    "univ_lookup_cik",
    """WITH r AS (SELECT c_custkey AS request_id, CASE c_custkey % 3 WHEN 0 THEN 'k.' || (c_custkey % (SELECT n FROM nsec))
           WHEN 1 THEN 'K-' || (c_custkey % (SELECT n FROM nsec)) ELSE 'K' || (c_custkey % (SELECT n FROM nsec)) END AS ticker
           FROM customer)
       SELECT r.request_id, r.ticker, coalesce(a.cik, b.cik, c.cik, d.cik) AS cik FROM r
       LEFT JOIN ciks a ON a.ticker = upper(r.ticker) LEFT JOIN ciks b ON b.ticker = replace(upper(r.ticker), '.', '-')
       LEFT JOIN ciks c ON c.ticker = replace(upper(r.ticker), '-', '.')
       LEFT JOIN ciks d ON d.ticker = replace(upper(r.ticker), '.', '')""",
)
def _(v: Views):
    return universe.lookup_cik(_cik_requests(v), bronze.cik_map(_cik_docs(v)))


# Entries to reconcile: known and unknown tickers.
SQL_VIEWS["entries"] = """
    SELECT CASE WHEN c_custkey % 2 = 0 THEN 'T' || c_custkey ELSE 'X' || c_custkey END AS ticker,
      'EQUITY' AS security_type, CASE WHEN c_custkey % 3 > 0 THEN 'Z' || c_custkey END AS cik FROM customer"""


def _entries(v: Views):
    return v.table("customer").selectExpr(
        "CASE WHEN c_custkey % 2 = 0 THEN concat('T', c_custkey) ELSE concat('X', c_custkey) END AS ticker",
        "'EQUITY' AS security_type", "CASE WHEN c_custkey % 3 > 0 THEN concat('Z', c_custkey) END AS cik",
    )


@check(
    "univ_reconcile",
    """WITH k AS (SELECT e.*, n.security_id FROM entries e LEFT JOIN now_tickers n ON n.ticker_key = upper(e.ticker))
       SELECT k.ticker, k.security_type, coalesce(k.cik, s.cik) AS cik, k.security_id, 'reconciled' AS outcome,
         CAST(NULL AS VARCHAR) AS valid_from
       FROM k JOIN securities s ON s.security_id = k.security_id
       UNION ALL
       SELECT ticker, security_type, cik, (SELECT max(security_id) FROM securities)
           + row_number() OVER (ORDER BY md5(ticker), ticker), 'created', '1900-01-01' FROM k WHERE security_id IS NULL""",
)
def _(v: Views):
    return universe.reconcile(_entries(v), v.identifiers, v.securities, TODAY)


@check(
    "univ_filled_cik",
    """SELECT s.security_id, coalesce(x.cik, s.cik) AS cik FROM securities s LEFT JOIN (
         SELECT n.security_id, max(e.cik) AS cik FROM entries e JOIN now_tickers n ON n.ticker_key = upper(e.ticker)
         GROUP BY 1) x ON x.security_id = s.security_id""",
)
def _(v: Views):
    done = universe.reconcile(_entries(v), v.identifiers, v.securities, TODAY)
    return universe.filled_ciks(v.securities, done).select("security_id", "cik")


# Dated entries: one per customer, windows of 150 days on tickers that exist or not.
SQL_VIEWS["dated"] = """
    SELECT c_custkey AS entry_no, CASE WHEN c_custkey % 3 = 0 THEN 'T' ELSE 'Y' END || (c_custkey // 5) AS ticker,
      CASE WHEN c_custkey % 11 > 0 THEN DATE '1995-01-01' + CAST((c_custkey % 7) * 200 AS INTEGER) END AS valid_from,
      CASE WHEN c_custkey % 4 > 0 THEN DATE '1995-01-01' + CAST((c_custkey % 7) * 200 + 150 AS INTEGER) END AS valid_to
    FROM customer"""


def _dated(v: Views):
    return v.table("customer").selectExpr(
        "c_custkey AS entry_no",
        "concat(CASE WHEN c_custkey % 3 = 0 THEN 'T' ELSE 'Y' END, c_custkey div 5) AS ticker",
        "CASE WHEN c_custkey % 11 > 0 THEN date_add(DATE'1995-01-01', CAST((c_custkey % 7) * 200 AS INT)) END"
        " AS valid_from",
        "CASE WHEN c_custkey % 4 > 0 THEN date_add(DATE'1995-01-01', CAST((c_custkey % 7) * 200 + 150 AS INT)) END"
        " AS valid_to",
    )


_HIT = f"""i.id_value = d.ticker AND i.valid_from <= coalesce(d.valid_to, {_FAR})
    AND coalesce(i.valid_to, {_FAR}) >= d.valid_from"""
SQL_VIEWS["dated_result"] = f"""
    SELECT d.*, CASE WHEN d.valid_from IS NULL THEN 'COLLISION'
        WHEN EXISTS (SELECT 1 FROM identifiers i WHERE i.id_value = d.ticker AND i.valid_from = d.valid_from) THEN 'skipped_exists'
        WHEN EXISTS (SELECT 1 FROM identifiers i WHERE {_HIT}) THEN 'COLLISION'
        WHEN EXISTS (SELECT 1 FROM dated o WHERE o.ticker = d.ticker AND o.valid_from = d.valid_from
          AND o.entry_no < d.entry_no) THEN 'skipped_exists'
        WHEN EXISTS (SELECT 1 FROM dated o WHERE o.ticker = d.ticker AND o.entry_no < d.entry_no
          AND o.valid_from <= coalesce(d.valid_to, {_FAR}) AND coalesce(o.valid_to, {_FAR}) >= d.valid_from) THEN 'COLLISION'
        ELSE 'created' END AS outcome
    FROM dated d"""
_DATED = "entry_no, ticker, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to"


@check(
    "univ_collisions",
    f"SELECT {_DATED} FROM dated d WHERE EXISTS (SELECT 1 FROM identifiers i WHERE {_HIT})",
)
def _(v: Views):
    return universe.colliding(_dated(v), v.identifiers)


@check("univ_dated_outcomes", f"SELECT {_DATED}, outcome FROM dated_result")
def _(v: Views):
    return universe.dated_outcomes(_dated(v), v.identifiers)


@check("univ_expansion_tallies", "SELECT outcome, count(*) AS n FROM dated_result GROUP BY outcome")
def _(v: Views):
    return universe.tallies(universe.dated_outcomes(_dated(v), v.identifiers))


@check(
    "univ_expansion_writes",
    f"""SELECT {_DATED}, outcome FROM dated_result WHERE outcome = 'created'
          AND (SELECT count(*) FROM dated_result WHERE outcome = 'COLLISION') = 0
        UNION ALL SELECT c_custkey, 'Q' || c_custkey, '1999-01-01', NULL, 'created' FROM customer""",
)
def _(v: Views):
    # One batch with collisions writes nothing; a clean one, a new ticker per customer, writes everything.
    bad = universe.dated_outcomes(_dated(v), v.identifiers)
    clean = v.table("customer").selectExpr(
        "c_custkey AS entry_no", "concat('Q', c_custkey) AS ticker", "DATE'1999-01-01' AS valid_from",
        "CAST(NULL AS DATE) AS valid_to",
    )
    good = universe.dated_outcomes(clean, v.identifiers)
    return universe.expansion_writes(bad, commit=True).unionByName(universe.expansion_writes(good, commit=True))


# Index stays by ticker, vendor windows, classification and decision.
SQL_VIEWS["stays"] = """
    SELECT CASE WHEN c_custkey % 4 = 0 THEN 'T' ELSE 'W' END || (c_custkey // 2) AS ticker,
      DATE '1994-06-01' + CAST((c_custkey * 37) % 2500 AS INTEGER) AS valid_from,
      CASE WHEN c_custkey % 3 > 0 THEN DATE '1994-06-01' + CAST((c_custkey * 37) % 2500 + 400 AS INTEGER) END AS valid_to
    FROM customer"""
SQL_VIEWS["vendor_meta"] = """
    SELECT 'W' || p_partkey AS ticker,
      CASE WHEN p_size % 6 = 0 THEN 'ok(translated)' WHEN p_size % 7 = 0 THEN '404' ELSE 'ok' END AS vendor_status,
      CASE WHEN p_size % 5 > 0 THEN DATE '1996-01-01' + CAST((p_partkey * 13) % 2000 AS INTEGER) END AS vendor_start,
      CASE WHEN p_size % 2 > 0 THEN DATE '1996-01-01' + CAST((p_partkey * 13) % 2000 + 300 AS INTEGER) END AS vendor_end
    FROM part"""
SQL_VIEWS["ticker_ciks"] = "SELECT 'W' || p_partkey AS ticker, lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS cik FROM part WHERE p_size > 10"


def _stays_text(v: Views):
    return v.table("customer").selectExpr(
        "concat(CASE WHEN c_custkey % 4 = 0 THEN 't' ELSE 'W' END, c_custkey div 2) AS ticker",
        "CAST(date_add(DATE'1994-06-01', CAST((c_custkey * 37) % 2500 AS INT)) AS STRING) AS start_date",
        "CASE WHEN c_custkey % 3 > 0 THEN CAST(date_add(DATE'1994-06-01', CAST((c_custkey * 37) % 2500 + 400 AS INT))"
        " AS STRING) ELSE '' END AS end_date",
    )


def _stays(v: Views):
    return registry_files.membership_intervals(_stays_text(v))


@check(
    "source_membership",
    "SELECT ticker, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to FROM stays",
)
def _(v: Views):
    blank = v.table("part").selectExpr("' ' AS ticker", "'1999-01-01' AS start_date", "'' AS end_date")
    return registry_files.membership_intervals(_stays_text(v).unionByName(blank))


SQL_VIEWS["classified"] = """
    SELECT *, CASE WHEN multi_interval THEN 'REVIEW' WHEN vendor_status = 'ok' THEN 'add'
        WHEN vendor_status = 'ok(translated)' THEN 'translate' ELSE 'unavailable' END AS recommendation
    FROM (SELECT s.ticker, s.n AS intervals, s.f AS index_first, s.l AS index_last, s.n > 1 AS multi_interval,
            coalesce(m.vendor_status, '404') AS vendor_status, m.vendor_start, m.vendor_end, c.cik
          FROM (SELECT ticker, count(*) AS n, min(valid_from) AS f, max(valid_to) AS l FROM stays
                WHERE upper(ticker) NOT IN (SELECT ticker_key FROM now_tickers) GROUP BY ticker) s
          LEFT JOIN vendor_meta m ON m.ticker = s.ticker LEFT JOIN ticker_ciks c ON c.ticker = s.ticker)"""
SQL_VIEWS["corroborated"] = f"""
    SELECT *, CASE WHEN recommendation <> 'add' THEN 'passthrough:' || recommendation
        WHEN vendor_start IS NULL THEN 'review:blank_window'
        WHEN vendor_start <= coalesce(index_last, {_FAR}) AND index_first <= coalesce(vendor_end, {_FAR}) THEN 'add:overlap_ok'
        ELSE 'review:modern_reuse' END AS corroboration FROM classified"""
SQL_VIEWS["overrides"] = """
    SELECT x.* FROM (SELECT 'W' || p_partkey AS ticker,
        CASE WHEN p_size % 5 = 0 THEN 'excluded_manual_review' ELSE 'new_identity' END AS decision
      FROM part WHERE p_brand = 'Brand#7') x JOIN corroborated c ON c.ticker = x.ticker
    WHERE c.vendor_start IS NOT NULL OR x.decision LIKE 'excluded%'"""
_BY_RULE = """CASE corroboration WHEN 'add:overlap_ok' THEN 'overlap_ok'
        WHEN 'passthrough:translate' THEN CASE WHEN vendor_start IS NULL THEN 'excluded_blank' ELSE 'translate' END
        WHEN 'review:modern_reuse' THEN 'excluded_reuse' WHEN 'review:blank_window' THEN 'excluded_blank'
        WHEN 'passthrough:unavailable' THEN 'excluded_unavailable' WHEN 'passthrough:REVIEW' THEN 'excluded_review'
        ELSE 'excluded_other' END"""
_HAND = ", ".join(f"['{t}', '{d}']" for d, names in seeds.HAND_DECISIONS.items() for t in names)
SQL_VIEWS["decided"] = f"""
    SELECT c.*, coalesce(o.decision, {_BY_RULE}) AS decision
    FROM corroborated c LEFT JOIN overrides o ON o.ticker = c.ticker"""
_CLS = """ticker, intervals, CAST(index_first AS VARCHAR) AS index_first, CAST(index_last AS VARCHAR) AS index_last,
    multi_interval, vendor_status, CAST(vendor_start AS VARCHAR) AS vendor_start, CAST(vendor_end AS VARCHAR) AS vendor_end,
    cik, recommendation"""


def _classified(v: Views):
    vendor = v.table("part").selectExpr(
        "concat('W', p_partkey) AS ticker",
        "CASE WHEN p_size % 6 = 0 THEN 'ok(translated)' WHEN p_size % 7 = 0 THEN '404' ELSE 'ok' END AS vendor_status",
        "CASE WHEN p_size % 5 > 0 THEN date_add(DATE'1996-01-01', CAST((p_partkey * 13) % 2000 AS INT)) END AS vendor_start",
        "CASE WHEN p_size % 2 > 0 THEN date_add(DATE'1996-01-01', CAST((p_partkey * 13) % 2000 + 300 AS INT)) END"
        " AS vendor_end",
    )
    ciks = v.table("part").where("p_size > 10").selectExpr(
        "concat('W', p_partkey) AS ticker", "lpad(CAST(p_partkey AS STRING), 10, '0') AS cik"
    )
    return universe.classify_unresolved(_stays(v), v.identifiers, vendor, ciks, TODAY)


def _decided(v: Views):
    overrides = v.table("part").where("p_brand = 'Brand#7'").selectExpr(
        "concat('W', p_partkey) AS ticker",
        "CASE WHEN p_size % 5 = 0 THEN 'excluded_manual_review' ELSE 'new_identity' END AS decision",
    )
    dated = universe.corroborate(_classified(v))
    # Decisions by hand that admit need a vendor start.
    usable = overrides.join(
        dated.select("ticker", "vendor_start"), "ticker"
    ).where("vendor_start IS NOT NULL OR decision LIKE 'excluded%'").drop("vendor_start")
    return universe.decide(dated, usable, TODAY)


@check("univ_classify", f"SELECT {_CLS} FROM classified")
def _(v: Views):
    return _classified(v)


@check("univ_corroborate", f"SELECT {_CLS}, corroboration FROM corroborated")
def _(v: Views):
    return universe.corroborate(_classified(v))


_ADMIT = "decision IN ('new_identity', 'verified_continuous', 'overlap_ok', 'translate')"
_KEEP_END = f"CASE WHEN vendor_end < DATE '{TODAY}' - 7 THEN vendor_end END"


@check(
    "univ_decide",
    f"""SELECT ticker, corroboration, decision, {_ADMIT} AS admitted,
          CASE WHEN {_ADMIT} THEN CAST(vendor_start AS VARCHAR) END AS valid_from,
          CASE WHEN {_ADMIT} THEN CAST({_KEEP_END} AS VARCHAR) END AS valid_to FROM decided""",
)
def _(v: Views):
    return _decided(v).select("ticker", "corroboration", "decision", "admitted", "valid_from", "valid_to")


@check(
    "univ_candidate_manifest",
    f"""SELECT ticker, 'EQUITY' AS security_type, 'vendor ' || ticker AS name, CAST(vendor_start AS VARCHAR) AS valid_from,
          CAST({_KEEP_END} AS VARCHAR) AS valid_to, decision,
          CASE WHEN ticker IN (SELECT ticker FROM overrides) THEN 'decided by hand' ELSE 'by rule: ' || corroboration END AS rationale
        FROM decided WHERE {_ADMIT}""",
)
def _(v: Views):
    return universe.candidate_manifest(_decided(v).withColumn("vendor_name", F.concat(F.lit("vendor "), "ticker")))


@check(
    "univ_decide_by_hand",
    f"""WITH named AS (SELECT c.* REPLACE (coalesce(h.ticker, c.ticker) AS ticker), h.decision AS hand FROM corroborated c
           LEFT JOIN (SELECT 'W' || (1 + i) AS w, t[1] AS ticker, t[2] AS decision FROM (SELECT unnest([{_HAND}]) AS t,
             generate_subscripts([{_HAND}], 1) - 1 AS i)) h ON h.w = c.ticker)
        SELECT ticker, corroboration, coalesce(hand, {_BY_RULE}) AS decision,
          CASE WHEN hand IS NOT NULL THEN 'decided by hand' ELSE 'by rule: ' || corroboration END AS rationale
        FROM named WHERE vendor_start IS NOT NULL""",
)
def _(v: Views):
    # The first candidates get the tickers that are decided by hand. Undated ones can't be admitted and are left out.
    order = [t for names in seeds.HAND_DECISIONS.values() for t in names]
    names = v.spark.createDataFrame([(f"W{1 + i}", t) for i, t in enumerate(order)], "ticker string, name string")
    dated = universe.corroborate(_classified(v)).where("vendor_start IS NOT NULL").join(names, "ticker", "left")
    decided = universe.decide(dated.withColumn("ticker", F.coalesce("name", "ticker")).drop("name"), None, TODAY)
    return decided.select("ticker", "corroboration", "decision", "rationale")


@check(
    "sink_manifest",
    f"""SELECT ticker, 'EQUITY' AS security_type, CAST(NULL AS VARCHAR) AS name, CAST(vendor_start AS VARCHAR) AS valid_from,
          CAST({_KEEP_END} AS VARCHAR) AS valid_to FROM decided WHERE {_ADMIT}""",
)
def _(v: Views):
    path = session.scratch(v.spark, "manifest")
    registry_files.write_manifest(universe.candidate_manifest(_decided(v)), path)
    return registry_files.manifest(registry_files.read_csv(v.spark, path, registry_files.MANIFEST_COLUMNS))


@check(
    "univ_decision_summary",
    "SELECT decision, count(*) AS n, (SELECT count(*) FROM decided) AS total FROM decided GROUP BY decision",
)
def _(v: Views):
    return universe.decision_summary(_decided(v))


# Membership load: every supplier's region is an index; stays refer to tickers.
SQL_VIEWS["load_rows"] = """
    SELECT 'T' || (c_custkey % (SELECT n FROM nsec) // 8) AS ticker,
      DATE '1995-01-01' + CAST((c_custkey * 29) % 2400 AS INTEGER) AS valid_from,
      CASE WHEN c_custkey % 3 > 0 THEN DATE '1995-01-01' + CAST((c_custkey * 29) % 2400 + (c_custkey % 400) AS INTEGER) END
        AS valid_to, c_mktsegment AS universe FROM customer"""
_TO = "coalesce(i.valid_to, DATE '9999-12-31')"
SQL_VIEWS["load_status"] = f"""
    WITH r AS (SELECT l.*, i.security_id FROM (SELECT *, row_number() OVER () AS rid FROM load_rows) l
        LEFT JOIN identifiers i ON upper(i.id_value) = upper(l.ticker) AND i.valid_from <= l.valid_from AND l.valid_from < {_TO}
        QUALIFY row_number() OVER (PARTITION BY l.rid ORDER BY i.valid_from DESC, {_TO} DESC, i.security_id) = 1),
      w AS (SELECT r.*, i.valid_to AS id_to FROM r LEFT JOIN identifiers i ON i.security_id = r.security_id
          AND i.valid_from <= r.valid_from AND r.valid_from < {_TO}
        QUALIFY row_number() OVER (PARTITION BY r.rid ORDER BY i.valid_from DESC, {_TO} DESC, i.id_value) = 1)
    SELECT universe, ticker, valid_from, valid_to, security_id,
      CASE WHEN security_id IS NULL THEN 'no_identity'
        WHEN id_to IS NOT NULL AND valid_to IS NOT NULL AND valid_to > id_to + 15 THEN 'containment_violation'
        WHEN id_to IS NOT NULL AND valid_to IS NULL AND id_to + 15 < DATE '{TODAY}' THEN 'containment_violation'
        ELSE 'ok' END AS base FROM w"""
SQL_VIEWS["load_result"] = """
    SELECT universe, ticker, valid_from, valid_to, security_id,
      CASE WHEN base = 'ok' AND valid_from < DATE '1997-01-01' THEN 'already_exists' WHEN base = 'ok' THEN 'insert' ELSE base END AS status
    FROM load_status"""


def _load(v: Views):
    n = v.n_securities
    rows = v.table("customer").selectExpr(
        f"concat('T', c_custkey % {n} div 8) AS ticker",
        "date_add(DATE'1995-01-01', CAST((c_custkey * 29) % 2400 AS INT)) AS valid_from",
        "CASE WHEN c_custkey % 3 > 0 THEN date_add(DATE'1995-01-01', CAST((c_custkey * 29) % 2400 + (c_custkey % 400)"
        " AS INT)) END AS valid_to", "c_mktsegment AS universe",
    )
    # Stays that began before 1997 are stored already.
    old = rows.where("valid_from < DATE'1997-01-01'")
    none = v.membership.select("universe", "security_id", "valid_from", "valid_to").where(F.lit(False))
    stored = universe.membership_outcomes(old, v.identifiers, none, F.col("universe"), TODAY).where("status = 'insert'")
    return rows, stored


@check(
    "univ_membership_load",
    """SELECT universe, ticker, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to,
         security_id, status FROM load_result""",
)
def _(v: Views):
    rows, stored = _load(v)
    out = universe.membership_outcomes(rows, v.identifiers, stored, F.col("universe"), TODAY)
    return out.select("universe", "ticker", "valid_from", "valid_to", "security_id", "status")


@check("univ_membership_tallies", "SELECT status, count(*) AS n FROM load_result GROUP BY status")
def _(v: Views):
    rows, stored = _load(v)
    out = universe.membership_outcomes(rows, v.identifiers, stored, F.col("universe"), TODAY)
    return universe.tallies(out, "status")


@check(
    "univ_membership_new",
    """SELECT universe, security_id, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to, ticker
       FROM load_result WHERE status = 'insert'
       QUALIFY row_number() OVER (PARTITION BY universe, security_id, valid_from ORDER BY valid_to NULLS LAST, ticker) = 1""",
)
def _(v: Views):
    rows, stored = _load(v)
    out = universe.membership_outcomes(rows, v.identifiers, stored, F.col("universe"), TODAY)
    return universe.new_memberships(out, stored)


# FIGI answers: one request per supplier's tickers.
SQL_VIEWS["figi_answers"] = """
    SELECT DISTINCT ON (ticker) ticker, figi, share, name FROM (
      SELECT i.id_value AS ticker, i.security_id AS s,
        CASE WHEN i.security_id % 7 = 0 THEN 'BBG' || (i.security_id + 1) ELSE 'NEW' || (i.security_id // 2) END AS figi,
        'SH' || i.security_id AS share, 'name ' || i.security_id AS name
      FROM identifiers i WHERE i.security_id % 6 > 0) ORDER BY ticker, s"""


def _figi_requests(v: Views):
    """One mapping request per identifier row with three answers: own composite second, no data, another first."""
    figi = "CASE WHEN security_id % 7 = 0 THEN concat('BBG', security_id + 1) ELSE concat('NEW', security_id div 2) END"

    def candidate(own: str, composite: str) -> str:
        return (
            f"concat('{{\"figi\": \"', {own}, '\", \"compositeFIGI\": \"', {composite}, '\", \"shareClassFIGI\": \"SH',"
            " security_id, '\", \"name\": \"name ', security_id, '\"}')"
        )

    wrong, right = candidate("'WRONG'", "'OTHER'"), candidate(figi, figi)
    return v.identifiers.selectExpr(
        "security_id",
        "array('NODATA', id_value) AS tickers",
        f"concat('[{{\"warning\": \"none\"}}, {{\"data\": [', {wrong}, ', ', {right}, ']}}]') AS text",
    )


@check(
    "source_figi",
    """SELECT id_value AS ticker, CASE WHEN security_id % 7 = 0 THEN 'BBG' || (security_id + 1) ELSE 'NEW' || (security_id // 2) END AS figi,
         CASE WHEN security_id % 7 = 0 THEN 'BBG' || (security_id + 1) ELSE 'NEW' || (security_id // 2) END AS composite_figi,
         'SH' || security_id AS share_class_figi, 'name ' || security_id AS name FROM identifiers""",
)
def _(v: Views):
    return bronze.figi_identities(_figi_requests(v))


_TARGETS = f"""SELECT DISTINCT i.id_value AS ticker FROM identifiers i JOIN securities s ON s.security_id = i.security_id
    WHERE s.figi IS NULL AND i.valid_from <= DATE '{TODAY}' AND (i.valid_to IS NULL OR i.valid_to >= DATE '{TODAY}')"""


@check("univ_figi_targets", f"SELECT ticker FROM ({_TARGETS})")
def _(v: Views):
    return universe.figi_targets(v.securities, v.identifiers, TODAY).distinct()


SQL_VIEWS["figi_result"] = f"""
    WITH a AS (SELECT t.ticker, f.figi, f.share, f.name, n.security_id FROM ({_TARGETS}) t
        LEFT JOIN figi_answers f ON f.ticker = t.ticker LEFT JOIN now_tickers n ON n.ticker_key = upper(t.ticker)),
      o AS (SELECT figi, arg_min(security_id, ticker) AS first FROM a WHERE figi IS NOT NULL AND security_id IS NOT NULL GROUP BY 1)
    SELECT a.*, CASE WHEN a.figi IS NULL THEN 'no_mapping' WHEN a.security_id IS NULL THEN 'unresolved'
        WHEN s.security_id IS NOT NULL AND s.security_id <> a.security_id THEN 'clashed'
        WHEN s.security_id IS NULL AND o.first <> a.security_id THEN 'clashed' ELSE 'enriched' END AS outcome
    FROM a LEFT JOIN (SELECT figi, security_id FROM securities WHERE figi IS NOT NULL) s ON s.figi = a.figi
    LEFT JOIN o ON o.figi = a.figi"""


def _figi(v: Views):
    answers = bronze.figi_identities(_figi_requests(v).where("security_id % 6 > 0"))
    # Identifier rows share tickers; the answer of the first security stands.
    one = answers.groupBy("ticker").agg(
        F.min(
            F.struct(
                F.substring_index("share_class_figi", "H", -1).cast("bigint").alias("s"), "figi", "share_class_figi", "name"
            )
        ).alias("m")
    ).select("ticker", "m.figi", "m.share_class_figi", "m.name")
    targets = universe.figi_targets(v.securities, v.identifiers, TODAY).distinct()
    return universe.figi_outcomes(targets, one, v.identifiers, v.securities, TODAY)


@check(
    "univ_figi_outcomes",
    "SELECT ticker, figi, security_id, outcome FROM figi_result",
)
def _(v: Views):
    return _figi(v).select("ticker", "figi", "security_id", "outcome")


@check("univ_figi_tallies", "SELECT outcome, count(*) AS n FROM figi_result GROUP BY outcome")
def _(v: Views):
    return universe.tallies(_figi(v))


@check(
    "univ_figi_enriched",
    """SELECT s.security_id, coalesce(f.figi, s.figi) AS figi, coalesce(f.share, s.composite_figi) AS composite_figi,
         coalesce(f.name, s.description) AS description, CASE WHEN f.figi IS NULL THEN s.country ELSE coalesce(s.country, 'US') END AS country,
         s.source_id
       FROM securities s LEFT JOIN (SELECT * FROM figi_result WHERE outcome = 'enriched'
         QUALIFY row_number() OVER (PARTITION BY security_id ORDER BY ticker DESC) = 1) f ON f.security_id = s.security_id""",
)
def _(v: Views):
    out = universe.enriched_securities(v.securities, _figi(v))
    return out.select("security_id", "figi", "composite_figi", "description", "country", "source_id")


@check(
    "univ_vendor_symbol",
    "SELECT s_suppkey AS security_id, replace('K.' || s_suppkey || '.B', '.', '-') AS symbol FROM supplier",
)
def _(v: Views):
    return v.table("supplier").select(
        F.col("s_suppkey").alias("security_id"),
        universe.share_class_symbol(F.concat(F.lit("K."), F.col("s_suppkey"), F.lit(".B"))).alias("symbol"),
    )


@check(
    "univ_assign_creator",
    """SELECT s.security_id, CASE WHEN s.security_id IN (SELECT n.security_id FROM now_tickers n
           JOIN (SELECT DISTINCT 'T' || p_size AS t FROM part) p ON upper(p.t) = n.ticker_key) THEN 1 ELSE s.source_id END AS source_id
       FROM securities s""",
)
def _(v: Views):
    symbols = v.table("part").selectExpr("concat('t', p_size) AS symbol").distinct()
    return universe.assign_creator(v.securities, v.identifiers, symbols, 1, TODAY).select("security_id", "source_id")


# Holdings files: one per supplier, a preamble and a header before the lines.
@check(
    "source_holdings",
    """SELECT 's' || s_suppkey AS doc, CASE WHEN k = 3 THEN 'H' || s_suppkey || '.B' ELSE 'H' || s_suppkey END AS ticker,
         CASE WHEN k = 3 THEN 3 ELSE 6 END AS line_no, 'EQUITY' AS security_type
       FROM supplier, (SELECT unnest([3, 6]) AS k)""",
)
def _(v: Views):
    text = (
        "concat('\ufeffFund Holdings\\nAs of,\"Jan 1, 2000\"\\nName,\"Ticker\",Weight\\n',"
        " '\"Smith, Co\",h', s_suppkey, '.b,1.0\\n', 'Cash,USD,2.0\\n', 'Stub,', s_suppkey, 'D,0.1\\n',"
        " 'Plain,H', s_suppkey, ',0.5\\n', 'Again, H', s_suppkey, '.B ,0.5\\n', 'Bad,H H,0\\n', 'Odd,H_1,0')"
    )
    docs = v.table("supplier").selectExpr("concat('s', s_suppkey) AS doc", f"{text} AS text")
    return registry_files.holdings(docs, "Ticker", "EQUITY")
