"""Market-shaped views over the given tables, in Spark and in SQL.

Every view covers its whole table and is a plain projection, an explode, or one
aggregate; none needs a global row number. `Views` holds the Spark side,
`SQL_VIEWS` the same definitions for the SQL engine. Dates stand for knowledge
times in SQL (21:00 UTC of that date in Spark), so end-of-day cut-offs agree.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagelake import session

AS_OF = dt.date(2000, 6, 30)  # used by reads
TODAY = dt.date(2000, 6, 30)  # stands for "today" in listing rules
LATE = dt.date(2002, 12, 31)  # after every knowledge date

TAG_FAMILIES = [
    ("debt_noncurrent", "LongTermDebtNoncurrent", "LongTermDebt", "LongTermDebtOther"),
    ("debt_current", "DebtCurrent", "LongTermDebtCurrent", "ShortTermBorrowings"),
    ("total_assets", "Assets", "Assets", "AssetsOther"),
    ("revenue", "RevenueFromContractWithCustomerExcludingAssessedTax", "Revenues", "SalesRevenueNet"),
    ("cfo", "NetCashProvidedByUsedInOperatingActivities",
     "NetCashProvidedByUsedInOperatingActivitiesContinuingOperations",
     "NetCashProvidedByUsedInOperatingActivities"),
    ("capex", "PaymentsToAcquirePropertyPlantAndEquipment", "PaymentsToAcquireProductiveAssets",
     "PaymentsToAcquirePropertyPlantAndEquipment"),
    ("operating_income", "OperatingIncomeLoss", "OperatingIncomeLossOther", "OperatingIncomeLoss"),
    ("depreciation_amortization", "DepreciationDepletionAndAmortization", "DepreciationAndAmortization",
     "DepreciationAmortizationAndAccretionNet"),
]
DATASETS = [
    "bars_eod", "corporate_actions", "macro.observation", "fund.fundamental_fact",
    "univ.universe_membership", "sec.security", "ref.trading_session",
]


def _case(expr: str, values: list[str]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} {arms} END"


_TAG = "CASE pick " + " ".join(
    f"WHEN {i * 3 + j} THEN '{family[j + 1]}'"
    for i, family in enumerate(TAG_FAMILIES)
    for j in range(3)
) + " END"
_SEQ = "l_orderkey * 7 + l_linenumber * 3 + l_partkey * 31 + l_suppkey"


# Declared schemas of the given tables; reading needs no look at a file.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


class Views:
    """Spark side; views are lazy DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = session.configure(spark)
        self.dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def n_securities(self) -> int:
        return self.table("supplier").count()

    @cached_property
    def bars(self) -> DataFrame:
        base = self.table("lineitem").selectExpr(
            "*", f"{_SEQ} AS seq", "l_extendedprice / l_quantity AS px",
            "l_extendedprice / l_quantity * (1 - l_discount) AS low",
            "CAST(l_shipdate AS DATE) AS session_date",
        )
        return base.selectExpr(
            "l_suppkey AS security_id",
            "concat('S', l_suppkey) AS symbol",
            "session_date",
            "CASE WHEN seq % 997 = 0 THEN low * 0.98D ELSE px * (1 - l_discount / 10) END AS open",
            "CASE WHEN seq % 991 = 0 THEN low * 0.5D ELSE px * (1 + l_tax) END AS high",
            "low",
            "px AS close",
            "CASE WHEN seq % 983 = 0 THEN 0L ELSE CAST(l_quantity * 100 AS BIGINT) END AS volume",
            "CAST(l_linenumber * 10 AS BIGINT) AS trade_count",
            "px * (1 - l_discount / 2) AS vwap",
            "CAST(date_add(session_date, CAST((l_orderkey + l_linenumber) % 45 AS INT)) AS TIMESTAMP)"
            " + INTERVAL 21 HOURS AS knowledge_time",
            "l_orderkey AS batch_id",
            "CASE WHEN l_returnflag = 'R' THEN 'ALPACA' ELSE 'TIINGO' END AS source",
        )

    @cached_property
    def sessions(self) -> DataFrame:
        """Weekdays of the shipping period, less New Year and Christmas; Christmas Eve is a half day."""
        span = self.table("lineitem").selectExpr(
            "CAST(min(l_shipdate) AS DATE) AS lo", "CAST(max(l_shipdate) AS DATE) AS hi"
        )
        days = span.selectExpr("explode(sequence(lo, hi)) AS session_date")
        return days.where(
            "weekday(session_date) < 5 AND NOT (month(session_date) = 1 AND day(session_date) = 1)"
            " AND NOT (month(session_date) = 12 AND day(session_date) = 25)"
        ).selectExpr(
            "session_date",
            "CAST(session_date AS TIMESTAMP) + INTERVAL '14:30' HOUR TO MINUTE AS open_utc",
            "CAST(session_date AS TIMESTAMP) + CASE WHEN month(session_date) = 12 AND day(session_date) = 24"
            " THEN INTERVAL 18 HOURS ELSE INTERVAL 21 HOURS END AS close_utc",
            "month(session_date) = 12 AND day(session_date) = 24 AS is_half_day",
        )

    @cached_property
    def actions(self) -> DataFrame:
        base = self.table("orders").selectExpr(
            "o_orderkey AS k", "o_custkey AS c", "CAST(o_orderdate AS DATE) AS ex_date",
            "explode(CASE WHEN o_orderkey % 5 = 0 THEN array(0, 1) ELSE array(0) END) AS copy",
        )
        return base.selectExpr(
            "k * 2 + copy AS action_id",
            f"c % {self.n_securities} AS security_id",
            "CASE WHEN k % 2 = 0 THEN 'SPLIT' ELSE 'CASH_DIVIDEND' END AS action_type",
            "ex_date",
            "CASE WHEN k % 2 = 0 THEN CAST(19 + 2 * (k % 3) AS DOUBLE) END AS split_from",
            "CASE WHEN k % 2 = 0 THEN CAST(20 + (k div 3) % 3 + CASE WHEN copy = 1 AND k % 25 = 0"
            " THEN 1 ELSE 0 END AS DOUBLE) END AS split_to",
            "CASE WHEN k % 2 = 1 THEN CAST(1 + c % 5 + CASE WHEN copy = 1 AND k % 25 = 0"
            " THEN 1 ELSE 0 END AS DOUBLE) END AS cash_amount",
            "CAST(date_add(ex_date, CAST(k % 4 AS INT)) AS TIMESTAMP) + INTERVAL 21 HOURS AS knowledge_time",
            "CASE WHEN copy = 1 THEN 'SEC' WHEN k % 3 = 0 THEN 'TIINGO' WHEN k % 3 = 1 THEN 'MANUAL'"
            " ELSE 'BOOTSTRAP' END AS source",
        )

    @cached_property
    def vendor(self) -> DataFrame:
        """Vendor daily rows with the action columns and a vendor-adjusted close."""
        return self.table("lineitem").selectExpr(
            "l_suppkey AS security_id", "CAST(l_shipdate AS DATE) AS session_date",
            "l_orderkey AS batch_id", "l_linenumber AS line", f"{_SEQ} AS seq",
            "l_extendedprice / l_quantity AS close", "l_quantity AS qty",
        ).selectExpr(
            "security_id", "session_date", "batch_id", "line", "close",
            "CAST(qty * 100 AS BIGINT) AS volume",
            "CASE WHEN seq % 211 = 0 THEN CAST(1 + seq % 7 AS DOUBLE) / (1 + seq % 3)"
            " WHEN seq % 211 = 1 THEN 0.0D WHEN seq % 211 = 3 THEN NULL"
            " WHEN seq % 211 = 2 THEN 0.333333D ELSE 1.0D END AS split_factor",
            "CASE WHEN seq % 97 = 0 THEN CAST(seq % 5 AS DOUBLE) + 0.25D ELSE 0.0D END AS div_cash",
            "close * (1 + CAST(seq % 11 - 5 AS DOUBLE) / 100000000) AS adj_close",
        )

    @cached_property
    def identifiers(self) -> DataFrame:
        base = self.table("supplier").selectExpr(
            "s_suppkey AS s", "explode(array(0, 1)) AS copy",
            "date_add(DATE'1995-01-01', CAST((s_suppkey % 8) * 300 AS INT)) AS vf",
        )
        return base.selectExpr(
            "s AS security_id",
            "'TICKER' AS id_type",
            "CASE WHEN copy = 0 THEN concat('T', s div 8) ELSE concat('U', s div 2) END AS id_value",
            "CASE WHEN copy = 0 THEN vf WHEN s % 4 = 0 THEN date_add(vf, 200) ELSE date_add(vf, 310) END"
            " AS valid_from",
            "CASE WHEN copy = 0 AND s % 8 = 7 THEN NULL WHEN copy = 0 THEN date_add(vf, 298)"
            " WHEN s % 5 = 0 THEN date_add(vf, 1200) END AS valid_to",
        )

    @cached_property
    def securities(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "s_suppkey AS security_id",
            "CASE WHEN s_suppkey % 10 = 0 THEN 'ETF' ELSE 'EQUITY' END AS security_type",
            "s_name AS description",
            "CASE WHEN s_suppkey % 3 > 0 THEN concat('BBG', s_suppkey) END AS figi",
            "CASE WHEN s_suppkey % 3 > 0 THEN concat('SCF', s_suppkey) END AS composite_figi",
            "CASE WHEN s_suppkey % 4 > 0 THEN lpad(CAST(s_suppkey AS STRING), 10, '0') END AS cik",
            "CASE WHEN s_suppkey % 5 > 0 THEN 'US' END AS country",
            "5L AS source_id",
        )

    @cached_property
    def membership(self) -> DataFrame:
        base = (
            self.table("supplier")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .selectExpr(
                "r_name AS universe", "s_suppkey AS s",
                "explode(CASE WHEN s_suppkey % 4 = 0 THEN array(0, 1) ELSE array(0) END) AS copy",
            )
        )
        return base.selectExpr(
            "universe", "s AS security_id",
            "CASE WHEN copy = 0 THEN date_add(DATE'1995-01-01', CAST((s * 53) % 900 AS INT))"
            " ELSE date_add(DATE'2000-01-01', CAST(s % 300 AS INT)) END AS valid_from",
            "CASE WHEN copy = 0 AND (s % 3 = 0 OR s % 4 = 0)"
            " THEN date_add(DATE'1998-01-01', CAST((s * 31) % 700 AS INT)) END AS valid_to",
            "CAST(date_add(DATE'1999-10-01', CAST(s % 400 AS INT)) AS TIMESTAMP) + INTERVAL 21 HOURS"
            " AS knowledge_time",
        )

    @cached_property
    def macro(self) -> DataFrame:
        days = self.table("events").selectExpr(
            "event_type AS series_id", "CAST(ts AS DATE) AS obs_date",
            "date_add(CAST(ts AS DATE), CAST(event_id % 7 AS INT)) AS vintage_date", "value", "event_id",
        )
        return days.groupBy("series_id", "obs_date", "vintage_date").agg(
            F.max_by("value", "event_id").alias("value")
        )

    @cached_property
    def _fact_lines(self) -> DataFrame:
        """Three to six reported entries per order. Names are array look-ups: a long CASE would be
        copied into every expression that uses it and outgrow code generation."""
        tags = ", ".join(f"'{t}'" for f in TAG_FAMILIES for t in f[1:])
        names = ", ".join(f"'{f[0]}'" for f in TAG_FAMILIES)
        base = self.table("orders").selectExpr(
            "o_orderkey AS k", "CAST(o_orderdate AS DATE) AS od", "floor(o_totalprice) AS total",
            "explode(sequence(0, CAST(2 + o_orderkey % 4 AS INT))) AS i",
        ).selectExpr("*", f"CAST((k div 7 + i div 3) % {len(TAG_FAMILIES)} AS INT) AS family")
        return base.selectExpr(
            "*",
            f"element_at(array({tags}), family * 3 + i % 3 + 1) AS tag",
            f"element_at(array({names}), family + 1) AS concept",
        )

    @cached_property
    def raw_facts(self) -> DataFrame:
        """Reported entries as a filing states them."""
        return self._reported().drop("concept")

    def _reported(self) -> DataFrame:
        base = self._fact_lines
        return base.selectExpr(
            f"k % {self.n_securities} AS security_id",
            "concat('A', k) AS accession",
            "tag",
            "CASE WHEN i = 4 THEN ' usd' WHEN k % 13 = 0 AND i = 1 THEN 'EUR' ELSE 'USD' END AS unit",
            "CAST(total * (1 + CASE WHEN k % 3 = 0 THEN 0.01D * i ELSE 0.0D END) AS DOUBLE) AS value",
            "CASE WHEN family < 3 THEN NULL WHEN k % 2 = 0 THEN date_add(trunc(od, 'quarter'), -365)"
            " ELSE date_add(trunc(od, 'quarter'), -90) END AS period_start",
            "trunc(od, 'quarter') AS period_end",
            "CASE WHEN k % 11 = 0 THEN '8-K' WHEN k % 2 = 0 THEN '10-K' ELSE '10-Q' END AS form",
            "CASE WHEN k % 2 = 0 THEN 'FY' ELSE 'Q1' END AS fiscal_period",
            "date_add(od, CAST(k % 60 AS INT)) AS filed_date",
            "i AS ordinal",
            "concept",
        )

    @cached_property
    def facts(self) -> DataFrame:
        """Stored facts: the raw entries under their concept name."""
        return self._reported().selectExpr(
            "security_id", "accession", "concept", "period_start", "period_end",
            "fiscal_period", "CAST(value AS DECIMAL(38,9)) AS value", "trim(upper(unit)) AS unit",
            "CAST(filed_date AS TIMESTAMP) AS filed_at",
        )

    @cached_property
    def batches(self) -> DataFrame:
        dataset = _case("o_orderkey % 7", DATASETS)
        return self.table("orders").selectExpr(
            "o_orderkey AS batch_id", "1 + o_custkey % 8 AS source_id", f"{dataset} AS dataset",
            "CASE WHEN o_orderkey % 10 = 0 THEN 'partial' WHEN o_orderstatus = 'F' THEN 'succeeded'"
            " WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'running' END AS status",
            "CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + make_dt_interval(0, 0, 0, o_orderkey % 86400)"
            " AS started_at",
            "CASE WHEN o_orderstatus <> 'O' OR o_orderkey % 10 = 0 THEN"
            " CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)"
            " + make_dt_interval(0, 0, 0, o_orderkey % 86400 + o_orderkey % 7200) END AS finished_at",
            "CAST(floor(o_totalprice) AS BIGINT) AS rows_in",
            "CAST(floor(o_totalprice) AS BIGINT) - o_orderkey % 100 AS rows_out",
            "concat('v', o_orderkey % 3) AS code_version",
            "CASE WHEN o_orderkey % 10 <> 0 AND o_orderstatus = 'P' THEN concat('error ', o_orderkey % 17) END"
            " AS error",
        )

    @cached_property
    def dq_results(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey AS result_id",
            "CASE WHEN o_orderkey % 2 = 0 THEN 'bars_non_session_date' ELSE 'bars_malformed_row' END AS check_name",
            "o_orderkey AS batch_id",
            "CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS run_at",
            "o_orderkey % 4 > 0 AS passed",
            "to_json(named_struct('severity', CASE WHEN o_orderkey % 4 = 0 THEN 'error' ELSE 'info' END,"
            " 'count', o_custkey)) AS observed",
            "concat('batch ', o_orderkey) AS details",
        )


SQL_VIEWS: dict[str, str] = {
    "nsec": "SELECT count(*) AS n FROM supplier",
    "bars": f"""
        SELECT l_suppkey AS security_id, 'S' || l_suppkey AS symbol, session_date,
          CASE WHEN seq % 997 = 0 THEN low * 0.98::DOUBLE ELSE px * (1 - l_discount / 10) END AS open,
          CASE WHEN seq % 991 = 0 THEN low * 0.5::DOUBLE ELSE px * (1 + l_tax) END AS high,
          low, px AS close,
          CASE WHEN seq % 983 = 0 THEN 0 ELSE CAST(l_quantity * 100 AS BIGINT) END AS volume,
          CAST(l_linenumber * 10 AS BIGINT) AS trade_count, px * (1 - l_discount / 2) AS vwap,
          session_date + CAST((l_orderkey + l_linenumber) % 45 AS INTEGER) AS known,
          l_orderkey AS batch_id,
          CASE WHEN l_returnflag = 'R' THEN 'ALPACA' ELSE 'TIINGO' END AS source
        FROM (SELECT *, {_SEQ} AS seq, l_extendedprice / l_quantity AS px,
                l_extendedprice / l_quantity * (1 - l_discount) AS low,
                CAST(l_shipdate AS DATE) AS session_date FROM lineitem)""",
    "sessions": """
        SELECT session_date, session_date + CASE WHEN half THEN INTERVAL 18 HOUR ELSE INTERVAL 21 HOUR END AS close_utc,
          half AS is_half_day
        FROM (SELECT d AS session_date, month(d) = 12 AND day(d) = 24 AS half
          FROM (SELECT CAST(unnest(generate_series(CAST(min(l_shipdate) AS DATE), CAST(max(l_shipdate) AS DATE),
                  INTERVAL 1 DAY)) AS DATE) AS d FROM lineitem)
          WHERE isodow(d) < 6 AND NOT (month(d) = 1 AND day(d) = 1) AND NOT (month(d) = 12 AND day(d) = 25))""",
    "actions": """
        SELECT k * 2 + copy AS action_id, c % (SELECT n FROM nsec) AS security_id,
          CASE WHEN k % 2 = 0 THEN 'SPLIT' ELSE 'CASH_DIVIDEND' END AS action_type, ex_date,
          CASE WHEN k % 2 = 0 THEN CAST(19 + 2 * (k % 3) AS DOUBLE) END AS split_from,
          CASE WHEN k % 2 = 0 THEN CAST(20 + (k // 3) % 3 + CASE WHEN copy = 1 AND k % 25 = 0 THEN 1 ELSE 0 END
            AS DOUBLE) END AS split_to,
          CASE WHEN k % 2 = 1 THEN CAST(1 + c % 5 + CASE WHEN copy = 1 AND k % 25 = 0 THEN 1 ELSE 0 END
            AS DOUBLE) END AS cash_amount,
          ex_date + CAST(k % 4 AS INTEGER) AS known,
          CASE WHEN copy = 1 THEN 'SEC' WHEN k % 3 = 0 THEN 'TIINGO' WHEN k % 3 = 1 THEN 'MANUAL'
            ELSE 'BOOTSTRAP' END AS source
        FROM (SELECT o_orderkey AS k, o_custkey AS c, CAST(o_orderdate AS DATE) AS ex_date,
                unnest(CASE WHEN o_orderkey % 5 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM orders)""",
    "vendor": f"""
        SELECT security_id, session_date, batch_id, line, close, CAST(qty * 100 AS BIGINT) AS volume,
          CASE WHEN seq % 211 = 0 THEN CAST(1 + seq % 7 AS DOUBLE) / (1 + seq % 3)
            WHEN seq % 211 = 1 THEN 0.0::DOUBLE WHEN seq % 211 = 3 THEN NULL
            WHEN seq % 211 = 2 THEN 0.333333::DOUBLE ELSE 1.0::DOUBLE END AS split_factor,
          CASE WHEN seq % 97 = 0 THEN CAST(seq % 5 AS DOUBLE) + 0.25::DOUBLE ELSE 0.0::DOUBLE END AS div_cash,
          close * (1 + CAST(seq % 11 - 5 AS DOUBLE) / 100000000) AS adj_close
        FROM (SELECT l_suppkey AS security_id, CAST(l_shipdate AS DATE) AS session_date, l_orderkey AS batch_id,
                l_linenumber AS line, {_SEQ} AS seq, l_extendedprice / l_quantity AS close, l_quantity AS qty
              FROM lineitem)""",
    "identifiers": """
        SELECT s AS security_id, 'TICKER' AS id_type,
          CASE WHEN copy = 0 THEN 'T' || (s // 8) ELSE 'U' || (s // 2) END AS id_value,
          CASE WHEN copy = 0 THEN vf WHEN s % 4 = 0 THEN vf + 200 ELSE vf + 310 END AS valid_from,
          CASE WHEN copy = 0 AND s % 8 = 7 THEN NULL WHEN copy = 0 THEN vf + 298
            WHEN s % 5 = 0 THEN vf + 1200 END AS valid_to
        FROM (SELECT s_suppkey AS s, unnest([0, 1]) AS copy,
                DATE '1995-01-01' + CAST((s_suppkey % 8) * 300 AS INTEGER) AS vf FROM supplier)""",
    "securities": """
        SELECT s_suppkey AS security_id,
          CASE WHEN s_suppkey % 10 = 0 THEN 'ETF' ELSE 'EQUITY' END AS security_type, s_name AS description,
          CASE WHEN s_suppkey % 3 > 0 THEN 'BBG' || s_suppkey END AS figi,
          CASE WHEN s_suppkey % 3 > 0 THEN 'SCF' || s_suppkey END AS composite_figi,
          CASE WHEN s_suppkey % 4 > 0 THEN lpad(CAST(s_suppkey AS VARCHAR), 10, '0') END AS cik,
          CASE WHEN s_suppkey % 5 > 0 THEN 'US' END AS country, CAST(5 AS BIGINT) AS source_id
        FROM supplier""",
    "membership": """
        SELECT universe, s AS security_id,
          CASE WHEN copy = 0 THEN DATE '1995-01-01' + CAST((s * 53) % 900 AS INTEGER)
            ELSE DATE '2000-01-01' + CAST(s % 300 AS INTEGER) END AS valid_from,
          CASE WHEN copy = 0 AND (s % 3 = 0 OR s % 4 = 0)
            THEN DATE '1998-01-01' + CAST((s * 31) % 700 AS INTEGER) END AS valid_to,
          DATE '1999-10-01' + CAST(s % 400 AS INTEGER) AS known
        FROM (SELECT r_name AS universe, s_suppkey AS s,
                unnest(CASE WHEN s_suppkey % 4 = 0 THEN [0, 1] ELSE [0] END) AS copy
              FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""",
    "macro": """
        SELECT event_type AS series_id, CAST(ts AS DATE) AS obs_date,
          CAST(ts AS DATE) + CAST(event_id % 7 AS INTEGER) AS vintage_date, arg_max(value, event_id) AS value
        FROM events GROUP BY ALL""",
    "raw_facts": f"""
        SELECT k % (SELECT n FROM nsec) AS security_id, 'A' || k AS accession, {_TAG} AS tag,
          CASE WHEN i = 4 THEN ' usd' WHEN k % 13 = 0 AND i = 1 THEN 'EUR' ELSE 'USD' END AS unit,
          CAST(total * (1 + CASE WHEN k % 3 = 0 THEN 0.01::DOUBLE * i ELSE 0.0::DOUBLE END) AS DOUBLE) AS value,
          CASE WHEN family < 3 THEN NULL WHEN k % 2 = 0 THEN pe - 365 ELSE pe - 90 END AS period_start,
          pe AS period_end,
          CASE WHEN k % 11 = 0 THEN '8-K' WHEN k % 2 = 0 THEN '10-K' ELSE '10-Q' END AS form,
          CASE WHEN k % 2 = 0 THEN 'FY' ELSE 'Q1' END AS fiscal_period,
          od + CAST(k % 60 AS INTEGER) AS filed_date, i AS ordinal
        FROM (SELECT *, (k // 7 + i // 3) % {len(TAG_FAMILIES)} AS family, ((k // 7 + i // 3) % {len(TAG_FAMILIES)}) * 3 + i % 3 AS pick,
                CAST(date_trunc('quarter', od) AS DATE) AS pe
              FROM (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS od, floor(o_totalprice) AS total,
                      CAST(unnest(generate_series(0, 2 + o_orderkey % 4)) AS INTEGER) AS i FROM orders))""",
    "facts": "SELECT security_id, accession, " + "CASE " + " ".join(
        f"WHEN tag IN ({', '.join(repr(t) for t in sorted(set(f[1:])))}) THEN '{f[0]}'" for f in TAG_FAMILIES
    ) + " END AS concept, period_start, period_end, fiscal_period, CAST(value AS DECIMAL(38,9)) AS value, "
        "trim(upper(unit)) AS unit, filed_date AS filed FROM raw_facts",
    "batches": f"""
        SELECT o_orderkey AS batch_id, 1 + o_custkey % 8 AS source_id, {_case("o_orderkey % 7", DATASETS)} AS dataset,
          CASE WHEN o_orderkey % 10 = 0 THEN 'partial' WHEN o_orderstatus = 'F' THEN 'succeeded'
            WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'running' END AS status,
          CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_seconds(o_orderkey % 86400) AS started_at,
          CASE WHEN o_orderstatus <> 'O' OR o_orderkey % 10 = 0 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)
            + to_seconds(o_orderkey % 86400 + o_orderkey % 7200) END AS finished_at,
          CAST(floor(o_totalprice) AS BIGINT) AS rows_in,
          CAST(floor(o_totalprice) AS BIGINT) - o_orderkey % 100 AS rows_out,
          'v' || (o_orderkey % 3) AS code_version,
          CASE WHEN o_orderkey % 10 <> 0 AND o_orderstatus = 'P' THEN 'error ' || (o_orderkey % 17) END AS error
        FROM orders""",
    "dq_results": """
        SELECT o_orderkey AS result_id,
          CASE WHEN o_orderkey % 2 = 0 THEN 'bars_non_session_date' ELSE 'bars_malformed_row' END AS check_name,
          o_orderkey AS batch_id, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS run_at,
          o_orderkey % 4 > 0 AS passed,
          CASE WHEN o_orderkey % 4 = 0 THEN 'error' ELSE 'info' END AS severity, o_custkey AS cnt,
          'batch ' || o_orderkey AS details
        FROM orders""",
}

_BAR_TIES = (
    "known DESC, batch_id DESC, source, close DESC, volume DESC, open DESC, high DESC, low DESC, "
    "trade_count DESC, vwap DESC"
)
# Reads that several checks share.
SQL_VIEWS["bars_asof"] = f"""
    SELECT * FROM bars WHERE known <= DATE '{AS_OF}'
    QUALIFY row_number() OVER (PARTITION BY security_id, session_date ORDER BY {_BAR_TIES}) = 1"""
SQL_VIEWS["bars_latest"] = f"""
    SELECT * FROM bars QUALIFY row_number() OVER (PARTITION BY security_id, session_date ORDER BY {_BAR_TIES}) = 1"""


def oracle(body: str) -> str:
    """Prefix a query with the views it names, in definition order."""
    import re

    needed: set[str] = set()
    stack = [body]
    while stack:
        text = stack.pop()
        for name, sql in SQL_VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                stack.append(sql)
    parts = [f"{n} AS ({' '.join(SQL_VIEWS[n].split())})" for n in SQL_VIEWS if n in needed]
    body = " ".join(body.split())
    if not parts:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {', '.join(parts)}, {body[5:]}"
    return f"WITH {', '.join(parts)} {body}"


def present(df: DataFrame) -> DataFrame:
    """Render dates and times as text and decimals as doubles so both engines hash alike."""
    cols = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind == "date" or kind.startswith("timestamp"):
            c = c.cast("string")
        elif kind.startswith("decimal"):
            c = c.cast("double")
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        cols.append(c.alias(name))
    return df.select(*cols)


# Rounding for comparison. Prices are short decimals, so exact ties at a rounding
# boundary are common and one last bit decides them; an offset that no short
# decimal can meet moves the boundary away from all of them.
_OFFSET = 0.3183098861


def settle(column, digits: int):
    scale = 10.0**digits
    return F.floor(column * scale + _OFFSET).cast("double") / scale


def settle_sql(expr: str, digits: int) -> str:
    scale = f"{10.0**digits}::DOUBLE"
    return f"floor(({expr}) * {scale} + {_OFFSET}::DOUBLE) / {scale}"
