"""Reference dictionaries.

Fixed values throughout: concept names, vendor tags with priority and
confidence, macro series, feature definitions, quality checks, pipelines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# concept, statement, expected unit; flows first, then balances, then cash flows, then computed ones.
CONCEPTS = [
    ("revenue", "income", "USD"),
    ("cost_of_revenue", "income", "USD"),
    ("gross_profit", "income", "USD"),
    ("operating_income", "income", "USD"),
    ("net_income", "income", "USD"),
    ("depreciation_amortization", "income", "USD"),
    ("eps_basic", "income", "USD/shares"),
    ("eps_diluted", "income", "USD/shares"),
    ("shares_basic", "income", "shares"),
    ("shares_diluted", "income", "shares"),
    ("total_assets", "balance", "USD"),
    ("total_liabilities", "balance", "USD"),
    ("total_equity", "balance", "USD"),
    ("cash_and_equivalents", "balance", "USD"),
    ("goodwill", "balance", "USD"),
    ("debt_current", "balance", "USD"),
    ("debt_noncurrent", "balance", "USD"),
    ("operating_lease_liability", "balance", "USD"),
    ("finance_lease_liability", "balance", "USD"),
    ("cfo", "cashflow", "USD"),
    ("capex", "cashflow", "USD"),
    ("cff", "cashflow", "USD"),
    ("total_debt", "balance", "USD"),
    ("ebitda", "income", "USD"),
    ("fcf", "cashflow", "USD"),
]
PREFER_HIGHER_CONFIDENCE = ("debt_current", "debt_noncurrent")

# concept, tag, priority, confidence
ALIASES = [
    ("revenue", "RevenueFromContractWithCustomerExcludingAssessedTax", 10, "HIGH"),
    ("revenue", "RevenueFromContractWithCustomerIncludingAssessedTax", 20, "MEDIUM"),
    ("revenue", "Revenues", 30, "MEDIUM"),
    ("revenue", "SalesRevenueNet", 40, "MEDIUM"),
    ("cost_of_revenue", "CostOfRevenue", 10, "HIGH"),
    ("cost_of_revenue", "CostOfGoodsAndServicesSold", 20, "HIGH"),
    ("cost_of_revenue", "CostOfGoodsSold", 30, "MEDIUM"),
    ("gross_profit", "GrossProfit", 10, "HIGH"),
    ("operating_income", "OperatingIncomeLoss", 10, "HIGH"),
    ("net_income", "NetIncomeLoss", 10, "HIGH"),
    ("net_income", "ProfitLoss", 20, "MEDIUM"),
    ("depreciation_amortization", "DepreciationDepletionAndAmortization", 10, "HIGH"),
    ("depreciation_amortization", "DepreciationAmortizationAndAccretionNet", 20, "MEDIUM"),
    ("depreciation_amortization", "DepreciationAndAmortization", 30, "MEDIUM"),
    ("eps_basic", "EarningsPerShareBasic", 10, "HIGH"),
    ("eps_diluted", "EarningsPerShareDiluted", 10, "HIGH"),
    ("shares_basic", "WeightedAverageNumberOfSharesOutstandingBasic", 10, "HIGH"),
    ("shares_diluted", "WeightedAverageNumberOfDilutedSharesOutstanding", 10, "HIGH"),
    ("total_assets", "Assets", 10, "HIGH"),
    ("total_liabilities", "Liabilities", 10, "HIGH"),
    ("total_equity", "StockholdersEquity", 10, "HIGH"),
    ("cash_and_equivalents", "CashAndCashEquivalentsAtCarryingValue", 10, "HIGH"),
    ("goodwill", "Goodwill", 10, "HIGH"),
    ("debt_current", "DebtCurrent", 10, "HIGH"),
    ("debt_current", "LongTermDebtCurrent", 20, "MEDIUM"),
    ("debt_current", "ShortTermBorrowings", 30, "MEDIUM"),
    ("debt_noncurrent", "LongTermDebtNoncurrent", 10, "HIGH"),
    ("debt_noncurrent", "LongTermDebt", 20, "MEDIUM"),
    ("operating_lease_liability", "OperatingLeaseLiability", 10, "HIGH"),
    ("finance_lease_liability", "FinanceLeaseLiability", 10, "HIGH"),
    ("cfo", "NetCashProvidedByUsedInOperatingActivities", 10, "HIGH"),
    ("cfo", "NetCashProvidedByUsedInOperatingActivitiesContinuingOperations", 20, "MEDIUM"),
    ("capex", "PaymentsToAcquirePropertyPlantAndEquipment", 10, "HIGH"),
    ("capex", "PaymentsToAcquireProductiveAssets", 20, "MEDIUM"),
    ("cff", "NetCashProvidedByUsedInFinancingActivities", 10, "HIGH"),
    ("cff", "NetCashProvidedByUsedInFinancingActivitiesContinuingOperations", 20, "MEDIUM"),
]

# series, label, dimension, revisable
MACRO_SERIES = [
    ("CPIAUCSL", "CPI, All Urban Consumers, SA", "inflation", True),
    ("PPIACO", "PPI, All Commodities", "inflation", True),
    ("UNRATE", "Unemployment Rate", "employment", True),
    ("PAYEMS", "Total Nonfarm Payrolls", "employment", True),
    ("FEDFUNDS", "Effective Federal Funds Rate (monthly)", "rates", True),
    ("DGS3MO", "3-Month Treasury Yield", "yield_curve", False),
    ("DGS2", "2-Year Treasury Yield", "yield_curve", False),
    ("DGS10", "10-Year Treasury Yield", "yield_curve", False),
    ("T10Y2Y", "10Y minus 2Y Treasury Spread", "yield_curve", False),
    ("GDPC1", "Real GDP", "growth", True),
    ("HOUST", "Housing Starts", "housing", True),
    ("BAMLH0A0HYM2", "ICE BofA US High Yield OAS", "credit", True),
]

# name, version, parameters, inputs
FEATURES = [
    ("return_1d", 1, '{"function":"simple_return","period":1}', "bars_eod"),
    ("log_return_1d", 1, '{"function":"log_return","period":1}', "bars_eod"),
    ("sma20", 1, '{"function":"sma","window":20}', "bars_eod"),
    ("sma50", 1, '{"function":"sma","window":50}', "bars_eod"),
    ("ema20", 1, '{"function":"ema","span":20}', "bars_eod"),
    ("realized_vol20", 1, '{"function":"realized_vol","window":20}', "bars_eod"),
    ("roc20", 1, '{"function":"roc","window":20}', "bars_eod"),
    ("momentum_12_1", 1, '{"function":"momentum_12_1","skip":21,"lookback":252}', "bars_eod"),
]

# name, dataset, severity, parameters, enabled
DQ_CHECKS = [
    ("bars_non_session_date", "bars_eod", "warn", '{"fail_fraction": 0.01}', True),
    ("bars_malformed_row", "bars_eod", "warn", '{"fail_fraction": 0.01}', True),
]

# source id, source name
SOURCES = [
    (1, "SEC_EDGAR"), (2, "FRED"), (3, "OPENFIGI"), (4, "EXCHANGE_CALENDARS"),
    (5, "UNIVERSE"), (6, "ALPACA"), (7, "BOOTSTRAP"), (8, "TIINGO"),
]

# source id, dataset, cadence, enabled, retired, critical
PIPELINES = [
    (8, "bars_eod", "daily", True, False, True),
    (8, "corporate_actions", "on-demand", True, False, True),
    (2, "macro.observation", "weekly", True, False, False),
    (1, "fund.fundamental_fact", "weekly", True, False, False),
    (5, "univ.universe_membership", "on-demand", True, False, False),
    (5, "sec.security", "on-demand", True, False, False),
    (3, "sec.security", "on-demand", True, False, False),
    (4, "ref.trading_session", "on-demand", True, False, False),
    (6, "bars_eod", "daily", False, True, False),
]
PIPELINE_KINDS = {
    "bars_eod": "prices",
    "corporate_actions": "corporate_actions",
    "macro.observation": "macro",
    "fund.fundamental_fact": "fundamentals",
    "univ.universe_membership": "universe",
    "sec.security": "reference",
    "ref.trading_session": "reference",
}
OTHER_KIND = "reference"

# name, storage
DATASETS = [
    ("bars", "parquet_lake"),
    ("gold", "parquet_lake"),
    ("macro", "postgres"),
    ("fundamentals", "postgres"),
    ("universe", "postgres"),
]


def concepts(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame(CONCEPTS, "concept string, statement string, expected_unit string")
    return df.withColumn("research_status", F.lit("core")).withColumn(
        "prefer_higher_confidence", F.col("concept").isin(*PREFER_HIGHER_CONFIDENCE)
    )


def aliases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ALIASES, "concept string, tag string, priority int, confidence string")


def macro_series(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MACRO_SERIES, "series_id string, label string, dimension string, revisable boolean")


def features(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FEATURES, "name string, version int, spec string, inputs string")


def dq_checks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        DQ_CHECKS, "name string, dataset string, severity string, spec string, enabled boolean"
    )


def sources(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SOURCES, "source_id bigint, name string")


def pipelines(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        PIPELINES,
        "source_id bigint, dataset string, cadence string, enabled boolean, retired boolean, critical boolean",
    )


def datasets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DATASETS, "name string, storage string")


def values_sql(rows: list[tuple], columns: str) -> str:
    """The same rows as SQL text, for comparison queries."""

    def lit(x) -> str:
        if isinstance(x, bool):
            return str(x).upper()
        return str(x) if isinstance(x, (int, float)) else "'" + x.replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(lit(x) for x in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) t({columns})"


# Tickers decided by hand, by decision.
HAND_DECISIONS = {
    "excluded_reuse": ["HOT", "HONA", "PEAK", "WRK", "SOLS", "CAM", "GENZ", "LLL", "NVLS", "PCL", "TSS", "EDS"],
    "new_identity": ["H", "MIR", "DXC", "AAL", "NE"],
    "verified_continuous": ["AN", "CE", "COV", "FL", "FMC", "GAS", "GGP", "HP", "KSU", "MXIM", "OI", "RIG"],
    "excluded_manual_review": ["CBE", "MEE"],
    "excluded_unavailable": ["ESV", "HRS"],
}


def hand_decisions(spark: SparkSession) -> DataFrame:
    """ticker, decision."""
    return spark.createDataFrame([(t, d) for d, names in HAND_DECISIONS.items() for t in names], "ticker string, decision string")
