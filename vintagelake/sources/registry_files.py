"""CSV registries: coverage manifests, index holdings, membership intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagelake.operators.select import first_per_key
from vintagelake.sources.bronze import iso_day

DEFAULT_TYPE = "EQUITY"
# Holdings lines that are cash, not securities.
CASH_LINES = ("", "-", "--", "CASH", "USD", "CASH_USD", "USD CASH", "US DOLLAR")

_QUOTED_COMMA = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, asked of the file system that owns it."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All-text rows of a CSV with a header. A missing file has no rows, a missing column is null."""
    if not exists(spark, path):
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))
    df = spark.read.csv(path, header=True)
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def _text(column: str) -> Column:
    t = F.trim(F.col(column))
    return F.when(t != "", t)


MANIFEST_COLUMNS = ["ticker", "security_type", "name", "valid_from", "valid_to"]


def manifest(rows: DataFrame, default_type: str | Column = DEFAULT_TYPE) -> DataFrame:
    """Coverage entries: upper-case ticker, type from the row or the source, blank dates null."""
    fallback = default_type if isinstance(default_type, Column) else F.lit(default_type)
    extra = [c for c in rows.columns if c not in MANIFEST_COLUMNS]
    return rows.select(
        *extra,
        F.upper(_text("ticker")).alias("ticker"),
        F.upper(F.coalesce(_text("security_type"), fallback, F.lit(DEFAULT_TYPE))).alias("security_type"),
        _text("name").alias("name"),
        iso_day(_text("valid_from")).alias("valid_from"),
        iso_day(_text("valid_to")).alias("valid_to"),
    ).where(F.col("ticker").isNotNull())


def membership_intervals(rows: DataFrame) -> DataFrame:
    """ticker, start_date, end_date text rows; rows without ticker or start are dropped."""
    return rows.select(
        F.upper(_text("ticker")).alias("ticker"),
        iso_day(_text("start_date")).alias("valid_from"),
        iso_day(_text("end_date")).alias("valid_to"),
    ).where(F.col("ticker").isNotNull() & F.col("valid_from").isNotNull())


def _cells(line: Column) -> Column:
    return F.transform(F.split(line, _QUOTED_COMMA), lambda c: F.trim(F.regexp_replace(F.trim(c), '^"|"$', "")))


def holdings(docs: DataFrame, ticker_column: str, security_type: str) -> DataFrame:
    """Tickers of holdings files (doc, text), in file order.

    The header is the first line that has the ticker column; whatever precedes it
    is preamble. Cash lines, placeholders (digits and one letter) and texts that
    cannot be a ticker are dropped; the first mention of a ticker counts.
    """
    target = ticker_column.strip().lower()
    lines = docs.select("doc", F.split(F.regexp_replace("text", "^﻿", ""), "\r?\n").alias("lines"))
    header = F.array_position(
        F.transform("lines", lambda line: F.array_contains(F.transform(_cells(line), F.lower), target)), True
    )
    found = lines.withColumn("h", header).where(F.col("h") > 0)
    column = F.array_position(F.transform(_cells(F.element_at("lines", F.col("h").cast("int"))), F.lower), target)
    body = found.withColumn("c", column).select("doc", "h", "c", F.posexplode("lines").alias("line_no", "line"))
    ticker = F.upper(F.trim(F.get(_cells(F.col("line")), (F.col("c") - 1).cast("int"))))
    rows = (
        body.where(F.col("line_no") >= F.col("h"))
        .select("doc", "line_no", ticker.alias("ticker"))
        .where(F.col("ticker").isNotNull() & ~F.col("ticker").isin(*CASH_LINES))
        .where(~F.col("ticker").rlike(r"^\d+[A-Z]$") & F.col("ticker").rlike(r"^[\p{L}\p{N}.\-/]+$"))
    )
    return first_per_key(rows, ["doc", "ticker"], [F.col("line_no")]).withColumn(
        "security_type", F.lit(security_type)
    )


def write_manifest(rows: DataFrame, path: str) -> None:
    """Store coverage entries as CSV text; missing columns are left blank."""
    have = set(rows.columns)
    text = [F.col(c).cast("string").alias(c) if c in have else F.lit(None).cast("string").alias(c) for c in MANIFEST_COLUMNS]
    rows.select(*text).write.mode("overwrite").csv(path, header=True)
