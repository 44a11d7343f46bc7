"""Raw vendor documents to rows.

Input is one document per row in a text column, as `read_documents` gives it. A
document is parsed and exploded inside its row; nothing is grouped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagelake import schemas
from vintagelake.operators.select import first_per_key

# What a company-facts entry must be to count.
TAXONOMY = "us-gaap"
FORMS = ("10-K", "10-Q", "10-K/A", "10-Q/A")

# Months and days in range: each that is not would cost an exception inside the cast.
_ISO_DAY = r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])$"
# Of the texts that the cast reads, those with another character are names (NaN), hexadecimal or carry a type's letter.
_NO_NUMBER = r"[^0-9eE+.\s-]"


# Fields of a vendor's daily row; the prices in the order in which they are read.
_PRICES = ("open", "high", "low", "close")
_VENDOR_FIELDS = {
    "date": "date", **{f: f for f in _PRICES}, "volume": "volume",
    "split_factor": "splitFactor", "div_cash": "divCash", "adj_close": "adjClose",
}


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: document name and text."""
    return spark.read.text(path, wholetext=True).select(
        F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("doc"), F.col("value").alias("text")
    )


def iso_day(text: Column) -> Column:
    """A strict yyyy-mm-dd date, else null."""
    return F.when(text.rlike(_ISO_DAY), text.try_cast("date"))


def number(text: Column) -> Column:
    """A decimal number, else null."""
    return F.when(~text.rlike(_NO_NUMBER), F.trim(text).try_cast("double"))


def company_facts(docs: DataFrame) -> DataFrame:
    """Accepted entries of company-facts documents; other columns of docs are kept.

    `ordinal` is the position in the document (tag, unit, entry).
    """
    keep = [c for c in docs.columns if c != "text"]
    tags = docs.select(*keep, F.from_json("text", schemas.COMPANY_FACTS_JSON).alias("d")).select(
        *keep, F.posexplode(F.col("d.facts")[TAXONOMY]).alias("tag_pos", "tag", "body")
    )
    units = tags.select(*keep, "tag_pos", "tag", F.posexplode("body.units").alias("unit_pos", "unit", "entries"))
    rows = units.select(
        *keep, "tag_pos", "unit_pos", "tag", "unit", F.posexplode("entries").alias("entry_pos", "e")
    )
    start = iso_day(F.col("e.start"))
    bad_start = F.col("e.start").isNotNull() & (F.col("e.start") != "") & start.isNull()
    return (
        rows.where(F.col("e.form").isin(*FORMS) & ~bad_start)
        .select(
            *keep, "tag", "unit",
            number(F.col("e.val")).alias("value"),
            start.alias("period_start"),
            iso_day(F.col("e.end")).alias("period_end"),
            F.col("e.form").alias("form"),
            F.col("e.fy").alias("fiscal_year"),
            F.col("e.fp").alias("fiscal_period"),
            F.col("e.accn").alias("accession"),
            iso_day(F.col("e.filed")).alias("filed_date"),
            (F.col("tag_pos") * 1000000000000 + F.col("unit_pos") * 1000000000 + F.col("entry_pos")).alias("ordinal"),
        )
        .dropna(subset=["value", "period_end", "accession", "filed_date"])
    )


def vintages(docs: DataFrame, single_vintage: Column | None = None) -> DataFrame:
    """Observation vintages. docs: series_id, text.

    Market series have one vintage, known on the observation date. Whether a
    document is one is its own flag, unless a column decides (series configuration).
    """
    flag = single_vintage if single_vintage is not None else F.coalesce("d.single_vintage", F.lit(False))
    rows = (
        docs.withColumn("d", F.from_json("text", schemas.VINTAGES_JSON))
        .withColumn("_single", flag)
        .select("series_id", "_single", F.explode("d.observations").alias("o"))
        .where((F.col("o.date") != "") & (F.col("_single") | (F.col("o.realtime_start") != "")))
    )
    day = iso_day(F.col("o.date"))
    return rows.select(
        "series_id",
        day.alias("obs_date"),
        F.when(F.col("_single"), day).otherwise(iso_day(F.col("o.realtime_start"))).alias("vintage_date"),
        F.when(~F.col("_single"), iso_day(F.col("o.realtime_end"))).alias("realtime_end"),
        number(F.col("o.value")).alias("value"),
    )


def series_metadata(docs: DataFrame) -> DataFrame:
    """First element of `seriess` or `series`; the title defaults to the id. docs: series_id, text."""
    d = F.from_json("text", schemas.SERIES_JSON)
    first = F.coalesce(F.get("d.seriess", F.lit(0)), F.get("d.series", F.lit(0)))
    return docs.withColumn("d", d).withColumn("m", first).select(
        "series_id",
        F.coalesce("m.title", "series_id").alias("title"),
        F.col("m.units").alias("units"),
        F.col("m.frequency").alias("frequency"),
    )


def paged_bars(docs: DataFrame) -> DataFrame:
    """Bars of paged documents (doc, text), with where each was found; rows without a time are dropped.

    Parsed by a generator: the filters that Spark derives for an explode would each parse a plain column again.
    """
    parsed = docs.select("doc", F.inline(F.array(F.from_json("text", schemas.PAGED_BARS_JSON))))
    pages = parsed.select("doc", "fetched_at", F.posexplode("pages").alias("page", "p"))
    symbols = pages.select("doc", "fetched_at", "page", F.explode("p.bars").alias("symbol", "list"))
    rows = symbols.select("doc", "fetched_at", "page", "symbol", F.posexplode("list").alias("entry", "b"))
    return rows.where(F.col("b.t").isNotNull()).select(
        "doc", "fetched_at", "page", "entry", "symbol",
        F.to_date(F.substring("b.t", 1, 10)).alias("session_date"),
        F.col("b.o").alias("open"), F.col("b.h").alias("high"), F.col("b.l").alias("low"),
        F.col("b.c").alias("close"), F.col("b.v").cast("bigint").alias("volume"),
        F.col("b.n").alias("trade_count"), F.col("b.vw").alias("vwap"),
    )


def vendor_rows(docs: DataFrame) -> DataFrame:
    """Daily rows of vendor documents (security_id, symbol, text), with the reason a row is unusable.

    The first failing step names the cause: date, then open, high, low, close,
    then volume. KeyError: no such field; TypeError: null; ValueError: not readable.
    Fields are looked up, then read, then judged, each in a projection of its own: in one expression every
    look-up and pattern would be repeated, and the generated method would be too long to be compiled.
    """
    rows = docs.select(
        "security_id", "symbol",
        F.posexplode(F.from_json("text", "array<map<string,string>>")).alias("entry", "r"),
    )
    fields = {name: F.try_element_at("r", F.lit(key)).alias(f"_{name}") for name, key in _VENDOR_FIELDS.items()}
    named = rows.select("security_id", "symbol", "entry", "r", *fields.values())
    cut = F.substring("_date", 1, 10)
    volume = F.coalesce(F.when(F.col("_volume") != "", F.col("_volume")), F.lit("0"))
    read = named.select(
        "security_id", "symbol", "entry", "r", *[f"_{f}" for f in ("date", *_PRICES)],
        cut.alias("raw_date"), iso_day(cut).alias("session_date"),
        *[number(F.col(f"_{f}")).alias(f) for f in _PRICES],
        F.floor(number(volume)).cast("bigint").alias("volume"),
        number(F.col("_split_factor")).alias("split_factor"),
        F.coalesce(number(F.col("_div_cash")), F.lit(0.0)).alias("div_cash"),
        number(F.col("_adj_close")).alias("adj_close"),
    )
    cause = F.when(F.col("session_date").isNull(), "ValueError")
    for field in _PRICES:
        failed = (
            F.when(F.col(f"_{field}").isNotNull(), "ValueError")
            .when(F.map_contains_key("r", F.lit(field)), "TypeError")
            .otherwise("KeyError")
        )
        cause = cause.when(F.col(field).isNull(), failed)
    cause = cause.when(F.col("volume").isNull(), "ValueError")
    reason = F.when(F.col("_date").isNull() | (F.col("_date") == ""), "missing_date").otherwise(
        F.when(cause.isNotNull(), F.concat(F.lit("malformed_row:"), cause))
    )
    return read.select(
        "security_id", "symbol", "entry", "raw_date", "session_date", *_PRICES, "volume",
        F.lit(None).cast("bigint").alias("trade_count"), F.lit(None).cast("double").alias("vwap"),
        "split_factor", "div_cash", "adj_close", reason.alias("reason"),
    )


BAR_FIELDS = ["security_id", "symbol", "session_date", "open", "high", "low", "close", "volume", "trade_count", "vwap"]


def vendor_bars(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable bars and the anomalies."""
    rows = vendor_rows(docs)
    # As `reason IS NULL`, said of the few fields that decide it: a filter is computed apart from the row's other columns.
    needed = ["session_date", *_PRICES, "volume"]
    bars = rows.dropna(subset=needed).select(*BAR_FIELDS)
    lacking = F.col(needed[0]).isNull()
    for field in needed[1:]:
        lacking = lacking | F.col(field).isNull()
    bad = rows.where(lacking).select("security_id", "symbol", "raw_date", "reason")
    return bars, bad


def figi_identities(responses: DataFrame) -> DataFrame:
    """Pair request i with answer i. responses: tickers (array), text.

    The candidate that is its own composite is taken, else the first one.
    """
    pairs = responses.select(
        F.explode(F.arrays_zip("tickers", F.from_json("text", schemas.FIGI_JSON).alias("answers"))).alias("p")
    )
    data = F.col("p.answers.data")
    own = F.get(F.filter(data, lambda c: c["figi"] == c["compositeFIGI"]), F.lit(0))
    best = F.coalesce(own, F.get(data, F.lit(0)))
    return pairs.select(F.col("p.tickers").alias("ticker"), best.alias("b")).where(F.col("b").isNotNull()).select(
        "ticker", F.col("b.figi").alias("figi"), F.col("b.compositeFIGI").alias("composite_figi"),
        F.col("b.shareClassFIGI").alias("share_class_figi"), F.col("b.name").alias("name"),
    )


def cik_map(docs: DataFrame) -> DataFrame:
    """Ticker to ten-digit CIK from an indexed map document; the first index wins."""
    entries = docs.select(
        F.explode(F.from_json("text", "map<string,struct<cik_str:bigint,ticker:string>>")).alias("k", "e")
    )
    rows = entries.select(
        F.upper(F.trim("e.ticker")).alias("ticker"),
        F.lpad(F.col("e.cik_str").cast("string"), 10, "0").alias("cik"),
        F.col("k").cast("bigint").alias("position"),
    ).where(F.col("ticker").isNotNull() & (F.col("ticker") != ""))
    return first_per_key(rows, ["ticker"], [F.col("position")]).select("ticker", "cik")
