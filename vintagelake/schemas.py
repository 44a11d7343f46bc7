"""Declared schemas; nothing is inferred from files."""

from __future__ import annotations

from pyspark.sql import types as T

BARS = T.StructType(
    [
        T.StructField("security_id", T.LongType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("session_date", T.DateType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("trade_count", T.LongType()),
        T.StructField("vwap", T.DoubleType()),
        T.StructField("knowledge_time", T.TimestampType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("source", T.StringType()),
    ]
)

GOLD = T.StructType(
    [
        T.StructField("security_id", T.LongType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("session_date", T.DateType()),
        T.StructField("knowledge_time", T.TimestampType()),
        T.StructField("adj_close", T.DoubleType()),
        T.StructField("adj_volume", T.LongType()),
        T.StructField("return_1d", T.DoubleType()),
        T.StructField("log_return_1d", T.DoubleType()),
        T.StructField("sma20", T.DoubleType()),
        T.StructField("sma50", T.DoubleType()),
        T.StructField("ema20", T.DoubleType()),
        T.StructField("realized_vol20", T.DoubleType()),
        T.StructField("roc20", T.DoubleType()),
        T.StructField("momentum_12_1", T.DoubleType()),
    ]
)

ACTIONS = T.StructType(
    [
        T.StructField("action_id", T.LongType()),
        T.StructField("security_id", T.LongType()),
        T.StructField("action_type", T.StringType()),
        T.StructField("ex_date", T.DateType()),
        T.StructField("split_from", T.DoubleType()),
        T.StructField("split_to", T.DoubleType()),
        T.StructField("cash_amount", T.DoubleType()),
        T.StructField("knowledge_time", T.TimestampType()),
        T.StructField("source", T.StringType()),
    ]
)

SESSIONS = T.StructType(
    [
        T.StructField("session_date", T.DateType()),
        T.StructField("open_utc", T.TimestampType()),
        T.StructField("close_utc", T.TimestampType()),
        T.StructField("is_half_day", T.BooleanType()),
    ]
)

IDENTIFIERS = T.StructType(
    [
        T.StructField("security_id", T.LongType()),
        T.StructField("id_type", T.StringType()),
        T.StructField("id_value", T.StringType()),
        T.StructField("valid_from", T.DateType()),
        T.StructField("valid_to", T.DateType()),
    ]
)

MEMBERSHIP = T.StructType(
    [
        T.StructField("universe", T.StringType()),
        T.StructField("security_id", T.LongType()),
        T.StructField("valid_from", T.DateType()),
        T.StructField("valid_to", T.DateType()),
        T.StructField("knowledge_time", T.TimestampType()),
    ]
)

MACRO = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("obs_date", T.DateType()),
        T.StructField("vintage_date", T.DateType()),
        T.StructField("realtime_end", T.DateType()),
        T.StructField("value", T.DoubleType()),
    ]
)

FACTS = T.StructType(
    [
        T.StructField("security_id", T.LongType()),
        T.StructField("accession", T.StringType()),
        T.StructField("concept", T.StringType()),
        T.StructField("period_start", T.DateType()),
        T.StructField("period_end", T.DateType()),
        T.StructField("fiscal_period", T.StringType()),
        T.StructField("value", T.DecimalType(38, 9)),
        T.StructField("unit", T.StringType()),
        T.StructField("filed_at", T.TimestampType()),
    ]
)

# Documents as vendors deliver them.
_ENTRY = "array<struct<start:string,end:string,val:string,accn:string,fy:int,fp:string,form:string,filed:string>>"
# Only the taxonomy that is read: the parser skips the others unconverted.
COMPANY_FACTS_JSON = f"facts struct<`us-gaap`:map<string,struct<units:map<string,{_ENTRY}>>>>"
VINTAGES_JSON = (
    "single_vintage boolean, "
    "observations array<struct<date:string,realtime_start:string,realtime_end:string,value:string>>"
)
SERIES_JSON = "seriess array<struct<id:string,title:string,units:string,frequency:string>>, " \
              "series array<struct<id:string,title:string,units:string,frequency:string>>"
PAGED_BARS_JSON = (
    "fetched_at string, pages array<struct<bars:map<string,array<"
    "struct<t:string,o:double,h:double,l:double,c:double,v:double,n:bigint,vw:double>>>>>"
)
FIGI_JSON = (
    "array<struct<data:array<struct<figi:string,compositeFIGI:string,"
    "shareClassFIGI:string,name:string>>>>"
)
