"""Small DataFrames for the tests."""

import datetime as dt

from vintagelake import schemas

D = dt.date


def utc(*a):
    return dt.datetime(*a, tzinfo=dt.timezone.utc)


def bar(sec, day, close, known, batch=1, volume=1000, symbol="AAA", source="TIINGO", **kw):
    p = {"open": close, "high": close, "low": close, "vwap": None} | kw
    return (sec, symbol, day, p["open"], p["high"], p["low"], close, volume, None, p["vwap"], known, batch, source)


def bars(spark, rows):
    return spark.createDataFrame(rows, schemas.BARS)


def actions(spark, rows):
    """rows: (security, type, ex_date, from, to, cash[, known, source])"""
    full = []
    for i, r in enumerate(rows):
        known = r[6] if len(r) > 6 else dt.datetime(r[2].year, r[2].month, r[2].day, tzinfo=dt.timezone.utc)
        full.append((i, *r[:6], known, r[7] if len(r) > 7 else "TIINGO"))
    return spark.createDataFrame(full, schemas.ACTIONS)


def sessions(spark, days, close_hour=21):
    rows = [(d, utc(d.year, d.month, d.day, 14, 30), utc(d.year, d.month, d.day, close_hour), False) for d in days]
    return spark.createDataFrame(rows, schemas.SESSIONS)


def identifiers(spark, rows):
    return spark.createDataFrame([(s, "TICKER", t, a, b) for s, t, a, b in rows], schemas.IDENTIFIERS)


def pairs(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
