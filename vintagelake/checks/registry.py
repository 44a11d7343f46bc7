"""Collects the checked queries of all families."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vintagelake.checks.views import Views, oracle, present

Query = Callable[[Views], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    """Register a query and the SQL it must match."""

    def wrap(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = oracle(sql)
        return fn

    return wrap


def _load() -> None:
    from vintagelake.checks import families  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def bind(fn: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: present(fn(Views(spark, sf_dir)))

    return {name: bind(fn) for name, fn in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
