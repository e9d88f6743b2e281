"""Checked queries: each operator over the star-schema tables, with equivalent SQL beside it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def _modules():
    from . import aggregates, cleaning, contracts, currency, geography, kpis, reports, state
    return (geography, currency, cleaning, aggregates, kpis, reports, contracts, state)


def queries() -> dict[str, Query]:
    return {name: q for m in _modules() for name, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    from .sql import with_base
    return {name: with_base(sql) for m in _modules() for name, sql in m.SQL.items()}
