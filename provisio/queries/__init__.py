"""Registry of named queries: each key pairs a Spark query over the test
tables with an independent SQL text for a second engine (the oracle).

"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .layers import compose


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(key: str, sql: str | None = None, layers: tuple[str, ...] = ()):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``key``
    with its oracle SQL (``layers`` are prepended as CTEs)."""
    def deco(fn):
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Query(key, fn, compose(sql, *layers) if sql is not None else None)
        return fn
    return deco


def _load_all() -> None:
    from . import (q_loans_a, q_loans_b, q_scalars, q_sme, q_market, q_models,  # noqa: F401
                   q_tables, q_extensions)
    from . import q_streaming  # noqa: F401  (reuses batch oracle texts)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return {k: q.build for k, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: q.sql for k, q in REGISTRY.items() if q.sql is not None}
