"""Query registry: ``@query(name, sql=...)`` records a plan and its oracle SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}

_PLAN_MODULES = ("flight_reports", "hive_reports", "ingest", "quality", "vault", "marts",
                 "history", "learning")


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql.strip()
        return fn
    return deco


def _load() -> None:
    for mod in _PLAN_MODULES:
        importlib.import_module(f"sparkdesk.plans.{mod}")


def all_queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def all_oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLE)
