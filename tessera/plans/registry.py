"""Name -> (Spark query, oracle SQL) registry."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}

PLAN_MODULES = (
    "tessera.plans.relational",
    "tessera.plans.keywords",
    "tessera.plans.completion",
    "tessera.plans.stats",
    "tessera.plans.keys",
    "tessera.plans.sources",
    "tessera.plans.catalog",
    "tessera.plans.writes",
    "tessera.plans.streams",
)


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``oracle`` is DuckDB SQL over views named like the tables; leave it out
    only for results SQL cannot state (non-deterministic or stream-only).
    """
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn
    return deco


def _load() -> None:
    for m in PLAN_MODULES:
        importlib.import_module(m)


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
