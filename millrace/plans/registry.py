"""Every registered query of the analytics part, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.adapters import oracle

MODULES = ("marts", "features", "cleaning", "merging", "quality", "monitoring", "items", "anomaly", "loading", "stages", "extras", "search", "refresh", "lines", "history")
_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_oracles: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register f(spark, sf_dir) under name; sql may name adapter views in braces."""

    def keep(f):
        _queries[name] = f
        if sql is not None:
            _oracles[name] = oracle(sql)
        return f

    return keep


def _loaded() -> None:
    for m in MODULES:
        import_module(f"millrace.plans.{m}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _loaded()
    return _queries


def oracle_sql() -> dict[str, str]:
    _loaded()
    return _oracles


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["x04_employee_labels"](spark, sf_dir)
