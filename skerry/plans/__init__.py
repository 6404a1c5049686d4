"""Registry of whole queries: ``@query(name, sql)`` pairs a plan with its oracle."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .registry import ORACLES, QUERIES

_MODULES: tuple[str, ...] = ("catalog", "store", "audit", "incremental", "files", "ordered", "datasets", "store_life")


def _load() -> None:
    for name in _MODULES:
        importlib.import_module(f"{__name__}.{name}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLES)
