"""Registered queries: every operator bound to the driver tables, with the same result in SQL where SQL can say it."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from refloom.session import Tables


@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}
MODULES = ("sources", "columns", "relations", "groups", "nesting", "webpages", "increments", "datasets")


def query(name: str, sql: str | None = None):
    """Register a query under a name, with its SQL text if it has one."""

    def add(run: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(run, sql)
        return run

    return add


def load() -> dict[str, Query]:
    for module in MODULES:
        importlib.import_module(f"refloom.catalog.{module}")
    return REGISTRY
