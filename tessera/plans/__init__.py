"""Queries over the tables of a folder, and SQL that says the same."""

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

#: Modules that register queries.
PARTS = ("cohort", "search", "store", "measures", "asking", "derived", "loads", "findings", "depth")


def _load():
    for part in PARTS:
        import_module(f"tessera.plans.{part}")
    return import_module("tessera.plans.registry")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_load().QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_load().ORACLE)
