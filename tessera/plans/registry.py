"""Queries by name, each with SQL that says the same for an independent engine."""

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def with_bindings(text: str) -> str:
    """The SQL with the common table expressions that it names, in order of need."""
    from tessera.plans.bindings import CTES

    order: list[str] = []
    seen: set[str] = set()

    def need(part: str) -> None:
        for cte in CTES:
            if cte not in seen and re.search(rf"\b{cte}\b", part):
                seen.add(cte)
                need(CTES[cte])
                order.append(cte)

    need(text)
    head = ", ".join(f"{c} AS ({CTES[c]})" for c in order)
    if not head:
        return text
    return f"WITH {head}, {text[5:]}" if text.upper().startswith("WITH ") else f"WITH {head} {text}"


def query(name: str, sql: str | None = None):
    """Registers a query; ``sql`` starts from the bindings' common table expressions."""

    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = with_bindings(sql.strip())
        return f

    return register
