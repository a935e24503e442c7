"""Registered queries: a DataFrame builder and, next to it, the same result as DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tallyloom.coverage.views import with_views
from tallyloom.sources.tables import Tables


@dataclass(frozen=True)
class Case:
    build: Callable[[Tables], DataFrame]
    sql: str


CASES: dict[str, Case] = {}


def case(name: str, sql: str) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register ``build(tables)`` under ``name`` with its oracle (views are prefixed on use)."""
    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in CASES:
            raise ValueError(f"{name} is registered twice")
        CASES[name] = Case(build, with_views(sql))
        return build
    return register


def listed(values: tuple) -> str:
    """A fixed list as an SQL list."""
    return "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + ")"


def dbl(expression: str) -> str:
    """Correctly rounded DECIMAL -> DOUBLE in DuckDB (its direct cast divides and may miss the last bit)."""
    return f"CAST(CAST({expression} AS VARCHAR) AS DOUBLE)"
