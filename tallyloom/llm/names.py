"""Names of helper columns that no given column bears."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(df: DataFrame, *wanted: str) -> list[str]:
    """``wanted`` with underscores before each until no column of ``df`` is called so, in whatever case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
