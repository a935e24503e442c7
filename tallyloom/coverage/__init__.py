"""Every operator and report as a registered query with an SQL oracle."""

from tallyloom.coverage import aggregates, filters, joins, reports, scalars, tables_and_columns  # noqa: F401
from tallyloom.coverage.registry import CASES  # noqa: F401
