"""Date keys: Sunday-based weeks with ISO numbering, periods, rolling windows, id dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAINS = ("Weekly", "Monthly", "Quarterly", "Yearly")


def _date(value: str | dt.date) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def weekday(day: Column) -> Column:
    """Day of week with Sunday = 0 (Saturday = 6)."""
    return F.dayofweek(day) - 1


def planning_week(day: Column) -> Column:
    """Week number of a week that starts on Sunday: the ISO week of the following day."""
    return F.weekofyear(F.date_add(day, 1))


def planning_week_text(day: Column) -> Column:
    return F.lpad(planning_week(day).cast("string"), 2, "0")


def planning_year(day: Column) -> Column:
    """Year that belongs to :func:`planning_week` (the ISO year of the following day)."""
    return F.extract(F.lit("YEAROFWEEK"), F.date_add(day, 1)).cast("int")


def week_start(day: Column) -> Column:
    """The Sunday on or before ``day``."""
    return F.date_sub(F.trunc(F.date_add(day, 1), "week"), 1)


def week_label_year(sunday: Column) -> Column:
    """Calendar year of the Saturday that closes the week."""
    return F.year(F.date_add(sunday, 6))


def period_start(day: Column, grain: str) -> Column:
    if grain == "Weekly":
        return week_start(day)
    unit = {"Monthly": "month", "Quarterly": "quarter", "Yearly": "year"}[grain]
    return F.trunc(day, unit)


def whole_months_between(later: Column, earlier: Column) -> Column:
    return F.floor(F.months_between(later, earlier)).cast("int")


def days_in_month(day: Column) -> Column:
    return F.dayofmonth(F.last_day(day))


def id_date(identifier: Column) -> Column:
    """Date in the first eight characters of a run id (``20010601a``); NULL if there is none."""
    return F.try_to_date(F.substring(identifier, 1, 8), "yyyyMMdd")


# Year tests are written as ranges of the bare day, so that they reach the file scan; a predicate on
# year(day) does not.
def year_start(year: int) -> dt.date:
    return dt.date(year, 1, 1)


def year_end(year: int) -> dt.date:
    return dt.date(year, 12, 31)


def in_year(day: Column, year: int) -> Column:
    return within(day, year_start(year), year_end(year))


def on_or_after(day: Column, first: str | dt.date) -> Column:
    return day >= F.lit(_date(first))


def within(day: Column, first: str | dt.date, last: str | dt.date) -> Column:
    """Closed range."""
    return day.between(F.lit(_date(first)), F.lit(_date(last)))


def as_of_date(as_of: str | dt.date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(_date(as_of))


def months_from(as_of: str | dt.date | None, months: int) -> Column:
    """First day of the month ``months`` away from the month of ``as_of``."""
    return F.add_months(F.trunc(as_of_date(as_of), "month"), months)


def horizon_start(dataset_date: Column) -> Column:
    """First forecast day that counts: the planning week of the dataset date, moved on two days."""
    return F.date_sub(F.trunc(F.date_add(dataset_date, 2), "week"), 1)
