"""Forecast, actual and prior-year actual of each product group and day."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import calendar, labels
from tallyloom.operators.joins import beside_prior_year, rates_of
from tallyloom.plans.common import canonical_names, kept_products, numbers, order_revenue, priced
from tallyloom.sources.tables import Tables

KEYS = ("country_code", "channel", "gl_rollup", "gl_product_group")
LONGEST_YEAR = 53 * 7  # days between a day and its partner in the year before, at most


@dataclass(frozen=True)
class Params:
    scenario: str = "2019 OP2"
    target_country: str = "US"
    forecast_id: int = 6106
    since: str = "2019-11-01"
    countries: tuple[str, ...] = labels.EIGHT_COUNTRIES
    max_group: int = 991


def report(t: Tables, p: Params = Params()) -> DataFrame:
    rates = rates_of(t["fx_rates"], p.scenario, p.target_country)
    kept = kept_products(p.max_group) & F.col("country_code").isin(*p.countries)
    planned = t.days("orders_forecast_adjusted", (p.since, None)).filter((F.col("forecast_id") == p.forecast_id) & kept)
    forecast = priced(planned.groupBy("dataset_date", *KEYS, "target_day").agg(
        F.sum("net_ordered_units").alias("fcst_units"), F.sum(order_revenue()).alias("fcst_gms")), rates, "fcst_gms")

    # A prior day matters only if its partner can be current, so the scan stops a year before `since`.
    oldest = dt.date.fromisoformat(p.since) - dt.timedelta(days=LONGEST_YEAR)
    day = F.col("order_day")
    sold = t.days("orders_actuals", (oldest, None)).filter(kept)
    actual = beside_prior_year(
        sold, "order_day", KEYS, {"units": F.col("net_ordered_units"), "gms": order_revenue()},
        current=calendar.on_or_after(day, p.since), prior=calendar.on_or_after(day, oldest))
    actual = priced(actual, rates, "gms_cy", "gms_py")
    joined = (forecast.join(actual, [*KEYS, "target_day"])
              .join(canonical_names(t["gl_names"]), "gl_product_group"))
    shown = joined.select(
        F.lit("Orders").alias("data_type"), "dataset_date", *KEYS, "week", "target_day", "fcst_units", "fcst_gms",
        F.col("units_cy").alias("act_units"), F.col("gms_cy").alias("act_gms"),
        F.col("units_py").alias("act_py_units"), F.col("gms_py").alias("act_py_gms"), "gl_name")
    return numbers(shown, "fcst_units", "fcst_gms", "act_units", "act_gms", "act_py_units", "act_py_gms")
