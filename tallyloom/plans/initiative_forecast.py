"""Revenue and units of each forecast portfolio by initiative, product and month."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import calendar, measures
from tallyloom.operators.joins import rates_of
from tallyloom.plans.common import kept_products, numbers, priced
from tallyloom.sources.tables import Tables


@dataclass(frozen=True)
class Params:
    scenario: str = "2019 OP2"
    target_country: str = "US"
    since: str = "2018-12-31"
    first_year: int = 2018
    excluded_forecast: int = 5299
    initiative_type: str = "Baseline"
    max_group: int = 991


def report(t: Tables, p: Params = Params()) -> DataFrame:
    day = F.col("target_day")
    rows = t.days("shipment_forecasts", (calendar.year_start(p.first_year), None)).filter(
        calendar.on_or_after(F.col("dataset_date"), p.since) & kept_products(p.max_group) & (F.col("forecast_id") != p.excluded_forecast)
        & (F.col("initiative_type") == p.initiative_type))
    revenue = measures.market_revenue(F.col("country_code"), F.col("channel"),
                                      F.col("product_revenue_amt"), F.col("gross_gms_amt"))
    sums = rows.groupBy(
        "portfolio_id", "country_code", "channel", "subchannel", "gl_rollup", "gl_product_group",
        "initiative_type", "initiative", F.month(day).alias("target_month"),
        F.quarter(day).alias("target_quarter"), F.year(day).alias("target_year")).agg(
        F.sum(revenue).alias("gms"), F.sum("shipped_units").alias("shu"))
    result = priced(sums, rates_of(t["fx_rates"], p.scenario, p.target_country), "gms")
    return numbers(result, "gms", "shu")
