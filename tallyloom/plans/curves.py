"""Shipment curves of recent portfolios and curves of the latest adjusted order forecasts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import calendar
from tallyloom.operators.joins import rates_of
from tallyloom.operators.selection import latest_id_per, only_value, portfolio_list, recent_portfolios, with_ids
from tallyloom.operators.staging import stage
from tallyloom.plans.common import kept_products, numbers, priced
from tallyloom.sources.tables import Tables


@dataclass(frozen=True)
class Params:
    target_country: str = "US"
    since: str = "2019-06-01"
    first_day: str = "2012-01-01"
    last_day: str = "2021-01-02"
    tests: int = 5
    published: int = 5
    drafts: int = 1
    max_group: int = 991


def portfolios(t: Tables, p: Params) -> DataFrame:
    listed = t.versions("shipment_forecasts")
    return recent_portfolios(
        t["portfolio_pins"],
        portfolio_list(listed, p.tests, "TEST", p.since, tiebreak=False),
        portfolio_list(listed, p.published, "PRODUCTION", p.since, tiebreak=False),
        portfolio_list(listed, p.drafts, "DRAFT", p.since, tiebreak=False))


def report(t: Tables, p: Params = Params()) -> DataFrame:
    rates = rates_of(t["fx_rates"], only_value(t["fx_scenario"], "scenario"), p.target_country)
    kept = kept_products(p.max_group)
    days = (p.first_day, p.last_day)
    grain = ("country_code", "channel", "gl_rollup", "target_day")
    ids = stage(portfolios(t, p), "portfolios")
    shipped = with_ids(t.days("shipment_forecasts", days).filter(kept), ids, "portfolio_id").groupBy("initiative", "portfolio_id", *grain).agg(
        F.sum("shipped_units").alias("shu"), F.sum("product_revenue_amt").alias("prv"), F.sum("gross_gms_amt").alias("gms"))
    shipments = priced(shipped, rates, "prv", "gms").select(
        "initiative", F.lit("shipments").alias("type"), "portfolio_id", *grain, "shu", "prv", "gms")

    adjusted = F.col("forecast_type") == "Adjusted"
    newest = stage(latest_id_per(t.versions("orders_forecast_daily").filter(adjusted), "dataset_date", "forecast_id")
                   .select("forecast_id").distinct(), "forecast-ids")
    ordered = (with_ids(t.days("orders_forecast_daily", days).filter(adjusted & kept & calendar.on_or_after(F.col("dataset_date"), p.since)),
                        newest, "forecast_id", how="left_semi").groupBy("dataset_date", *grain)
               .agg(F.sum("net_ordered_units").alias("shu"), F.sum("net_ops").alias("prv"), F.sum("net_ordered_gms").alias("gms")))
    orders = priced(ordered, rates, "prv", "gms").select(
        F.lit("orders_final_forecast").alias("initiative"), F.lit("orders (OSA)").alias("type"),
        F.date_format("dataset_date", "yyyy-MM-dd").alias("portfolio_id"), *grain, "shu", "prv", "gms")
    return numbers(shipments.union(orders), "shu", "prv", "gms")
