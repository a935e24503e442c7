"""Shipment and order revenue of recent portfolios and actuals at four date grains; a refresh job."""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import calendar, labels, measures
from tallyloom.operators.grains import roll_cells
from tallyloom.operators.joins import rates_of
from tallyloom.operators.selection import largest, latest_id_per, only_value, with_ids
from tallyloom.operators.staging import run_scope, stage
from tallyloom.plans.common import kept_products, numbers
from tallyloom.plans.member_comparison import INTERNAL, SATURDAY, portfolios
from tallyloom.sources import sinks
from tallyloom.sources.tables import Tables

KEYS = ("type", "portfolio_id", "country_code", "channel", "subchannel", "gl_rollup", "gl_product_group",
        "prime_group", "initiative", "initiative_type")
ORDERS = "orders (OSA final adjusted)"
ORDER_INITIATIVE = "orders_final_forecast"
TEXT = 100


@dataclass(frozen=True)
class Params:
    mode: str = INTERNAL
    target_country: str = "US"
    listed_since: str = "2019-06-01"
    since: str = "2017-01-01"
    excluded_forecast: int = 5299
    max_group: int = 991


SHIP_KEYS = ("portfolio_id", "country_code", "channel", "subchannel", "gl_rollup", "gl_product_group", "gl_name", "prime_group",
             "initiative", "initiative_type")
ORDER_KEYS = ("portfolio_id", "country_code", "channel", "gl_rollup", "gl_product_group", "prime_group")


def _cells(rows: DataFrame, keys: tuple[str, ...], tags: dict[str, Column], revenue: Column, units: str) -> DataFrame:
    """Sums in local currency per raw key and cell, the part of a week inside one month, named by its first day.

    Sums are linear: rates, names and cut texts are attached to the cells instead of to every fact row.
    """
    day = F.col("target_day")
    first = F.greatest(calendar.week_start(day), F.trunc(day, "month"))
    return (rows.withColumns(tags).withColumn("target_day", first).groupBy(*keys, "target_day")
            .agg(F.sum(revenue).alias("gms"), F.sum(units).alias("shu")))


def _branch(cells: DataFrame, tags: dict[str, Column]) -> DataFrame:
    """Common columns; the texts are cut here, because rows whose cut texts are equal belong together. The country names a rate, so it stays whole."""
    texts = [(F.col(k) if k == "country_code" else F.left(F.col(k), F.lit(TEXT))).alias(k) for k in KEYS]
    label = labels.product_label(F.col("gl_product_group"), F.col("gl_name"))
    return cells.withColumn("gl_product_group", label).withColumns(tags).select(*texts, "target_day", "gms", "shu")


def cells(t: Tables, p: Params) -> DataFrame:
    """The four sources with common columns, aggregated to cells, in local currency."""
    kept = kept_products(p.max_group)
    day = F.col("target_day")
    ids = stage(portfolios(t, p.mode, p.listed_since), "portfolios")
    visible = t["visible_products"].filter(F.col("visible_gl_product_group").isNotNull()).select("gl_product_group", "gl_name")
    actual = {"portfolio_id": F.lit("Actuals")}
    # actuals end at the last Saturday of the shipments, for orders too
    last = largest(t.versions("shipment_actuals").filter((day >= F.lit(p.since).cast("date")) & (calendar.weekday(day) == SATURDAY)), "target_day")
    current, finished = (p.since, None), (p.since, last)

    ship_revenue = measures.market_revenue(F.col("country_code"), F.col("channel"),
                                           F.col("product_revenue_amt"), F.col("gross_gms_amt"))
    order_revenue = measures.market_revenue(F.col("country_code"), F.col("channel"),
                                            F.col("net_ops"), F.col("net_ordered_gms"))
    baseline = {"initiative": F.lit("Baseline"), "initiative_type": F.lit("Baseline")}

    planned = with_ids(t.days("shipment_forecasts", current).filter(kept & (F.col("forecast_id") != p.excluded_forecast)), ids, "portfolio_id")
    shipped = t.days("shipment_actuals", finished).filter(kept)

    adjusted = F.col("forecast_type") == "Adjusted"
    newest = latest_id_per(t.versions("orders_forecast_daily").filter(adjusted), "dataset_date", "forecast_id").select("forecast_id").distinct()
    # one row per forecast id and listed portfolio it belongs to
    chosen = stage(newest.join(t["forecast_portfolios"], "forecast_id").join(ids, "portfolio_id"), "forecast-ids")
    ordered = with_ids(t.days("orders_forecast_daily", current).filter(adjusted & kept & calendar.on_or_after(F.col("dataset_date"), p.listed_since)),
                       chosen, "forecast_id")
    sold = t.days("orders_actuals", finished).filter(kept).withColumnRenamed("order_day", "target_day")

    shipments = [_cells(planned, SHIP_KEYS, {}, ship_revenue, "shipped_units"),
                 _cells(shipped, SHIP_KEYS, actual | baseline, ship_revenue, "shipped_units")]
    orders = [_cells(ordered, ORDER_KEYS, {}, order_revenue, "net_ordered_units"),
              _cells(sold, ORDER_KEYS, actual, order_revenue, "net_ordered_units")]
    order_tags = {"type": F.lit(ORDERS), "subchannel": F.col("channel"), "initiative": F.lit(ORDER_INITIATIVE),
                  "initiative_type": F.lit(ORDER_INITIATIVE)}
    branches = [_branch(c, {"type": F.lit("Shipments")}) for c in shipments]
    branches += [_branch(c.join(visible, "gl_product_group"), order_tags) for c in orders]
    return functools.reduce(DataFrame.union, branches)


def report(t: Tables, p: Params = Params()) -> DataFrame:
    """The daily step of the job is skipped: sums over days of daily sums are sums over cells of days.

    The four sources differ in type, initiative or portfolio, so they need no deduplication. The rates, one a country, meet the
    sums of periods: a sum of local amounts has few digits and adds up faster than one of converted ones.
    """
    rolled = roll_cells(cells(t, p), "target_day", KEYS, ["gms", "shu"])
    rates = rates_of(t["fx_rates"], only_value(t["fx_scenario"], "scenario"), p.target_country)
    money = measures.converted_total(F.col("gms")).alias("gms")
    named = [F.left("country_code", F.lit(TEXT)).alias(k) if k == "country_code" else F.col(k) for k in KEYS]
    priced = rolled.join(rates, "country_code").select("date_granularity", *named, F.col("scenario").alias("fx_scenario"), "target_day", money, "shu")
    return numbers(priced, "gms", "shu")


def refresh(t: Tables, p: Params, root: str) -> DataFrame:
    """Replace the stored result of the run mode."""
    target = sinks.target_name("shipments", p.mode)
    with run_scope(t.spark):
        return sinks.publish_version(report(t, p), f"{root}/{target}", target)
