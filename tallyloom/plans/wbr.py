"""Weekly business review: forecasts beside actuals of shipments and orders, with data freshness."""

from __future__ import annotations

import functools
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import calendar, labels, measures
from tallyloom.operators.grains import final_and_system
from tallyloom.operators.joins import full_pair, rates_of, with_rate
from tallyloom.operators.selection import latest_id_per, newest, ranked, with_ids
from tallyloom.operators.staging import run_scope, stage
from tallyloom.plans.common import canonical_names, kept_products, numbers
from tallyloom.sources import sinks
from tallyloom.sources.tables import Tables

KEYS = ("country_code", "channel", "gl_rollup", "gl_product_group", "gl_name", "prime_group", "target_day")
ORDER_KEYS = tuple(k for k in KEYS if k != "gl_name")  # orders take the name from the master list
COLUMNS = ("ship_order", "latest_act", "region", "country_code", "channel", "gl_rollup", "gl_product_group", "gl_name",
           "prime_group", "target_day", "portfolio_id", "initiative", "units_fcst", "rev_fcst", "units_act", "rev_act")


@dataclass(frozen=True)
class Params:
    as_of: str | None = None          # None: the current date
    portfolios: int = 5
    pinned_portfolio: str = "20191229a"
    pinned_date: str = "2019-12-29"
    scenario: str = "2019 OP2"
    target_country: str = "US"
    countries: tuple[str, ...] = labels.NINE_COUNTRIES
    months_back: int = 25
    months_ahead: int = 13
    max_group: int = 990
    orders_channel_rule: bool = False  # orders count gross sales in every channel
    windowed: bool = True              # False: all days, for a view that is windowed when it is read

    def rows(self, t: Tables, fact: str, closed: bool) -> DataFrame:
        """Rows of a fact in the rolling window; actuals have no upper end."""
        first = calendar.months_from(self.as_of, -self.months_back) if self.windowed else None
        last = calendar.months_from(self.as_of, self.months_ahead) if closed and self.windowed else None
        return t.days(fact, (first, last)).filter(
            kept_products(self.max_group) & F.col("country_code").isin(*self.countries))


def ranked_portfolios(t: Tables) -> DataFrame:
    """Published portfolios, newest dataset first."""
    published = t.versions("shipment_forecasts").filter(
        (F.col("portfolio_status") == "PRODUCTION") & (F.col("is_latest_publish") == "Y"))
    return ranked(published.select("portfolio_id", "dataset_date").distinct(), newest("dataset_date"), name="portfolio_rank")


def ranked_forecasts(t: Tables, portfolios: DataFrame) -> DataFrame:
    """Last order forecast of each dataset that has a portfolio, ranked within its type."""
    kinds = [latest_id_per(t.versions(fact), "dataset_date", "forecast_id").withColumn("forecast_type", F.lit(kind))
             for fact, kind in (("orders_forecast_daily", "Baseline"), ("orders_forecast_adjusted", "Adjusted"))]
    listed = kinds[0].union(kinds[1]).join(portfolios.select("portfolio_id", "dataset_date"), "dataset_date")
    return ranked(listed, newest("dataset_date"), ["forecast_type"], "forecast_rank")


def _with_class(df: DataFrame) -> DataFrame:
    return df.withColumn("prime_group", labels.member_class(F.col("prime_group")))


def _sums(df: DataFrame, keys: tuple[str, ...], units: Column, revenue: Column, suffix: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(units).alias(f"units_{suffix}"), F.sum(revenue).alias(f"rev_{suffix}"))


def _shipment_measures() -> tuple[Column, Column]:
    return F.col("shipped_units"), measures.channel_revenue(
        F.col("channel"), F.col("product_revenue_amt"), F.col("gross_gms_amt"))


def _order_measures(p: Params) -> tuple[Column, Column]:
    gross = F.col("net_ordered_gms")
    basis = measures.channel_revenue(F.col("channel"), F.col("net_ops"), gross) if p.orders_channel_rule else gross
    return F.col("net_ordered_units"), basis


def _once(forecast: DataFrame, chosen: DataFrame) -> DataFrame:
    """Forecast rows that differ in dataset only, once.

    Groups are unique per portfolio and dataset, so only a portfolio of several datasets can have such rows; the short list
    ``chosen`` tells whether there is one, and without it no row is compared.
    """
    rows = forecast.drop("dataset_date")
    if chosen.groupBy("portfolio_id").agg(F.count_distinct("dataset_date").alias("n")).where("n > 1").isEmpty():
        return rows
    # hashed by the join keys first: that serves the distinct (on more columns) and the join, one exchange
    return rows.repartition(*KEYS).distinct()


def _shipments(t: Tables, p: Params, portfolios: DataFrame) -> tuple[DataFrame, DataFrame]:
    chosen = portfolios.filter((F.col("portfolio_rank") <= p.portfolios) | (F.col("portfolio_id") == p.pinned_portfolio))
    planned = _with_class(with_ids(p.rows(t, "shipment_forecasts", closed=True), chosen.select("portfolio_id", "dataset_date"),
                                   "portfolio_id", "dataset_date"))
    units, revenue = _shipment_measures()
    forecast = final_and_system(planned, ["portfolio_id", "dataset_date", *KEYS],
                                {"units_fcst": units, "rev_fcst": revenue}, F.col("initiative_type") == "Baseline")
    shipped = p.rows(t, "shipment_actuals", closed=False)
    return _once(forecast, chosen), stage(_sums(_with_class(shipped), KEYS, units, revenue, "act"), "shipped")


def _orders(t: Tables, p: Params, portfolios: DataFrame) -> tuple[DataFrame, DataFrame]:
    pinned = F.col("dataset_date") == F.lit(p.pinned_date).cast("date")
    chosen = stage(ranked_forecasts(t, portfolios).filter((F.col("forecast_rank") <= p.portfolios) | pinned)
                   .select("dataset_date", "forecast_id", "forecast_type", "portfolio_id"), "forecast-ids")
    units, revenue = _order_measures(p)
    keys = ("portfolio_id", "dataset_date", *ORDER_KEYS)

    def planned(fact: str, kind: str, name: str) -> DataFrame:
        rows = with_ids(p.rows(t, fact, closed=True).filter(F.col("forecast_type") == kind), chosen.filter(F.col("forecast_type") == kind),
                        "forecast_id", "dataset_date", "forecast_type")
        return (_sums(_with_class(rows), keys, units, revenue, "fcst")
                .select(*keys, F.lit(name).alias("initiative"), "units_fcst", "rev_fcst"))

    forecast = planned("orders_forecast_adjusted", "Adjusted", "Final").union(planned("orders_forecast_daily", "Baseline", "System"))
    sold = p.rows(t, "orders_actuals", closed=False).withColumnRenamed("order_day", "target_day")
    names = stage(canonical_names(t["gl_names"]), "names")
    actual = stage(_sums(_with_class(sold), ORDER_KEYS, units, revenue, "act"), "sold")
    return _once(forecast.join(names, "gl_product_group", "left"), chosen), actual.join(names, "gl_product_group", "left")


def _stream(name: str, forecast: DataFrame, actual: DataFrame) -> DataFrame:
    """Pair one stream's forecast and actual, and attach its freshness, which the staged groups of the actual hold.

    Forecast rows were merged before the join (:func:`_once`): the actual side is unique per key, so the order does not matter,
    and the narrower side is deduplicated.
    """
    paired = full_pair(forecast, actual, KEYS)
    last = actual.groupBy("country_code").agg(F.max("target_day").alias("latest_act"))
    return (paired.join(stage(last, "last-days"), "country_code", "left")
            .withColumn("ship_order", F.lit(name)).withColumn("region", labels.region(F.col("country_code"))))


def _both(t: Tables, p: Params) -> list[tuple[str, DataFrame, DataFrame]]:
    portfolios = stage(ranked_portfolios(t), "portfolios")
    return [("Shipments", *_shipments(t, p, portfolios)), ("Orders", *_orders(t, p, portfolios))]


def _finished(t: Tables, p: Params, streams: list[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    both = functools.reduce(DataFrame.union, [_stream(*s).select(*COLUMNS) for s in streams])
    rates = rates_of(t["fx_rates"], p.scenario, p.target_country, p.countries)
    priced = with_rate(both, rates, "left")
    money = {c: measures.converted_total(F.col(c)) for c in ("rev_fcst", "rev_act")}
    return numbers(priced.withColumns(money).select(*COLUMNS), "units_fcst", "rev_fcst", "units_act", "rev_act")


def report(t: Tables, p: Params = Params()) -> DataFrame:
    return _finished(t, p, _both(t, p))


def create_view(t: Tables, p: Params, root: str, view: str) -> DataFrame:
    """The report as a catalog view with its declared columns, whose window follows the current date at each read; ``<view>_at(date)`` gives that of
    another date. Stored are the paired rows of all days, and once more the actual rows alone: days past the window's end have no forecast.
    """
    p = replace(p, windowed=False)
    with run_scope(t.spark):
        streams = _both(t, p)
        paired = _finished(t, p, streams).withColumn("part", F.lit("paired"))
        alone = _finished(t, p, [(n, forecast.limit(0), actual) for n, forecast, actual in streams]).withColumn("part", F.lit("alone"))
        first, last = (f"add_months(trunc({{as_of}}, 'MONTH'), {m})" for m in (-p.months_back, p.months_ahead))
        shown = {c: f"`{c}`" for c in COLUMNS} | {"latest_act": f"CASE WHEN latest_act >= {first} THEN latest_act END"}
        rows = paired.union(alone)
        return sinks.publish_live(rows, root, view, shown, f"target_day >= {first} AND (target_day <= {last}) = (part = 'paired')")
