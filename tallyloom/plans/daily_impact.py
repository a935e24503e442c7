"""Daily order forecast beside the actual, up to the last actual day of each country."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import calendar, labels
from tallyloom.operators.joins import rates_of
from tallyloom.operators.staging import stage
from tallyloom.plans.common import canonical_names, kept_products, numbers, order_revenue, priced
from tallyloom.sources.tables import Tables

KEYS = ("country_code", "channel", "gl_product_group", "gl_rollup", "order_day")


@dataclass(frozen=True)
class Params:
    scenario: str = "2019 OP2"
    target_country: str = "US"
    year: int = 2020
    forecast_of_country: dict[str, int] = field(default_factory=lambda: {"JP": 5967})
    forecast_elsewhere: int = 6106
    max_group: int = 990

    def wanted_forecast(self) -> Column:
        own = F.lit(False)
        for country, forecast in self.forecast_of_country.items():
            own = own | ((F.col("forecast_id") == forecast) & (F.col("country_code") == country))
        rest = (F.col("forecast_id") == self.forecast_elsewhere) & ~F.col("country_code").isin(*self.forecast_of_country)
        return own | rest


def report(t: Tables, p: Params = Params()) -> DataFrame:
    rates = rates_of(t["fx_rates"], p.scenario, p.target_country)
    kept = kept_products(p.max_group)
    year = (calendar.year_start(p.year), calendar.year_end(p.year))
    actual = t.days("orders_actuals", year).filter(kept)
    last_day = stage(actual.groupBy("country_code").agg(F.max("order_day").alias("max_order_day")), "last-days")
    by_day = priced(actual.groupBy(*KEYS).agg(F.sum("net_ordered_units").alias("ordered_units_act"),
                                              F.sum(order_revenue()).alias("gms_act")), rates, "gms_act")
    planned = (t.days("orders_forecast_adjusted", year).filter(p.wanted_forecast() & kept)
               .withColumnRenamed("target_day", "order_day"))
    forecast = priced(planned.groupBy("dataset_date", *KEYS).agg(
        F.sum("net_ordered_units").alias("ordered_units_fcst"), F.sum(order_revenue()).alias("gms_fcst")), rates, "gms_fcst")
    # the cut comes before the big join: fewer days to pair
    cut = (forecast.join(last_day, "country_code")
           .filter(F.col("order_day") <= F.col("max_order_day")))
    paired = cut.join(by_day, list(KEYS), "left").join(canonical_names(t["gl_names"]), "gl_product_group", "left")
    shown = paired.withColumn("product_bucket", labels.product_bucket(F.col("gl_product_group")))
    return numbers(shown, "ordered_units_fcst", "gms_fcst", "ordered_units_act", "gms_act")
