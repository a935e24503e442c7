"""Category orders of this year beside last year, with extension groups and a trailing-week flag."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import calendar, labels
from tallyloom.operators.joins import beside_prior_year, rates_of, specific_or_default
from tallyloom.operators.staging import stage
from tallyloom.plans.common import kept_products, numbers, order_revenue, priced
from tallyloom.sources.tables import Tables

KEYS = ("country_code", "channel", "prime_group", "gl_custom_group", "gl_boss_group")
RAW_KEYS = ("country_code", "channel", "prime_group", "gl_product_group", "category_code")


@dataclass(frozen=True)
class Params:
    scenario: str = "2019 OP2"
    target_country: str = "US"
    countries: tuple[str, ...] = labels.YOY_COUNTRIES
    current_from: str = "2019-12-29"
    prior_from: str = "2018-12-30"
    prior_to: str = "2019-06-30"
    max_group: int = 991
    trailing_days: int = 7


def last_days(orders: DataFrame) -> DataFrame:
    """Last order day of each country, of order rows or of their list of days."""
    return orders.groupBy("country_code").agg(F.max("order_day").alias("max_order_day"))


def last_days_with_regions(orders: DataFrame, countries: tuple[str, ...] = labels.YOY_COUNTRIES) -> DataFrame:
    """Last order day of each country, and of each region the earliest of its countries' last days."""
    per_country = last_days(orders)
    area = F.when(F.col("country_code").isin(*labels.NORTH_AMERICA), "NA").otherwise("EU")
    per_region = (per_country.filter(F.col("country_code").isin(*countries))
                  .groupBy(area.alias("country_code")).agg(F.min("max_order_day").alias("max_order_day")))
    return per_region.union(per_country).distinct()


def with_groups(orders: DataFrame, t: Tables) -> DataFrame:
    """Attach the extension group (specific, wildcard or country default) and the boss flag, to rows or to groups of them."""
    named = specific_or_default(orders, t["promise_extension"], "promise_extension")
    bossed = named.join(t["boss_categories"], ["country_code", "gl_product_group", "category_code"], "left")
    return (bossed.withColumn("gl_boss_group", F.coalesce("boss", F.lit("No"))).drop("boss")
            .withColumnRenamed("promise_extension", "gl_custom_group"))


def report(t: Tables, p: Params = Params()) -> DataFrame:
    day = F.col("order_day")
    current = calendar.on_or_after(day, p.current_from)
    prior = calendar.within(day, p.prior_from, p.prior_to)
    in_scope = F.col("country_code").isin(*p.countries)
    orders = (t.days("orders_actuals", (p.current_from, None), (p.prior_from, p.prior_to))
              .filter(in_scope & kept_products(p.max_group)))
    # sums are linear: the lookups meet one row a day and raw key
    sums = orders.groupBy(*RAW_KEYS, "order_day").agg(F.sum("net_ordered_units").alias("act_units"), F.sum(order_revenue()).alias("act_gms"))
    paired = beside_prior_year(with_groups(sums, t), "order_day", KEYS, {c: F.col(c) for c in ("act_units", "act_gms")}, current, prior)
    paired = priced(paired, rates_of(t["fx_rates"], p.scenario, p.target_country), "act_gms_cy", "act_gms_py")
    # Region rows of last_days_with_regions carry region codes and cannot match a country.
    newest = stage(last_days(t.versions("orders_actuals").filter(current & in_scope)), "last-days")
    age = F.datediff(F.col("max_order_day"), F.col("target_day"))
    shown = (paired.join(newest, "country_code").filter(F.col("target_day") <= F.col("max_order_day"))
             .withColumn("t7", F.when(age < p.trailing_days, 1).otherwise(0))
             .withColumn("week", F.lpad(F.col("week").cast("string"), 2, "0")).drop("max_order_day"))
    return numbers(shown, "act_units_cy", "act_gms_cy", "act_units_py", "act_gms_py")
