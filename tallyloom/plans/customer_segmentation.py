"""Units, revenue and average members of customer segments by month, system and final scenario."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import calendar, labels, measures
from tallyloom.operators.grains import final_and_system
from tallyloom.operators.joins import rates_of, with_rate
from tallyloom.operators.selection import newest_rows, with_ids
from tallyloom.operators.staging import stage
from tallyloom.plans.common import SEGMENT, latest_sets, numbers
from tallyloom.sources.tables import Tables

KEYS = ("portfolio_id", "scenario", *SEGMENT, "tenure")
TENURE_PRODUCT = 14  # the product whose forecast rows show which tenures a segment has


@dataclass(frozen=True)
class Params:
    portfolios: int = 5
    creators: tuple[str, ...] = ("root",)
    scenario: str = "2020 OP2"
    target_country: str = "US"
    countries: tuple[str, ...] = labels.EIGHT_COUNTRIES
    rollups: tuple[str, ...] = labels.PHYSICAL_ROLLUPS
    max_group: int = 990
    first_year: int = 2019
    members_since: str = "2019-01-01"
    shock_since: str = "2018-01-01"
    shock_country: str = "US"


def portfolios(t: Tables, p: Params) -> DataFrame:
    published = t["portfolio_metadata"].filter(
        (F.col("portfolio_status") == "PRODUCTION") & F.col("created_by").isin(*p.creators) & (F.col("published") == "true"))
    return newest_rows(published.select("portfolio_id", "creation_date"), p.portfolios, "creation_date", "portfolio_id").select("portfolio_id")


def _days(p: Params) -> tuple[dt.date, None]:
    return calendar.year_start(p.first_year), None


def _forecast_rows(fact: DataFrame, p: Params, ids: DataFrame) -> DataFrame:
    """Refreshed forecasts of the listed portfolios, without backtests."""
    dated = F.try_to_date(F.col("forecast_date"), "yyyyMMdd") == calendar.id_date(F.col("portfolio_id"))
    return (fact.filter((F.col("cs_tag") == "Refresh") & dated & F.col("country_code").isin(*p.countries))
            .transform(lambda df: with_ids(df, ids, "portfolio_id")))


def _sales(t: Tables, p: Params, ids: DataFrame) -> DataFrame:
    rows = _forecast_rows(t.days("segment_forecast", _days(p)), p, ids).filter(
        F.col("gl_rollup").isin(*p.rollups) & (F.col("gl_product_group") < p.max_group))
    revenue = measures.channel_revenue(F.col("channel"), F.col("product_revenue_amt"), F.col("gross_gms_amt"))
    return final_and_system(rows, ["portfolio_id", *SEGMENT, "tenure", "target_day"],
                            {"shipped_units": F.col("shipped_units"), "gms": revenue},
                            F.col("initiative") == "baseline", names=("final", "system"), tag="scenario")


def _tenures(t: Tables, p: Params, ids: DataFrame) -> DataFrame:
    first_day = F.col("target_day") == F.try_to_date(F.col("forecast_date"), "yyyyMMdd")
    return (_forecast_rows(t.days("segment_forecast", (p.members_since, None)), p, ids).filter(
        (F.col("channel") == "ret") & (F.col("subchannel") == "ret") & (F.col("gl_rollup") == "med")
        & (F.col("gl_product_group") == TENURE_PRODUCT) & first_day)
        .groupBy("portfolio_id", *SEGMENT).agg(F.countDistinct("tenure").alias("tenure_count")))


def runs(t: Tables, p: Params) -> DataFrame:
    """System and final runs of the newest set of each published portfolio (backtests included)."""
    listed = latest_sets(t["member_portfolio_sets"]).filter(
        labels.published_id(F.col("portfolio_id")) & calendar.on_or_after(calendar.id_date(F.col("portfolio_id")), p.members_since))
    return (t["member_sets"].filter(F.col("scenario").isin("system", "final")).join(listed, "set_id")
            .select("portfolio_id", "scenario", "run_id"))


def _members(t: Tables, p: Params, ids: DataFrame) -> DataFrame:
    mine = stage(runs(t, p), "segment-runs")
    keys = [*KEYS, "target_day"]
    whole = (t.days("member_runs", _days(p)).filter((F.col("customer_group") == "npr") | (F.col("plan_status") == "free"))
             .withColumn("plan_status", labels.plan_status(F.col("customer_group"), F.col("plan_status")))
             .withColumn("tenure", F.lit("0")).join(mine, "run_id"))
    paid = (t.days("member_cohort_runs", _days(p)).filter(F.col("plan_status") == "paid").join(mine, "run_id")
            .join(stage(_tenures(t, p, ids), "tenures"), ["portfolio_id", *SEGMENT])
            .withColumn("tenure", labels.tenure_band(F.col("tenure_count"), F.col("target_day"), F.col("cohort_month"))))
    sums = [part.groupBy(*keys).agg(F.sum("member_count").alias("members")) for part in (whole, paid)]
    return sums[0].union(sums[1]).withColumn("days_in_month", calendar.days_in_month(F.col("target_day")))


def _shock(t: Tables, p: Params) -> DataFrame:
    return (t.days("member_shock", (p.shock_since, None)).filter(F.col("country_code") == p.shock_country)
            .withColumn("plan_status", labels.plan_status(F.col("customer_group"), F.col("plan_status")))
            .groupBy(*SEGMENT, "target_day").agg(F.sum("member_count").alias("shock"))
            .withColumn("tenure", F.lit("0")))


def report(t: Tables, p: Params = Params()) -> DataFrame:
    ids = stage(portfolios(t, p), "portfolios")
    joined = (_sales(t, p, ids).join(_members(t, p, ids), [*KEYS, "target_day"], "left")
              .join(_shock(t, p), [*SEGMENT, "tenure", "target_day"], "left"))
    priced = with_rate(joined, rates_of(t["fx_rates"], p.scenario, p.target_country, p.countries), "left")
    held = F.col("members") - F.coalesce("shock", F.lit(0))
    result = priced.groupBy(*KEYS, F.trunc("target_day", "month").alias("target_month")).agg(
        F.sum("shipped_units").alias("shipped_units"), F.sum(measures.converted_total(F.col("gms"))).alias("gms_usd"),
        measures.per_day(F.sum(held), F.avg("days_in_month")).alias("avg_members"))
    return numbers(result, "shipped_units", "gms_usd")
