"""Average members of recent portfolios and of the actuals at four date grains; a refresh job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import calendar, measures
from tallyloom.operators.grains import multi_grain
from tallyloom.operators.selection import largest, portfolio_list, recent_portfolios, with_ids
from tallyloom.operators.staging import run_scope, stage
from tallyloom.plans.common import latest_sets
from tallyloom.sources import sinks
from tallyloom.sources.tables import Tables

INTERNAL = "INTERNAL"
SATURDAY = 6


@dataclass(frozen=True)
class Params:
    mode: str = INTERNAL
    listed_since: str = "2019-06-01"
    since: str = "2017-01-01"
    tests: int = 5
    published: int = 5
    drafts: int = 1
    skipped_country: str = "MX"
    skipped_group: str = "npi"
    shock_country: str = "US"
    shock_since: str = "2018-01-01"


def portfolios(t: Tables, mode: str, since: str, tests: int = 5, published: int = 5, drafts: int = 1) -> DataFrame:
    """Pinned and newest published portfolios; internal runs also see tests and the newest draft."""
    listed = t.versions("shipment_forecasts")
    lists = [portfolio_list(listed, published, "PRODUCTION", since, latest_only=True)]
    if mode == INTERNAL:
        lists.append(portfolio_list(listed, tests, "TEST", since))
        lists.append(portfolio_list(listed, drafts, "DRAFT", since))
    return recent_portfolios(t["portfolio_pins"], *lists)


def runs(t: Tables, p: Params) -> DataFrame:
    """System runs of the newest set of each listed portfolio, without backtests."""
    ids = portfolios(t, p.mode, p.listed_since, p.tests, p.published, p.drafts)
    listed = latest_sets(t["member_portfolio_sets"]).join(ids, "portfolio_id")
    return (t["member_sets"].filter(F.col("scenario") == "system").join(listed, "set_id")
            .filter(F.col("forecast_date") == calendar.id_date(F.col("portfolio_id")))
            .select("portfolio_id", "run_id"))


def daily(t: Tables, p: Params) -> DataFrame:
    day = F.col("target_day")
    wanted = F.col("country_code") != p.skipped_country
    columns = ("portfolio_id", "country_code", "customer_group", "target_day", "member_count")
    planned = with_ids(t.days("member_runs", (p.since, None)).filter(wanted & (F.col("customer_group") != p.skipped_group)),
                       stage(runs(t, p), "member-runs"), "run_id").select(*columns)
    # whole weeks only: actuals end at the last Saturday
    last = largest(t.versions("member_actuals").filter((day >= F.lit(p.since).cast("date")) & (calendar.weekday(day) == SATURDAY)), "target_day")
    actual = (t.days("member_actuals", (p.since, last)).filter(wanted)
              .withColumn("portfolio_id", F.lit("Actuals")).select(*columns))
    return planned.union(actual)


def report(t: Tables, p: Params = Params()) -> DataFrame:
    keys = ["country_code", "customer_group"]
    members = multi_grain(daily(t, p), "target_day", ["portfolio_id", *keys], {"members": F.col("member_count")},
                          distinct_days="days_in_period")
    shocked = t.days("member_shock", (p.shock_since, None)).filter(F.col("country_code") == p.shock_country)
    shock = multi_grain(shocked, "target_day", keys, {"shock": F.col("member_count")})
    held = F.col("members") - F.coalesce("shock", F.lit(0))
    return (members.join(shock, ["date_granularity", *keys, "target_day"], "left")
            .select("date_granularity", "portfolio_id", "country_code", F.col("customer_group").alias("prime_group"),
                    "target_day", measures.per_day(held, F.col("days_in_period")).alias("avg_members")))


def refresh(t: Tables, p: Params, root: str) -> DataFrame:
    """Replace the stored result of the run mode."""
    target = sinks.target_name("members", p.mode)
    with run_scope(t.spark):
        return sinks.publish_version(report(t, p), f"{root}/{target}", target)
