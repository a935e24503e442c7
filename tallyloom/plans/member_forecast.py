"""Membership flows and rates of published, test, daily and preview runs, with the actuals."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import calendar, labels, measures
from tallyloom.operators.selection import largest, latest_versions
from tallyloom.operators.staging import stage
from tallyloom.plans.common import SEGMENT, latest_sets
from tallyloom.sources.tables import Tables

COUNTS = ("cancel_count", "convert_in_count", "convert_out_count", "member_count", "start_count")
RATES = ("cancel_rate", "convert_in_rate", "convert_out_rate", "start_rate")
SCENARIOS = ("system", "final")
COLUMNS = (*SEGMENT, "target_day", "portfolio_id", "forecast_date", "scenario", "actuals_range", *COUNTS,
           "net_add_count", *RATES)


@dataclass(frozen=True)
class Params:
    published_since: str = "2018-12-31"
    pinned_days: tuple[str, ...] = ("2019-12-10",)
    previews: dict[str, str] = field(default_factory=dict)  # shown name -> set id
    since: str = "2015-01-01"
    skipped_countries: tuple[str, ...] = ("MX",)


def published_runs(sets: DataFrame, latest: DataFrame, since: str) -> DataFrame:
    """Runs of the newest set of each published portfolio, without backtests."""
    day = calendar.id_date(F.col("portfolio_id"))
    return (sets.join(latest, "set_id")
            .filter(labels.published_id(F.col("portfolio_id")) & calendar.on_or_after(day, since)
                    & (F.col("forecast_date") == day)))


def _newest_test(sets: DataFrame, latest: DataFrame, every: DataFrame) -> DataFrame:
    """Runs of the last portfolio, if that is a test portfolio."""
    last = latest.filter(F.col("portfolio_id") == largest(every, "portfolio_id"))
    return (sets.join(last, "set_id")
            .filter(F.contains(F.col("portfolio_id"), F.lit("pit"))
                    & (F.col("forecast_date") == calendar.id_date(F.col("portfolio_id")))))


def _newest_daily(sets: DataFrame, days: DataFrame, suffix: str) -> DataFrame:
    """Runs of the newest set of the last snapshot day."""
    last = days.filter(F.col("snapshot_day") == largest(days, "snapshot_day"))
    newest = latest_versions(last, ["snapshot_day"], "snapshot_day_set_created_time")
    text = F.date_format("snapshot_day", "yyyy-MM-dd")
    parts = [F.split_part(text, F.lit("-"), F.lit(i)) for i in (1, 2, 3)]
    return (sets.join(newest, "set_id").filter(F.col("forecast_date") == F.col("snapshot_day"))
            .withColumn("portfolio_id", F.concat(*parts, F.lit(suffix))))


def _preview(sets: DataFrame, name: str, set_id: str) -> DataFrame:
    """Runs of an unpublished set at its own last forecast date."""
    own = sets.filter(F.col("set_id") == set_id)
    return own.filter(F.col("forecast_date") == largest(own, "forecast_date")).withColumn("portfolio_id", F.lit(name))


def run_list(t: Tables, p: Params) -> DataFrame:
    sets = t["member_sets"].filter(F.col("scenario").isin(*SCENARIOS))
    latest = latest_sets(t["member_portfolio_sets"])
    days = t["member_snapshot_day_sets"]
    pinned = days.filter(F.col("snapshot_day").isin(*[F.lit(d).cast("date") for d in p.pinned_days]))
    kinds = [published_runs(sets, latest, p.published_since),
             _newest_test(sets, latest, t["member_portfolio_sets"]),
             _newest_daily(sets, pinned, ""), _newest_daily(sets, days, " Daily Run")]
    # the last forecast date of a preview set is looked up over all of its scenarios
    kinds += [_preview(t["member_sets"], name, s).filter(F.col("scenario").isin(*SCENARIOS)) for name, s in p.previews.items()]
    columns = ("portfolio_id", "set_id", "forecast_date", "scenario", "run_id")
    runs = kinds[0].select(*columns)
    for other in kinds[1:]:
        runs = runs.union(other.select(*columns))
    return runs.distinct()


def _net_add() -> Column:
    return measures.net_flow(F.col("start_count"), F.col("convert_in_count"), F.col("cancel_count"), F.col("convert_out_count"))


def report(t: Tables, p: Params = Params()) -> DataFrame:
    wanted, days = ~F.col("country_code").isin(*p.skipped_countries), (p.since, None)
    runs = stage(run_list(t, p), "member-runs").drop("set_id")
    last_actual = stage(t["member_actuals"].filter(wanted)
                        .groupBy("country_code").agg(F.max("snapshot_day").alias("last_actual")), "last-days")
    rates = (t.days("member_rates", days).filter(wanted).join(runs, "run_id")
             .select(*SEGMENT, "target_day", "portfolio_id", "scenario", *RATES))
    flows = t.days("member_runs", days).filter(wanted).join(runs, "run_id")
    rated = flows.join(rates, [*SEGMENT, "target_day", "portfolio_id", "scenario"], "left")
    forecast = (rated.join(last_actual, "country_code")
                .withColumn("actuals_range", F.when(F.col("target_day") <= F.col("last_actual"), 1).otherwise(0))
                .withColumn("net_add_count", _net_add()).select(*COLUMNS))
    actual = (t.days("member_actuals", days).filter(wanted)
              .withColumns({"portfolio_id": F.lit("Actuals"), "scenario": F.lit("Actuals"), "actuals_range": F.lit(1),
                            "forecast_date": F.lit(None).cast("date"), "net_add_count": _net_add(),
                            **{r: F.lit(None).cast("double") for r in RATES}}).select(*COLUMNS))
    # Set union: the scenarios of the branches differ, so equal rows can only occur within a branch. The
    # forecast branch is already spread by the join keys, a subset of its columns, and needs no new exchange.
    return forecast.distinct().union(actual.distinct())
